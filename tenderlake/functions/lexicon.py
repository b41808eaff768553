"""Dictionaries of many terms or patterns, matched in one pass over a text.

``Lexicon`` is an Aho-Corasick automaton over all terms of a dictionary: the
cost of a text is its length plus its hits, whatever the number of terms.
``PatternIndex`` finds, for every regular expression, literals of which each
match must contain one; a lexicon of these literals tells which expressions
can match at all, and only those are run.

Both are sent with the Arrow functions below, so Spark partitions the texts and
no term table is joined.
"""

from __future__ import annotations

import re
import sys
from functools import lru_cache
from operator import itemgetter

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SHORT = 4  # terms up to this length need word bounds
LEAST_LITERAL = 3


def _is_word(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def bounded(text: str, start: int, end: int) -> bool:
    """Whether ``\\b`` holds on both sides of ``text[start:end]``."""
    return ((start > 0 and _is_word(text[start - 1])) != _is_word(text[start])
            and (end < len(text) and _is_word(text[end])) != _is_word(text[end - 1]))


class Lexicon:
    """Terms (as given; the caller folds case) and those of them that need word bounds.

    Equal terms are one entry of the automaton with several places.  NULL and
    empty terms match nothing.
    """

    def __init__(self, terms, needs_bounds=lambda term: False):
        self.tree = ahocorasick.Automaton()
        self.places: list[tuple[int, ...]] = []
        self.size: list[int] = []  # length of a term that needs bounds, else 0
        at: dict[str, int] = {}
        for place, term in enumerate(terms):
            if not term:
                continue
            if term not in at:
                at[term] = len(self.places)
                self.tree.add_word(term, at[term])
                self.places.append(())
                self.size.append(len(term) if needs_bounds(term) else 0)
            self.places[at[term]] += (place,)
        if at:
            self.tree.make_automaton()
        self.any_bounds = any(self.size)

    def found(self, text: str) -> list[int]:
        """Places of the terms in ``text``, ascending."""
        if not text or not self.places:
            return []
        if not self.any_bounds:
            hits = set(map(itemgetter(1), self.tree.iter(text)))
        else:
            hits, size = set(), self.size
            for end, k in self.tree.iter(text):
                if k not in hits and (not size[k] or bounded(text, end + 1 - size[k], end + 1)):
                    hits.add(k)
        return sorted(p for k in hits for p in self.places[k])


# ----------------------------------------------------------------- patterns
@lru_cache(maxsize=1)
def _other_lower() -> tuple[re.Pattern, dict[int, str]]:
    """Lower-case characters that a case-insensitive pattern takes for another
    lower-case one (both have one upper case), and that other one."""
    table, first = {}, {}
    for cp in range(0x80, sys.maxunicode + 1):
        ch, up = chr(cp), chr(cp).upper()
        if ch.lower() == ch != up:
            low = first.setdefault(up, up.lower() if len(up.lower()) == 1 else ch)
            if low != ch:
                table[cp] = low
    return re.compile(f"[{''.join(map(chr, table))}]"), table


def one_case(text: str) -> str:
    """``text`` with one character for all that differ in case only."""
    if text.isascii():
        return text.lower()
    low = text.replace("\u0130", "i").lower()
    odd, table = _other_lower()
    return low.translate(table) if odd.search(low) else low


def required_literals(pattern: str, flags: int = re.IGNORECASE) -> frozenset[str] | None:
    """Strings of which every match of ``pattern`` contains one (in ``one_case``
    form), or None if no such set with strings of ``LEAST_LITERAL`` characters is seen."""
    parser = re._parser
    best = _best(_sequence(parser.parse(pattern, flags)))
    return best if best and min(map(len, best)) >= LEAST_LITERAL else None


def _best(found: list[frozenset[str]]) -> frozenset[str] | None:
    return max(found, key=lambda s: (min(map(len, s)), -len(s)), default=None)


def _sequence(items) -> list[frozenset[str]]:
    """Every set of which a match of the whole sequence contains one string."""
    found, run = [], []

    def close():
        if run:
            found.append(frozenset(["".join(run)]))
            run.clear()

    def walk(items):
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                run.append(one_case(chr(arg)))
            elif name in ("AT", "ASSERT", "ASSERT_NOT"):
                continue  # no width: what stands around it is still adjacent
            elif name == "SUBPATTERN":
                walk(arg[3])
            elif name == "ATOMIC_GROUP":
                walk(arg)
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] >= 1:
                if arg[0] == arg[1] == 1:
                    walk(arg[2])
                else:
                    close()
                    found.extend(_sequence(arg[2]))
            elif name == "BRANCH":
                close()
                ways = [_best(_sequence(way)) for way in arg[1]]
                if all(ways):
                    found.append(frozenset().union(*ways))
            else:
                close()

    walk(items)
    close()
    return found


class PatternIndex:
    """Named case-insensitive patterns behind a lexicon of their literals."""

    def __init__(self, patterns: dict[str, str]):
        self.names = list(patterns)
        self.run = [re.compile(p, re.IGNORECASE) for p in patterns.values()]
        literals = [required_literals(p) for p in patterns.values()]
        self.always = [k for k, s in enumerate(literals) if s is None]
        owned = [(k, lit) for k, s in enumerate(literals) if s for lit in sorted(s)]
        self.owner = [k for k, _ in owned]
        self.lexicon = Lexicon([lit for _, lit in owned])

    def candidates(self, text: str) -> list[int]:
        """Patterns that can match, in order."""
        return sorted({*self.always, *(self.owner[p] for p in self.lexicon.found(one_case(text)))})

    def found(self, text: str) -> list[int]:
        return [k for k in self.candidates(text) if self.run[k].search(text)]


# ------------------------------------------------------------------ columns
def _column(c: Column, finder, names: list) -> Column:
    """Names found in every text, in dictionary order; [] for NULL."""
    shown = pa.array(names, pa.string())

    def run(texts: pa.Array) -> pa.Array:
        flat, ends = [], [0]
        for text in texts.to_pylist():
            if text is not None:
                flat += finder.found(text)
            ends.append(len(flat))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), shown.take(pa.array(flat, pa.int64())))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<string>")(c)


def found_terms(c: Column, terms, needs_bounds=lambda term: False, names=None) -> Column:
    """``array<string>``: the terms (or their ``names``) in the text, in the order given."""
    terms = list(terms)
    return _column(c, Lexicon(terms, needs_bounds), list(terms if names is None else names))


def found_patterns(c: Column, patterns: dict[str, str]) -> Column:
    """``array<string>``: names of the patterns found in the text, in the order given."""
    return _column(c, PatternIndex(patterns), list(patterns))
