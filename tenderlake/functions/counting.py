"""Counting kernels over Arrow columns of token lists.

A batch's tokens are numbered once (one hash pass), and everything else is
arithmetic on arrays of numbers; strings come back only for what is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_TOKENS = 1 << 19


class Tokens:
    """The tokens of a list column: ``code`` and ``row`` of each, and the ``words`` behind the codes.  NULL lists are empty."""

    def __init__(self, lists: pa.Array):
        flat = pc.dictionary_encode(lists.flatten())
        self.rows = len(lists)
        self.words = flat.dictionary
        self.code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.row = np.repeat(np.arange(self.rows), self.size)


def groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the number of each."""
    key = np.sort(key)
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if key.size else np.zeros(0, np.int64)
    return key[cut], np.diff(np.append(cut, key.size))


def ranked(lists: pa.Array, k: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The ``k`` most frequent tokens of each list, ties by first place: (tokens, counts, list ends)."""
    t = Tokens(lists)
    width = max(len(t.words), 1)
    key = t.row * width + t.code
    order = np.argsort(key, kind="stable")
    key = key[order]
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if key.size else np.zeros(0, np.int64)
    n, first, row, code = np.diff(np.append(cut, key.size)), order[cut], key[cut] // width, key[cut] % width
    best = np.lexsort((first, -n, row))
    row, code, n = row[best], code[best], n[best]
    per = np.bincount(row, minlength=t.rows)
    keep = np.arange(row.size) - np.repeat(np.cumsum(per) - per, per) < k
    ends = np.concatenate([[0], np.cumsum(np.minimum(per, k))])
    return t.words.take(pa.array(code[keep])), n[keep], ends


def top_tokens(toks: Column, k: int) -> Column:
    """The ``k`` most frequent tokens with their counts, ties by first
    occurrence: ``array<struct<t, n>>`` in rank order ([] for NULL)."""

    def run(lists: pa.Array) -> pa.Array:
        words, n, ends = ranked(lists, k)
        pairs = pa.StructArray.from_arrays([words.cast(pa.string()), pa.array(n, pa.int32())], names=["t", "n"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    run.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<t: string, n: int>>")(toks)


# -------------------------------------------------------------------- n-grams
class Grams:
    """All grams of ``lo`` to ``hi`` neighbouring tokens of each list.

    ``levels[n]`` has the key of every n-gram and its row.  A key is (key of the
    first n - 1 tokens, numbered) * words + code of the last.
    """

    def __init__(self, lists: pa.Array, lo: int, hi: int):
        self.t, self.lo = Tokens(lists), lo
        self.width = max(len(self.t.words), 1)
        self.levels, self.numbered = {}, {}  # numbered: distinct keys of a level that a longer one is built on
        key = self.t.code
        for n in range(1, hi + 1):
            if n > 1:
                inside = self.t.row[n - 1:] == self.t.row[:self.t.row.size - n + 1]
                if n > 2:
                    self.numbered[n - 1], place = np.unique(shorter, return_inverse=True)
                    front = np.zeros(self.t.code.size, np.int64)
                    front[at] = place
                else:
                    front = self.t.code
                at = np.flatnonzero(inside)
                key = front[at] * self.width + self.t.code[at + n - 1]
            else:
                at = np.arange(key.size)
            shorter = key
            if n >= lo:
                self.levels[n] = (key, self.t.row[at])

    def text(self, n: int, key: np.ndarray) -> pa.Array:
        """The grams of some keys of level ``n``, tokens joined by a space."""
        last = self.t.words.take(pa.array(key % self.width if n > 1 else key))
        if n == 1:
            return last.cast(pa.string())
        front = key // self.width
        return pc.binary_join_element_wise(self.text(n - 1, self.numbered[n - 1][front] if n > 2 else front), last.cast(pa.string()), " ")

    def find(self, terms: list[list[str]]) -> list[tuple[int, int, int]]:
        """(level, key, place) of the terms (split into tokens) that this batch can have."""
        code = {w: k for k, w in enumerate(self.t.words.to_pylist())}
        out = []
        for place, term in enumerate(terms):
            n = len(term)
            codes = [code.get(w) for w in term]
            if n not in self.levels or None in codes:
                continue
            key = codes[0]
            for m, c in enumerate(codes[1:], 2):
                if m > 2:
                    own = self.numbered[m - 1]
                    at = int(np.searchsorted(own, key))
                    if at == own.size or own[at] != key:
                        break
                    key = at
                key = key * self.width + c
            else:
                out.append((n, key, place))
        return out

    def counts(self, terms: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place of the term, number) wherever a row has one of the terms, by row."""
        rows, places = [], []
        found = self.find(terms)
        for n, (key, row) in self.levels.items():
            own = sorted((k, p) for m, k, p in found if m == n)
            if own:
                known, place = (np.array(x, np.int64) for x in zip(*own))
                at = np.minimum(np.searchsorted(known, key), known.size - 1)
                hit = known[at] == key
                rows.append(row[hit])
                places.append(place[at[hit]])
        if not rows:
            return (np.zeros(0, np.int64),) * 3
        both, n = groups(np.concatenate(rows) * len(terms) + np.concatenate(places))
        return both // len(terms), both % len(terms), n


def token_slices(batches, col: str, limit: int | None = None):
    """Slices of record batches with about ``limit`` tokens of a list column each (one row at least)."""
    limit = limit or SLICE_TOKENS
    for batch in batches:
        at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(batch.column(col)), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi
