"""Text operators: Column -> Column.

All are native expressions, but for keyword and pattern dictionaries, whose
automata (``lexicon``), and token counts, whose kernels (``counting``), run in
Arrow batches.
Java regex notes: ``(?U)`` gives Unicode ``\\s``/``\\b``/``\\w`` like
Python's ``re``; ``(?iu)`` gives Unicode case-insensitivity.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import counting, fixed, lexicon

WS = r"(?U)\s+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's str.isspace() accepts (built by rule, BMP).
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (a linear trim from both ends, no regex pass over the text)."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def squash(c) -> Column:
    """Collapse whitespace runs to one space and trim; NULL -> ''."""
    return F.coalesce(strip(F.regexp_replace(_c(c), WS, " ")), F.lit(""))


def squash_lower(c) -> Column:
    """T02 (+lower): the rule/regex cleaner's text form."""
    return F.lower(squash(c))


# ------------------------------------------------------------------ folding
@lru_cache(maxsize=1)
def _fold_tables():
    """(source characters, their ASCII character, first entry of each block of
    256 code points or nothing, entries of the blocks that have any), by rule:
    every code point whose NFKD form holds ASCII characters; entries are for
    those with several."""
    one, many = {}, {}
    for cp in range(0x80, sys.maxunicode + 1):
        ascii_part = "".join(x for x in unicodedata.normalize("NFKD", chr(cp)) if x < "\x80")
        if len(ascii_part) == 1:
            one[chr(cp)] = ascii_part
        elif ascii_part:
            many[cp] = ascii_part
    used = sorted({cp >> 8 for cp in many})
    first = [str(used.index(b) << 8) if b in used else "" for b in range(used[-1] + 1)]
    return "".join(one), "".join(one.values()), first, [many.get(b << 8 | low, "") for b in used for low in range(256)]


def fold_raw(c) -> Column:
    """NFKD + drop non-ASCII, without lower/strip.

    Most characters map to one ASCII character (one ``translate``).  Texts
    with anything else outside ASCII are cut at it: a ligature, fraction or
    the like is looked up by its code point, the rest goes.
    """
    src, dst, first, entries = _fold_tables()
    x = F.translate(_c(c), src, dst)
    sep = "\x1f"  # in no entry
    starts, flat = F.split(F.lit(sep.join(first)), sep), F.split(F.lit(sep.join(entries)), sep)  # constants
    def looked_up(p: Column) -> Column:
        start = F.get(starts, F.shiftright(F.ascii(p), 8)).try_cast("int")
        return F.coalesce(F.get(flat, start + F.ascii(p).bitwiseAND(255)), F.lit(""))

    def rest(y: Column) -> Column:
        pieces = F.regexp_extract_all(y, F.lit(r"[^\x00-\x7F]|[\x00-\x7F]+"), 0)
        ascii_only = F.transform(pieces, lambda p: F.when(p < "\x80", p).otherwise(looked_up(p)))
        return F.when(y.rlike(r"[^\x00-\x7F]"), F.array_join(ascii_only, "")).otherwise(y)

    return bound(x, rest)


def fold(c) -> Column:
    """Lower, strip, accent-fold to ASCII; NULL/'' -> ''."""
    return F.coalesce(fold_raw(strip(F.lower(_c(c)))), F.lit(""))


def fold_squash(c) -> Column:
    """Fold then collapse whitespace (accent-insensitive filter form)."""
    return squash(fold(c))


# --------------------------------------------------------------- ML cleaner
def clean_text(c, stopwords=None) -> Column:
    """Lower; non-letters -> space; letter tokens; drop stop-words and
    tokens of <= 2 chars; join by one space.  NULL -> ''."""
    sw = list(fixed.CLEANER_STOPWORDS if stopwords is None else stopwords)
    x = F.regexp_replace(F.lower(_c(c)), r"(?iu)[^a-zÀ-ú\s]", " ")
    toks = F.regexp_extract_all(x, F.lit(r"\b[a-zÀ-ú]+\b"), 0)
    keep = F.filter(toks, lambda t: (F.length(t) > 2) & ~t.isin(sw) if sw else F.length(t) > 2)
    return F.coalesce(F.array_join(keep, " "), F.lit(""))


def raw_tokens(c) -> Column:
    """Alphanumeric runs of the folded text (before the T04 token filter)."""
    return F.regexp_extract_all(fold(c), F.lit(r"[a-zA-Z0-9]+"), 0)


def token_keep(t: Column, stopwords=None) -> Column:
    """T04 token filter as a row predicate (len > 2, not a stop-word)."""
    sw = list(fixed.TOKEN_STOPWORDS if stopwords is None else stopwords)
    return (F.length(t) > 2) & ~t.isin(sw)


def tokens(c, stopwords=None) -> Column:
    """Tokens of the folded text: ``[a-zA-Z0-9]+``, len > 2, no stop-words."""
    return F.filter(raw_tokens(c), lambda t: token_keep(t, stopwords))


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where ``use``
    needs it inside lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def top_tokens(toks: Column, k: int) -> Column:
    """The ``k`` most frequent tokens with their counts, ties by first
    occurrence: ``array<struct<t, n>>`` in rank order."""
    return counting.top_tokens(toks, k)


# ------------------------------------------------------------ keyword match
def matched_keywords(c, keywords, boundary_short: bool = True) -> Column:
    """Keywords found in lower(text), in dimension order.

    Terms of <= 4 characters need word boundaries (when ``boundary_short``),
    longer ones match as substrings; NULL and empty ones never match.  One pass
    per text for any number of terms.  NULL/'' text -> [].
    """
    keywords = list(keywords)
    short = (lambda term: len(term) <= lexicon.SHORT) if boundary_short else (lambda term: False)
    return lexicon.found_terms(F.lower(_c(c)), [k and k.lower() for k in keywords], short, keywords)


def flex_pattern(term: str) -> str:
    """Regular expression of a phrase whose words may be apart: the phrase
    is escaped as a whole, each escaped gap becomes the flexible separator, and
    both ends are word-bounded."""
    gap = r"(?:\\\s)+"
    return rf"\b{re.sub(gap, lambda _: fixed.SEP, re.escape(term.strip()))}\b"


def pattern_texts(d: dict) -> dict:
    """name -> regular expression for a dictionary of ``(kind, text)`` entries
    where kind is ``flex`` or ``re``."""
    entries = {name: v if isinstance(v, tuple) else ("re", v) for name, v in d.items()}
    return {name: flex_pattern(text) if kind == "flex" else text for name, (kind, text) in entries.items()}


def compile_patterns(d: dict) -> dict:
    """``pattern_texts`` as case-insensitive Java patterns with Unicode classes."""
    return {name: "(?iU)" + p for name, p in pattern_texts(d).items()}


def regex_hits(c, patterns: dict) -> Column:
    """Names of the dictionary patterns found in the text, in order
    (case-insensitive).  A pattern runs only on texts that hold a literal which
    each of its matches must contain."""
    return lexicon.found_patterns(_c(c), pattern_texts(patterns))


def reason_text(arr, n: int, prefix: str = "") -> Column:
    """First ``n`` names joined by ', ' (optionally prefixed)."""
    j = F.array_join(F.slice(_c(arr), 1, n), ", ")
    return F.concat(F.lit(prefix), j) if prefix else j


# ---------------------------------------------------------------- category
def categorize(c, categories=None, default: str | None = None) -> Column:
    """First category of the ordered dictionary whose term is contained
    in the folded text; else the default ("outros")."""
    cats = fixed.CATEGORIES if categories is None else categories
    dflt = fixed.DEFAULT_CATEGORY if default is None else default
    t = fold(c)
    expr = None
    for name, terms in cats.items() if isinstance(cats, dict) else cats:
        cond = None
        for term in terms:
            k = t.contains(term)
            cond = k if cond is None else (cond | k)
        if cond is None:
            continue
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.lit(dflt) if expr is None else expr.otherwise(F.lit(dflt))


def slug(c) -> Column:
    """Fold, lower, non-alphanumeric runs -> '_', strip '_'; '' -> 'termo'."""
    x = strip(F.lower(fold_raw(_c(c))))
    x = F.regexp_replace(x, r"[^a-z0-9]+", "_")
    x = F.regexp_replace(x, r"^_+|_+$", "")
    return F.when(F.coalesce(x, F.lit("")) == "", F.lit("termo")).otherwise(x)


# ------------------------------------------------------------------ labels
def parse_label(c) -> Column:
    """Whitespace removed; all '0' -> 0, all '1' -> 1, else NULL."""
    s = F.regexp_replace(_c(c).cast("string"), r"(?U)\s+", "")
    return (F.when(s.rlike("^0+$"), F.lit(0))
             .when(s.rlike("^1+$"), F.lit(1))
             .otherwise(F.lit(None).cast("int")))


def bool_label(c) -> Column:
    """True -> 1, False -> 0, anything else -> NULL."""
    x = _c(c)
    return F.when(x == F.lit(True), F.lit(1)).when(x == F.lit(False), F.lit(0)).otherwise(
        F.lit(None).cast("int"))


def title_case(c) -> Column:
    """Python ``str.title()``: each run of letters gets an upper-case first
    letter and lower-case rest; other characters unchanged."""
    parts = F.regexp_extract_all(_c(c), F.lit(r"\p{L}+|[^\p{L}]+"), 0)
    fixed_parts = F.transform(parts, lambda p: F.when(
        p.rlike(r"^\p{L}"),
        F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30))))
        .otherwise(p))
    return F.array_join(fixed_parts, "")


# --------------------------------------------------------- response parser
def parse_response(c, valid=None) -> Column:
    """Classifier response text -> struct(relevante int, categoria, motivo, ok).

    Code fences are removed; the JSON must parse to an object; ``relevante``
    follows Python ``int()``: bool -> 0/1, integer as is, float truncated,
    integer-looking string parsed; missing -> 0; null or other text -> the
    error row (0, NULL, error text).  ``categoria`` outside the closed set
    -> NULL.
    """
    vals = list(fixed.SCORER_CATEGORIES if valid is None else valid)
    t = strip(_c(c))
    t = F.when(t.startswith("```"), strip(F.regexp_replace(t, r"(?m)^```[^\n]*(\n|$)", ""))).otherwise(t)
    v = F.try_parse_json(t)
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    rv = F.try_variant_get(v, "$.relevante", "variant")
    rtype = F.schema_of_variant(rv)
    present = rv.isNotNull()
    rstr = F.try_variant_get(v, "$.relevante", "string")
    rel = (F.when(~present, F.lit(0))
            .when(F.is_variant_null(rv), F.lit(None).cast("int"))
            .when(rtype == "BOOLEAN", F.when(rstr == "true", 1).otherwise(0))
            .when(rtype.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | rtype.startswith("DECIMAL")
                  | rtype.isin("DOUBLE", "FLOAT"),
                  F.try_variant_get(v, "$.relevante", "double").cast("long").cast("int"))
            .when(rtype == "STRING",
                  F.when(strip(rstr).rlike(r"^[+-]?\d+$"), strip(rstr).cast("int")))
            .otherwise(F.lit(None).cast("int")))
    ok = is_obj & rel.isNotNull()
    cat = F.try_variant_get(v, "$.categoria", "string")
    cat_type = F.schema_of_variant(F.try_variant_get(v, "$.categoria", "variant"))
    cat = F.when((cat_type == "STRING") & cat.isin(vals), cat)
    mv = F.try_variant_get(v, "$.motivo", "variant")
    motivo = (F.when(mv.isNull(), F.lit(""))
               .when(F.is_variant_null(mv), F.lit("None"))
               .otherwise(F.try_variant_get(v, "$.motivo", "string")))
    err = F.concat(F.lit("Erro ao parsear resposta da API: "),
                   F.when(v.isNull(), F.lit("invalid JSON")).otherwise(F.lit("invalid relevante")))
    return F.struct(
        F.when(ok, rel).otherwise(F.lit(0)).alias("relevante"),
        F.when(ok, cat).alias("categoria"),
        F.when(ok, motivo).otherwise(err).alias("motivo"),
        ok.alias("ok"),
    )
