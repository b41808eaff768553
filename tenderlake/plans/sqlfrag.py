"""DuckDB SQL fragments mirroring the native Column operators (oracle side).

Parity notes (see SURVEY 7.3): RE2's ``\\b`` is ASCII-only, so word
boundaries are spelled with Unicode letter/number classes; ``strip_accents``
keeps a few letters that NFKD drops, so non-ASCII is deleted afterwards.
"""

from __future__ import annotations

import re

from ..functions import text as X

NW = r"[^\p{L}\p{N}_]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


def fold(x: str) -> str:
    return rf"regexp_replace(strip_accents(lower(trim({x}))), '[^\x00-\x7F]', '', 'g')"


def squash(x: str) -> str:
    return rf"coalesce(trim(regexp_replace({x}, '\s+', ' ', 'g')), '')"


def squash_lower(x: str) -> str:
    return f"lower({squash(x)})"


def re2(java_pattern: str) -> str:
    """Java regex (with \\b) -> RE2 with Unicode-aware boundaries."""
    p = java_pattern
    flags = ""
    m = re.match(r"^\(\?[a-zA-Z]+\)", p)
    if m:
        flags = "(?i)" if "i" in m.group(0) else ""
        p = p[m.end():]
    if p.startswith(r"\b"):
        p = f"(?:^|{NW})" + p[2:]
    if p.endswith(r"\b"):
        p = p[:-2] + f"(?:{NW}|$)"
    return flags + p


def regex_hits(x: str, patterns: dict, sep: str = ", ") -> str:
    """Names of matching patterns, in order, as a list expression."""
    pats = X.compile_patterns(patterns)
    items = [f"CASE WHEN regexp_matches({x}, {q(re2(p))}) THEN {q(n)} END" for n, p in pats.items()]
    return f"list_filter([{', '.join(items)}], lambda v: v IS NOT NULL)"


def term_hits(x: str, terms) -> str:
    items = [f"CASE WHEN contains({x}, {q(t)}) THEN {q(t)} END" for t in terms]
    return f"list_filter([{', '.join(items)}], lambda v: v IS NOT NULL)"


def matched_keywords(x: str, keywords, boundary_short: bool = True) -> str:
    items = []
    for kw in keywords:
        kl = kw.lower()
        if boundary_short and len(kl) <= 4:
            cond = f"regexp_matches(lower({x}), {q('(?:^|' + NW + ')' + re.escape(kl) + '(?:' + NW + '|$)')})"
        else:
            cond = f"contains(lower({x}), {q(kl)})"
        items.append(f"CASE WHEN {cond} THEN {q(kw)} END")
    return f"list_filter([{', '.join(items)}], lambda v: v IS NOT NULL)"


def clean_text(x: str, stopwords) -> str:
    return (rf"array_to_string(list_filter(string_split_regex(regexp_replace(lower({x}), '[^a-zÀ-ú\s]', ' ', 'gi'), '\s+'), "
            rf"lambda t: regexp_full_match(t, '[a-zÀ-ú]+') AND length(t) > 2 AND NOT list_contains({sql_list(stopwords)}, t)), ' ')")


def tokens(x: str, stopwords) -> str:
    return (f"list_filter(regexp_extract_all({fold(x)}, '[a-zA-Z0-9]+'), "
            f"lambda t: length(t) > 2 AND NOT list_contains({sql_list(stopwords)}, t))")


def categorize(x: str, categories, default: str) -> str:
    f = fold(x)
    whens = []
    for name, terms in categories:
        cond = " OR ".join(f"contains({f}, {q(t)})" for t in terms)
        whens.append(f"WHEN {cond} THEN {q(name)}")
    return "CASE " + " ".join(whens) + f" ELSE {q(default)} END"
