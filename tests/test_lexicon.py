"""Term automata and pattern literals against plain searches."""

import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from tenderlake.functions import fixed, lexicon
from tenderlake.functions import text as X
from tenderlake.operators import merge as J


def plain(text, terms, short):
    """Places of the terms by one search per term."""
    return [k for k, t in enumerate(terms) if t and (re.search(rf"\b{re.escape(t)}\b", text) if short(t) else t in text)]


def test_lexicon_equals_a_search_per_term():
    rng = random.Random(1)
    short = lambda t: len(t) <= 4
    for _ in range(300):
        alphabet = rng.choice(["ab", "ab ", "aé_1 -/", "xyz .…"])
        terms = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 7))) for _ in range(rng.randrange(0, 30))] + [None]
        lex = lexicon.Lexicon(terms, short)
        for _ in range(5):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60)))
            assert lex.found(text) == plain(text, terms, short)


def test_matched_keywords_keep_order_repeats_and_nulls(spark):
    kw = ["controle de acesso", "Facial", "acesso", None, "", "facial", "hid"]
    data = [("CONTROLE DE ACESSO facial",), (None,), ("",), ("hidhid acessos",), ("a\0hid\0b" * 50_000,)]
    df = spark.createDataFrame(data, "text string")
    assert [r[0] for r in df.select(X.matched_keywords("text", kw)).collect()] == [
        ["controle de acesso", "Facial", "acesso", "facial"], [], [], ["acesso"], ["hid"]]
    assert [r[0] for r in df.select(X.matched_keywords("text", [])).collect()] == [[]] * 5
    assert df.limit(0).select(X.matched_keywords("text", kw)).count() == 0


def test_a_hundred_thousand_terms_in_one_pass(spark):
    terms = spark.range(100_000).select(F.concat(F.lit("termo"), "id").alias("term"))
    docs = spark.createDataFrame([(1, "um termo99999x e termo5"), (2, "nada"), (3, "Termo12345")], "doc_id long, text string")
    pairs = J.match_pairs(docs, terms, "text")
    assert sorted((r.doc_id, r.keyword) for r in pairs.collect()) == sorted(
        [(1, f"termo{'99999'[:k]}") for k in range(1, 6)] + [(1, "termo5")] + [(3, f"termo{'12345'[:k]}") for k in range(1, 6)])
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Union" not in plan and "Join" not in plan


# ------------------------------------------------------------------ patterns
def test_one_case_joins_all_that_patterns_take_for_the_same():
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        for v in {c.lower(), c.upper(), c.title(), c.casefold(), c.upper().lower()}:
            if len(v) == 1 and v != c and re.fullmatch(re.escape(c), v, re.I):
                assert lexicon.one_case(c) == lexicon.one_case(v)


@pytest.mark.parametrize("pattern,want", [
    (r"\bmit license\b", {"mit license"}), (r"cat(?:raca)?s?", {"cat"}), (r"(?:abc|defg)x+", {"abc", "defg"}), (r"a.b", None), (r"[a-z]+", None),
    (r"x(?:abcd)*yz12", {"yz12"}), (r"x(?:abcd)+y", {"abcd"}), (r"(?:abc|.)de", None), (r"re(?=abc)abc", {"reabc"}), (r"(?P<n>GATE)(?P=n)", {"gate"}),
    (r"con(?:tr)ole", {"controle"}), (r"(?:ab){2}cd", None), (r"(?>atom)ic", {"atomic"}), (r"[xX]abc[^y]", {"abc"}), ("", None), (r"STRASSE|ſtraße", {"strasse", "straße"})])
def test_required_literals(pattern, want):
    assert lexicon.required_literals(pattern) == (want and frozenset(want))


def example(rng, items):
    """A random text that a parsed pattern matches."""
    out = ""
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "IN":
            kind, value = rng.choice(arg)
            out += chr(value) if str(kind) == "LITERAL" else chr(value[0]) if str(kind) == "RANGE" else {"CATEGORY_SPACE": " ", "CATEGORY_DIGIT": "7"}.get(str(value), "w")
        elif name == "SUBPATTERN":
            out += example(rng, arg[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(example(rng, arg[2]) for _ in range(rng.randrange(arg[0], min(arg[1], arg[0] + 2) + 1)))
        elif name == "BRANCH":
            out += example(rng, rng.choice(arg[1]))
        elif name == "ANY":
            out += "z"
    return out


def texts_near(rng, patterns):
    """Texts of matches and pieces of the patterns, in many cases."""
    parsed = [re._parser.parse(p, re.I) for p in patterns]
    pieces = [w for p in patterns for w in re.findall(r"[a-zà-ú0-9]{2,}", p)] + ["de", "x", "Ação", "ſ", "K", "ı"]
    for _ in range(400):
        t = " ".join(example(rng, rng.choice(parsed)) if rng.random() < 0.4 else rng.choice(pieces) for _ in range(rng.randrange(1, 12)))
        yield rng.choice([t, t.upper(), t.title(), t.replace("s", "ſ"), t.replace("k", "K"), t.replace("i", "İ")])


@pytest.mark.parametrize("dictionary", [fixed.POSITIVE_PATTERNS, fixed.NEGATIVE_PATTERNS])
def test_no_pattern_is_left_out_wrongly(dictionary):
    patterns = X.pattern_texts(dictionary)
    index = lexicon.PatternIndex(patterns)
    rng, hits = random.Random(2), 0
    for t in texts_near(rng, patterns.values()):
        want = [k for k, p in enumerate(patterns.values()) if re.search(p, t, re.I)]
        assert index.found(t) == want
        hits += len(want)
    assert hits > 300
    assert len(index.always) < len(patterns) / 4  # most have a literal
    assert index.candidates("nada que interesse") == index.always


def test_random_patterns_are_not_left_out():
    rng = random.Random(3)

    def make(depth):
        kind = rng.randrange(7 if depth else 2)
        if kind < 2:
            return re.escape("".join(rng.choice("abcİſk ") for _ in range(rng.randrange(1, 5))))
        inner = make(depth - 1)
        return [f"(?:{inner}|{make(depth - 1)})", f"(?:{inner}){rng.choice(['?', '*', '+', '{2}', '{1,3}'])}", inner + make(depth - 1),
                f"({inner})(?={make(0)}|.|$)", f"[abk]{inner}"][kind - 2]

    for _ in range(400):
        p = make(3)
        index = lexicon.PatternIndex({"p": p})
        for _ in range(20):
            t = "".join(rng.choice("abcABCiısſSkK ") for _ in range(40))
            assert bool(index.found(t)) == bool(re.search(p, t, re.I)), (p, t)


def test_regex_hits_of_nulls_and_empty_texts(spark):
    df = spark.createDataFrame([(None,), ("",), ("Controle-de_Acesso",)], "text string")
    got = [r[0] for r in df.select(X.regex_hits("text", {"a": ("flex", "controle de acesso"), "b": ("re", r"acesso$"), "c": ("re", "^$")})).collect()]
    assert got == [[], ["c"], ["a", "b"]]
