"""Counting kernels and the exact vocabulary against plain counts."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenderlake.functions import counting
from tenderlake.functions import text as X
from tenderlake.operators import model as M


def test_top_tokens_of_odd_rows(spark):
    rng = random.Random(1)
    rows = [[rng.choice("abcdefg") for _ in range(rng.randrange(0, 30))] for _ in range(200)] + [None, [], ["z"] * 1000, [""]]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, toks array<string>").repartition(3)
    for k in (1, 3, 50):
        got = {r.k: [(x.t, x.n) for x in r.top] for r in df.select("k", X.top_tokens(F.col("toks"), k).alias("top")).collect()}
        for i, toks in enumerate(rows):
            assert got[i] == Counter(toks or []).most_common(k), i  # ties: first seen


@pytest.mark.parametrize("lo,hi", [(1, 1), (1, 2), (2, 2), (1, 4), (3, 3)])
def test_grams_equal_plain_counts(lo, hi):
    rng = random.Random(lo * 10 + hi)
    lists = [[rng.choice(["a", "b", "é", "dd"]) for _ in range(rng.randrange(0, 12))] for _ in range(40)] + [None, []]
    want = [Counter(" ".join(t[i:i + n]) for n in range(lo, hi + 1) for i in range(len(t or []) - n + 1)) for t in lists]
    g = counting.Grams(pa.array(lists, pa.list_(pa.string())), lo, hi)
    total = Counter()
    for n, (key, _) in g.levels.items():
        keys, count = counting.groups(key)
        total.update(dict(zip(g.text(n, keys).to_pylist(), count.tolist())))
    assert total == sum(want, Counter())
    terms = [*total, "no such", "a x", "a a a a a a a a"]
    row, place, n = g.counts([t.split(" ") for t in terms])
    got = [Counter() for _ in lists]
    for r, p, c in zip(row, place, n):
        got[r][terms[p]] += int(c)
    assert got == want


def corpus(rng, n):
    vocabulary = [f"w{k}" for k in range(300)]
    weights = [1 / (k + 1) for k in range(300)]
    return [(k, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 40)))) for k in range(n)] + [(n, None), (n + 1, ""), (n + 2, "a b c"), (n + 3, "W1 w1, w1-W2")]


@pytest.mark.parametrize("kept", [5, 60, 100_000])
def test_vocabulary_is_exact_however_short_the_lists(spark, monkeypatch, kept):
    monkeypatch.setattr(counting, "SLICE_TOKENS", 300)
    rows = corpus(random.Random(kept), 150)
    df = spark.createDataFrame(rows, "id long, text string").repartition(4)
    grams = {k: [t for t in M_words(text)] for k, text in rows}
    tf = {k: Counter(g + [" ".join(p) for p in zip(g, g[1:])]) for k, g in grams.items()}
    total, found = sum(tf.values(), Counter()), Counter(t for c in tf.values() for t in c)
    top = sorted(total, key=lambda t: (-total[t], t))[:40]
    vocab = M.fit_vocab(df, "id", "text", 40, kept=kept)
    got = {r.term: (r.idx, r.idf) for r in vocab.collect()}
    assert sorted(got) == sorted(top)
    for k, t in enumerate(sorted(top)):
        assert got[t][0] == k and got[t][1] == pytest.approx(math.log((1 + len(rows)) / (1 + found[t])) + 1)
    weights = {(r.id, r.term): r.weight for r in M.tfidf(df, "id", "text", vocab).collect()}
    want = {}
    for k, c in tf.items():
        own = {t: n * got[t][1] for t, n in c.items() if t in got}
        norm = math.sqrt(sum(w * w for w in own.values()))
        want.update({(k, t): w / norm for t, w in own.items()})
    assert weights == pytest.approx(want)


def M_words(text):
    import re
    return re.findall(r"\b\w\w+\b", (text or "").lower())


def test_rare_grams_are_not_sent(spark):
    # every text has words of its own beside ten that all share
    df = spark.range(4000).select("id", F.concat_ws(" ", *[F.lit(f"comum{k}") for k in range(10)], *[F.concat(F.lit(f"raro{k}x"), "id") for k in range(10)]).alias("text")).repartition(4)
    sent = M._frequent(df.select(M.words("text").alias("_t")), (1, 2), 100)
    assert sent.count() <= 4 * 2 * 100 + 1
    assert {r.term for r in M.fit_vocab(df, "id", "text", 10, kept=100).collect()} <= {f"comum{k}" for k in range(10)} | {f"comum{k} comum{k + 1}" for k in range(9)}


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "id long, text string")
    vocab = M.fit_vocab(df, "id", "text", 10)
    assert vocab.count() == 0 and M.tfidf(df, "id", "text", vocab).count() == 0
    two = spark.createDataFrame([(1, "x"), (2, None)], "id long, text string")
    assert M.tfidf(two, "id", "text", M.fit_vocab(two, "id", "text", 10)).count() == 0
