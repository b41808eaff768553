"""Operator 3 - quality rules with risk-controlled thresholds (native).

A rule rejects a text whose feature exceeds a cutoff.  Cutoffs come from a
fixed grid, chosen per stratum (``lang``; NULL is a stratum) on the labelled
holdout: a cutoff is certified if the exact binomial tail P(Bin(n, risk) <= k)
of its k false rejections among the stratum's n good texts is at most
``delta`` divided by the number of all (stratum, rule, cutoff) tests
(Bonferroni).  ``alpha`` is shared out among the rules, so with probability
1 - ``delta`` no stratum loses more than ``alpha`` of its good texts to all
rules together.  Of the certified cutoffs the one that rejects most of the bad
minus the good is used; without a certified cutoff that helps, a rule is off
in that stratum.

Features are computed once per text in one pass of array expressions and
written without the text; labels meet that narrow table.

The bound is for independent draws.  Where a corpus holds copies, ``once`` makes
those of a text in a stratum one labelled text (told by a 64-bit hash; a clash
merges two of the holdout); the query does so.

Defined cases: NULL or empty text has no words and fails the base rule; a text
whose labels disagree counts as good; NULL labels are ignored; no labels at
all leaves the base rule only; rows that repeat are judged each; other columns
are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read, written

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
ALPHA, DELTA, GRID = 0.05, 0.05, 50
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_capitals")
#: rule -> (feature, largest cutoff); cutoffs are the GRID + 1 steps from 0 to it
RULES = {
    "symbols": ("n_symbols / word_chars", 1.0),
    "dup_lines": ("n_dup_lines / n_lines", 1.0),
    "repeats": ("n_repeat_words / n_words", 1.0),
    "marks": ("n_marks / n_words", 2.0),
    "capitals": ("n_capitals / word_chars", 1.0),
}


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, stratum, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ...) of (doc_id, text, lang).

    Repeated words: hashes of all three-word windows are sorted with their
    places; a window equal to its neighbour repeats, and the places of those
    windows, sorted again, cover min(3, distance to the next) words each.
    The arrays are bound by one-element transforms, so each is built once.
    """
    text = F.coalesce("text", F.lit(""))

    def bound(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), 0)

    def repeats(w: Column) -> Column:
        n = F.size(w)
        windows = F.array_sort(F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
                                           lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))

        def covered(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        def places(s: Column) -> Column:
            marked = F.transform(s, lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]))
            return F.array_sort(F.array_compact(marked))

        return F.when(n < 4, 0).otherwise(bound(bound(windows, places), covered))

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    base = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string").alias("stratum"), text.alias("text"))
    per = bound(words, lambda w: F.struct(F.size(w).alias("n_words"), repeats(w).alias("n_repeat_words")))
    line = bound(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    rows = base.select("doc_id", "stratum", F.xxhash64("text").alias("text_hash"), per.alias("w"), line.alias("l"),
                       F.length(F.translate("text", SPACES, "")).alias("word_chars"),
                       F.regexp_count("text", F.lit(SYMBOLS)).alias("n_symbols"),
                       F.regexp_count("text", F.lit("[!?|=;:]")).alias("n_marks"),
                       F.regexp_count("text", F.lit(r"\p{Lu}")).alias("n_capitals"))
    return rows.select("doc_id", "stratum", "text_hash", *[F.col(c).cast("long").alias(c.split(".")[-1]) for c in (
        "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", "n_marks", "n_capitals")])


def log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series at x + 9, and the product of the factors between."""
    y, few = x.cast("double") + 9, F.lit(0.0)
    for k in range(1, 9):
        few = few + F.log(x + k)
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - few


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact but for rounding (n times 1e-15, relative).

    Away from the mode the terms fall, faster with every step: below it they are
    summed from k downwards, above it those over k upwards and taken from 1, in
    both cases for some twelve standard deviations, a number that grows with the
    square root of n only.
    """
    low = k < F.floor((n + 1) * p)
    b = F.when(low, k).otherwise(F.least(k + 1, n))  # the first term
    left = F.when(low, b).otherwise(n - b)
    steps = F.least(left, F.ceil(12 * F.sqrt(n * p * (1 - p)) + 60)).cast("int")
    first = log_factorial(n) - log_factorial(b) - log_factorial(n - b) + b * math.log(p) + (n - b) * math.log1p(-p)
    odds = F.when(low, F.lit((1 - p) / p)).otherwise(F.lit(p / (1 - p)))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] * (left - j + 1) / (n - left + j) * odds
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    more = F.when(steps > 0, F.sequence(F.lit(1), F.greatest(steps, F.lit(1)))).otherwise(F.expr("array()").cast("array<int>"))
    side = F.exp(first) * F.aggregate(more, start, add, lambda acc: acc["total"])
    return F.when(k >= n, 1.0).when(low, F.least(F.lit(1.0), side)).otherwise(F.greatest(F.lit(0.0), 1 - side))


def _feature(rule: str) -> Column:
    over, under = (x.strip() for x in RULES[rule][0].split("/"))
    return F.coalesce(F.try_divide(F.col(over).cast("double"), F.col(under).cast("double")), F.lit(0.0))


def thresholds(rows: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, once: bool = False) -> DataFrame:
    """(stratum, rule, cutoff, n_good, k, tail): the certified cutoffs in use; with
    ``once``, copies of a text in a stratum are one labelled text."""
    truth = labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long")).agg(F.max("quality").alias("good"))
    held = rows.join(truth.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id")).filter(~base_failed())
    if once:  # one draw per text: its features are equal, and it is good if any of its labels says so
        held = held.groupBy("stratum", "text_hash").agg(F.max("good").alias("good"), *[F.first(c).alias(c) for c in MEASURES])
    # the first grid step that does not reject a text; counts of steps, then a running sum over the small grid
    step = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.least(F.lit(GRID + 1), F.ceil(F.round(_feature(r) * GRID / RULES[r][1], 9))).alias("step")) for r in RULES]))
    counts = (held.select("stratum", "good", step.alias("s")).groupBy("stratum", "s.rule", "s.step")
              .agg(F.sum("good").alias("g"), F.sum(1 - F.col("good")).alias("b")))
    per = counts.groupBy("stratum", "rule").agg(F.collect_list(F.struct("step", "g", "b")).alias("c"),  # GRID + 2 steps at most
                                                F.sum("g").alias("n_good"), F.sum("b").alias("n_bad"))
    grid = per.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(GRID))))

    def over(field: str) -> Column:
        return F.aggregate(F.filter("c", lambda x: x["step"] > F.col("at")), F.lit(0).cast("long"), lambda a, x: a + x[field])

    grid = written(rows.sparkSession, grid.select("stratum", "rule", "at", "n_good", "n_bad", over("g").alias("k"), over("b").alias("caught")), "quality-grid")
    tests, risk = max(1, grid.count()), alpha / len(RULES)
    gain = F.coalesce(F.try_divide(F.col("caught"), F.col("n_bad")), F.lit(0.0)) - F.coalesce(F.try_divide(F.col("k"), F.col("n_good")), F.lit(0.0))
    sure = (grid.withColumn("tail", binomial_tail(F.col("k"), F.col("n_good"), risk))
            .filter((F.col("tail") <= delta / tests) & (gain > 0)).withColumn("gain", gain))
    best = sure.groupBy("stratum", "rule").agg(F.max_by(F.struct("at", "n_good", "k", "tail"), F.struct("gain", "at")).alias("x"))
    top = reduce(lambda e, r: e.when(F.col("rule") == r, RULES[r][1]), RULES, F.when(F.lit(False), 0.0))
    return best.select("stratum", "rule", (F.col("x.at") * top / GRID).alias("cutoff"), F.col("x.at").alias("at"), "x.n_good", "x.k", "x.tail")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(docs: DataFrame, labels: DataFrame, once: bool = False) -> DataFrame:
    """Features, ``base_failed``, ``kept`` and the rules that reject, of every row of ``docs``."""
    spark = docs.sparkSession
    rows = written(spark, features(docs), "quality-features")
    cut = written(spark, thresholds(rows, labels, once=once), "quality-cutoffs")
    per = cut.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "at"))).alias("cuts"))  # one entry per rule
    out = rows.join(per.withColumnRenamed("stratum", "_s"), F.col("stratum").eqNullSafe(F.col("_s")), "left")
    steps = {r: F.ceil(F.round(_feature(r) * GRID / RULES[r][1], 9)) for r in RULES}
    failed = F.array_compact(F.array(*[F.when(steps[r] > F.col("cuts")[r], F.lit(r)) for r in RULES]))
    out = out.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def query(spark, sf_dir: str) -> DataFrame:
    out = judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), once=True)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      F.concat_ws(",", "failed_rules").alias("failed_rules"))
