"""W08 pages against slices of the sorted rows."""

import random

import pytest
from pyspark.sql import functions as F

from tenderlake import session
from tenderlake.operators import dedupe as W


@pytest.mark.parametrize("columns", [["k", "n"], ["s", "k", "n"], ["n"]])
def test_pages_are_slices(spark, columns):
    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "", "a", "ab", "b'c"]), n) for n in range(120)]
    df = spark.createDataFrame(rows, "k long, s string, n long").repartition(7)
    at = {"k": 0, "s": 1, "n": 2}
    low = {"k": 0, "s": "", "n": 0}
    want = sorted(rows, key=lambda r: [(r[at[c]] is not None, low[c] if r[at[c]] is None else r[at[c]]) for c in columns])
    for offset, limit in [(0, 10), (0, None), (13, 1), (50, 40), (100, 50), (119, 5), (120, 5), (500, None), (7, 0), (3, None)]:
        got = [tuple(r) for r in W.page(df, offset, limit, columns).collect()]
        assert got == want[offset:offset + limit if limit else None], (offset, limit)


def test_page_has_no_limit_operator(spark):
    df = spark.range(1000).toDF("n")
    for limit in (None, 10):
        plan = W.page(df, 400, limit, ["n"])._jdf.queryExecution().executedPlan().toString()
        assert "CollectLimit" not in plan and "TakeOrdered" not in plan and "GlobalLimit" not in plan
    assert W.page(df.limit(0), 0, 5, ["n"]).count() == 0


def test_positions_are_kept_compressed(spark, tmp_path):
    """The numbered rows are one compressed table, and rows of few groups are not shuffled to be numbered."""
    held, before = [], W.stored
    W.stored = lambda df, name: held.append(before(df, name)) or held[-1]
    try:
        df = spark.range(3000).select("id", (F.col("id") % 3).alias("g"), F.concat(F.repeat(F.lit("notice text "), 100), F.col("id")).alias("raw"))
        got = W.with_index(df, ["id"], "i", num_partitions=4, partition_by=["g"])
        assert {(r.id, r.i) for r in got.select("id", "i").collect()} == {(k, k // 3 + 1) for k in range(3000)}
    finally:
        W.stored = before
    fs, p = session._hadoop(spark, held[0].scratch)
    assert fs.getContentSummary(p).getLength() < 3000 * 1200 / 20
    assert "BroadcastHashJoin" in got._jdf.queryExecution().toString()
