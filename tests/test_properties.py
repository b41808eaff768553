"""Property tests (few examples each: every example runs Spark jobs)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenderlake.operators import dedupe as W
from tenderlake.operators import merge as J
from tenderlake.operators import model as M
from tenderlake.sources import sinks as K


@settings(max_examples=5, deadline=None)
@given(total=st.integers(min_value=0, max_value=40), n=st.integers(min_value=1, max_value=9))
def test_slices_cover(spark, total, n):
    rows = W.slices(spark.range(total), n, ["id"]).collect()
    b = sorted({(r.slice_offset, r.slice_size) for r in rows})
    assert len(rows) == total == sum(size for _, size in b)
    assert all(b[i][0] + b[i][1] == b[i + 1][0] for i in range(len(b) - 1))
    if b:
        assert max(s for _, s in b) - min(s for _, s in b) <= 1


@settings(max_examples=5, deadline=None)
@given(keys=st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=12))
def test_pending_plus_done_is_all(spark, keys):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "seq long, k string")
    done = spark.createDataFrame([("a",), ("c",)], "k string")
    p = {r.seq for r in J.pending(df, done, "k").collect()}
    d = {r.seq for r in J.already_done(df, done, "k").collect()}
    assert p | d == set(range(len(keys))) and not (p & d)


@settings(max_examples=5, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50)), min_size=1, max_size=10,
                     unique_by=lambda t: t[1]))
def test_upsert_idempotent(spark, rows):
    """upsert . upsert = upsert for keyed rows (NULL keys are always
    inserted, as with a UNIQUE column that admits many NULLs)."""
    batch = spark.createDataFrame(rows, "k string, seq long")
    empty = batch.limit(0)
    once = K.upsert(empty, batch, "k", "seq")
    twice = K.upsert(once, batch, "k", "seq")
    assert sorted((r.k or "", r.seq) for r in once.collect()) == sorted((r.k or "", r.seq) for r in twice.collect())


def test_stratified_split_partitions_input(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    s = M.stratified_split(df, "label", "doc_id").collect()
    assert len(s) == 200 and len({r.doc_id for r in s}) == 200
    for lab, n in ((0, 160), (1, 40)):
        test = sum(1 for r in s if r.label == lab and r.is_test)
        assert test == -(-n * 2 // 10)
