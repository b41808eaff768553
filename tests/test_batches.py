"""Saves and loads of batch results."""

from pyspark.sql import functions as F

from tenderlake.sources import sinks as K


def rows(df):
    return [(r.batch_id, r.v) for r in df.collect()]


def test_saves_and_loads_open_their_own_files(spark, tmp_path):
    path = str(tmp_path / "r")
    assert K.finished_batches(spark, path) is None
    make = lambda lo, hi, v: spark.range(lo, hi).select((F.col("id") * 4000).alias("batch_id"), F.lit(v).alias("v"))
    K.save_batch_results(make(0, 4, "a"), path)
    K.save_batch_results(make(4, 8, "b"), path)
    K.save_batch_results(make(0, 0, "none"), path)
    # a run that broke off before its entry, with other results of a finished batch
    make(2, 9, "broken").withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"{path}/results/_run=0broken")
    assert sorted(r.batch_id for r in K.finished_batches(spark, path).collect()) == [k * 4000 for k in range(8)]
    assert rows(K.load_results(spark, path)) == [(k * 4000, "ab"[k > 3]) for k in range(8)]
    assert not any("broken" in f for f in K.load_results(spark, path).inputFiles())
    part = K.load_results(spark, path, first=20_000, last=24_000)
    assert rows(part) == [(20_000, "b"), (24_000, "b")]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan
    pending = K.pending_batches(make(6, 10, "c"), K.finished_batches(spark, path))
    assert sorted(r.batch_id for r in pending.collect()) == [32_000, 36_000]


def test_a_batch_saved_twice_is_read_once(spark, tmp_path):
    path = str(tmp_path / "r")
    for v in "xy":
        K.save_batch_results(spark.createDataFrame([(1, v), (1, v + "2")], "batch_id long, v string"), path)
    got = rows(K.load_results(spark, path))
    assert got in ([(1, "x"), (1, "x2")], [(1, "y"), (1, "y2")]) or sorted(got) in ([(1, "x"), (1, "x2")], [(1, "y"), (1, "y2")])
