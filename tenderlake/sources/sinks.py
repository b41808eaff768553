"""Sinks and table maintenance.

Tables live on shared storage (the folder named by ``spark.checkpoint.dir``
or any path the caller passes).  Writes are whole-job commits, so a lost
executor means a retried task, never a half-written table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import delete_path, path_exists


def _gkey(key: str, seq: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.concat(F.lit("#"), F.col(seq).cast("string")))


# ----------------------------------------------------------------- K01
def insert_if_absent(existing: DataFrame, batch: DataFrame, key: str, seq: str) -> DataFrame:
    """Rows of ``batch`` to append: first row per key inside the batch
    (by ``seq``), keys already in ``existing`` skipped, NULL keys always
    inserted.  ``count()`` of the result is the inserted count."""
    first = (batch.groupBy(_gkey(key, seq).alias("_g"))
                  .agg(F.min_by(F.struct(*[F.col(c) for c in batch.columns]), F.col(seq)).alias("_r"))
                  .select("_r.*"))
    ek = existing.select(F.col(key).alias("_ek")).where(F.col("_ek").isNotNull())
    keyed = first.where(F.col(key).isNotNull()).join(ek, F.col(key) == F.col("_ek"), "left_anti")
    return keyed.unionByName(first.where(F.col(key).isNull()))  # keyless rows stay out of the join


def append_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


# ----------------------------------------------------------------- K02
def upsert(existing: DataFrame, batch: DataFrame, key: str, seq: str) -> DataFrame:
    """Last write wins by key (batch after existing; within a side by
    ``seq``); NULL keys always kept.  One partial aggregate, no window."""
    u = (existing.withColumn("_side", F.lit(0))
         .unionByName(batch.withColumn("_side", F.lit(1)), allowMissingColumns=True))
    return last_write(u, key, seq, F.col("_side")).drop("_side")


def last_write(rows: DataFrame, key: str, seq: str, side: Column) -> DataFrame:
    """K02 over one frame that holds both sides (``side`` 0: table, 1: batch)."""
    g = F.coalesce(F.col(key).cast("string"),
                   F.concat(F.lit("#"), side.cast("string"), F.lit(":"), F.col(seq).cast("string")))
    return (rows.groupBy(g.alias("_g"))
                .agg(F.max_by(F.struct(*[F.col(c) for c in rows.columns]), F.struct(side, seq)).alias("_r"))
                .select("_r.*"))


# ----------------------------------------------------------------- K03
def to_bronze(df: DataFrame, raw: str, page: Column, collected_at: str, day: str) -> DataFrame:
    """Bronze rows ``ingest_seq, page, collected_at, raw, data``."""
    return df.select(F.col("ingest_seq"), page.cast("int").alias("page"),
                     F.lit(collected_at).alias("collected_at"), F.col(raw).alias("raw"),
                     F.to_date(F.lit(day)).alias("data"))


def bronze_append(df: DataFrame, path: str) -> None:
    append_table(df, path, "parquet", ["data"])


# ----------------------------------------------------------------- K04
def write_date(df: DataFrame, path: str, col: str = "data", reset=()) -> None:
    """Idempotent date-partitioned write: re-running a date replaces
    exactly the partitions present in ``df`` (dynamic overwrite).  Dates in
    ``reset`` are emptied first, so that a re-run without rows leaves none."""
    for date in reset:
        delete_path(df.sparkSession, f"{path}/{col}={date}")
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(col).parquet(path))


# ----------------------------------------------------------------- K05/K06
def write_csv(df: DataFrame, path: str, cols=None) -> None:
    """CSV with header and quoted text; ``cols`` keeps only those that
    exist.  Embedded quotes are doubled, multi-line text stays quoted."""
    if cols:
        df = df.select(*[c for c in cols if c in df.columns])
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("quoteAll", True).csv(path))


def write_jsonl(df: DataFrame, path: str, append: bool = True) -> None:
    """JSON lines, UTF-8 kept as is."""
    df.write.mode("append" if append else "overwrite").json(path)


# ----------------------------------------------------------------- K08
def write_by_slug(df: DataFrame, path: str, term: str) -> None:
    """One output folder per search term (``slug=<slug(term)>``)."""
    df.withColumn("slug", X.slug(F.col(term))).write.mode("overwrite").partitionBy("slug").parquet(path)


# ----------------------------------------------------------------- K09
def export_for_labelling(df: DataFrame, key: str, text: str, order: str, n: int = 100) -> DataFrame:
    """The first ``n`` notices as ``pncp_id, Objeto, Relevante=''``."""
    return (df.orderBy(order).limit(n)
              .select(F.col(key).alias("pncp_id"), F.col(text).alias("Objeto"), F.lit("").alias("Relevante")))


# ----------------------------------------------------------------- K10
BUCKET_BATCHES = 10_000


def save_batch_results(results: DataFrame, path: str, batch_col: str = "batch_id") -> None:
    """Results of whole batches.

    Each call is a run with folders of its own, by ranges of ``BUCKET_BATCHES``
    batch ids.  The ids that it finished are a small table beside the results,
    written after them from the run's own files; a run without that entry broke
    off and is never opened.
    """
    spark = results.sparkSession
    run = uuid.uuid4().hex
    own = f"{path}/results/_run={run}"
    results.withColumn("_bucket", F.floor(F.col(batch_col) / BUCKET_BATCHES)).write.partitionBy("_bucket").parquet(own)
    saved = spark.read.schema(results.schema).parquet(own)
    saved.select(batch_col).distinct().coalesce(1).write.parquet(f"{path}/finished/_run={run}")


def _finished(spark: SparkSession, path: str, batch_col: str) -> DataFrame:
    """One run per finished batch: that of the smallest run id where a batch was saved twice."""
    return spark.read.parquet(f"{path}/finished").groupBy(batch_col).agg(F.min("_run").alias("_run"))


def finished_batches(spark: SparkSession, path: str, batch_col: str = "batch_id") -> DataFrame | None:
    if not path_exists(spark, f"{path}/finished"):
        return None
    return _finished(spark, path, batch_col).select(batch_col)


def pending_batches(batches: DataFrame, done: DataFrame | None, batch_col: str = "batch_id") -> DataFrame:
    """Input rows whose batch is not saved yet."""
    return batches if done is None else batches.join(done, batch_col, "left_anti")


def load_results(spark: SparkSession, path: str, batch_col: str = "batch_id", first: int | None = None, last: int | None = None) -> DataFrame:
    """All results of finished batches in batch order, or those of batches
    ``first`` to ``last``.  Only the runs and folders that hold them are opened."""
    done = _finished(spark, path, batch_col)
    if first is not None:
        done = done.where(F.col(batch_col) >= first)
    if last is not None:
        done = done.where(F.col(batch_col) <= last)
    done = done.checkpoint()
    runs = [r["_run"] for r in done.select("_run").distinct().collect()]  # one per save
    results = spark.read.option("basePath", f"{path}/results").parquet(*[f"{path}/results/_run={r}" for r in runs] or [f"{path}/results"])
    bucket = F.col("_bucket")
    for end, keep in ((first, bucket.__ge__), (last, bucket.__le__)):
        if end is not None:
            results = results.where(keep(end // BUCKET_BATCHES))
    kept = results.join(done, [batch_col, "_run"], "left_semi")
    return kept.drop("_bucket", "_run").orderBy(batch_col)
