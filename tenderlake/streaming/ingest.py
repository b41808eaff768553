"""Structured Streaming forms of ingestion and resumable processing (ST1-ST4).

* ST1 ``stream_pages``: landed page files become records exactly once; the
  checkpoint (on shared storage) is the resume point.
* ST2 ``stream_dedupe``: state keyed by id in RocksDB; unbounded by default (as
  in the batch client), or bounded by a watermark when asked.
* ST3 ``stream_upsert``: ``foreachBatch`` into a keyed table
  (``sources.keyed``) with insert-if-absent (first write wins) or latest-wins: a
  micro-batch opens only files that may hold its keys.
* ST4 ``stream_relevance``: resumable classification; the ids processed are
  state of the stream, so the cost of a micro-batch does not grow with history.

Micro-batches are committed by id, so a replay does nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relevance as RV
from ..session import path_exists
from ..sources import keyed
from ..sources.pages import parse_pages

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_on_disk(spark: SparkSession) -> None:
    """Keep the state of stateful streams in RocksDB, unless the session names a
    state store.  A stream remembers its choice in its checkpoint."""
    if "HDFSBackedStateStoreProvider" in (spark.conf.get(STATE_STORE, None) or "HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")  # a commit writes its changes only


def stream_pages(spark: SparkSession, path: str, source: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """ST1: streaming read of landed page documents (one per line)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_pages(r.load(path), "value", source)


def stream_dedupe(sdf: DataFrame, key: str, watermark: tuple[str, str] | None = None) -> DataFrame:
    """ST2: drop repeated ids across micro-batches.

    With ``watermark`` (time column, delay) the state holds the ids of the delay
    only: rows later than that are dropped, and repeats within it found.
    Without it, every id is kept for good.
    """
    state_on_disk(sdf.sparkSession)
    if watermark:
        col, delay = watermark
        return sdf.withWatermark(col, delay).dropDuplicatesWithinWatermark([key])
    return sdf.dropDuplicates([key])


def _commits(out: str) -> str:
    return out.rstrip("/") + "_commits"


def _batch_done(spark: SparkSession, out: str, batch_id: int) -> bool:
    """Whether the commit log beside ``out`` names the micro-batch: a folder
    per committed batch, so the test is one file-system call."""
    return path_exists(spark, f"{_commits(out)}/batch={batch_id}")


def _commit(spark: SparkSession, out: str, batch_id: int) -> None:
    spark.range(1).select(F.lit(batch_id).alias("batch")).write.mode("overwrite").parquet(f"{_commits(out)}/batch={batch_id}")


def _append(df: DataFrame, out: str, batch_id: int) -> None:
    """One micro-batch as one partition folder: a replay after a failure
    replaces what the broken attempt left."""
    df.write.mode("overwrite").parquet(f"{out}/_batch_id={batch_id}")


def upsert_batch(batch: DataFrame, batch_id: int, path: str, key: str, seq: str, mode: str) -> None:
    """One micro-batch into the keyed table at ``path`` (K01 or K02 semantics)."""
    {"insert": keyed.insert, "latest": keyed.upsert}[mode](batch, path, key, seq, batch_id=batch_id)


def stream_upsert(sdf: DataFrame, path: str, key: str, seq: str, checkpoint: str, mode: str = "insert",
                  available_now: bool = True):
    """ST3: start the streaming upsert (``mode`` insert or latest); returns the
    StreamingQuery.  Read the table with ``keyed.read``."""
    if mode not in ("insert", "latest"):
        raise ValueError(mode)
    w = (sdf.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda b, i: upsert_batch(b, i, path, key, seq, mode)))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def relevance_batch(batch: DataFrame, batch_id: int, out: str, key: str, text: str, scorer) -> None:
    """ST4 micro-batch of ids that were not processed before: score once, append
    the relevant rows and log all ids with their status (R07)."""
    spark = batch.sparkSession
    if _batch_done(spark, out, batch_id):
        return
    new, status = RV.run_relevance(batch, batch.limit(0), key, text, scorer)
    _append(new, out, batch_id)
    _append(status, processed_log(out), batch_id)
    _commit(spark, out, batch_id)


def processed_log(out: str) -> str:
    """Folder of the processed ids of ``stream_relevance``: ``key, status``."""
    return out.rstrip("/") + "_processed"


def stream_relevance(sdf: DataFrame, out: str, key: str, text: str, scorer, checkpoint: str,
                     available_now: bool = True):
    """ST4: resumable classification as a stream (restart = checkpoint).  An id is
    processed once, whichever of its rows came first; rows without an id all are."""
    state_on_disk(sdf.sparkSession)
    new = sdf.where(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(sdf.where(F.col(key).isNull()))
    w = (new.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda b, i: relevance_batch(b, i, out, key, text, scorer)))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def run_to_sink(sdf: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"):
    """Plain append sink with ``availableNow`` (ST1/ST2 materialisation)."""
    return (sdf.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
               .outputMode("append").trigger(availableNow=True).start())
