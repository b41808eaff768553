"""Spark session helpers.

The engine never creates machine-local scratch space on a cluster: every
intermediate table is written below ``spark.checkpoint.dir`` (the shared
folder the cluster names).  Only a ``local[..]`` session without that setting
(tests) gets a folder of its own; elsewhere its absence is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "tenderlake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session used by tests, bench and the command line.

    UTC session zone (oracle parity for timestamps), AQE on (runtime
    coalescing + skew-join splitting), UI off (no server).  The number of
    shuffle partitions is left to the cluster unless it is given.
    """
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    compiled_methods(spark)
    return spark


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


def compiled_methods(spark: SparkSession) -> None:
    """Leave methods over 8,000 bytes out of whole-stage code, unless the session
    names a limit of its own: the JVM interprets such a method for good, and wide
    notice rows in one stage make methods of 30,000 bytes."""
    if spark.conf.get(HUGE_METHOD, None) is None:
        spark.conf.set(HUGE_METHOD, "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not re.match(r"local(\[.*\])?$", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="tenderlake-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for a written table."""
    return os.path.join(_scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder (its path is ``scratch``),
    read back: lineage ends here.  A reliable checkpoint would hold the rows uncompressed.  Shuffles that
    nobody refers to any more go once the driver collects its garbage."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    del df
    spark._jvm.System.gc()
    out = spark.read.schema(schema).parquet(path)
    out.scratch = path
    return out


def _scratch_root(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "tables", spark.sparkContext.applicationId)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, in whatever file system it names."""
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    fs, p = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def clean_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application.  Results are lazy: call
    it once they have been written or collected."""
    delete_path(spark, _scratch_root(spark))
