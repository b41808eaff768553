"""Shared pieces of the training-data operators.

Words are `[^\\x20\\x09-\\x0D]+` everywhere; only A-Z is lower-cased.  The
kernels below turn an Arrow string column into NumPy arrays once per slice of
about a megabyte of text, so that a task's memory is bounded by a slice (or by
the one text that is longer than that) and no Python loop runs per word.
"""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.session import delete_path, scratch_path

SLICE_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint8)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd multiplier of the rolling sums
_BASE_INV = pow(_BASE, -1, 1 << 64)


# ------------------------------------------------------------------ Spark side
def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SCOPES: list[list[str]] = []  # scratch tables of the open ``scratch`` scopes


def written(spark: SparkSession, df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` as a table in the shared folder, read back: lineage ends here."""
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


@contextmanager
def scratch(spark: SparkSession):
    """Tables that ``written`` makes inside are deleted at the end, but for those
    passed to ``keep``, the context's value, which go to the scope around it.

    Spark deletes the shuffles of jobs that nobody refers to when the driver
    collects its garbage, so that is asked for too.
    """
    own: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        own.remove(df.scratch)
        if len(_SCOPES) > 1:
            _SCOPES[-2].append(df.scratch)
        return df

    _SCOPES.append(own)
    try:
        yield keep
    finally:
        _SCOPES.pop()
        for path in own:
            delete_path(spark, path)
        spark._jvm.System.gc()


@contextmanager
def bucketed(spark: SparkSession, df: DataFrame, key: str, **options):
    """``df`` as a table bucketed by ``key``: joins on it do not move its rows.
    It lasts as long as the context."""
    name = f"scratch_{uuid.uuid4().hex}"
    buckets, path = int(spark.conf.get("spark.sql.shuffle.partitions")), scratch_path(spark, name)
    df.write.options(**options).bucketBy(buckets, key).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(spark, path)


def fold(col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a NULL id."""
    return F.crc32(col.cast("string").cast("binary")) % n


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) links: (node, root), root the smallest node.

    Each pass points every node at its smallest neighbour, follows the
    pointers by doubling, and contracts the links to the roots, so the number
    of passes is logarithmic.  All tables stay in Spark; only counts of
    changed rows reach the driver.
    """
    links = written(spark, edges.filter("a <> b").select("a", "b").distinct(), "cc-links")
    names = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(spark, both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.first("a"), F.min("b")).alias("root")), "cc-up")
        while True:
            nxt = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = written(spark, up.join(nxt, "root").select("node", F.col("top").alias("root"),
                                                               (F.col("top") != F.col("root")).alias("moved")), "cc-jump")
            moved = not jumped.filter("moved").isEmpty()
            up = jumped.select("node", "root")
            if not moved:
                break
        if names is None:
            names = up
        else:
            m = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            names = written(spark, names.join(m, "root", "left")
                            .select("node", F.coalesce("top", "root").alias("root")), "cc-names")
        ua, ub = (up.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        links = written(spark, links.join(ua, "a").join(ub, "b").filter("ra <> rb")
                        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "cc-links")
    if names is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return names


def joined(spark: SparkSession, names: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) after more links (a, b): only links between different roots are worked on."""
    for c in "ab":
        links = links.join(names.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")), c, "left").withColumn(f"r{c}", F.coalesce(f"r{c}", c))
    fresh = written(spark, links.filter("ra <> rb").select("a", "b", "ra", "rb").distinct(), "cc-fresh")
    if fresh.isEmpty():
        return names
    top = components(spark, fresh.select(F.col("ra").alias("a"), F.col("rb").alias("b"))).select(F.col("node").alias("root"), F.col("root").alias("top"))
    known = names.unionByName(fresh.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                              .join(names.select("node"), "node", "left_anti").withColumn("root", F.col("node")))
    return written(spark, known.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "cc-all")


class Shared:
    """An object of this package sent to the tasks once.

    Spark's broadcast pickles classes by reference, which needs the package on
    the workers; this sends the state only and the closure brings the class.
    """

    def __init__(self, spark: SparkSession, obj):
        self.kind, self.sent = type(obj), spark.sparkContext.broadcast(vars(obj))

    @property
    def value(self):
        obj = object.__new__(self.kind)
        obj.__dict__.update(self.sent.value)
        return obj

    def destroy(self) -> None:
        self.sent.destroy()


# ---------------------------------------------------------------- Arrow kernels
def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
SECOND = mix(np.arange(257, 513, dtype=np.uint64) * _GOLD)  # for a second, independent hash


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(batch: pa.RecordBatch, col: str, limit: int = SLICE_BYTES):
    """Consecutive slices of ``batch`` with about ``limit`` bytes of text each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each row; NULL is empty."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offs[0]:offs[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def words(col: pa.Array, chars: np.ndarray = LOWER, table: np.ndarray = _TABLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash of each word, its row, its length in bytes); words are
    lower-cased by default, ``AS_IS`` leaves them and another ``table`` gives other hashes."""
    data, offs = text_buffer(col)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not data.size:
        return none
    inside = ~SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = offs[:-1][offs[:-1] < data.size]
    start[first] = inside[first]
    at = np.flatnonzero(start)
    if not at.size:
        return none
    begin = np.cumsum(inside, dtype=np.int64)[at] - 1
    shown = chars[data[inside]]
    length = np.diff(np.append(begin, shown.size))
    pos = np.arange(shown.size, dtype=np.int64) - np.repeat(begin, length)
    value = table[shown] * powers(_BASE, int(length.max()))[pos]
    h = mix(np.add.reduceat(value, begin) + length.astype(np.uint64) * _GOLD)
    return h, np.searchsorted(offs, at, side="right") - 1, length


def runs(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``n`` words within a row, and its first word's index."""
    if h.size < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = h[:h.size - n + 1].copy()
    for k in range(1, n):
        acc = mix(acc) + h[k:h.size - n + 1 + k]
    keep = np.flatnonzero(row[:h.size - n + 1] == row[n - 1:])
    return mix(acc[keep] + np.uint64(n)), keep


def runs_at(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the windows of ``n`` words that start at ``at``."""
    acc = h[at]
    for k in range(1, n):
        acc = mix(acc) + h[at + k]
    return mix(acc + np.uint64(n))


def pack(x: np.ndarray) -> bytes:
    """A sorted unsigned array as compressed byte planes of its differences."""
    gaps = np.diff(x, prepend=x.dtype.type(0))
    return _planes(gaps)


def unpack(raw: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack_plain(raw, dtype), dtype=dtype)


def pack_plain(x: np.ndarray) -> bytes:
    """An unsigned array as compressed byte planes."""
    return _planes(x)


def _planes(x: np.ndarray) -> bytes:
    most = int(x.max()) if x.size else 0
    width = max(1, (most.bit_length() + 7) // 8)
    raw = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return x.size.to_bytes(8, "little") + width.to_bytes(1, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_plain(raw: bytes, dtype) -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), raw[8]
    planes = np.frombuffer(pa.decompress(raw[9:], n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    full = np.zeros((n, 8), np.uint8)
    full[:, :width] = planes.T
    return full.view("<u8").ravel().astype(dtype)


def rolling(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums for Karp-Rabin windows of any length: see ``window``."""
    q = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * powers(_BASE, x.size)[:x.size], dtype=np.uint64)])
    return q, powers(_BASE_INV, x.size + 1)


def window(rolled: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``n`` values."""
    q, inv = rolled
    return (q[n:] - q[:-n]) * inv[:q.size - n]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def local_path(uri: str) -> str | None:
    """Path of a file: URI or plain path; None for any other store."""
    if re.match(r"[a-z0-9+.-]+:", uri, re.I):
        m = re.match(r"file:/*(/.*)", uri)
        return m[1] if m else None
    return uri
