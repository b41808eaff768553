"""Dedupe, numbering, slicing and paging.

Dedupes are ``min_by`` aggregates (partial on the map side, so a hot key is
collapsed before the shuffle).  Global numbering never funnels the table
through one task: rows are range-partitioned and sorted, each row's
position inside its partition comes from ``monotonically_increasing_id``,
and per-partition offsets (one row per partition -- a proven size bound)
are broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

OFFSETS = 400_000  # a counted table of at most so many narrow rows goes to all tasks


def _gkey(key: str, seq: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.concat(F.lit("#"), F.col(seq).cast("string")))


# ----------------------------------------------------------------- W01
def dedupe_first(df: DataFrame, key: str, seq: str, empty_is_null: bool = True) -> DataFrame:
    """First row (lowest ``seq``) per key; rows without a key are all
    kept.  With ``empty_is_null`` an empty-string key counts as no key
    (Python truthiness)."""
    k = F.when(F.col(key) != "", F.col(key)) if empty_is_null else F.col(key)
    g = F.coalesce(k.cast("string"), F.concat(F.lit("#"), F.col(seq).cast("string")))
    return (df.groupBy(g.alias("_g"))
              .agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.col(seq)).alias("_r"))
              .select("_r.*"))


def dedupe_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """W01 counters: rows before, removed, after (one row)."""
    u = before.select(F.lit(True).alias("_b")).unionByName(after.select(F.lit(False).alias("_b")))
    c = u.agg(F.count_if(F.col("_b")).alias("antes"), F.count_if(~F.col("_b")).alias("depois"))
    return c.select("antes", (F.col("antes") - F.col("depois")).alias("removidos"), "depois")


# ----------------------------------------------------------------- W02
def fallback_key(df: DataFrame, fields, record_cols=None) -> Column:
    """W02 key: ``name:value`` of the first non-empty field among ``fields``,
    else ``hash:`` + canonical (key-sorted) JSON of the record."""
    parts = [F.when(F.col(f).cast("string") != "", F.concat(F.lit(f + ":"), F.col(f).cast("string")))
             for f in fields]
    cols = sorted(record_cols or df.columns)
    canon = F.to_json(F.struct(*[F.col(c) for c in cols]))
    return F.coalesce(*parts, F.concat(F.lit("hash:"), canon))


def _first_by_digest(df: DataFrame, key: Column, seq: str, keep=None) -> DataFrame:
    """First row per value of a long text: grouped on its SHA-256, so that the
    shuffle key has 32 bytes and only the kept row carries the text.  Of it, the
    columns ``keep`` (all by default) go through the shuffle."""
    digest = F.unhex(F.sha2(key.cast("binary"), 256))
    return (df.groupBy(digest.alias("_h"))
              .agg(F.min_by(F.struct(*[F.col(c) for c in keep or df.columns]), F.col(seq)).alias("_r"))
              .select("_r.*"))


def dedupe_fallback(df: DataFrame, fields, seq: str, keep=None) -> DataFrame:
    """Keep-first dedupe on the fallback key (never NULL).  The whole record
    makes the key; the kept rows have its columns ``keep`` (all by default) and
    ``_dedupe_key``."""
    x = df.withColumn("_dedupe_key", fallback_key(df, fields, [c for c in df.columns if c != seq]))
    return _first_by_digest(x, F.col("_dedupe_key"), seq, [*keep, "_dedupe_key"] if keep is not None else None)


# ----------------------------------------------------------------- W03/W04
def dedupe_text(df: DataFrame, text: str, seq: str) -> DataFrame:
    """Exact dedupe on the (already normalised) text, keep first."""
    return _first_by_digest(df, F.col(text), seq)


def dedupe_pairs(df: DataFrame, cols=("text", "label"), seq: str | None = None) -> DataFrame:
    """One row per (text, label) pair (first by ``seq`` when given)."""
    if seq is None:
        return df.dropDuplicates(list(cols))
    return (df.groupBy(*[F.col(c) for c in cols])
              .agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.col(seq)).alias("_r"))
              .select("_r.*"))


# ----------------------------------------------------------------- W05
def with_index(df: DataFrame, order, name: str = "idx", num_partitions: int | None = None,
               partition_by=None) -> DataFrame:
    """1-based row number in ``order`` (which must be total), globally
    or within each ``partition_by`` group -- without a single-task window.

    Rows are range-partitioned and sorted on (groups, order); a row's
    position inside its partition comes from ``monotonically_increasing_id``
    (partition id in the upper bits).  Per (partition, group) counts -- at
    most partitions x groups rows -- give each slice its offset by a running
    sum, joined back on (partition, group).  A group that is a third of the
    table is simply spread over many range partitions.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    groups = [F.col(g) if isinstance(g, str) else g for g in (partition_by or [])]
    gnames = [g if isinstance(g, str) else None for g in (partition_by or [])]
    keys = groups + order
    # Without an explicit count AQE sizes the range partitions from the data.
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    s = (ranged.sortWithinPartitions(*keys)
           .withColumn("_mid", F.monotonically_increasing_id())
           .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
           .withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid"), 33)))
    # Positions and per-partition counts must come from the SAME physical
    # layout: range bounds are sampled and AQE may coalesce differently per
    # evaluation, so the positioned rows are materialised once, as a compressed
    # table in the shared checkpoint folder (survives executor loss).
    s = stored(s, "positions")
    gcols = [c for c in gnames if c]
    counts = s.groupBy("_pid", *gcols).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    w = Window.partitionBy(*gcols).orderBy("_pid") if gcols else Window.orderBy("_pid")
    offs = counts.select("_pid", *gcols, "_first", F.coalesce(
        F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    if gcols:
        offs = stored(offs, "offsets")
    small = not gcols or offs.count() <= OFFSETS  # else all rows would be shuffled once more
    j = s.join(F.broadcast(offs) if small else offs, ["_pid", *gcols])
    return (j.withColumn(name, (F.col("_off") + F.col("_pos") - F.col("_first") + 1).cast("bigint"))
             .drop("_mid", "_pid", "_pos", "_off", "_first"))


# ----------------------------------------------------------------- W06
def slices(df: DataFrame, n: int, order, name: str = "slice") -> DataFrame:
    """``n`` contiguous slices; the first ``total % n`` are one row
    larger; empty slices do not exist (same split as ``ntile``).  Adds the
    0-based slice id, its offset and size."""
    x = with_index(df, order, "_i")
    cnt = df.count()  # one scalar
    q, r = divmod(cnt, n)
    i0 = F.col("_i") - 1
    big = r * (q + 1)
    sl = F.when(i0 < big, F.floor(i0 / (q + 1))).otherwise(
        F.lit(r) + F.floor((i0 - big) / F.lit(max(q, 1))))
    off = F.when(sl < r, sl * (q + 1)).otherwise(big + (sl - r) * q)
    size = F.when(sl < r, F.lit(q + 1)).otherwise(F.lit(q))
    return (x.withColumn(name, sl.cast("bigint"))
             .withColumn("slice_offset", off.cast("bigint"))
             .withColumn("slice_size", size.cast("bigint"))
             .withColumnRenamed("_i", "idx"))


# ----------------------------------------------------------------- W07/W08/W09
def batches(df: DataFrame, size: int, order, name: str = "batch_id") -> DataFrame:
    """Fixed-size batches in ``order`` (0-based batch id)."""
    x = with_index(df, order, "idx")
    return x.withColumn(name, F.floor((F.col("idx") - 1) / size).cast("bigint"))


def page(df: DataFrame, offset: int, limit: int | None, order) -> DataFrame:
    """LIMIT/OFFSET in ``order`` (limit None/0 = no limit), ``order`` total.

    The order columns alone are ranked (``with_index``: rows per range
    partition and their running sums).  The page's first and last rank are two
    rows of that index, and the page is the range between their values: a
    filter that reaches the scan, so nothing collects offset + limit rows and no
    partition holds a whole tail.  NULLs sort first, as in ``orderBy``.
    """
    order = [o if isinstance(o, str) else None for o in order]
    if None in order:
        raise ValueError("name the columns of the order")
    ranked = with_index(df.select(*order), order, "_rank")
    last = offset + limit if limit else None
    ends = {r["_rank"]: r for r in ranked.where(F.col("_rank").isin([offset + 1, *([last + 1] if limit else [])])).collect()}  # two rows
    if offset + 1 not in ends:
        return df.limit(0)
    inside = ~_before(order, ends[offset + 1])
    if last and last + 1 in ends:
        inside = inside & _before(order, ends[last + 1])
    return df.where(inside).orderBy(*order)


def _before(order: list[str], row) -> Column:
    """Whether a row comes before ``row`` in the order (ascending, NULL first)."""
    out = F.lit(False)
    for name in reversed(order):
        value = row[name]
        if value is None:  # nothing is less than NULL
            out = F.col(name).isNull() & out
        else:
            less = F.col(name).isNull() | (F.col(name) < F.lit(value))
            out = less | ((F.col(name) == F.lit(value)) & out) if name != order[-1] else less
    return F.coalesce(out, F.lit(False))


def progress(df: DataFrame, order, name: str = "pct") -> DataFrame:
    """Running count and percent done per record, in ``order``."""
    x = with_index(df, order, "done")
    cnt = df.count()
    return x.withColumn(name, F.round(F.col("done") * 100.0 / F.lit(max(cnt, 1)), 2))
