"""Date windows and adaptive range bisection.

Bisection needs no iteration: the candidate ranges are fixed by halving,
only the split decisions depend on the counts, so every day's chain of
enclosing ranges is counted in one aggregate and each day picks the first
range of its chain that is not split -- no nested-loop join, no driver
loop, no per-level jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _d(x) -> Column:
    return F.to_date(F.lit(x)) if isinstance(x, str) else x


# ----------------------------------------------------------------- T20
def date_windows(spark, lo: str, hi: str, days: int = 7) -> DataFrame:
    """Consecutive windows ``[start, min(start + days - 1, hi)]``
    covering ``[lo, hi]`` (end inclusive)."""
    s = F.explode(F.sequence(_d(lo), _d(hi), F.expr(f"INTERVAL {int(days)} DAYS")))
    base = spark.range(1).select(s.alias("inicio"))
    return base.select("inicio", F.least(F.date_add("inicio", days - 1), _d(hi)).alias("fim"))


def assign_windows(df: DataFrame, date_col: str, lo: str, hi: str, days: int = 7) -> DataFrame:
    """Each row's window (start, end) by arithmetic on the day number."""
    d = F.to_date(F.col(date_col))
    k = F.floor(F.datediff(d, _d(lo)) / days)
    start = F.date_add(_d(lo), (k * days).cast("int"))
    inside = (d >= _d(lo)) & (d <= _d(hi))
    return df.where(inside).withColumn("inicio", start).withColumn(
        "fim", F.least(F.date_add(start, days - 1), _d(hi)))


# ----------------------------------------------------------------- T21/T22
def daily_counts(df: DataFrame, date_col: str, groups=()) -> DataFrame:
    return df.groupBy(*groups, F.to_date(F.col(date_col)).alias("dia")).agg(F.count(F.lit(1)).alias("n"))


def bisect_ranges(daily: DataFrame, lo: str, hi: str, cap: int, max_depth: int = 6,
                  groups=(), starts: DataFrame | None = None) -> DataFrame:
    """Split ``[lo, hi]`` at its middle day while its row count is
    ``>= cap``, depth ``< max_depth`` and it spans more than one day.
    Returns the leaves ``groups..., lo, hi, depth, n, overflow`` (overflow
    when a leaf still holds ``>= cap`` rows).  ``daily`` has
    ``groups..., dia, n``; ``starts`` gives the groups (default: those in
    ``daily``).

    No iteration: the candidate ranges do not depend on the data (halving
    is fixed), only the decision to split does.  Every calendar day carries
    its chain of enclosing ranges (one per depth, computed by unrolled
    column expressions), the chain is exploded and counted per range in one
    aggregate, and each day's leaf is the first range of its chain that is
    not split.  The calendar is groups x days -- bounded by the date span,
    not by the data.
    """
    g = list(groups)
    if starts is None:
        starts = daily.select(*g).distinct() if g else daily.sparkSession.range(1).select()
    cal = starts.select(*g, F.explode(F.sequence(_d(lo), _d(hi))).alias("dia"))
    cal = cal.join(daily.select(*g, "dia", "n"), [*g, "dia"], "left").select(
        *g, "dia", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))
    # chain of enclosing ranges for each day: depth d -> (lo_d, hi_d), one
    # column pair per depth (each step reads the previous columns, so the
    # expressions stay small)
    x = cal.select(*g, "dia", "n", _d(lo).alias("lo0"), _d(hi).alias("hi0"))
    for d in range(1, max_depth + 1):
        plo, phi = F.col(f"lo{d - 1}"), F.col(f"hi{d - 1}")
        x = x.withColumn("_mid", F.date_add(plo, F.floor(F.datediff(phi, plo) / 2).cast("int")))
        left = F.col("dia") <= F.col("_mid")
        x = (x.withColumn(f"lo{d}", F.when(left, plo).otherwise(F.date_add(F.col("_mid"), 1)))
              .withColumn(f"hi{d}", F.when(left, F.col("_mid")).otherwise(phi)).drop("_mid"))
    chain = [F.struct(F.lit(d).alias("depth"), F.col(f"lo{d}").alias("lo"), F.col(f"hi{d}").alias("hi"))
             for d in range(max_depth + 1)]
    rows = x.select(*g, "dia", "n", F.explode(F.array(*chain)).alias("r")).select(
        *g, "dia", "n", "r.depth", "r.lo", "r.hi")
    counts = rows.groupBy(*g, "depth", "lo", "hi").agg(F.sum("n").cast("bigint").alias("n"))
    split = (F.col("n") >= cap) & (F.col("depth") < max_depth) & (F.col("hi") > F.col("lo"))
    flags = counts.select(*g, "depth", "lo", "hi", "n", split.alias("_split"))
    per_day = rows.select(*g, "dia", "depth", "lo", "hi").join(flags, [*g, "depth", "lo", "hi"])
    leaf = (per_day.where(~F.col("_split"))
                   .groupBy(*g, "dia")
                   .agg(F.min_by(F.struct("depth", "lo", "hi", "n"), F.col("depth")).alias("leaf")))
    return (leaf.select(*g, "leaf.depth", "leaf.lo", "leaf.hi", "leaf.n").distinct()
                .withColumn("overflow", F.col("n") >= cap))


def _within(df: DataFrame, date_col: str, lo, hi) -> DataFrame:
    d = F.to_date(F.col(date_col))
    return df.where((d >= _d(lo)) & (d <= _d(hi)))


def state_ranges(df: DataFrame, date_col: str, uf: str, lo, hi, cap: int, max_depth: int = 6) -> DataFrame:
    """The adaptive ranges of each state."""
    return bisect_ranges(daily_counts(_within(df, date_col, lo, hi), date_col, [uf]), lo, hi, cap, max_depth, groups=[uf])


def collect_by_state(df: DataFrame, date_col: str, key: str, uf: str, lo, hi, cap: int, max_depth: int = 6) -> DataFrame:
    """The notices that the leaves deliver, with their leaf, unique by key
    across leaves and states: the first by date, then state.  Rows without a
    key are all delivered.  A leaf that overflows still delivers its rows."""
    rows = _within(df, date_col, lo, hi).withColumn("_dia", F.to_date(F.col(date_col)))
    leaves = state_ranges(df, date_col, uf, lo, hi, cap, max_depth)
    days = leaves.select(F.col(uf).alias("_uf"), "lo", "hi", F.explode(F.sequence("lo", "hi")).alias("_day"))
    found = rows.join(days, F.col(uf).eqNullSafe(F.col("_uf")) & (F.col("_dia") == F.col("_day"))).drop("_uf", "_day", "_dia")
    first = F.min_by(F.struct(*[F.col(c) for c in found.columns]), F.struct(date_col, uf))
    keyed = found.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(first.alias("_r")).select("_r.*")
    return keyed.unionByName(found.where(F.col(key).isNull()))
