"""Operator 8 - mixing sources to target weights with pivotal dependent rounding.

A source's rate is its target over its size.  Every text gets the whole part
of the rate as copies; the rest is its fractional copy probability.  Rounding
moves probability mass, weighted by size, between two units until one is
integral; a fair two-way draw keeps each text's expected copies, and the
source's expected words stay exact at every step:

* leaves: about ``LEAF`` texts of one source (a large source has many leaves).
  The longest open text is paired with the block of all shorter ones, so it
  becomes integral and the block, which shares one probability, takes the
  difference; what stays open at the end is a single short text;
* inner nodes of the tree: the open texts of up to ``LEAF`` leaves are paired
  with each other, level by level, until one is open per source, which one
  draw settles.

A source's words thus miss its target by less than one short text.  Draws are
hashes of the seed and the ids, so reruns and retries agree.

Defined cases: NULL text counts 0 words; NULL source is a source (last in the
order); an empty source or text takes 0 words; a text never gets more than 2
copies; rows that repeat count each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tenderlake.operators.dedupe import with_index

from .common import mix, read, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
LEAF = 1024
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"
UNIT = "row long, doc_id long, source string, size long, leaf long, p double, tie long"


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, texts, target) of (source, size); one row per source.

    A target is min(most * size, level * weight) with the level at which the
    targets add up; the level is the first, in order of cap per weight, that no
    remaining source exceeds.  Only one row per source is ordered globally.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("texts"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    src = src.select("*", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")).alias("weight"),
                     (most * F.col("source_size")).cast("double").alias("cap"), (share * F.sum("source_size").over(W.partitionBy())).alias("total"))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_cap.rowsBetween(W.unboundedPreceding, -1), by_cap.rowsBetween(W.currentRow, W.unboundedFollowing)
    src = src.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    src = src.withColumn("level", F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("cap") / F.col("weight"))).over(W.partitionBy()))
    return src.select("source", "source_size", "texts",
                      F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def _draw(level: int, a: np.uint64, b: np.uint64) -> float:
    with np.errstate(over="ignore"):
        h = mix(mix(mix(np.array([SEED * 1000 + level], np.uint64)) + a) + b)
    return float(h[0] >> np.uint64(11)) / (1 << 53)


def _step(p: float, w: float, q: float, v: float, u: float) -> tuple[float, float]:
    """One pivotal step of (p, weight w) and (q, weight v): w p + v q is kept, one becomes 0 or 1."""
    up, down = min(1 - p, q * v / w), min(p, (1 - q) * v / w)
    move = up if u * (up + down) < down else -down
    p2, q2 = p + move, q - move * w / v
    if (move > 0 and up == 1 - p) or (move < 0 and down == p):
        return float(move > 0), min(1.0, max(0.0, q2))
    return min(1.0, max(0.0, p2)), float(move < 0)


def round_leaf(size: np.ndarray, p: float, key: np.ndarray) -> np.ndarray:
    """Probabilities after rounding the texts of a leaf (sizes descending, one common
    probability): 0 or 1 but for one text at most."""
    out = np.zeros(size.size)
    rest = np.concatenate([np.cumsum(size[::-1].astype(float))[::-1], [0.0]])
    q = p
    for i in range(size.size - 1):
        a, q = _step(q, float(size[i]), q, rest[i + 1], _draw(0, key[i], key[i + 1]))
        out[i] = a
        if q in (0.0, 1.0):  # the block is settled; text i may stay open
            out[i + 1:] = q
            return out
    if size.size:
        out[-1] = q
    return out


def round_units(size: np.ndarray, p: np.ndarray, key: np.ndarray, level: int) -> np.ndarray:
    """Pairwise pivotal rounding of open units: 0 or 1 but for one at most."""
    out = p.astype(float).copy()
    held = 0
    for j in range(1, out.size):
        if 0 < out[held] < 1:
            out[held], out[j] = _step(out[held], float(size[held]), out[j], float(size[j]), _draw(level, key[held], key[j]))
        if not 0 < out[held] < 1:
            held = j
    return out


def copies(sizes: DataFrame, rates: DataFrame) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, copies) of (row, doc_id, source, size) and ``targets``."""
    spark = sizes.sparkSession
    r = rates.withColumnRenamed("source", "_source").withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    leaves = F.ceil(F.col("texts") / LEAF)
    rows = (sizes.join(r, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("tie", F.xxhash64("doc_id", "source", "size"))
            .withColumn("base", F.floor("rate")).withColumn("p", F.col("rate") - F.floor("rate")))
    # rows that agree in all three are told apart by their place among them, so that they meet in no leaf
    again = written(spark, rows.groupBy("tie").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("tie"), "mix-again")
    if not again.isEmpty():
        placed = with_index(rows.join(again, "tie").select("tie", "row"), ["row"], "place", partition_by=["tie"])
        placed = written(spark, placed.select(F.col("row").alias("_row"), F.xxhash64("tie", "place").alias("_tie")), "mix-places")
        rows = rows.join(placed, F.col("row") == F.col("_row"), "left").withColumn("tie", F.coalesce("_tie", "tie")).drop("_row", "_tie")
    rows = rows.withColumn("leaf", F.pmod(F.col("tie"), leaves))
    whole = rows.filter((F.col("p") == 0) | (F.col("size") == 0)).select("row", "doc_id", "source", "size", F.lit(0).alias("extra"))
    open_rows = rows.filter((F.col("p") > 0) & (F.col("size") > 0)).select("row", "doc_id", "source", "size", "leaf", "p", "tie")

    def node(level):
        def run(units: pa.Table) -> pa.Table:
            units = units.sort_by([("size", "descending"), ("doc_id", "ascending"), ("tie", "ascending")])
            key, size, p = units["tie"].to_numpy().view(np.uint64), units["size"].to_numpy(), units["p"].to_numpy()
            p = round_leaf(size, float(p[0]), key) if level == 0 else round_units(size, p, key, level)
            return units.set_column(units.schema.get_field_index("p"), "p", pa.array(p))

        return run

    done, level = [whole], 0
    most = rates.agg(F.max(leaves)).first()[0] or 1
    still = F.col("p").between(F.lit(1e-12), F.lit(1 - 1e-12))
    while True:
        state = written(spark, open_rows.groupBy("source", "leaf").applyInArrow(node(level), UNIT), "pivotal")
        settled = state if most <= 1 else state.filter(~still)
        if most <= 1:  # the root: one draw settles the last open text of a source
            u = (F.pmod(F.xxhash64(F.lit(SEED), "tie"), F.lit(1 << 52)) / float(1 << 52))
            settled = settled.withColumn("p", F.when(still, (u < F.col("p")).cast("double")).otherwise(F.col("p")))
        done.append(settled.select("row", "doc_id", "source", "size", F.round("p").cast("int").alias("extra")))
        if most <= 1:
            break
        open_rows = state.filter(still).withColumn("leaf", F.floor(F.col("leaf") / LEAF))
        most, level = -(-most // LEAF), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return (out.join(r, F.col("source").eqNullSafe(F.col("_source")))
            .select("row", "doc_id", "source", "size", "source_size", "target", (F.floor("rate") + F.col("extra")).cast("int").alias("copies")))


def mixed(docs: DataFrame) -> DataFrame:
    """Copies of every row of (doc_id, source, text); ``row`` numbers the rows, as the column ``_row`` where there is one."""
    row = F.col("_row") if "_row" in docs.columns else F.monotonically_increasing_id()
    sizes = written(docs.sparkSession, docs.select(row.alias("row"), F.col("doc_id").cast("long"), F.col("source").cast("string"),
                                                   F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "mix-sizes")
    rates = written(docs.sparkSession, targets(sizes), "mix-targets")
    return copies(sizes, rates)


def stage(docs: DataFrame) -> DataFrame:
    """A row of ``docs`` per copy that the mix takes, with ``copy`` (1 first; ``copy_1`` and so on
    where ``docs`` has such a column); rows without a copy go.

    Rows are numbered in a written table, so repeated rows keep copies of their own.
    """
    doc = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "source", "text", F.monotonically_increasing_id().alias("_row"))
    numbered = written(docs.sparkSession, doc.select("doc", "_row"), "mix-docs")
    taken = mixed(numbered.select("_row", "doc.doc_id", "doc.source", "doc.text")).filter("copies > 0").select(F.col("row").alias("_taken"), "copies")
    name = next(n for n in ("copy", *(f"copy_{k}" for k in range(1, 10_000))) if n not in docs.columns)
    return (numbered.join(taken, F.col("_row") == F.col("_taken"))
            .select("doc.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(name)))


def query(spark, sf_dir: str) -> DataFrame:
    out = mixed(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")
