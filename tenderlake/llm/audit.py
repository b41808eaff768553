"""Operator 11 - how filters interact: forward-backward path counting.

Every text gets the set of filters that it fails as a bit mask.  The filters
already applied are a state of the subset lattice, so an order of the filters
is a path from the empty set to the full one and a step is an edge.  With
``alive(S)``, the texts that fail no filter of S, the edge (S, f) removes
``alive(S) - alive(S + f)`` texts, in whatever order S was built.  Forward
counting gives the orders that reach S, backward counting those that leave
S + f; their product is the number of orders that use the edge, and the
Shapley sum of f is the edge removals of f weighted by it.  The steps of an
order are read from the same edges.  No order is ever run over the texts:
they are read once, and the lattice works on one row per (part, mask).

Repeats (filter E) are found without a join of texts: rows are counted by
(digest, id), a digest's smallest id is a partial aggregate, and the rows under
it are taken off the rows that fail.  A digest is SHA-256 of the UTF-8 text, so
a text in a third of all rows is one row per task before anything is shuffled.

Defined cases: a NULL text is empty (no words: fails A, never B, C or D); a
NULL id is not smaller than any and has no smaller one, so such rows neither
fail E nor make others fail it, and have no labels; rows that share the
smallest id of a text all pass E; a text counts as good or toxic if any of its
labels says 1; NULL parts are the part ''; no rows give no parts, hence no
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, written

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
MARKS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
MOST_ORDERS = 5040  # all orders of seven filters
FLAGS = "doc_id long, part string, mask int, digest binary"


def content_mask(text: str) -> tuple[int, bytes]:
    """Bits of the failed filters A to D of one text, and the text's digest."""
    raw = text.encode()
    words = raw.split()  # exactly at 0x20 and 0x09-0x0D
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    failed = (len(words) < MIN_WORDS, 100 * len(set(words)) < MIN_DISTINCT * len(words),
              100 * capitals > MAX_CAPITALS * len(text), len(raw) > len(raw.translate(None, MARKS)))
    return sum(bit << k for k, bit in enumerate(failed)), hashlib.sha256(raw).digest()


def content_flags(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask of A to D, digest) of every row of (doc_id, lang, text)."""

    def run(batches):
        for batch in batches:
            found = [content_mask(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array([m for m, _ in found], pa.int32()),
                                              pa.array([d for _, d in found], pa.binary())], names=["doc_id", "part", "mask", "digest"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text").mapInArrow(run, FLAGS)


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): texts by the exact set of filters they fail."""
    spark = docs.sparkSession
    rows = content_flags(docs).groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = written(spark, rows, "audit-rows")
    said = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic")))
    known = rows.filter("doc_id is not null").join(said, "doc_id", "left").fillna(0, ["good", "toxic"])
    known = written(spark, known, "audit-known")
    # the rows of one id and text differ in their part only, so the list is as short as the id's parts
    own = known.groupBy("digest", "doc_id").agg(F.collect_list(F.struct("part", "mask", "good", "toxic", "n")).alias("own"))
    first = own.groupBy("digest").agg(F.min_by("own", "doc_id").alias("own")).select(F.inline("own"))
    repeat = 1 << FILTERS.index("E")
    again = F.col("mask").bitwiseOR(F.lit(repeat))
    same = ("part", "mask", "good", "toxic", "n")
    parts = [known.withColumn("mask", again).select(*same), first.withColumn("mask", again).withColumn("n", -F.col("n")).select(*same), first.select(*same),
             rows.filter("doc_id is null").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "n")]
    return (reduce(DataFrame.unionByName, parts).groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


def paths(n: int) -> list[tuple[int, int, int, int]]:
    """(state, filter, next state, orders through this edge) of every edge of the lattice of ``n`` filters."""
    full = (1 << n) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for s in range(1, full + 1):  # a subset has a smaller number
        reach[s] = sum(reach[s ^ 1 << f] for f in range(n) if s >> f & 1)
    for s in range(full - 1, -1, -1):
        leave[s] = sum(leave[s | 1 << f] for f in range(n) if not s >> f & 1)
    return [(s, f, s | 1 << f, reach[s] * leave[s | 1 << f]) for s in range(full + 1) for f in range(n) if not s >> f & 1]


def interactions(counts: DataFrame, filters: str, orders: list[str] | None = None) -> DataFrame:
    """One row per part, order and step of (part, mask, n, good, toxic) counts; bit k of a mask is ``filters[k]``.

    ``orders`` are the orders whose steps are wanted, all by default (more than
    seven filters have too many: name them).  The Shapley sums always stand for all orders.
    """
    spark, n = counts.sparkSession, len(filters)
    if orders is None:
        if factorial(n) > MOST_ORDERS:
            raise ValueError(f"name the orders of {n} filters whose steps are wanted")
        orders = ["".join(p) for p in permutations(filters)]
    edges = spark.createDataFrame(paths(n), "state int, f int, next int, paths long")
    walks = []
    for order in orders:
        state = 0
        for step, letter in enumerate(order):
            f = filters.index(letter)
            walks.append((order, step + 1, state, f))
            state |= 1 << f
    steps = spark.createDataFrame(walks, "filter_order string, step int, state int, f int")
    counts = written(spark, counts, "audit-counts")
    measures = ("n", "good", "toxic")
    survives = F.col("mask").bitwiseAND(F.col("state")) == 0
    alive = (counts.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))))
             .groupBy("part", "state").agg(*[F.sum(F.when(survives, F.col(m)).otherwise(0)).alias(m) for m in measures]))
    alive = written(spark, alive, "audit-alive")
    after = alive.select("part", F.col("state").alias("next"), *[F.col(m).alias(f"{m}_left") for m in measures])
    gone = (alive.join(edges, "state").join(after, ["part", "next"])
            .select("part", "state", "f", "paths", F.col("n_left").alias("kept"), *[(F.col(m) - F.col(f"{m}_left")).alias(m) for m in measures]))
    bit = F.expr("shiftleft(1, f)")
    fails = (counts.withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).groupBy("part", "f")
             .agg(F.sum(F.when(F.col("mask").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("fails"),
                  F.sum(F.when(F.col("mask") == bit, F.col("n")).otherwise(0)).alias("unique_fails")))
    worth = gone.groupBy("part", "f").agg(F.sum(F.col("paths") * F.col("n")).alias("shapley"))
    out = gone.join(steps, ["state", "f"]).join(fails.join(worth, ["part", "f"]), ["part", "f"])
    return out.select("part", "filter_order", "step", "kept", F.col("n").alias("removed"), (F.col("fails") - F.col("n")).alias("redundant"),
                      "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")


def query(spark, sf_dir: str) -> DataFrame:
    return interactions(mask_counts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")), FILTERS)


#: the same rows straight from the definition: every step of every order over the masks of all texts
SQL = r"""
with texts as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
worded as (
    select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by t) as first_id from texts),
said as (
    select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
flags as (
    select part, coalesce(good, 0) as good, coalesce(s.toxic, 0) as toxic,
           (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
           + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::int
           + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(doc_id > first_id, false)::int as mask
    from worded left join said s using (doc_id)),
f as (select unnest(['A', 'B', 'C', 'D', 'E']) as x, unnest([1, 2, 4, 8, 16]) as bit),
orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
    from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31
        and (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps as (
    select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as done
    from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
masks as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from flags group by part, mask),
per as (
    select part, filter_order, step, bit,
           sum(case when mask & (done | bit) = 0 then n else 0 end) as kept,
           sum(case when mask & bit <> 0 and mask & done = 0 then n else 0 end) as removed,
           sum(case when mask & bit <> 0 and mask & done <> 0 then n else 0 end) as redundant,
           sum(case when mask = bit then n else 0 end) as unique_fails,
           sum(case when mask & bit <> 0 and mask & done = 0 then good else 0 end) as good_lost,
           sum(case when mask & bit <> 0 and mask & done = 0 then toxic else 0 end) as toxic_lost
    from masks, steps group by part, filter_order, step, bit)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley
from per
"""
