"""Operator 5 - n-gram Jaccard join with parity sketches.

A text's set is its distinct shingles of ``shingle`` words (fewer words: the
whole sequence as one).  Two texts link when 100 * |A and B| >= num * |A or B|.
The query takes three words and 90, which are the defaults; the pipeline takes
five and 80.

Equal sets are one class from the start.  For the others, every shingle flips
one bit of a sketch, so the Hamming distance of two sketches never exceeds the
sets' symmetric difference, which for linked sets is at most
(|A| + |B|) * (100 - num) / (100 + num), a 19th of |A| + |B| at 90 and a ninth at
80.  In the size band whose largest set is ``top`` that is d, the whole part of
2 * top times that fraction, so of d + 1 + s sketch pieces s + 1 at least are equal.  A piece has so many bits that
unlike sets hardly ever agree in it, and is held as the XOR of its set bits'
64-bit hashes: chance meetings would grow with the square of the input.  Pieces
without a shingle, or with one, are alike by chance: a text emits its d + 1
fullest ones only.  Of the equal pieces of two linked sets the fullest (or by its
hash the first of those) has s others behind it in both sets, so both emit it.  Bands are a
factor 100 / num wide: linked sets are in the same or in neighbouring bands, and a
text emits the pieces of its own band and of the next.

Pieces meet on a key of 48 bits, a text is named by 48 bits of its set's name
there: tasks send sorted lists of both, packed, and no key that is met by one set
alone becomes a row (see ``met_keys``).  The members of a key with a few of them are
compared with each other.  Within a larger one no pairs are listed: one member
is compared with the rest on the whole sets, which also tells everybody's
difference from the members' centre, and so from the member nearest to it (see
``centred``).  A group of near copies costs one comparison per member.
Members that do not link with the nearest one can link with another only if
both differ from the centre in a common shingle, or are small or near enough
(see ``refined``), so such shingles are the keys of the next round.  Keys whose
members are one component are done; rounds go on until no key is left, so
every link that can join two components is tested.

Defined cases: NULL or empty text or text without words has an empty set,
links with nothing and is its own component; a text without doc_id takes part,
and a component's id is its smallest non-NULL id (NULL if it has none); rows
that repeat an id or a text are rows of one class; other columns are ignored.
Classes are named by a 64-bit hash of the set.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bucketed, joined, mix, pack, pack_plain, read, runs, scratch, signed, slices, unpack, unpack_plain, words, written

NUM, DEN = 90, 100  # least Jaccard similarity, unless asked otherwise
SHINGLE = 3  # words, unless asked otherwise
KEY_BITS = 48  # of a key, where keys meet
HELD_KEYS = 1 << 21  # that a task lists at once
PART_BYTES = 1 << 24  # of text, whose keys are one part
SKETCHED = ["doc_id", "name", "n", "part", "keys", "tags"]
FEW, FEW_LATER = 6, 16  # members of a key, in the first and in later rounds, that are all compared with each other


def band(n: int, num: int = NUM) -> int:
    """Size band of a set of n shingles."""
    return int(np.floor(np.log(n) / np.log(DEN / num) + 1e-9))


def pieces(b: int, num: int = NUM) -> tuple[int, int]:
    """(sketch pieces, those emitted) in band b: one more than the largest symmetric
    difference of a link are emitted, a quarter of all pieces is not."""
    top = np.floor(np.exp((b + 1) * np.log(DEN / num)) + 1e-6)
    d = int(2 * top * (DEN - num) // (DEN + num))
    return d + 1 + (d + 2) // 3, d + 1


def sets(h: np.ndarray, row: np.ndarray, rows: int, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a slice."""
    shingle, at = runs(h, row, n)
    own = row[at]
    cut = np.searchsorted(own, np.arange(rows + 1))
    out = [np.unique(shingle[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    count = np.bincount(row, minlength=rows)
    first = np.searchsorted(row, np.arange(rows))
    for i in np.flatnonzero((count > 0) & (count < n)):
        part = h[first[i]:first[i] + count[i]]
        out[i] = runs(part, np.zeros(part.size, np.int64), part.size)[0]
    return out


def set_name(s: np.ndarray) -> int:
    """64-bit name of a set."""
    return int(signed(mix(np.array([mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64) + np.uint64(s.size)], np.uint64)))[0])


def sketch(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k pieces of the parity sketch of sorted hashes, and the hashes in each: a hash's
    high half gives the piece, all of it the bit; a piece is held as the XOR of its bits' hashes."""
    piece = ((x >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    count = np.bincount(piece.astype(np.int64), minlength=k)
    used = np.flatnonzero(count)
    out = np.zeros(k, np.uint64)
    out[used] = np.bitwise_xor.reduceat(mix(x), (np.cumsum(count) - count)[used])
    return out, count


def keys(s: np.ndarray, num: int = NUM) -> np.ndarray:
    """Join keys (band, piece number, piece) of a set, in its own band and the next: the fullest pieces of each."""
    out, x = [np.zeros(0, np.uint64)], np.sort(mix(s + np.uint64(0x632BE59BD9B4E019)))
    for b in (band(s.size, num), band(s.size, num) + 1) if s.size else ():
        k, sent = pieces(b, num)
        if sent > 1:  # else only equal sets link
            place = mix(np.arange(k, dtype=np.uint64) + np.uint64(b << 32))
            piece, count = sketch(x, k)
            key = mix(piece ^ place) + place
            out.append(key[np.lexsort((key, count))[k - sent:]])
    return np.concatenate(out)


def sketched(docs: DataFrame, parts: int, shingle: int = SHINGLE, num: int = NUM) -> DataFrame:
    """(doc_id, name, n) of every row of (doc_id, text), name is NULL for an empty set;
    and (part, keys, tags): the sorted keys of many texts that fall to a part, packed,
    and the tags (name without its last 16 bits) of their texts."""
    edges = np.array([(i << KEY_BITS) // parts for i in range(1, parts)], np.uint64)

    def listed(found, tags):
        key = np.concatenate([np.zeros(0, np.uint64), *found]) >> np.uint64(64 - KEY_BITS)
        tag = np.repeat(np.array(tags, np.uint64), [f.size for f in found])
        order = np.argsort(key)
        key, tag = key[order], tag[order]
        cut = np.concatenate([[0], np.searchsorted(key, edges), [key.size]])
        own = np.flatnonzero(np.diff(cut))
        some = [(cut[i], cut[i + 1]) for i in own]
        none = pa.nulls(own.size, pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, pa.array(own, pa.int32()), pa.array([pack(key[a:b]) for a, b in some], pa.binary()),
                                           pa.array([pack_plain(tag[a:b]) for a, b in some], pa.binary())], names=SKETCHED)

    def run(batches):
        found, tags, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                h, row, _ = words(part.column("text"))
                all_sets = sets(h, row, part.num_rows, shingle)
                names = [set_name(s) if s.size else None for s in all_sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.int64()), pa.array([s.size for s in all_sets], pa.int64()),
                     pa.array(np.arange(part.num_rows) % parts, pa.int32()), pa.nulls(part.num_rows, pa.binary()), pa.nulls(part.num_rows, pa.binary())], names=SKETCHED)
                for s, name in zip(all_sets, names):
                    if s.size:
                        found.append(keys(s, num))
                        tags.append((name % (1 << 64)) >> 16)
                        held += found[-1].size
                if held >= HELD_KEYS:
                    yield listed(found, tags)
                    found, tags, held = [], [], 0
        if held:
            yield listed(found, tags)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, name long, n long, part int, keys binary, tags binary")


def met_keys(rows: DataFrame) -> DataFrame:
    """Rows of ``sketched``, by part: those of texts as they are, (doc_id, name, n), and
    (key, tag, size) of the keys that several tags have, once for each tag; size tells how many."""

    def met(lists):
        key = np.concatenate([unpack(k, np.uint64) for k, _ in lists])
        tag = np.concatenate([unpack_plain(t, np.uint64) for _, t in lists])
        order = np.argsort(key, kind="stable")
        key, tag = key[order], tag[order]
        same = key[1:] == key[:-1]
        some = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
        key, tag = key[some], tag[some]
        order = np.lexsort((tag, key))
        key, tag = key[order], tag[order]
        once = np.r_[True, (key[1:] != key[:-1]) | (tag[1:] != tag[:-1])] if key.size else np.zeros(0, bool)
        key, tag = key[once], tag[once]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if key.size else np.zeros(0, np.int64)
        size = np.diff(np.append(first, key.size))
        size = np.repeat(size, size)
        more = size > 1
        for at in range(0, int(more.sum()), 1 << 16):
            chosen = np.flatnonzero(more)[at:at + (1 << 16)]
            none = pa.nulls(chosen.size, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, *[pa.array(signed(c[chosen])) for c in (key, tag)], pa.array(size[chosen], pa.int64())],
                                             names=["doc_id", "name", "n", "key", "tag", "size"])

    def run(batches):
        lists, now = [], None
        for batch in batches:
            text = batch.filter(pc.is_null(batch.column("keys")))
            none = pa.nulls(text.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([text.column("doc_id"), text.column("name"), text.column("n"), none, none, none],
                                             names=["doc_id", "name", "n", "key", "tag", "size"])
            packed = batch.filter(pc.is_valid(batch.column("keys")))
            for part, k, t in zip(packed.column("part").to_pylist(), packed.column("keys"), packed.column("tags")):
                if part != now and lists:
                    yield from met(lists)
                    lists = []
                now = part
                lists.append((k.as_py(), t.as_py()))
        if lists:
            yield from met(lists)

    return rows.sortWithinPartitions("part").mapInArrow(run, "doc_id long, name long, n long, key long, tag long, size long")


def full_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(name, n, shingles) of every row with words."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, row, _ = words(part.column("text"))
                own = [s for s in sets(h, row, part.num_rows, shingle) if s.size]
                offs = np.concatenate([[0], np.cumsum([s.size for s in own])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_name(s) for s in own], pa.int64()), pa.array([s.size for s in own], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offs), pa.array(signed(np.concatenate([np.zeros(0, np.uint64), *own]))))],
                    names=["name", "n", "shingles"])

    return docs.select("text").mapInArrow(run, "name long, n long, shingles array<long>")


def apart(n: Column, m: Column, num: int = NUM) -> Column:
    """Largest symmetric difference of two linked sets of n and m shingles."""
    return F.floor((n + m) * (DEN - num) / (DEN + num))


def pairs_to_test(open_keys: DataFrame, few: int, num: int = NUM) -> tuple[DataFrame, DataFrame]:
    """(b, x) of every large key's leader with its members, and of all members of
    keys with at most ``few`` of them, which are settled by that."""
    per = open_keys.groupBy("key").agg(F.count("*").alias("size"), F.max_by("name", F.struct("weight", "name")).alias("b"))
    led = open_keys.join(per.filter(F.col("size") > few).select("key", "b"), "key").filter("name <> b").select("b", F.col("name").alias("x"))
    small = open_keys.join(per.filter(F.col("size") <= few).select("key"), "key").select("key", "name", "n", "root")
    other = small.select("key", F.col("name").alias("x"), F.col("n").alias("nx"), F.col("root").alias("root_x"))
    fits = DEN * F.least("n", "nx") >= num * F.greatest("n", "nx")
    both = small.join(other, "key").filter(F.expr("name < x and root <> root_x") & fits).select(F.col("name").alias("b"), "x")
    return led.distinct(), both.distinct()


def compared(pairs: DataFrame, whole: DataFrame, num: int = NUM) -> DataFrame:
    """The pairs on the whole sets: (b, x, nb, nx, linked, added, removed), added = x without b, removed = b without x."""
    left = whole.select(F.col("name").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    right = whole.select(F.col("name").alias("x"), F.col("n").alias("nx"), F.col("shingles").alias("sx"))
    rows = (pairs.join(left, "b").join(right, "x")
            .select("b", "x", "nb", "nx", F.array_except("sx", "sb").alias("added"), F.array_except("sb", "sx").alias("removed")))
    return rows.withColumn("linked", F.size("added") + F.size("removed") <= apart(F.col("nb"), F.col("nx"), num))


def centred(tested: DataFrame, num: int = NUM) -> DataFrame:
    """Members and their differences from the centre of each leader's members.

    The centre is the set of shingles that more than half of the members have;
    it need not be a text.  Differences from it follow from those from the
    leader, in the member's row.  Returns (b, x, n, nc, off, plus, minus, head,
    linked): size, centre's size, shingles off the centre, which x has and
    lacks, the member nearest to the centre and whether x links with it.
    Leaders whose members all link, or with one member only, are settled.
    """
    spark = tested.sparkSession
    active = tested.groupBy("b").agg(F.count("*").alias("m"), F.bool_and("linked").alias("all")).filter("m > 1 and not all").select("b", "m")
    rows = written(spark, tested.join(active, "b"), "sketch-active")
    own = majority(rows)
    none = F.expr("array()").cast("array<long>")
    every = rows.select("b", "x", F.col("nx").alias("n"), "nb", "added", "removed")
    every = every.unionByName(rows.select("b", F.col("b").alias("x"), F.col("nb").alias("n"), "nb").distinct().withColumn("added", none).withColumn("removed", none))
    every = every.join(own, "b", "left").withColumn("most", F.coalesce("most", none)).withColumn("few", F.coalesce("few", none))
    every = every.select("b", "x", "n", (F.col("nb") + F.size("most") - F.size("few")).alias("nc"),
                         F.concat(F.array_except("added", "most"), F.array_except("few", "removed")).alias("plus"),
                         F.concat(F.array_except("removed", "few"), F.array_except("most", "added")).alias("minus"))
    every = written(spark, every.withColumn("off", F.size("plus") + F.size("minus")), "sketch-every")
    head = every.groupBy("b").agg(F.min_by(F.struct("x", "n", "off", "plus", "minus"), F.struct("off", "x")).alias("h"))
    every = every.join(head, "b")
    common = F.size(F.array_intersect("plus", "h.plus")) + F.size(F.array_intersect("minus", "h.minus"))
    linked = F.col("off") + F.col("h.off") - 2 * common <= apart(F.col("n"), F.col("h.n"), num)
    return written(spark, every.select("b", "x", "n", "nc", "off", "plus", "minus", F.col("h.x").alias("head"), linked.alias("linked")), "sketch-members")


def _leader_runs(batch: pa.RecordBatch):
    """(first row, rows) of each run of rows of one leader."""
    b = batch.column("b").to_numpy()
    cut = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if b.size else np.zeros(0, np.int64)
    return cut, np.diff(np.append(cut, b.size))


def _run_counts(lists: pa.Array, cut: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, shingle, rows of the run that have it), ordered."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    run = np.repeat(np.repeat(np.arange(rows.size), rows), size)
    e = lists.flatten().to_numpy(zero_copy_only=False)
    order = np.lexsort((e, run))
    run, e = run[order], e[order]
    new = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (e[1:] != e[:-1])]) if e.size else np.zeros(0, np.int64)
    return run[new], e[new], np.diff(np.append(new, e.size))


def majority(rows: DataFrame) -> DataFrame:
    """(b, most, few): the added, and the removed, shingles that more than half of
    a leader's members (the leader counted among them) have; rows are (b, m, added, removed).

    What more than half of the members have, more than half of some run of them
    in a task have: those are the candidates, and tasks count them by run.  No
    member's differences become rows.
    """
    def half(batches):
        for batch in batches:
            cut, n = _leader_runs(batch)
            out = [batch.column("b").take(pa.array(cut))]
            for col in ("added", "removed"):
                run, e, c = _run_counts(batch.column(col), cut, n)
                keep = 2 * c > n[run]
                ends = np.concatenate([[0], np.cumsum(np.bincount(run[keep], minlength=n.size))])
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(e[keep], pa.int64())))
            yield pa.RecordBatch.from_arrays(out, names=["b", "most", "few"])

    def count(batches):
        for batch in batches:
            cut, n = _leader_runs(batch)
            for col, asked, has in (("added", "most", True), ("removed", "few", False)):
                run, e, c = _run_counts(batch.column(col), cut, n)
                own, known, _ = _run_counts(batch.column(asked).take(pa.array(cut)), np.arange(n.size), np.ones(n.size, np.int64))
                # runs and shingles are both ordered: number the pairs of the two sides together
                order = np.lexsort((np.r_[np.zeros(run.size), np.ones(own.size)], np.r_[e, known], np.r_[run, own]))
                r, x = np.r_[run, own][order], np.r_[e, known][order]
                hit = np.flatnonzero((r[1:] == r[:-1]) & (x[1:] == x[:-1]))
                at = cut[r[hit]]
                yield pa.RecordBatch.from_arrays([batch.column("b").take(pa.array(at)), batch.column("m").take(pa.array(at)), pa.array(x[hit], pa.int64()),
                                                  pa.array(np.full(hit.size, has)), pa.array(c[order[hit]], pa.int64())], names=["b", "m", "e", "has", "c"])

    slim = rows.select("b", "m", "added", "removed")
    found = slim.sortWithinPartitions("b").mapInArrow(half, "b long, most array<long>, few array<long>")
    either = found.groupBy("b").agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("most", "few")])  # sets of a row per run
    counts = slim.join(either, "b").sortWithinPartitions("b").mapInArrow(count, "b long, m long, e long, has boolean, c long")
    kept = counts.groupBy("b", "e", "has").agg(F.sum("c").alias("c"), F.first("m").alias("m")).filter(2 * F.col("c") > F.col("m") + 1)
    return kept.groupBy("b").agg(F.collect_list(F.when(F.col("has"), F.col("e"))).alias("most"),  # the leader lacks them; no more than sets hold
                                 F.collect_list(F.when(~F.col("has"), F.col("e"))).alias("few"))


def signed_shingles(has: Column, lacks: Column) -> Column:
    return F.concat(F.transform(has, lambda e: F.struct(e.alias("e"), F.lit(True).alias("has"))),
                    F.transform(lacks, lambda e: F.struct(e.alias("e"), F.lit(False).alias("has"))))


def refined(every: DataFrame, names: DataFrame, num: int = NUM) -> DataFrame:
    """(key, name, n, weight, root): keys on which members of different components may still link.

    All members were compared with the head, so take u that does not link with
    it, and any y; d is what may be between them.  If they link and share added
    shingles, they share at least added(u) - d.  If they share none, their
    difference is at least off(u) + n(y) - n(centre) and the reverse, and they
    share at least off(u) - d removed ones.  If they share nothing, it is
    off(u) + off(y).  A set that shares t shingles does so among all but t - 1
    of its own, so only the rarest of each member's are keys.
    """
    m = every.filter("x <> head").join(names.withColumnRenamed("node", "x"), "x", "left").withColumn("root", F.coalesce("root", "x"))
    free = F.when(~F.col("linked"), F.col("off"))
    limits = m.groupBy("b").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("off").alias("near"), F.min(free).alias("near_u"),
                                F.min(F.when(~F.col("linked"), F.col("n"))).alias("least_u"), F.min("root").alias("r1"), F.max("root").alias("r2"))
    m = m.join(limits.filter("near_u is not null and r1 < r2"), "b").withColumn("d", apart(F.col("n"), F.col("most"), num))
    shrunk = (~F.col("linked") & (F.col("off") + F.col("least") - F.col("nc") <= F.col("d"))) | (F.col("off") + F.col("least_u") - F.col("nc") <= F.col("d"))
    alone = (~F.col("linked") & (F.col("off") + F.col("near") <= F.col("d"))) | (F.col("off") + F.col("near_u") <= F.col("d"))
    weight = (-F.col("off")).cast("long").alias("weight")
    lacks = F.when(shrunk, F.col("minus")).otherwise(F.expr("array()").cast("array<long>"))
    away = m.select("b", "x", "n", "off", "d", "root", F.size("plus").alias("np"), F.size("minus").alias("nm"),
                    F.explode(signed_shingles(F.col("plus"), lacks)).alias("s")).select("*", "s.e", "s.has").drop("s")
    often = away.groupBy("b", "e", "has").agg(F.count("*").alias("times")).filter("times > 1")
    # shingles that no other member has are rarest of all: they count, but are not looked at
    own = W.partitionBy("b", "x", "has")
    size = F.when(F.col("has"), F.col("np")).otherwise(F.col("nm"))
    first = F.when(F.col("has"), F.least(F.col("np"), F.col("d") + 1)).otherwise(F.least(F.col("nm"), F.col("nm") - F.col("off") + F.col("d") + 1))
    keyed = (away.join(often, ["b", "e", "has"])
             .withColumn("place", F.row_number().over(own.orderBy("times", "e")) + size - F.count("*").over(own)).filter(F.col("place") <= first)
             .select(F.xxhash64("b", "e", "has").alias("key"), F.col("x").alias("name"), "n", weight, "root"))
    return keyed.unionByName(m.filter(alone).select(F.xxhash64("b", F.lit("alone")).alias("key"), F.col("x").alias("name"), "n", weight, "root"))


def unsettled(rows: DataFrame) -> DataFrame:
    """The rows of keys that hold several components."""
    spark = rows.sparkSession
    rows = written(spark, rows.groupBy("key", "name").agg(F.first("n").alias("n"), F.max("weight").alias("weight"), F.first("root").alias("root")), "sketch-keys")
    hot = rows.groupBy("key").agg((F.min("root") < F.max("root")).alias("more")).filter("more").select("key")
    return written(spark, rows.join(hot, "key", "left_semi"), "sketch-open")


def classes(docs: DataFrame, slim: DataFrame, open_keys: DataFrame, shingle: int = SHINGLE, num: int = NUM) -> DataFrame:
    """(node, root): the component of every class that links with another one, from ``opened``."""
    spark = docs.sparkSession
    with scratch(spark) as keep:
        # the sets of the members, from the text of one row each; merge joins at every size, so that the plan does not depend on it
        chosen = slim.join(open_keys.select("name").distinct(), "name", "left_semi").groupBy("name").agg(F.min("doc_id").alias("doc_id"))
        chosen = written(spark, chosen, "sketch-chosen")
        texts = docs.select(F.col("doc_id").cast("long"), "text").join(
            chosen.select(F.col("doc_id").alias("_id")).distinct().hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        with bucketed(spark, full_sets(texts, shingle).join(chosen.select("name").hint("merge"), "name", "left_semi").dropDuplicates(["name"]), "name") as whole:
            names = written(spark, spark.createDataFrame([], "node long, root long"), "sketch-components")
            few = FEW
            while not open_keys.isEmpty():
                with scratch(spark) as on:
                    led, both = pairs_to_test(open_keys, few, num)
                    tested = written(spark, compared(led, whole, num), "sketch-tested")
                    links = written(spark, compared(both, whole, num).filter("linked").select(F.col("b").alias("a"), F.col("x").alias("b")), "sketch-links")
                    links = links.unionByName(tested.filter("linked").select(F.col("b").alias("a"), F.col("x").alias("b")))
                    last = tested.isEmpty()
                    if not last:
                        every = centred(tested, num)
                        links = links.unionByName(every.filter("linked").select(F.col("head").alias("a"), F.col("x").alias("b")))
                    names = on(written(spark, joined(spark, names, links), "sketch-components"))
                    if last:
                        break
                    open_keys, few = on(unsettled(refined(every, names, num))), FEW_LATER
        return keep(names)


def opened(docs: DataFrame, shingle: int = SHINGLE, num: int = NUM) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, name) of every row of (doc_id, text), and the keys that several sets share."""
    spark = docs.sparkSession
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(4 * dealt, (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES)
    with scratch(spark) as keep:
        rows = written(spark, met_keys(sketched(docs, parts, shingle, num).repartition(dealt, "part")), "sketches")
        slim = keep(written(spark, rows.filter("key is null").select("doc_id", "n", "name"), "sketch-names"))
        names = slim.filter("name is not null").groupBy("name").agg(F.first("n").alias("n")).withColumn("tag", F.shiftrightunsigned("name", 16))
        met = written(spark, rows.filter("key is not null").select("key", "tag", "size").join(names, "tag").select("key", "name", "n", "size"), "sketch-met")
        weight = met.groupBy("name").agg(F.sum("size").alias("weight"))  # the middle of a group meets most
        return slim, keep(written(spark, met.drop("size").join(weight, "name").withColumn("root", F.col("name")), "sketch-open"))


def grouped(docs: DataFrame, shingle: int = SHINGLE, num: int = NUM) -> DataFrame:
    """(doc_id, n_shingles, component_id, class) of every row of (doc_id, text), linked from ``num`` % on."""
    spark = docs.sparkSession
    with scratch(spark) as keep:
        slim, open_keys = opened(docs, shingle, num)
        names = classes(docs, slim, open_keys, shingle, num)
        per = slim.filter("name is not null").groupBy("name").agg(F.min("doc_id").alias("first"))
        per = per.join(names.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
        ids = per.groupBy("root").agg(F.min("first").alias("component_id"))
        per = keep(written(spark, per.join(ids, "root").select(F.col("name").alias("_name"), "component_id"), "sketch-classes"))
        keep(slim)
    out = slim.join(per, F.col("name") == F.col("_name"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.col("name").alias("class"))


def stage(docs: DataFrame, shingle: int = SHINGLE, num: int = NUM) -> DataFrame:
    """One row per component stays: that of the smallest id (rows without an id, or without words, stay)."""
    spark = docs.sparkSession
    own = f"id_{uuid.uuid4().hex}"  # a name that ``docs`` cannot have
    with scratch(spark) as keep:
        gone = grouped(docs.select("doc_id", "text"), shingle, num).filter("component_id < doc_id").select(F.col("doc_id").alias(own)).distinct()
        gone = keep(written(spark, gone, "near-copies"))
    return docs.join(gone, docs["doc_id"].cast("long") == F.col(own), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return grouped(read(spark, sf_dir, "documents"), 3, 90)
