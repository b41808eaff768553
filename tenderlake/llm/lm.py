"""Operator 2 - language-model scores by online logistic context mixing.

A token is coded as the bits of its class (``BITS`` bits of its hash) and then
as itself within the class:

* every bit is predicted in several contexts (none, the last token, the last
  two, the one before the last, the last short token); a predictor is the count
  of ones and zeros that training saw in that context at that node of the class
  tree.  Only nodes that training reached take room: (context, node) is hashed
  into ``SLOTS`` counters per context, so whole tokens and pairs of tokens tell
  contexts apart; a context never seen has no opinion (log-odds 0);
* the predictions, as log-odds, are combined with weights that a gate selects
  (bit number; whether the last token is short) and that learn online, text by
  text, from ``BLOCK`` tokens to the next; then an adaptive table over the
  mixed log-odds refines the probability the same way.  Only the past of the
  text is used, so probabilities add up to 1;
* within its class k a token has probability (c + 1) / (C + V + 1), C and V
  being the class's tokens and distinct tokens in training; what is unknown
  shares the class's last 1.

``base_score`` is the add-one unigram of the same counts.

Training is two passes: in one each task sums word counts (64-bit hashes), in
the other its context counters, which travel as packed blocks of ``CHUNK`` and
are added up and turned into log-odds by block; all word counts stay in a table.
The words that make up at least 1 / ``HEAD`` of all tokens, at most ``HEAD`` of
them, are broadcast along with the log-odds (2 bytes per slot); the rest are joined per distinct word of a text, where no key is
hot any more.

Defined cases: NULL or empty text is the end token alone; a text without
doc_id is scored and not learned from; without training every token is
unknown; rows that repeat are scored each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, fold, mix, pack_plain, read, signed, slices, unpack_plain, words, written

BITS = 8
CLASSES = 1 << BITS
BUCKETS = 1 << 14  # of CLASSES counters each, per context
SLOTS = BUCKETS * CLASSES // 2  # per context; a slot is two neighbouring counters, zeros and ones
CHUNK = 1 << 13  # counters sent in one row
TRAIN_BYTES = 1 << 18  # text whose nodes are counted at once
CONTEXTS = 5
HEAD = 1 << 17
BLOCK = 32
SHORT = 3  # bytes of a short token
RATE, RATE_REFINE, START, PRIOR = 0.02, 0.02, 1 / CONTEXTS, 0.4
CELLS = 24
END = np.uint64(0x5F3A9C1E77B2D405)
NODE, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
HELD_OUT, FOLDS = 2, 7


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, bytes) of every token: the words of a row, then its end."""
    h, row, length = words(col)
    n = len(col)
    at = np.searchsorted(row, np.arange(n), side="right")
    return np.insert(h, at, END), np.insert(row, at, np.arange(n)), np.insert(length, at, 0)


def classes(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def contexts(h: np.ndarray, row: np.ndarray, length: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hash of every context of every token, and the gate (last token is short)."""
    start = np.flatnonzero(np.diff(row, prepend=-1))
    first = np.repeat(start, np.diff(np.append(start, h.size)))
    place = np.arange(h.size)
    one, two = place - 1, place - 2
    last = np.where(one >= first, h[np.maximum(one, 0)], np.uint64(1))
    before = np.where(two >= first, h[np.maximum(two, 0)], np.uint64(2))
    short = (length > 0) & (length <= SHORT)
    seen = np.maximum.accumulate(np.where(short, place, -1))
    seen = np.concatenate([[-1], seen[:-1]])  # the last short token before this one
    word = np.where(seen >= first, h[np.maximum(seen, 0)], np.uint64(3))
    keys = [last, mix(last) + before, before + np.uint64(7), word + np.uint64(11)]
    gate = np.where(one >= first, short[one], False).astype(np.int64)
    return [np.zeros(h.size, np.uint64), *map(mix, keys)], gate


def _paths() -> tuple[np.ndarray, np.ndarray]:
    own, depth = np.arange(CLASSES)[:, None], np.arange(BITS)
    return ((1 << depth) | (own >> (BITS - depth))).astype(np.uint64) * NODE, (own >> (BITS - 1 - depth)) & 1


PATH, TURN = _paths()  # of every class, by depth: hash of the node of the class tree, and the bit taken there


def slots(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Slot of every context at every node (hash) of the last axis."""
    at = context[..., None] + node
    at *= SPREAD
    at >>= np.uint64(64 - (SLOTS.bit_length() - 1))
    return at.view(np.int64)


def counted(docs: DataFrame) -> DataFrame:
    """(key, n): count of every word by hash, over all rows of (text)."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(where, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        def rows(keys, n):
            for i in range(0, keys.size, 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + 100_000]), pa.array(n[i:i + 100_000])], names=["key", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                held.append(np.unique(signed(tokens(part.column("text"))[0]), return_counts=True))
                if sum(k.size for k, _ in held) > 2_000_000:
                    held = [merged()]
                    if held[0][0].size > 1_000_000:
                        yield from rows(*held[0])
                        held = []
        if held:
            yield from rows(*merged())

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def context_odds(docs: DataFrame) -> DataFrame:
    """(key, odds): the log-odds of block ``key`` of all contexts' slots, as float16 bytes,
    where training over all rows of (text) reached the block."""

    def count(batches):
        table = np.zeros((CONTEXTS, 2 * SLOTS), np.int32)
        for batch in batches:
            for part in slices(batch, "text", TRAIN_BYTES):
                h, row, length = tokens(part.column("text"))
                own = classes(h)
                node, bit = PATH[own], TURN[own]
                for k, context in enumerate(contexts(h, row, length)[0]):
                    at = slots(context, node)
                    at <<= 1
                    at += bit
                    np.add.at(table[k], at.ravel(), np.int32(1))
        table = table.reshape(-1, CHUNK)
        reached = np.flatnonzero(table.any(axis=1))
        for i in range(0, reached.size, 256):
            own = reached[i:i + 256]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([pack_plain(table[k]) for k in own], pa.binary())], names=["key", "part"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, part in zip(batch.column("key").to_pylist(), batch.column("part")):
                total[key] = total.get(key, 0) + unpack_plain(part.as_py(), np.int64)
        for key, n in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([log_odds(n).astype(np.float16).tobytes()], pa.binary())], names=["key", "odds"])

    return docs.select("text").mapInArrow(count, "key long, part binary").repartition("key").mapInArrow(add, "key long, odds binary")


def log_odds(count: np.ndarray) -> np.ndarray:
    """Log-odds of a one in every slot, from its two counters: ``PRIOR`` of each are
    added, so that 0 stands where nothing was seen."""
    return np.log((count[..., 1::2] + PRIOR) / (count[..., ::2] + PRIOR)).astype(np.float32)


class Model:
    """What scoring needs beside the tail of the word counts."""

    def __init__(self, odds: np.ndarray, head: np.ndarray, head_n: np.ndarray, class_n: np.ndarray):
        self.odds, self.head = odds.reshape(CONTEXTS, -1), head
        self.head_log, self.class_log = np.log10(head_n + 1.0), np.log10(class_n + 1.0)

    def in_head(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = signed(h)
        at = np.minimum(np.searchsorted(self.head, s), max(0, self.head.size - 1))
        return at, (self.head[at] == s) if self.head.size else np.zeros(h.size, bool)

    def bits(self, h: np.ndarray, row: np.ndarray, length: np.ndarray, rows: int) -> np.ndarray:
        """log10 probability of the class bits of every row; rows in step, block by block."""
        own, (context, gate) = classes(h), contexts(h, row, length)
        count = np.bincount(row, minlength=rows)
        order = np.argsort(-count, kind="stable")
        begin = np.concatenate([[0], np.cumsum(count)[:-1]])[order]
        count = count[order]
        w = np.full((rows, 2, BITS, CONTEXTS), START, np.float32)
        refine = np.zeros((rows, CELLS), np.float32)
        total = np.zeros(rows)
        for s in range(0, int(count[0]) if rows else 0, BLOCK):
            a = int(np.searchsorted(-count, -s, side="left"))  # rows that are longer than s
            width = min(BLOCK, int(count[0]) - s)
            place = begin[:a, None] + s + np.arange(width)
            there = (s + np.arange(width) < count[:a, None])
            place = np.where(there, place, 0)
            o, g = own[place], gate[place]
            ys, node = (TURN[o] * 2 - 1).astype(np.float32), PATH[o]
            xs = np.stack([self.odds[k][slots(c[place], node)] for k, c in enumerate(context)], axis=3).astype(np.float32)
            logit = np.einsum("abjk,abjk->abj", xs, w[np.arange(a)[:, None], g])
            cell = np.clip((logit + 6) * (CELLS / 12), 0, CELLS - 1).astype(np.int64) + (np.arange(a) * CELLS)[:, None, None]
            margin = (logit + refine[:a].ravel()[cell]) * ys
            total[:a] -= (np.logaddexp(0, -margin).sum(axis=2) * there).sum(axis=1)
            err = ys / (1 + np.exp(np.clip(margin, -30, 30))) * there[:, :, None]
            for k in range(2):
                w[:a, k] += RATE * np.einsum("abj,abjk->ajk", err * (g == k)[:, :, None], xs)
            refine[:a] += RATE_REFINE * np.bincount(cell.ravel(), weights=err.ravel(), minlength=a * CELLS).reshape(a, CELLS)
        out = np.zeros(rows)
        out[order] = total / np.log(10)
        return out


SCORED = ("doc_id long, held_out boolean, row long, n_tokens long, n_bytes long, head_known long, head_log double, class_log double, bits double, "
          "tail array<long>, tail_n array<long>")


def scored_rows(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of (doc_id, held_out, row, text): all but the counts of the words outside the head, which it lists."""
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                h, row, length = tokens(part.column("text"))
                rows = part.num_rows
                at, known = m.in_head(h)

                def total(values, where=slice(None)):
                    return np.bincount(row[where], weights=values, minlength=rows)

                rest_h, rest_row = signed(h[~known]), row[~known]
                order = np.lexsort((rest_h, rest_row))
                rest_h, rest_row = rest_h[order], rest_row[order]
                new = np.flatnonzero((np.diff(rest_h, prepend=0) != 0) | (np.diff(rest_row, prepend=-1) != 0))
                times = np.diff(np.append(new, rest_h.size))
                offs = pa.array(np.searchsorted(rest_row[new], np.arange(rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), part.column("row"), pa.array(np.bincount(row, minlength=rows)),
                     pa.array(total(length).astype(np.int64)), pa.array(total(known.astype(float)).astype(np.int64)),
                     pa.array(total(m.head_log[at[known]], known) if known.any() else np.zeros(rows)), pa.array(total(m.class_log[classes(h)])),
                     pa.array(m.bits(h, row, length, rows)), pa.ListArray.from_arrays(offs, pa.array(rest_h[new])),
                     pa.ListArray.from_arrays(offs, pa.array(times))],
                    names=[c.split()[0] for c in SCORED.split(", ")])

    return docs.mapInArrow(run, SCORED)


def scored(docs: DataFrame) -> DataFrame:
    """Scores of every row of (doc_id, text): see ``query``."""
    spark = docs.sparkSession
    group = fold(F.col("doc_id"), FOLDS)
    training = docs.filter(group != HELD_OUT)
    vocab = written(spark, counted(training), "lm-counts")
    n_all, v_all = (x or 0 for x in vocab.agg(F.sum("n"), F.count("*")).first())
    head = vocab.filter(F.col("n") * HEAD >= n_all).orderBy("key").toArrow()  # HEAD rows at most
    per_class = vocab.groupBy(F.shiftrightunsigned("key", 64 - BITS).alias("k")).agg((F.sum("n") + F.count("*")).alias("n")).collect()
    class_n = np.zeros(CLASSES)
    for r in per_class:
        class_n[r["k"]] = r["n"]
    odds = np.zeros((CONTEXTS * 2 * SLOTS // CHUNK, CHUNK // 2), np.float16)
    seen = context_odds(training).toArrow()  # a row per block, CONTEXTS * SLOTS values at most
    for key, part in zip(seen["key"].to_pylist(), seen["odds"]):
        odds[key] = np.frombuffer(part.as_py(), np.float16)
    model = Model(odds, head["key"].to_numpy(), head["n"].to_numpy(), class_n)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(group == HELD_OUT, F.lit(False)).alias("held_out"), F.monotonically_increasing_id().alias("row"), "text")
    rows = written(spark, scored_rows(rows, model), "lm-rows")
    tail = rows.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("t")).select("row", F.col("t.tail").alias("key"), F.col("t.tail_n").alias("times"))
    rare = vocab.filter(F.col("n") * HEAD < n_all).withColumnRenamed("n", "c")
    sums = tail.join(rare, "key").groupBy("row").agg(F.sum("times").alias("tail_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("tail_log"))
    out = rows.drop("tail", "tail_n").join(sums, "row", "left").withColumn("own", F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)))
    score = F.col("bits") + F.col("own") - F.col("class_log")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
                      F.lit(n_all).cast("long").alias("train_tokens"), (F.col("own") - F.col("n_tokens") * F.log10(F.lit(float(n_all + v_all + 1)))).alias("base_score"),
                      score.alias("score"), (-score * F.lit(float(np.log2(10))) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))


def query(spark, sf_dir: str) -> DataFrame:
    return scored(read(spark, sf_dir, "documents"))
