"""Operator 12 - exact substring dedup behind a count-min prefilter.

A window of ``width`` consecutive words is a repeat in a document if the same
words also start in a document with a smaller id.  Every word under a repeat
goes; windows are judged on the input.

1. Sketch.  Each partition sends, per ``chunk`` windows, the sorted cells of
   its windows in the rows of a count-min sketch (a text counts each of its
   windows once), delta-coded and cut into blocks of cells.  Blocks are merged
   in a tree, 64 partitions at a time, with counts that stop at two.  A cell's
   count is never below the count of any window in it.
2. Exact grouping.  The bitmaps of cells that reached two are broadcast; their
   size is ``rows * 2**cell_bits`` bits (64 MB by default) however large the
   input.  A second pass over the texts takes the windows whose cells all
   reached two, by 96 bits (of two independent hashes).  A chunk settles what it
   can: only the occurrences in a window's smallest document of that chunk are
   sent on, so a passage of every text is one row per chunk.  They are grouped
   by window in shards of the hash space, whose number grows with the windows.
3. The repeats of each text meet it by (id, hash of the text), and the words
   that are left are written out.

No window with two documents can be lost: each of them raises its cells to
two.  A full sketch (far more windows than cells) passes more windows to the
exact grouping, which stays linear; it never changes the result.

Defined cases: NULL and empty texts have no words and keep the empty text;
texts of fewer than ``width`` words lose nothing; rows that share an id are
one document, each text judged by itself, so they do not remove each other's
words; a NULL id is not smaller than any and has no smaller one: such rows
keep all words and are no evidence; an empty table gives no rows; a text
longer than a chunk is a chunk of its own; other columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (AS_IS, SECOND, Shared, mix, pack, pack_plain, read, runs, runs_at, slices, unpack, unpack_plain, words,
                     written)

WIDTH = 13
CELL_BITS, ROWS, BLOCK_BITS = 28, 2, 22
CHUNK, SHARD = 1 << 20, 1 << 22  # windows held by a task; windows of the table for each shard of the grouping
FAN = 64
CELLS = "part int, block int, n long, ones binary, twos binary"
SENT = "shard int, doc_id long, th long, starts array<int>, hash binary, other binary, doc binary, at binary, ids binary, ths binary"
MARKS = "doc_id long, th long, starts array<int>, at int"
OUT = "doc_id long, n_words long, n_removed long, kept_text string"


def cells(w: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell of each window hash in one row of the sketch."""
    return mix(w + np.uint64(row)) >> np.uint64(64 - bits)


def sketch(docs: DataFrame, width: int, rows: int, bits: int, block: int, chunk: int) -> DataFrame:
    """The cells of each chunk of windows of (doc_id, text) rows, as CELLS."""
    per = 1 << bits - block

    def flush(part: int, held: list):
        w = np.concatenate(held)
        for r in range(rows):
            c = np.sort(cells(w, r, bits))
            new = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            twice = np.diff(np.append(new, c.size)) > 1
            c = c[new]
            cut = np.searchsorted(c, np.arange(per + 1, dtype=np.uint64) << np.uint64(block))
            for b in np.flatnonzero(np.diff(cut)):
                own = c[cut[b]:cut[b + 1]] - (np.uint64(b) << np.uint64(block))
                yield part, int(r * per + b), 0, pack(own), pack(own[twice[cut[b]:cut[b + 1]]])
        yield part, -1, w.size, None, None

    def run(batches):
        part, held, size = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            for texts in slices(batch, "text"):
                h, row, _ = words(texts.column("text"), AS_IS)
                w, at = runs(h, row, width)
                row = row[at]
                order = np.lexsort((w, row))
                w, row = w[order], row[order]
                w = w[np.r_[True, (w[1:] != w[:-1]) | (row[1:] != row[:-1])]] if w.size else w
                held.append(w)
                size += w.size
                if size >= chunk:
                    yield _batch(flush(part, held))
                    held, size = [], 0
        if size:
            yield _batch(flush(part, held))

    return docs.filter("doc_id is not null").select("text").mapInArrow(run, CELLS)


def _batch(rows) -> pa.RecordBatch:
    part, block, n, ones, twos = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(block, pa.int32()), pa.array(n, pa.int64()),
                                       pa.array(ones, pa.binary()), pa.array(twos, pa.binary())], names=["part", "block", "n", "ones", "twos"])


def merged(spark, parts: DataFrame, block: int, fan: int = FAN) -> DataFrame:
    """One row per block: a tree of merges, ``fan`` partitions a time, each streamed block by block."""

    def close(part, b, n, one, two):
        ones, twos = (np.flatnonzero(x).astype(np.uint64) for x in (one, two))
        return _batch([(part, b, n, pack(ones), pack(twos))])

    def run(batches):
        here, n = None, 0
        one, two = np.zeros(1 << block, bool), np.zeros(1 << block, bool)
        for batch in batches:
            for row in batch.to_pylist():
                if (row["part"], row["block"]) != here:
                    if here is not None:
                        yield close(*here, n, one, two)
                    here, n = (row["part"], row["block"]), 0
                    one[:], two[:] = False, False
                n += row["n"]
                if row["ones"] is not None:
                    c = unpack(row["ones"], np.uint64)
                    two[c[one[c]]] = True
                    one[c] = True
                    two[unpack(row["twos"], np.uint64)] = True
        if here is not None:
            yield close(*here, n, one, two)

    while True:
        up = parts.withColumn("part", F.floor(F.col("part") / fan).cast("int"))
        parts = written(spark, up.repartition("part", "block").sortWithinPartitions("part", "block").mapInArrow(run, CELLS), "sketch")
        if not (parts.agg(F.max("part")).first()[0] or 0):
            return parts


class Sketch:
    """Cells that at least two documents share, as bits; ``rows * 2**bits`` bits in all."""

    def __init__(self, blocks: list, rows: int, bits: int, block: int):
        self.rows, self.bits = rows, bits
        self.twice = np.zeros((rows, 1 << bits - 3), np.uint8)
        per = 1 << bits - block
        for b, raw in blocks:
            flag = np.zeros(1 << block, bool)
            flag[unpack(raw, np.uint64)] = True
            lo = (b % per) << block - 3
            self.twice[b // per, lo:lo + (1 << block - 3)] = np.packbits(flag, bitorder="little")

    def repeated(self, w: np.ndarray) -> np.ndarray:
        """Whether the estimate of each window is two or more."""
        ok = np.ones(w.size, bool)
        for r in range(self.rows):
            at = np.flatnonzero(ok)
            c = cells(w[at], r, self.bits)
            ok[at] = self.twice[r, c >> np.uint64(3)] >> (c & np.uint64(7)).astype(np.uint8) & 1 == 1
        return ok


def _later(hash_, other, doc_id):
    """Order by (window, id), and whether each occurrence, so ordered, has a smaller document."""
    order = np.lexsort((doc_id, other, hash_))
    h, o, d = hash_[order], other[order], doc_id[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])]
    return order, d > d[np.flatnonzero(new)][np.cumsum(new) - 1]


def _marked(doc: np.ndarray, at: np.ndarray):
    """(document, its sorted starts) of parallel arrays."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    cut = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if doc.size else np.zeros(0, np.int64)
    return doc[cut], np.split(at, cut[1:]) if doc.size else []


def occurrences(docs: DataFrame, sent: Shared, width: int, shards: int, chunk: int) -> DataFrame:
    """What each chunk found: starts already known to be repeats, and shards of windows to be grouped (SENT)."""

    def flush(held: list, ids: list, ths: list):
        hash_, other, doc, at = (np.concatenate(x) for x in zip(*held))
        ids, ths = np.array(ids, np.int64), np.array(ths, np.int64)
        order, later = _later(hash_, other, ids[doc])
        known = order[later]
        rows = [(k % shards, int(ids[d]), int(ths[d]), s, *[None] * 6) for k, (d, s) in enumerate(zip(*_marked(doc[known], at[known])))]
        open_ = order[~later]
        hash_, other, doc, at = hash_[open_], other[open_], doc[open_], at[open_]
        where = ((hash_ >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        cut = np.searchsorted(where, np.arange(shards + 1, dtype=np.uint64))
        by_id = np.argsort(ids.view(np.uint64))
        rank = np.empty_like(by_id)
        rank[by_id] = np.arange(by_id.size)
        for s in np.flatnonzero(np.diff(cut)):
            part = slice(cut[s], cut[s + 1])
            own, index = np.unique(rank[doc[part]], return_inverse=True)
            rows.append((int(s), None, None, None, pack(hash_[part]), other[part].tobytes(), pack_plain(index.astype(np.uint64)),
                         pack_plain(at[part].astype(np.uint64)), pack(ids[by_id[own]].view(np.uint64)), ths[by_id[own]].tobytes()))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), *[pa.binary()] * 6]
        names = ["shard", "doc_id", "th", "starts", "hash", "other", "doc", "at", "ids", "ths"]
        for k in range(0, len(rows), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 1000]), kinds)], names=names)

    def run(batches):
        twice = sent.value
        held, ids, ths, seen, size = [], [], [], {}, 0
        for batch in batches:
            for texts in slices(batch, "text"):
                key = list(zip(texts.column("doc_id").to_pylist(), texts.column("th").to_pylist()))
                fresh = np.zeros(len(key), bool)  # a repeated row adds nothing to its chunk
                number = np.zeros(len(key), np.int32)
                for k, x in enumerate(key):
                    if x not in seen:
                        seen[x] = number[k] = len(ids)
                        fresh[k] = True
                        ids.append(x[0])
                        ths.append(x[1])
                h, row, _ = words(texts.column("text"), AS_IS)
                w, at = runs(h, row, width)
                ok = fresh[row[at]]
                ok[ok] = twice.repeated(w[ok])
                w, at = w[ok], at[ok]
                if not w.size:
                    continue
                other = (runs_at(words(texts.column("text"), AS_IS, SECOND)[0], at, width) >> np.uint64(32)).astype(np.uint32)
                first = np.searchsorted(row, np.arange(len(key)))
                held.append((w, other, number[row[at]], (at - first[row[at]]).astype(np.int32)))
                size += w.size
                if size >= chunk:
                    yield from flush(held, ids, ths)
                    held, ids, ths, seen, size = [], [], [], {}, 0
        if size:
            yield from flush(held, ids, ths)

    return docs.filter("doc_id is not null").select("doc_id", "th", "text").mapInArrow(run, SENT)


def grouped(found: DataFrame) -> DataFrame:
    """MARKS: the repeats found by whole shards of windows, a row each (a document has windows
    in many shards), beside the starts that chunks had settled."""

    def run(table: pa.Table) -> pa.Table:
        done = table.filter(pc.is_valid(table.column("doc_id"))).select(["doc_id", "th", "starts"])
        done = done.append_column("at", pa.nulls(done.num_rows, pa.int32()))
        rows = [r for r in table.select(["hash", "other", "doc", "at", "ids", "ths"]).to_pylist() if r["hash"] is not None]
        if not rows:
            return done
        doc = [unpack_plain(r["doc"], np.int64) for r in rows]
        hash_, other, at, ids, ths = (np.concatenate(x) for x in (
            [unpack(r["hash"], np.uint64) for r in rows], [np.frombuffer(r["other"], np.uint32) for r in rows],
            [unpack_plain(r["at"], np.int32) for r in rows], [unpack(r["ids"], np.uint64).view(np.int64)[d] for r, d in zip(rows, doc)],
            [np.frombuffer(r["ths"], np.int64)[d] for r, d in zip(rows, doc)]))
        order, later = _later(hash_, other, ids)
        hit = order[later]
        marks = [pa.array(ids[hit]), pa.array(ths[hit]), pa.nulls(hit.size, pa.list_(pa.int32())), pa.array(at[hit])]
        return pa.concat_tables([done, pa.table([m.cast(k) for m, k in zip(marks, done.schema.types)], schema=done.schema)])

    return found.groupBy("shard").applyInArrow(run, MARKS)


def cut(docs: DataFrame, width: int = WIDTH, cell_bits: int = CELL_BITS, rows: int = ROWS, chunk: int = CHUNK) -> DataFrame:
    """OUT for every row of (doc_id, text): its words, those removed, and the text that is left (one space between words)."""
    spark, block = docs.sparkSession, min(BLOCK_BITS, cell_bits)
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumn("th", F.xxhash64("text"))
    blocks = merged(spark, sketch(docs, width, rows, cell_bits, block, chunk), block)
    total = blocks.agg(F.sum("n")).first()[0] or 0
    repeated = [(r["block"], r["twos"]) for r in blocks.filter("block >= 0").select("block", "twos").toLocalIterator()]  # rows * 2**bits bits at most
    sent = Shared(spark, Sketch(repeated, rows, cell_bits, block))
    found = occurrences(docs, sent, width, max(8, -(-total // SHARD)), chunk)
    starts = F.concat(F.flatten(F.collect_list("starts")), F.collect_list("at"))  # at most a start per word and chunk
    marks = grouped(found).groupBy("doc_id", "th").agg(starts.alias("starts"))
    marks = written(spark, marks, "repeats")
    sent.destroy()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for text, starts in zip(part.column("text").to_pylist(), part.column("starts")):
                    own = (text or "").encode().split()  # exactly at 0x20 and 0x09-0x0D
                    n = len(own)
                    if starts.is_valid:
                        step = np.zeros(n + 1, np.int64)
                        s = np.unique(starts.values.to_numpy())
                        step[s] += 1
                        step[s + width] -= 1
                        own = list(compress(own, np.cumsum(step)[:n] == 0))
                    out.append((n, n - len(own), b" ".join(own).decode()))
                n, gone, kept = zip(*out)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                                 names=["doc_id", "n_words", "n_removed", "kept_text"])

    return docs.join(marks, ["doc_id", "th"], "left").select("doc_id", "text", "starts").mapInArrow(run, OUT)


def query(spark, sf_dir: str) -> DataFrame:
    out = cut(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
with worded as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
windows as (
    select doc_id, i, array_to_string(ws[i:i + 12], ' ') as g
    from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from worded)),
firsts as (select g, min(doc_id) as first_id from windows group by g),
covered as (
    select distinct doc_id, i + j as k
    from (select doc_id, i from windows join firsts using (g) where doc_id > first_id), range(13) as t(j)),
kept as (
    select w.doc_id, w.word, w.k
    from (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as k from worded) w anti join covered using (doc_id, k)),
joined as (select doc_id, count(*) as n, string_agg(word, ' ' order by k) as t from kept group by doc_id)
select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from worded left join joined using (doc_id)
"""
