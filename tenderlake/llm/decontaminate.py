"""Operator 1 - benchmark decontamination with greedy string tiling.

Five-word seeds of the benchmark are looked up in the running windows of every
text.  An item whose positions under shared seeds reach the threshold (an
upper bound of any tiling, as a tile holds seeds only) is tiled against the
text: the longest common run of unmarked words, found by Karp-Rabin windows of
varied length, is marked on both sides, again and again until no run of
``min_match`` words is left.  Order does not matter, so reordered passages are
caught; each word serves one tile, so repeats inside an item must repeat in
the text.  A text is contaminated by an item when tiles cover at least
``min_cover`` of the item's words.

The benchmark goes out in blocks of at most ``block_words`` words (a longer
item is a block of its own), one pass over the texts per block, so a broadcast
never exceeds that bound and no text is shuffled.

Defined cases: NULL or empty texts and items match nothing; items with fewer
than ``min_match`` words are no evidence and match nothing; repeated items or
rows are reported each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, read, rolling, runs, slices, window, words, written

MIN_MATCH = 5
MIN_COVER = 0.8
BLOCK_WORDS = 1_000_000


def longest(a, b, mark_a: np.ndarray, mark_b: np.ndarray, least: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Length of the longest common window of unmarked words, and the window hashes
    of that length (0 where marked); length 0 if none has ``least`` words."""
    ca, cb = (np.concatenate([[0], np.cumsum(m)]) for m in (mark_a, mark_b))

    def at(n: int):
        wa, wb = window(a, n), window(b, n)
        free_a, free_b = ca[n:] == ca[:-n], cb[n:] == cb[:-n]
        return wa, wb, free_a & np.isin(wa, wb[free_b]), free_b

    lo, hi, best = 0, min(mark_a.size, mark_b.size), None
    step = least
    while step <= hi:  # gallop, then bisect: a common window of n words holds one of n - 1
        found = at(step)
        if not found[2].any():
            hi = step - 1
            break
        lo, best, step = step, found, 2 * step
    while lo and lo < hi:
        mid = (lo + hi + 1) // 2
        found = at(mid)
        if found[2].any():
            lo, best = mid, found
        else:
            hi = mid - 1
    return (lo, *best) if best else (0, None, None, None, None)


def tile(item: np.ndarray, text: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles (item position, text position, words), longest first, then leftmost."""
    if min(item.size, text.size) < least:
        return []
    a, b = rolling(item), rolling(text)
    mark_a, mark_b = np.zeros(item.size, bool), np.zeros(text.size, bool)
    tiles = []
    while True:
        n, wa, wb, common, free = longest(a, b, mark_a, mark_b, least)
        if not n:
            return tiles
        spots: dict[int, Iterator[int]] = {}
        where = np.flatnonzero(free)
        order = where[np.argsort(wb[where], kind="stable")]
        keys = wb[order]
        before = len(tiles)
        for i in np.flatnonzero(common):
            if mark_a[i:i + n].any():
                continue
            key = int(wa[i])
            if key not in spots:
                lo, hi = np.searchsorted(keys, wa[i], "left"), np.searchsorted(keys, wa[i], "right")
                spots[key] = iter(order[lo:hi])
            for j in spots[key]:
                if not mark_b[j:j + n].any() and np.array_equal(item[i:i + n], text[j:j + n]):
                    mark_a[i:i + n], mark_b[j:j + n] = True, True
                    tiles.append((int(i), int(j), int(n)))
                    break
        if len(tiles) == before:  # equal hashes of different words: nothing to mark at this length
            return tiles


class Block:
    """Seeds and words of some benchmark items."""

    def __init__(self, ids: list, texts: list[np.ndarray], least: int):
        self.ids, self.texts, self.least = ids, texts, least
        h = np.concatenate([np.zeros(0, np.uint64), *texts])
        row = np.repeat(np.arange(len(texts)), [t.size for t in texts])
        seed, at = runs(h, row, least)
        order = np.argsort(seed, kind="stable")
        self.seed, start = np.unique(seed[order], return_index=True)
        self.start = np.append(start, seed.size)
        first = np.concatenate([[0], np.cumsum([t.size for t in texts])])
        self.item, self.pos = row[at][order], (at - first[row[at]])[order]
        self.seen = np.zeros(1 << 20, bool)  # cheap first test by the top bits
        self.seen[(self.seed >> np.uint64(44)).astype(np.int64)] = True

    def matches(self, h: np.ndarray, row: np.ndarray, min_cover: float):
        """(row, item index, covered words, tiles) of the rows of a slice."""
        if not self.seed.size:
            return
        seed, at = runs(h, row, self.least)
        maybe = np.flatnonzero(self.seen[(seed >> np.uint64(44)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.seed, seed[maybe]), self.seed.size - 1)
        ok = self.seed[k] == seed[maybe]
        k, at = k[ok], at[maybe[ok]]
        rows = row[at]
        cut = np.flatnonzero(np.diff(rows)) + 1
        for ks, ats in zip(np.split(k, cut), np.split(at, cut)):
            if not ats.size:
                continue
            found = np.unique(ks)
            n = self.start[found + 1] - self.start[found]
            member = np.repeat(self.start[found] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            item, pos = self.item[member], self.pos[member]
            order = np.lexsort((pos, item))
            item, pos = item[order], pos[order]
            step = np.where(np.diff(item) == 0, np.minimum(np.diff(pos), self.least), self.least)
            most = np.bincount(item, weights=np.append(step, self.least), minlength=len(self.texts))
            for i in np.flatnonzero(most):
                words_i = self.texts[i]
                if most[i] < min_cover * words_i.size:
                    continue
                own = np.isin(ks, found[np.isin(found, np.repeat(found, n)[order][item == i])])
                tiles = tile(words_i, self.near(h, ats[own]), self.least)
                covered = sum(t[2] for t in tiles)
                if covered >= min_cover * words_i.size:
                    yield int(row[ats[0]]), int(i), covered, len(tiles)

    def near(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The words under the seeds at ``at``, with a word that occurs nowhere between regions."""
        at = np.unique(at)
        gap = np.flatnonzero(np.diff(at) > self.least) + 1
        out = []
        for k, part in enumerate(np.split(at, gap)):
            out += [h[part[0]:part[-1] + self.least], np.array([k], np.uint64)]
        return np.concatenate(out)


def blocks(benchmark: DataFrame, least: int, block_words: int) -> Iterator[Block]:
    """Blocks of items, read partition by partition; a block is bounded by its words."""
    ids, texts, held = [], [], 0
    for item in benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null").toLocalIterator():
        h = words(pa.array([item["text"]]))[0]
        if h.size < least:
            continue
        if held and held + h.size > block_words:
            yield Block(ids, texts, least)
            ids, texts, held = [], [], 0
        ids.append(item["item_id"])
        texts.append(h)
        held += h.size
    if ids:
        yield Block(ids, texts, least)


PAIRS = "doc_id long, item_id long, item_words long, covered_words long, tiles long, coverage double"


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, min_cover: float = MIN_COVER,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per text and benchmark item that it contains (see PAIRS)."""
    spark = docs.sparkSession

    def scan(block):
        shared = Shared(spark, block)

        def run(batches):
            b = shared.value
            for batch in batches:
                for part in slices(batch, "text"):
                    h, row, _ = words(part.column("text"))
                    ids = part.column("doc_id")
                    hit = list(b.matches(h, row, min_cover))
                    if hit:
                        size = [b.texts[i].size for _, i, _, _ in hit]
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array([r for r, *_ in hit])), pa.array([b.ids[i] for _, i, _, _ in hit], pa.int64()),
                             pa.array(size, pa.int64()), pa.array([c for _, _, c, _ in hit], pa.int64()),
                             pa.array([t for *_, t in hit], pa.int64()), pa.array([h[2] / n for h, n in zip(hit, size)], pa.float64())],
                            names=["doc_id", "item_id", "item_words", "covered_words", "tiles", "coverage"])

        return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PAIRS), shared

    done, ahead = [], blocks(benchmark, min_match, block_words)
    block = next(ahead, None)
    while block is not None:
        out, shared = scan(block)
        block = next(ahead, None)
        if block is not None or done:  # more than one block: write each result and free the block
            out = written(spark, out, "tiles")
            shared.destroy()
        done.append(out)
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], PAIRS)


def clean(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, min_cover: float = MIN_COVER,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item; a filter inside the scan, nothing is shuffled.
    A benchmark of several blocks takes a pass each, over the rows that the one before left."""
    spark = docs.sparkSession
    ahead = blocks(benchmark, min_match, block_words)
    block = next(ahead, None)
    while block is not None:
        shared = Shared(spark, block)

        def run(batches, shared=shared):
            b = shared.value
            for batch in batches:
                for part in slices(batch, "text"):
                    h, row, _ = words(part.column("text"))
                    keep = np.ones(part.num_rows, bool)
                    keep[[m[0] for m in b.matches(h, row, min_cover)]] = False
                    yield part.filter(pa.array(keep))

        docs, block = docs.mapInArrow(run, docs.schema), next(ahead, None)
        if block is not None:  # one block is out at a time: what it leaves is written before the next
            docs = written(spark, docs, "clean")
            shared.destroy()
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
