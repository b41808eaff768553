"""Operator 9 - language identification with language-bitmask n-gram filters.

A letter with its two neighbours (letters, or a word edge) is one n-gram.  Per
language, the n-grams whose relative frequency is at least ``min_rate`` and at
least ``share`` of the frequency in the language that uses them most form the
language's set; a set holds at most ``1 / min_rate`` n-grams, which bounds
what is collected and broadcast.  All sets go into one bit-sliced Bloom
filter: a slot holds one bit per language and ANDing ``HASHES`` slots returns
the mask of all languages that contain an n-gram.  A text's hits per language
are summed, corrected for the filter's false positives, and the largest
decides.

Defined cases: NULL text, or text without a letter, is ``und`` with score 0;
equal hits go to the smallest language name; a language is learned from rows
with non-NULL ``lang`` only; nothing learned gives ``und`` everywhere; repeated
rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Shared, fold, mix, slices

MIN_RATE = 1e-5
SHARE = 0.5
HASHES = 3
MIN_KNOWN = 0.2  # pipeline: least share of a text's n-grams its language knows


def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    letter = np.fromiter((chr(i).isalpha() for i in range(0x10000)), bool, 0x10000)
    lower = np.fromiter((ord(chr(i).lower()[0]) for i in range(0x10000)), np.int64, 0x10000)
    return letter, lower


def _ngrams(texts: list[str], letter: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each n-gram, its row): 21 bits per code point, 0 is a word edge."""
    cp = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    row = np.concatenate([[0], row])
    low = cp < 0x10000
    small = np.where(low, cp, 0)
    is_letter, x = letter[small], lower[small]
    for c in np.unique(cp[~low]):
        if chr(c).isalpha():
            at = cp == c
            is_letter[at], x[at] = True, ord(chr(c).lower()[0])
    x = np.where(is_letter, x, 0)
    at = np.flatnonzero(is_letter)
    return (x[at - 1] << 42) | (x[at] << 21) | x[at + 1], row[at]


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text); one partial count per task and n-gram."""

    def count(batches):
        letter, lower = _alphabet()
        held: dict[str, list] = {}

        def merge(parts):
            codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return codes, np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

        for batch in batches:
            for part in slices(batch, "text"):
                langs = np.array(part.column("lang").to_pylist(), object)
                texts = [t or "" for t in part.column("text").to_pylist()]
                for lang in set(langs):
                    codes, _ = _ngrams([texts[i] for i in np.flatnonzero(langs == lang)], letter, lower)
                    parts = held.setdefault(lang, [])
                    parts.append(np.unique(codes, return_counts=True))
                    if len(parts) >= 16:
                        held[lang] = [merge(parts)]
        for lang, parts in held.items():
            codes, n = merge(parts)
            for i in range(0, codes.size, 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * codes[i:i + 100_000].size, pa.string()), pa.array(codes[i:i + 100_000]),
                     pa.array(n[i:i + 100_000])], names=["lang", "gram", "n"])

    parts = docs.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Filters:
    """Bit-sliced Bloom filters: ``slots[w, i]`` has bits of languages 64w .. 64w+63."""

    langs: list[str]
    slots: np.ndarray
    false_rate: np.ndarray

    @staticmethod
    def build(langs: list[str], lang: np.ndarray, gram: np.ndarray) -> "Filters":
        size = 1 << max(10, int(16 * max(1, np.unique(gram).size)).bit_length())
        slots = np.zeros(((len(langs) + 63) // 64 or 1, size), np.uint64)
        filled = np.zeros(len(langs))
        for k in range(len(langs)):
            own = gram[lang == k]
            for at in Filters.places(own, size):
                slots[k // 64, at] |= np.uint64(1 << (k % 64))
            filled[k] = np.count_nonzero(slots[k // 64] & np.uint64(1 << (k % 64))) / size
        return Filters(langs, slots, filled ** HASHES)

    @staticmethod
    def places(gram: np.ndarray, size: int) -> list[np.ndarray]:
        h = mix(gram.astype(np.uint64) + np.uint64(0x51ED270B))
        step = mix(h) | np.uint64(1)
        return [((h + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64) for k in range(HASHES)]

    def hits(self, gram: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Corrected hits per (row, language), and the n-grams per row."""
        total = np.bincount(row, minlength=rows).astype(float)
        at = self.places(gram, self.slots.shape[1])
        out = np.zeros((rows, len(self.langs)))
        for w in range(self.slots.shape[0]):
            mask = self.slots[w, at[0]]
            for a in at[1:]:
                mask = mask & self.slots[w, a]
            for k in range(64 * w, min(len(self.langs), 64 * w + 64)):
                bit = (mask >> np.uint64(k % 64)) & np.uint64(1)
                out[:, k] = np.bincount(row, weights=bit.astype(float), minlength=rows)
        return np.maximum(0, (out - total[:, None] * self.false_rate) / (1 - self.false_rate)), total

    def decide(self, texts: list[str], letter, lower) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Per text: language, score, and the share of its n-grams that the language knows."""
        gram, row = _ngrams(texts, letter, lower)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        hits, total = self.hits(gram, row, len(texts))
        best = hits.argmax(axis=1)
        top, every = hits[np.arange(len(texts)), best], hits.sum(axis=1)
        score = np.divide(top, every, out=np.zeros_like(top), where=every > 0)
        known = np.divide(top, total, out=np.zeros_like(top), where=total > 0)
        return [self.langs[b] if t else "und" for b, t in zip(best, total)], score, np.minimum(known, 1)


def learn(docs: DataFrame, min_rate: float = MIN_RATE, share: float = SHARE) -> Filters:
    """Filters from every row of (lang, text) with a non-NULL lang."""
    counts = count_ngrams(docs.filter("lang is not null"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rows = (counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total")).filter(F.col("rate") >= min_rate)
            .withColumn("most", F.max("rate").over(W.partitionBy("gram"))).filter(F.col("rate") >= share * F.col("most"))
            .select("lang", "gram").toArrow())  # at most 1 / min_rate rows per language
    names = rows.column("lang").to_pylist()
    langs = sorted(set(names))
    index = {x: k for k, x in enumerate(langs)}
    return Filters.build(langs, np.array([index[x] for x in names], np.int64), rows.column("gram").to_numpy())


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score, known) of every row of (doc_id, text)."""
    shared = Shared(docs.sparkSession, filters)

    def run(batches):
        (letter, lower), known_to = _alphabet(), shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                lang, score, known = known_to.decide([t or "" for t in part.column("text").to_pylist()], letter, lower)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(known)],
                                                 names=["doc_id", "lang_pred", "score", "known"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, known double")


def identified(docs: DataFrame, filters: Filters, min_known: float = MIN_KNOWN) -> DataFrame:
    """The rows of ``docs`` whose language is known: not ``und``, and at least
    ``min_known`` of the n-grams belong to the language decided on."""
    shared = Shared(docs.sparkSession, filters)

    def run(batches):
        (letter, lower), known_to = _alphabet(), shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                lang, _, known = known_to.decide([t or "" for t in part.column("text").to_pylist()], letter, lower)
                keep = (np.array(lang, object) != "und") & (known >= min_known)
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def training(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Rows to learn from: the id's fold is not 0 (a NULL id is not learned from)."""
    return docs.filter(fold(F.col("doc_id"), folds) != 0).select("lang", "text")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents")
    held = docs.select(F.col("doc_id").cast("long"), "text")
    out = predict(held, learn(training(docs)))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "known")
