"""Operator 13 - alignment of two tokenizers, with corpus-wide link counts.

A text is encoded by A (byte-level BPE, of space + text) and by B (pieces with
byte fallback, which adds the space itself).  Byte offsets at which tokens of
both end cut the text into groups; every A token of a group is linked with
every B token of it.  The count of an id pair is the number of rows that hold
it linked.

1. First pass: texts are encoded once, in slices of about a megabyte, and
   aligned with a bitmap of B's token ends.  The ids are written as 16-bit (or
   32-bit) binaries beside the figures of each text; each chunk of a task adds
   its distinct pairs with the number of its rows that hold them.
2. The distinct pairs are dealt to shards by hash, and every shard builds a
   minimal perfect hash: levels of bits, one per key that meets no other, and
   the rank of a key's bit is its index.  The keys are kept in index order, so
   that a lookup is verified.
3. Chunks add their counts to dense vectors indexed by that hash, and the
   vectors are summed in a tree, 64 partitions at a time.  The largest count of
   each A id (a row per id of the vocabulary) follows from the vectors.
4. Second pass: the written ids are aligned again and the counts looked up.

Hashes, keys and counts are broadcast in blocks of at most ``block_keys``
pairs, about 17 bytes each.  The pairs are bounded by the product of the two
vocabularies, not by the input; if they need several blocks, each takes a pass
over the written ids and the partial sums of a text are added.

Links of large groups are counted by distinct ids with their multiplicities,
and expanded in pieces of bounded size.  The tokenizers' files are read once by
the driver and sent as they are, so the executors need no copy.

Defined cases: NULL and empty texts, and texts whose joined token bytes of A or
B are not space + text (U+2581 in a text, for example), have no tokens: zeros
and an empty string; special tokens' strings are plain text; rows that repeat
count each; ids, also NULL ones, are only carried; no rows give none; a text
longer than a slice is a slice of its own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.session import scratch_path

from .common import Shared, mix, pack, pack_plain, read, slices, unpack, unpack_plain, written

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SHARD_KEYS, BLOCK_KEYS, PIECE, FAN = 1 << 20, 1 << 22, 1 << 16, 64
BIG_GROUP, EXPANDED, CHUNK_PAIRS = 4096, 1 << 22, 1 << 22
CACHED = 1 << 19  # words that a task keeps encoded
SPACE_MARK = "\u2581"  # B's space
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
EDGE = re.compile(r"^\s|\s\Z")
_SEED = np.uint64(0x9E3779B97F4A7C15)
FIGURES = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
TOKENS = FIGURES + ", a binary, b binary, pairs binary, rows binary"
COUNTED = FIGURES + ", n_best long, count_sum long"


# ---------------------------------------------------------------- vocabularies
class Vocabularies:
    """Two tokenizers by the bytes of their files, and the bytes of every id."""

    def __init__(self, a_file: str, b_file: str):
        with open(a_file, "rb") as f:
            self.a_raw = f.read()
        with open(b_file, "rb") as f:
            self.b_raw = f.read()
        self.loaded = None
        tk, sp = self.load()
        # byte-level symbols: printable Latin-1 characters stand for themselves, the other bytes for U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        by_id = sorted((i, s) for s, i in tk.get_vocab(with_added_tokens=True).items())
        self.a_bytes = [b""] * (by_id[-1][0] + 1)
        for i, s in by_id:
            self.a_bytes[i] = bytes(byte[c] for c in s) if all(c in byte for c in s) else s.encode()
        self.b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(SPACE_MARK, " ").encode()
                        for i in range(sp.vocab_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        self.a_flat, self.b_flat = Bytes(self.a_bytes), Bytes(self.b_bytes)
        self.by_word = all(SPACE_MARK not in sp.id_to_piece(i).lstrip(SPACE_MARK) for i in range(sp.vocab_size()))
        self.loaded = None  # sent as bytes

    def load(self):
        if self.loaded is None:
            import sentencepiece
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            tk = Tokenizer.from_str(self.a_raw.decode())
            tk.encode_special_tokens = True
            sp = sentencepiece.SentencePieceProcessor(model_proto=self.b_raw)
            self.loaded = tk, sp
        return self.loaded

    def encode(self, texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A, ids of B, their numbers in each text); none where the joined bytes are not space + text."""
        tk, sp = self.load()
        plain = [bool(t) and self.by_word and SPACE_MARK not in t and n == SPACE_MARK + t.replace(" ", SPACE_MARK) for t, n in zip(texts, sp.normalize(texts))]
        split = [BETWEEN.split(t) if p else [] for t, p in zip(texts, plain)]
        cut = np.cumsum([0, *map(len, split)])
        ids = []
        for flat, per_word in words.encode(list(chain.from_iterable(split)), self):
            at = np.concatenate([[0], np.cumsum(per_word)])[cut]
            ids.append([flat[at[k]:at[k + 1]] for k in range(len(texts))])
        for k, (t, p) in enumerate(zip(texts, plain)):
            if t and not p:
                ids[0][k], ids[1][k] = (np.array(x, np.int64) for x in (tk.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)))
            if any(kind.joined(own[k]) != (" " + t).encode() for kind, own in zip((self.a_flat, self.b_flat), ids)):
                ids[0][k] = ids[1][k] = np.zeros(0, np.int64)
        none = np.zeros(0, np.int64)
        return (*(np.concatenate([none, *x]) for x in ids), *(np.array([y.size for y in x], np.int64) for x in ids))


class Bytes:
    """The bytes of every id in one buffer."""

    def __init__(self, by_id: list[bytes]):
        self.size = np.array([len(x) for x in by_id], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        return self.flat[ranges(self.start[ids], self.size[ids])].tobytes()


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of ``n`` places each, one after the other."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Words:
    """Ids of A and B of the words that a task has met, ``limit`` words at most.

    A's pattern ends a piece before every space between two other characters
    (only runs of white space look ahead, nothing looks behind), and no piece of
    B has a space behind another character, so where B leaves the characters
    alone " word" has the same ids wherever it stands.  New words are encoded as
    one text.
    """

    def __init__(self, limit: int = CACHED):
        self.limit = limit
        self.clear()

    def clear(self):
        self.at, none = {}, np.zeros(0, np.int64)
        self.held = [(none, none, none)] * 2  # of A and B: ids, first id and number of ids of each word

    def encode(self, own: list[str], v: Vocabularies) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: (ids one word after the other, number of ids of each word) of " word" for each word."""
        known = self.at
        new = list(dict.fromkeys(w for w in own if w not in known))
        if len(known) + len(new) > self.limit and known:
            self.clear()
            known, new = self.at, list(dict.fromkeys(own))
        if new:
            new.sort(key=lambda w: EDGE.search(w) is not None)
            inner = next((k for k, w in enumerate(new) if EDGE.search(w)), len(new))
            tk, sp = v.load()
            found: tuple[list, list] = [], []  # (ids, ids of each word) of A and of B
            # words with white space at an end, from the ends of texts, stand alone
            for some in filter(None, (new[:inner], *([w] for w in new[inner:]))):
                text, ends = " ".join(some), np.cumsum([len(w.encode()) + 1 for w in some])
                for to, ids, size in zip(found, (tk.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)), (v.a_size, v.b_size)):
                    ids = np.array(ids, np.int64)
                    token_ends = np.cumsum(size[ids])
                    last = np.searchsorted(token_ends, ends)
                    if token_ends[-1] != ends[-1] or not np.array_equal(token_ends[last], ends):
                        raise ValueError("the tokenizer does not split at single spaces")
                    to.append((ids, np.diff(last + 1, prepend=0)))
            for k, (before, now) in enumerate(zip(self.held, found)):
                ids, n = (np.concatenate(x) for x in zip(*now))
                self.held[k] = tuple(np.concatenate(x) for x in zip(before, (ids, before[0].size + np.cumsum(n) - n, n)))
            known.update(zip(new, range(len(known), len(known) + len(new))))
        at = np.fromiter(map(known.__getitem__, own), np.int64, len(own))
        return [(ids[ranges(start[at], n[at])], n[at]) for ids, start, n in self.held]


def _kind(size: int):
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


# -------------------------------------------------------------------- alignment
class Aligned:
    """Groups of consecutive texts; ``a`` and ``b`` are their ids, ``na`` and ``nb`` the ids of each text."""

    def __init__(self, a, b, na, nb, a_size, b_size):
        self.a, self.b, self.na, self.nb = a, b, na, nb
        end_a, end_b = np.cumsum(a_size[a]), np.cumsum(b_size[b])
        is_end = np.zeros((end_a[-1] if a.size else 0) + 1, bool)
        is_end[end_b] = True
        self.last_a = is_end[end_a]  # ends where a token of B ends
        is_end[:] = False
        is_end[end_a] = True
        self.last_b = is_end[end_b]
        self.ga, self.gb = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        groups = int(self.last_a.sum())
        self.ca, self.cb = np.bincount(self.ga, minlength=groups), np.bincount(self.gb, minlength=groups)
        self.row = np.repeat(np.arange(na.size), na)[self.last_a]  # text of each group

    def per_text(self, weight=None) -> np.ndarray:
        return np.bincount(self.row, weights=weight, minlength=self.na.size).astype(np.int64)

    def links(self) -> np.ndarray:
        total = np.zeros(self.na.size, np.int64)
        np.add.at(total, self.row, self.ca * self.cb)
        return total

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) of every distinct pair of every text, ordered; a pair is a * width + b."""
        big = self.ca * self.cb > BIG_GROUP
        found = [_unique(k, n) for k, n in self._expanded(self.a, self.ga, None, self.b, self.gb, None, big, width)]
        if big.any():
            in_a, in_b = big[self.ga], big[self.gb]
            ka, ma = np.unique(self.ga[in_a] * np.int64(1 << 32) + self.a[in_a], return_counts=True)
            kb, mb = np.unique(self.gb[in_b] * np.int64(1 << 32) + self.b[in_b], return_counts=True)
            low = np.int64((1 << 32) - 1)
            found += [_unique(k, n) for k, n in self._expanded(ka & low, ka >> 32, ma, kb & low, kb >> 32, mb, ~big, width)]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        key, links = found[0] if len(found) == 1 else _unique(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))
        return key >> 48, key & np.int64((1 << 48) - 1), links

    def _expanded(self, a, ga, ma, b, gb, mb, skip, width):
        """Pieces of (text << 48 | pair, links) of all pairs in the groups that are not skipped."""
        count = np.bincount(gb, minlength=skip.size)
        start = np.cumsum(count) - count
        own = np.flatnonzero(~skip[ga])
        n = count[ga[own]]
        total = np.cumsum(n)
        lo = 0
        while lo < own.size:
            before = total[lo] - n[lo]
            hi = max(lo + 1, int(np.searchsorted(total, before + EXPANDED, side="right")))
            token = np.repeat(own[lo:hi], n[lo:hi])
            other = start[ga[token]] + np.arange(token.size) - np.repeat(total[lo:hi] - n[lo:hi] - before, n[lo:hi])
            links = np.ones(token.size, np.int64) if ma is None else ma[token] * mb[other]
            yield self.row[ga[token]] << 48 | a[token].astype(np.int64) * width + b[other], links
            lo = hi

    def written_out(self, names_a, names_b) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each text; the names are ids with , and with | (or ;) behind them."""
        out = np.empty(self.a.size + self.b.size, object)
        start_a, start_b = np.cumsum(self.ca) - self.ca, np.cumsum(self.cb) - self.cb
        out[np.arange(self.a.size) + start_b[self.ga]] = names_a[self.last_a.astype(np.int8), self.a]
        out[np.arange(self.b.size) + (start_a + self.ca)[self.gb]] = names_b[self.last_b.astype(np.int8), self.b]
        at = np.concatenate([[0], np.cumsum(self.na + self.nb)])
        return ["".join(out[at[k]:at[k + 1]].tolist())[:-1] for k in range(self.na.size)]


def _unique(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ordered, and the sum of ``n`` under each."""
    if not key.size:
        return key, n
    if n.min() == n.max():  # equal weights: no need to know the places
        key = np.sort(key)
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        return key[cut], np.diff(np.append(cut, key.size)) * n[0]
    order = np.argsort(key, kind="stable")
    key = key[order]
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[cut], np.add.reduceat(n[order], cut)


def names(size: int, last: str) -> np.ndarray:
    return np.array([[f"{i}," for i in range(size)], [f"{i}{last}" for i in range(size)]], object)


def encoded(docs: DataFrame, sent: Shared) -> DataFrame:
    """TOKENS: a row per text, and a row per chunk of distinct pairs (``row`` is NULL)."""

    def run(batches):
        v = sent.value
        kind_a, kind_b, width = _kind(v.a_size.size), _kind(v.b_size.size), v.b_size.size
        names_a, names_b = names(v.a_size.size, "|"), names(width, ";")
        held, size, words = [], 0, Words()
        schema = pa.schema([*[(c, pa.int64()) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")],
                            ("groups_sha256", pa.string()), *[(c, pa.binary()) for c in ("a", "b", "pairs", "rows")]])

        def chunk():
            pair, n = _unique(np.concatenate([p for p, _ in held]), np.concatenate([n for _, n in held]))
            return pair, n

        def sent_off(pair, n):
            return pa.RecordBatch.from_pylist([{"pairs": pack(pair.astype(np.uint64)), "rows": pack_plain(n.astype(np.uint64))}], schema)

        for batch in batches:
            for part in slices(batch, "text"):
                a, b, na, nb = v.encode([t or "" for t in part.column("text").to_pylist()], words)
                own = Aligned(a, b, na, nb, v.a_size, v.b_size)
                sha = [hashlib.sha256(s.encode()).hexdigest() if n else "" for s, n in zip(own.written_out(names_a, names_b), na)]
                raw_a, raw_b = ([x.tobytes() for x in np.split(ids.astype(kind), np.cumsum(n)[:-1])]
                                for ids, n, kind in ((a, na, kind_a), (b, nb, kind_b)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(na), pa.array(nb), pa.array(own.per_text()), pa.array(own.links()),
                     pa.array(sha, pa.string()), pa.array(raw_a, pa.binary()), pa.array(raw_b, pa.binary()),
                     pa.nulls(len(sha), pa.binary()), pa.nulls(len(sha), pa.binary())], schema=schema)
                pair, n = np.unique(own.pairs(width)[1], return_counts=True)  # rows that hold each pair
                held.append((pair, n))
                size += pair.size
                if size > CHUNK_PAIRS:
                    held = [chunk()]
                    size = held[0][0].size
                    if 2 * size > CHUNK_PAIRS:
                        yield sent_off(*held[0])
                        held, size = [], 0
        if size:
            yield sent_off(*chunk())

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    path = scratch_path(docs.sparkSession, "tokens")
    rows.mapInArrow(run, TOKENS).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(TOKENS).parquet(path)


# --------------------------------------------------------- minimal perfect hash
class Shard:
    """Minimal perfect hash of distinct keys: every key has its own index below their number."""

    def __init__(self, keys: np.ndarray):
        self.sizes, bits, left = [], [], keys.astype(np.uint64)
        while left.size:
            m = -(-2 * left.size // 64) * 64
            at = self.place(left, len(self.sizes), m)
            alone = np.bincount(at, minlength=m)[at] == 1
            level = np.zeros(m, bool)
            level[at[alone]] = True
            self.sizes.append(m)
            bits.append(level)
            left = left[~alone]
        self.bits = np.packbits(np.concatenate(bits), bitorder="little").view("<u8") if bits else np.zeros(0, np.uint64)
        self.rank = (np.cumsum(np.bitwise_count(self.bits)) - np.bitwise_count(self.bits)).astype(np.uint32)
        self.keys = np.zeros(keys.size, np.int64)
        self.keys[self.index(keys)] = keys

    @staticmethod
    def place(keys: np.ndarray, level: int, m: int) -> np.ndarray:
        return (mix(keys.astype(np.uint64) * _SEED + np.uint64(level)) % np.uint64(m)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        out, left, base = np.zeros(keys.size, np.int64), np.arange(keys.size), 0
        for level, m in enumerate(self.sizes):
            at = base + self.place(keys[left], level, m)
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = word >> bit & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.rank[at >> 6] + np.bitwise_count(below))[hit]
            left = left[~hit]
            base += m
            if not left.size:
                break
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for one that is not in the shard."""
        if not self.keys.size:
            return np.full(keys.size, -1)
        at = self.index(keys)
        return np.where(self.keys[at] == keys, at, -1)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) ^ _SEED) % np.uint64(shards)).astype(np.int32)


class Index:
    """Consecutive shards with one index range; with counts and, per A id, the best count after the summing."""

    def __init__(self, parts: list[tuple[int, Shard]], shards: int):
        self.shards, self.parts = shards, dict(parts)
        size = np.array([s.keys.size for _, s in parts], np.int64)
        self.first = dict(zip(self.parts, np.cumsum(size) - size))
        self.n = int(size.sum())
        self.counts = self.best = None

    def find(self, keys: np.ndarray) -> np.ndarray:
        if self.shards == 1:
            return self.parts[0].find(keys)
        out, where = np.full(keys.size, -1), shard_of(keys, self.shards)
        for s in np.intersect1d(where, list(self.parts)):
            own = np.flatnonzero(where == s)
            at = self.parts[s].find(keys[own])
            out[own] = np.where(at >= 0, at + self.first[s], -1)
        return out

    def keys(self) -> np.ndarray:
        return np.concatenate([s.keys for s in self.parts.values()])


def hashed(tokens: DataFrame, shard_keys: int) -> tuple[DataFrame, int]:
    """(shard, n, sizes, bits, keys) of the distinct pairs, and the number of shards."""
    spark = tokens.sparkSession

    def pairs(batches):
        for batch in batches:
            for raw in batch.column("pairs").to_pylist():
                keys = unpack(raw, np.uint64).astype(np.int64)
                for k in range(0, keys.size, 1 << 18):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[k:k + (1 << 18)])], names=["pair"])

    keys = written(spark, tokens.filter("pairs is not null").select("pairs").mapInArrow(pairs, "pair long").distinct(), "pairs")
    shards = max(1, -(-keys.count() // shard_keys))

    def dealt(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("pair"), pa.array(shard_of(batch.column("pair").to_numpy(), shards))], names=["pair", "shard"])

    def build(table: pa.Table) -> pa.Table:
        s = Shard(np.sort(table.column("pair").to_numpy()))
        return pa.table({"shard": table.column("shard").slice(0, 1), "n": [s.keys.size], "sizes": pa.array([s.sizes], pa.list_(pa.int64())),
                         "bits": pa.array([s.bits.tobytes()], pa.binary()), "keys": pa.array([s.keys.tobytes()], pa.binary())})

    built = keys.mapInArrow(dealt, "pair long, shard int").groupBy("shard").applyInArrow(build, "shard int, n long, sizes array<long>, bits binary, keys binary")
    return written(spark, built, "perfect-hash"), shards


def blocks(table: DataFrame, shards: int, block_keys: int):
    """Index after Index of at most ``block_keys`` pairs (a shard that has more is a block of its own)."""
    sizes = [(r["shard"], r["n"]) for r in table.select("shard", "n").orderBy("shard").collect()]  # a row per shard
    cuts, held = [[]], 0
    for s, n in sizes:
        if held and held + n > block_keys:
            cuts.append([])
            held = 0
        cuts[-1].append(s)
        held += n
    for own in filter(None, cuts):
        parts = []
        for r in table.filter(F.col("shard").isin(own)).orderBy("shard").toLocalIterator():
            s = object.__new__(Shard)
            s.sizes, s.bits, s.keys = r["sizes"], np.frombuffer(r["bits"], "<u8"), np.frombuffer(r["keys"], np.int64)
            s.rank = (np.cumsum(np.bitwise_count(s.bits)) - np.bitwise_count(s.bits)).astype(np.uint32)
            parts.append((r["shard"], s))
        yield Index(parts, shards)


# ---------------------------------------------------------------------- counting
def summed(tokens: DataFrame, index: Shared) -> DataFrame:
    """(piece, counts): the dense vector of the index, summed in a tree."""
    spark, fan = tokens.sparkSession, FAN
    kind = "part int, piece int, counts binary"

    def out(part, piece, counts):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([piece], pa.int32()), pa.array([pack_plain(counts)], pa.binary())],
                                          names=["part", "piece", "counts"])

    def count(batches):
        own, total = index.value, None
        for batch in batches:
            for pairs, rows in zip(batch.column("pairs").to_pylist(), batch.column("rows").to_pylist()):
                total = np.zeros(own.n, np.int64) if total is None else total
                at = own.find(unpack(pairs, np.uint64).astype(np.int64))
                n = unpack_plain(rows, np.int64)
                total[at[at >= 0]] += n[at >= 0]  # a chunk has a pair once
        if total is not None:
            for k in range(0, own.n, PIECE):
                yield out(TaskContext.get().partitionId(), k // PIECE, total[k:k + PIECE].astype(np.uint64))

    def add(batches):
        here, total = None, None
        for batch in batches:
            for r in batch.to_pylist():
                counts = unpack_plain(r["counts"], np.uint64)
                if (r["part"], r["piece"]) == here:
                    total += counts
                    continue
                if here is not None:
                    yield out(*here, total)
                here, total = (r["part"], r["piece"]), counts
        if here is not None:
            yield out(*here, total)

    parts = tokens.filter("pairs is not null").select("pairs", "rows").mapInArrow(count, kind)
    while True:
        up = parts.withColumn("part", F.floor(F.col("part") / fan).cast("int"))
        parts = written(spark, up.repartition("part", "piece").sortWithinPartitions("part", "piece").mapInArrow(add, kind), "counts")
        if not (parts.agg(F.max("part")).first()[0] or 0):
            return parts.select("piece", "counts")


def best_counts(pieces: DataFrame, index: Shared, width: int) -> DataFrame:
    """(a, best): the highest count of each A id of one block."""

    def run(batches):
        keys = index.value.keys()
        for batch in batches:
            for piece, raw in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist()):
                counts = unpack_plain(raw, np.int64)
                a = keys[piece * PIECE:piece * PIECE + counts.size] // width
                order = np.lexsort((counts, a))
                last = np.flatnonzero(np.r_[a[order][1:] != a[order][:-1], True])
                yield pa.RecordBatch.from_arrays([pa.array(a[order][last]), pa.array(counts[order][last])], names=["a", "best"])

    return pieces.mapInArrow(run, "a long, best long").groupBy("a").agg(F.max("best").alias("best"))


def looked_up(tokens: DataFrame, index: Shared, a_size: np.ndarray, b_size: np.ndarray) -> DataFrame:
    """COUNTED of every text, as far as the pairs of this index go."""
    columns = [c.split()[0] for c in FIGURES.split(", ")]

    def run(batches):
        own = index.value
        kind_a, kind_b, width = _kind(a_size.size), _kind(b_size.size), b_size.size
        for batch in batches:
            for part in slices(batch, "a"):
                na, nb = (part.column(c).to_numpy() for c in ("n_a", "n_b"))
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), kind).astype(np.int64) for c, kind in (("a", kind_a), ("b", kind_b)))
                row, pair, links = Aligned(a, b, na, nb, a_size, b_size).pairs(width)
                keys, at = np.unique(pair, return_inverse=True)
                where = own.find(keys)
                count = np.where(where >= 0, own.counts[where], 0)
                best = (where >= 0) & (count == own.best[keys // width])
                n_best, total = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                np.add.at(n_best, row, links * best[at])
                np.add.at(total, row, links * count[at])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], pa.array(n_best), pa.array(total)],
                                                 names=[*columns, "n_best", "count_sum"])

    return tokens.filter("row is not null").select(*columns, "a", "b").mapInArrow(run, COUNTED)


def aligned(docs: DataFrame, a_file: str, b_file: str, shard_keys: int = SHARD_KEYS, block_keys: int = BLOCK_KEYS) -> DataFrame:
    """COUNTED for every row of (doc_id, text)."""
    spark = docs.sparkSession
    v = Vocabularies(a_file, b_file)
    sent = Shared(spark, v)
    tokens = encoded(docs, sent)
    sent.destroy()
    table, shards = hashed(tokens, shard_keys)
    vectors, tops = [], []
    for index in blocks(table, shards, block_keys):
        shared = Shared(spark, index)
        vectors.append(summed(tokens, shared))
        tops.append(written(spark, best_counts(vectors[-1], shared, v.b_size.size), "best"))
        shared.destroy()
    best = np.zeros(v.a_size.size, np.int64)
    if tops:
        for r in reduce(DataFrame.unionByName, tops).groupBy("a").agg(F.max("best").alias("best")).toLocalIterator():  # a row per A id
            best[r["a"]] = r["best"]
    done = []
    for index, pieces in zip(blocks(table, shards, block_keys), vectors):
        counts = [unpack_plain(r["counts"], np.int64) for r in pieces.orderBy("piece").toLocalIterator()]  # block_keys numbers at most
        index.counts, index.best = np.concatenate(counts), best
        shared = Shared(spark, index)
        done.append(looked_up(tokens, shared, v.a_size, v.b_size))
        if len(vectors) > 1:
            done[-1] = written(spark, done[-1], "looked-up")
            shared.destroy()
    figures = [c.split()[0] for c in FIGURES.split(", ")]
    if not done:  # no pair at all
        return tokens.filter("row is not null").select(*figures, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    if len(done) == 1:
        return done[0]
    return reduce(DataFrame.unionByName, done).groupBy(*figures).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def query(spark, sf_dir: str) -> DataFrame:
    return aligned(read(spark, sf_dir, "documents"), f"{TOKENIZERS}/{A_FILE}", f"{TOKENIZERS}/{B_FILE}").drop("row")
