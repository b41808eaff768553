"""Operators 4, 8 and 10, and the pipeline."""

import hashlib
import io
import random
import struct
import zipfile
from collections import defaultdict

import numpy as np
import pytest

from tenderlake.llm import chat, mixing, warc
from tenderlake.llm.common import read

# ---------------------------------------------------------------- operator 4
TURNS = "conv_id long, turn long, role string, text string, target string, loss string"


def test_prefix_targets(spark):
    rng = random.Random(1)
    odd = ["</s>[INST] ok [/INST]", "<|end|>\n", "&amp;&#60;|text|>", "&#91;INST]", "", None, "a\nb", "<|turn|>user<|text|>x<|end|>\n", "é漢😀", "&", "[/INST]"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "<|turn|>", None]), rng.choice(odd)) for c in range(25) for t in range(rng.randrange(1, 8))]
    rows += [(100, 0, "user", "hi"), (101, 0, "assistant", "alone"), (102, None, "assistant", "late"), (102, 5, "user", "early"), (103, 1, "user", "same"), (103, 1, "user", "same")]
    rows += [(104, t, "assistant" if t % 2 else "user", "x" * 3000) for t in range(40)]
    want = defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((t is None, t or 0, role or "", text or ""))
    df = spark.createDataFrame([(*r, "t", "l") for r in rows] + [(None, 0, "assistant", "q", "t", "l"), (None, 1, "user", "r", "t", "l")], TURNS)
    ex = chat.examples(df).collect()
    got = {r.conv_id: r for r in chat.digests(chat.examples(df)).filter("conv_id is not null").collect()}
    for c, turns in want.items():
        turns = sorted(turns)
        mine = sorted((e for e in ex if e.conv_id == c), key=lambda e: e.turns)
        assert [e.turns - 1 for e in mine if e.target is not None] == [k for k, x in enumerate(turns) if x[2] == "assistant"]
        for e in mine:  # the loss span is the reply, the context all turns before
            reply = e.formatted[e.loss_start:e.loss_start + e.loss_chars]
            back = reply.replace("&#60;", "<").replace("&#91;", "[").replace("&amp;", "&")
            assert back == (turns[e.turns - 1][3] if e.target is not None else "")
            assert e.formatted.count(chat.TURN) == e.formatted.count(chat.END) == e.turns
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert g.formatted_chars == sum(len(e.formatted) for e in mine)
    assert len([e for e in ex if e.conv_id is None]) == 2
    assert chat.examples(df.limit(0)).count() == 0


# ---------------------------------------------------------------- operator 8
def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        open_w = sum(weight[s] for s in names if s not in capped)
        share = {s: 2 * sizes[s] if s in capped else rest * weight[s] / open_w for s in names}
        over = {s for s in names if s not in capped and share[s] > 2 * sizes[s]}
        if not over:
            return share
        capped |= over


def test_targets_match_resharing(spark):
    rng = random.Random(4)
    for _ in range(6):
        sizes = {s: rng.choice([0, 5, 100, 1000, 40_000]) + 1 for s in rng.sample(["a", "b", "é", "Z", "z", "src1", "src10", "src2", "", "😀", "￮", None], rng.randrange(1, 12))}
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_rounding_keeps_mass():
    rng = np.random.default_rng(1)
    for _ in range(200):
        size = np.sort(rng.integers(1, 500, rng.integers(1, 60)))[::-1]
        p = float(rng.uniform(0.01, 0.99))
        key = rng.integers(0, 2**63, size.size).astype(np.uint64)
        out = mixing.round_leaf(size, p, key)
        assert ((out > 0) & (out < 1)).sum() <= 1 and (out @ size) == pytest.approx(p * size.sum())
        q = rng.uniform(0, 1, size.size)
        out = mixing.round_units(size, q, key, 1)
        assert ((out > 0) & (out < 1)).sum() <= 1 and (out @ size) == pytest.approx(q @ size)


def test_rounding_is_fair():
    rng = np.random.default_rng(3)
    size = np.array([90, 40, 30, 10, 5])
    mean = np.mean([mixing.round_leaf(size, 0.3, rng.integers(0, 2**63, 5).astype(np.uint64)) for _ in range(6000)], axis=0)
    assert mean == pytest.approx(np.full(5, 0.3), abs=0.03)


def test_mix(spark, docs, monkeypatch):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 20, 90])), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(900)]
    rows += [(5000, None, "en", "a"), (5001, "", "en", "empty"), (None, "x y z", "en", "a"), (7, "x y", "en", "b"), (7, "x y", "en", "b")]
    d = docs(rows)
    runs = []
    for leaf in (1024, 16, 4):  # one leaf per source; a tree of two and of several levels
        monkeypatch.setattr(mixing, "LEAF", leaf)
        got = mixing.mixed(d).collect()
        runs.append(got)
        sizes = defaultdict(int)
        for _, t, _, s in rows:
            sizes[s] += len((t or "").split())
        want = brute_targets(dict(sizes))
        assert len(got) == len(rows) and all(0 <= r.copies <= 2 for r in got)
        taken = defaultdict(int)
        for r in got:
            taken[r.source] += r.size * r.copies
            assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert all(abs(taken[s] - want[s]) <= 90 for s in want)
    again = mixing.mixed(d.repartition(7)).collect()
    key = sorted((r.doc_id or -1, r.source or "", r.size, r.copies) for r in runs[-1])
    assert key == sorted((r.doc_id or -1, r.source or "", r.size, r.copies) for r in again)
    out = mixing.stage(d).collect()
    assert len(out) == sum(r.copies for r in runs[-1])
    assert mixing.mixed(d.limit(0)).count() == 0


# --------------------------------------------------------------- operator 10
def test_zip_reader_reads_what_zipfile_writes():
    for force in (False, True):
        f = io.BytesIO()
        with zipfile.ZipFile(f, "w") as z:
            z.comment = b"PK\x05\x06 a comment that looks like an end record"
            with z.open(zipfile.ZipInfo("é.bin"), "w", force_zip64=force) as m:
                m.write(b"0123456789" * 1000)
            z.writestr("b", b"tail")
            z.writestr(zipfile.ZipInfo("packed"), b"c" * 100, compress_type=zipfile.ZIP_DEFLATED)
        r = warc.ZipReader(f, len(f.getvalue()))
        assert sorted(r.members) == ["b", "packed", "é.bin"]
        assert r.at(r.start("é.bin") + 9990, 10) == b"0123456789" and r.at(r.start("b"), 4) == b"tail"
        with pytest.raises(ValueError):
            r.start("packed")


def test_zip64_directory():
    """Sizes, offsets and counts that only the ZIP64 records hold."""
    body = b"PK\x03\x04" + b"\0" * 22 + struct.pack("<HH", 1, 0) + b"a" + b"hello"
    extra = struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    entry = (b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x800, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + b"a" + extra)
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), len(body))
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, len(body) + len(entry), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = body + entry + end64 + locator + end
    r = warc.ZipReader(io.BytesIO(data), len(data))
    assert r.members == {"a": {"method": 0, "size": 5, "full": 5, "header": 0}} and r.at(r.start("a"), 5) == b"hello"
    for broken in (data[:-1], b"", data.replace(b"PK\x06\x07", b"PK\x06\x00"), b"x" * 100):
        with pytest.raises(ValueError):
            warc.ZipReader(io.BytesIO(broken), len(broken))


def test_archives_round_trip(spark, monkeypatch):
    big, odd = "é" * 60, "x" * 99
    rows = [(5, "http://a/b c", big), (3, "u", big), (9, None, big), (None, "u", big), (3, "u", big), (1, "u", odd), (2, "u", odd), (4, "u", None), (6, "u", ""),
            (7, "u\r\nWARC-Type: x", "\r\n\r\nWARC/1.1"), (8, "u", "y" * 300_000)]
    rows += [(100 + i, f"http://h/{i}", f"page {i % 20} " * 30) for i in range(60)]
    df = spark.createDataFrame([(*r, "z", "zz") for r in rows], "page_id long, url string, html string, digest string, archive string").repartition(5)
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 7)
    got = warc.packed(df).collect()
    assert len(got) == len(rows) and len({r.archive for r in got}) >= 11
    first = {}
    for p, _, h in rows:
        h = (h or "").encode()
        if p is not None and len(h) >= 100:
            first[h] = min(p, first.get(h, p))
    want = []
    for p, _, h in rows:
        h = (h or "").encode()
        ref = first.get(h) if p is not None and first.get(h, p) != p else None
        want.append((p or -1, len(h), hashlib.sha256(h).hexdigest(), "response" if ref is None else "revisit", ref))
    assert sorted(want, key=str) == sorted(((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str)
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    with zipfile.ZipFile(warc.local_path(got[0].archive)) as z:  # other tools can read the packages
        assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
    assert warc.packed(df.limit(0)).count() == 0


# ------------------------------------------------------------------- pipeline
def test_pipeline(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.01"
    docs = read(spark, sf, "documents")
    assert [n for n, _ in cp.STAGES] == ["language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"]
    ids, left = {r.doc_id for r in docs.collect()}, []
    for _, stage in cp.STAGES:
        out = cp.written(spark, stage(spark, docs, sf), "t")
        now = {r.doc_id for r in out.select("doc_id").collect()}
        assert now <= ids
        ids, docs = now, out
        left.append(out)
    for out in left[:-1]:
        assert out.columns == read(spark, sf, "documents").columns
    texts = [r.text for r in left[1].collect()]
    seen = [" ".join(s.split()) for t in texts for s in t.split("\n") if s.split()]
    assert len(seen) == len(set(seen))
    assert left[3].count() < left[2].count()
    assert left[4].columns == [*docs.columns[:-1], "copy"]
    assert sorted((r.doc_id, r.copy) for r in cp.run(spark, sf).collect()) == sorted((r.doc_id, r.copy) for r in left[4].collect())
    empty = read(spark, sf, "documents").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, sf).count() == 0
