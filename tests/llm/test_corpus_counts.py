"""Operators 11, 12 and 13 against brute force."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.llm import alignment, audit, substrings
from tenderlake.llm.common import read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --------------------------------------------------------------- operator 11
def fails(rows, k, letter):
    text = rows[k][1] or ""
    ws = WORD.findall(text)
    return {"A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": rows[k][0] is not None and any(d is not None and d < rows[k][0] and (t or "") == text for d, t, *_ in rows)}[letter]


def played(rows, labels):
    """Every order, run over the rows one filter after the other."""
    good, toxic = ({d for d, *x in labels if x[k] == 1 and d is not None} for k in (0, 1))
    flags = [{c for c in "ABCDE" if fails(rows, k, c)} for k in range(len(rows))]
    out = {}
    for part in {r[2] or "" for r in rows}:
        own = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        share = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, c in enumerate(order, 1):
                gone = [k for k in left if c in flags[k]]
                left = [k for k in left if c not in flags[k]]
                share[c] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(c in flags[k] for k in own) - len(gone),
                                                   sum(flags[k] == {c} for k in own), sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(share[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit_of_odd_rows(spark, docs):
    rng = random.Random(3)
    rich = [" ".join(f"w{rng.randrange(900)}" for _ in range(n)) for n in (99, 100, 130, 130, 250)]
    texts = [*rich, *(t + " $1" for t in rich), *(t.upper() for t in rich), " ".join(["a b"] * 70), "", None, " \t\n", "é" * 50, "A\x0bB " * 60, "x" * 20000]
    rows = [(rng.choice([1, 2, 3, 5, 8, None, *range(20, 60)]), rng.choice(texts), rng.choice(["en", "fr", None])) for _ in range(120)]
    rows += rows[:10] + [(9, rich[4], "de"), (9, rich[4], "de"), (9, rich[4], "en"), (None, rich[4], "de")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in [*range(60), 5, 5, None]]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(1))
    got = audit.interactions(audit.mask_counts(docs(rows).withColumn("mask", F.lit(7)).withColumn("digest", F.lit("d")).withColumn("part", F.lit("p")), frame), audit.FILTERS).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in MEASURES) for r in got} == played(rows, labels)
    assert len(got) == 600 * len({r[2] for r in rows})


def test_audit_of_no_rows(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(audit.mask_counts(docs([]), labels), audit.FILTERS).count() == 0
    # rows without any label
    assert {r.good_lost + r.toxic_lost for r in audit.interactions(audit.mask_counts(docs([(1, "a"), (2, "a")]), labels), audit.FILTERS).collect()} == {0}


def test_paths_count_every_order():
    edges = audit.paths(6)
    assert len(edges) == 6 * 32
    for f in range(6):
        assert sum(w for _, g, _, w in edges if g == f) == 720
    used = Counter()
    for order in permutations(range(6)):
        state = 0
        for f in order:
            used[state, f] += 1
            state |= 1 << f
    assert {(s, f): w for s, f, _, w in edges} == used


def test_named_orders_of_many_filters(spark):
    counts = spark.createDataFrame([("x", 0, 5, 0, 0), ("x", 0b11111111, 3, 1, 1), ("x", 0b1, 2, 2, 0)], "part string, mask int, n long, good long, toxic long")
    with pytest.raises(ValueError):
        audit.interactions(counts, "ABCDEFGH")
    got = {r.step: r for r in audit.interactions(counts, "ABCDEFGH", ["HGFEDCBA"]).collect()}
    assert (got[1].removed, got[8].removed, got[8].kept, got[8].good_lost, got[8].redundant) == (3, 2, 5, 2, 3)
    assert got[8].shapley == 40320 * 2 + 3 * 40320 // 8 and got[1].shapley == 3 * 40320 // 8


# --------------------------------------------------------------- operator 12
def cut_by_hand(rows, width):
    first = {}
    for d, t, *_ in rows:
        ws = WORD.findall(t or "")
        for i in range(len(ws) - width + 1):
            if d is not None:
                g = tuple(ws[i:i + width])
                first[g] = min(first.get(g, d), d)
    out = []
    for d, t, *_ in rows:
        ws = WORD.findall(t or "")
        gone = set()
        for i in range(len(ws) - width + 1):
            if d is not None and first[tuple(ws[i:i + width])] < d:
                gone |= set(range(i, i + width))
        out.append((d, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=repr)


def passages(rng, n):
    shared = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(3, 40))) for _ in range(8)]
    sep = [" ", "\n", "\t", "  ", " \x0b", "  "]
    return ["".join(rng.choice([*shared, f"W{rng.randrange(99)}", "é ü"]) + rng.choice(sep) for _ in range(rng.randrange(0, 9))) for _ in range(n)]


@pytest.mark.parametrize("cell_bits,chunk", [(22, 1 << 20), (6, 40)])  # the second: a full sketch, chunks of a few texts
def test_substrings_of_odd_rows(docs, cell_bits, chunk):
    rng = random.Random(5)
    texts = passages(rng, 60)
    rows = [(rng.choice([None, 4, 4, *range(10, 90)]), t) for t in texts + texts[:15]] + [(4, texts[0]), (4, texts[0]), (100, None), (101, ""), (102, "a " * 3000), (103, "a " * 3000), (104, "b\x0cb " * 30)]
    rows += [(200 + k, texts[1] + " x") for k in range(40)]  # a hot group
    frame = docs(rows).withColumn("th", F.lit(1)).withColumn("starts", F.lit("s")).withColumn("at", F.lit(2)).repartition(5)
    got = substrings.cut(frame, 7, cell_bits=cell_bits, chunk=chunk).collect()
    assert sorted((tuple(r) for r in got), key=repr) == cut_by_hand(rows, 7)


def test_substrings_of_no_rows(docs):
    assert substrings.cut(docs([]), cell_bits=10).count() == 0
    got = substrings.cut(docs([(1, "too short"), (2, "too short"), (None, None)]), cell_bits=10).collect()
    assert sorted((r.n_words, r.n_removed, r.kept_text) for r in got) == [(0, 0, ""), (2, 0, "too short"), (2, 0, "too short")]


def test_sketch_never_underestimates(spark, docs):
    rng = random.Random(6)
    rows = [(k, t) for k, t in enumerate(passages(rng, 80))]
    parts = substrings.sketch(docs(rows).repartition(7), 5, 2, 9, 6, 30)
    blocks = substrings.merged(spark, parts, 6, fan=2)  # three levels of the tree
    held = substrings.Sketch([(r.block, r.twos) for r in blocks.filter("block >= 0").collect()], 2, 9, 6)
    import pyarrow as pa
    per = Counter()
    known = {}
    for _, t in rows:
        h, row, _ = substrings.words(pa.array([t]), substrings.AS_IS)
        w, at = substrings.runs(h, row, 5)
        per.update(set(w.tolist()))
        ws = WORD.findall(t)
        known.update({int(x): tuple(ws[i:i + 5]) for x, i in zip(w, at)})
    assert len(set(known.values())) == len(known)  # windows and hashes agree
    seen = held.repeated(np.array(list(per), np.uint64))
    assert all(ok for ok, n in zip(seen, per.values()) if n > 1) and not seen.all()
    assert blocks.agg(F.sum("n")).first()[0] == sum(per.values())


# --------------------------------------------------------------- operator 13
A, B = (f"{alignment.TOKENIZERS}/{f}" for f in (alignment.A_FILE, alignment.B_FILE))


@pytest.fixture(scope="module")
def both():
    return alignment.Vocabularies(A, B)


def aligned_by_hand(both, texts):
    """Groups of every text from prefix strings, token by token."""
    tk, sp = both.load()
    out = []
    for t in texts:
        a = tk.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        if t and not b"".join(both.a_bytes[i] for i in a) == b"".join(both.b_bytes[i] for i in b) == (" " + t).encode():
            a, b = [], []
        groups, i, j, x, y = [], 0, 0, 0, 0
        while i < len(a):
            left, right = [a[i]], [b[j]]
            x, y, i, j = x + len(both.a_bytes[a[i]]), y + len(both.b_bytes[b[j]]), i + 1, j + 1
            while x != y:
                if x < y:
                    left.append(a[i])
                    x, i = x + len(both.a_bytes[a[i]]), i + 1
                else:
                    right.append(b[j])
                    y, j = y + len(both.b_bytes[b[j]]), j + 1
            groups.append((left, right))
        out.append((a, b, groups))
    count = Counter(p for _, _, g in out for p in {(x, y) for left, right in g for x in left for y in right})
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    rows = []
    for a, b, g in out:
        links = [(x, y) for left, right in g for x in left for y in right]
        shown = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in g)
        rows.append((len(a), len(b), len(g), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                     hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = ["", None, " ", "  two  spaces ", "\n\n a\n b", "tab\tand\x0bvt", "<|endoftext|> <s> </s> <unk> <0x41>", "naïve café Ünïcödé", "日本語のテキスト", "a▁b", " nbsp em",
       "🙂🙃 emoji‍", "\x00nul", "don't we'll I'm", "12345 67,890.12", "aaaa" * 400, "x" * 3000, "́combining", "ﬁ ligature Å Å", "  ", "a" + " " * 700 + "b", "\U0001d517" * 40]


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 22), (50, 130)])  # the second: many shards and blocks
def test_alignment_of_odd_texts(docs, both, small, spark, sizes):
    texts = ODD + ODD[:7] + [r.text for r in read(spark, small, "documents").limit(25).collect()]
    rows = [(k % 20 or None, t) for k, t in enumerate(texts)]
    frame = docs(rows).withColumn("row", F.lit("r")).withColumn("a", F.lit(1)).withColumn("pairs", F.lit(2)).repartition(3)
    got = alignment.aligned(frame, A, B, *sizes).collect()
    want = [(d, *r) for (d, _), r in zip(rows, aligned_by_hand(both, texts))]
    assert sorted((tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in got), key=repr) == sorted(want, key=repr)


def test_alignment_of_no_rows(docs):
    assert alignment.aligned(docs([]), A, B).count() == 0
    assert [tuple(r)[1:] for r in alignment.aligned(docs([(1, None), (2, "")]), A, B).orderBy("doc_id").collect()] == [(d, 0, 0, 0, 0, "", 0, 0) for d in (1, 2)]


def test_words_alone_have_the_ids_they_have_in_a_text(both):
    tk, sp = both.load()
    assert both.by_word
    for limit in (3, 1000):
        words = alignment.Words(limit)
        for t in ODD:
            if t and "\u2581" not in t:
                (a, na), (b, nb) = words.encode(alignment.BETWEEN.split(t), both)
                assert a.tolist() == tk.encode(" " + t, add_special_tokens=False).ids and na.sum() == a.size
                assert b.tolist() == sp.encode(t) and nb.sum() == b.size


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    rng = np.random.default_rng(1)
    # one token of B (two bytes) to two of A
    own = alignment.Aligned(rng.integers(0, 5, 60), rng.integers(0, 4, 30), np.array([60]), np.array([30]), np.ones(5, np.int64), np.full(4, 2))
    plain = own.pairs(4)
    monkeypatch.setattr(alignment, "BIG_GROUP", 0)
    monkeypatch.setattr(alignment, "EXPANDED", 3)
    for x, y in zip(plain, own.pairs(4)):
        assert np.array_equal(x, y)
    assert plain[2].sum() == own.links().sum() == 60


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(2).integers(0, 1 << 40, 5000))
    shard = alignment.Shard(keys)
    assert sorted(shard.find(keys).tolist()) == list(range(keys.size))
    others = np.setdiff1d(np.arange(3000), keys)
    assert (shard.find(others) == -1).all() and alignment.Shard(keys[:0]).find(keys[:3]).tolist() == [-1] * 3


# ---------------------------------------------- operator 5: shingles of the majority
def test_majority_of_a_leaders_members(spark):
    from tenderlake.llm import jaccard
    rng = random.Random(11)
    rows, want = [], {}
    for b in range(12):
        m = rng.choice([2, 3, 40])
        lists = [(sorted(rng.sample(range(8), rng.randrange(0, 8))), sorted(rng.sample(range(100, 106), rng.randrange(0, 6)))) for _ in range(m)]
        rows += [(b, m, *x) for x in lists]
        for k in (0, 1):
            count = Counter(e for x in lists for e in x[k])
            want[b, k] = {e for e, c in count.items() if 2 * c > m + 1}
    df = spark.createDataFrame(rows, "b long, m long, added array<long>, removed array<long>").repartition(5)
    got = {r.b: r for r in jaccard.majority(df).collect()}
    for b in range(12):
        assert (set(got[b].most), set(got[b].few)) == (want[b, 0], want[b, 1]) if b in got else not want[b, 0] | want[b, 1]
    assert jaccard.majority(df.limit(0)).count() == 0


# ------------------------------------------------ stages: names that the code uses
def test_stages_carry_columns_of_any_name(spark):
    from tenderlake.llm import decontaminate, jaccard, lines, mixing
    names = ["_id", "_hash", "_new", "_dropped", "_lines", "_left", "_taken", "_copies", "_row", "copy", "copies", "doc", "row", "name", "key", "n"]
    rows = [(k, f"line one of text {k} here and more\nshared line of all texts there", f"s{k % 2}", *[f"{c}{k}" for c in names]) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in names))
    for out in (lines.stage(df), jaccard.stage(df, 5, 80), mixing.stage(df).drop("copy_1")):
        assert out.columns == df.columns
        for r in out.collect():
            assert [r[c] for c in names] == [f"{c}{r.doc_id}" for c in names]
    assert "copy_1" in mixing.stage(df).columns
    bench = spark.createDataFrame([(1, "line one of text 3 here and more"), (2, "no such passage in any of the texts")], "item_id long, text string")
    for size in (1_000_000, 5):  # one block; a block per item
        assert sorted(r.doc_id for r in decontaminate.clean(df, bench, block_words=size).collect()) == [k for k in range(12) if k != 3]


def test_mix_deals_equal_rows_over_many_leaves(spark, monkeypatch):
    from tenderlake.llm import mixing
    monkeypatch.setattr(mixing, "LEAF", 50)
    leaves = []

    def write(session, df, name, real=mixing.written):
        out = real(session, df, name)
        if name == "pivotal":
            leaves.append(max(r["count"] for r in out.groupBy("source", "leaf").count().collect()) if leaves == [] else 0)
        return out

    monkeypatch.setattr(mixing, "written", write)
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.substring(F.lit("abc"), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("source"), F.lit("two words").alias("text")).repartition(4)
    out = mixing.mixed(df).collect()
    assert len(out) == 4000 and 20 < leaves[0] < 150  # 1,333 equal rows a source
    for source in "abc":
        own = [r for r in out if r.source == source]
        assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= 2 and max(r.copies for r in own) <= 2
    assert len({r.row for r in out}) == 4000


# ------------------------------------------------------- operator 3: holdouts
def test_binomial_tail_of_large_holdouts(spark):
    import math

    from tenderlake.llm import quality
    n, p = 1_000_000, 0.01
    ks = [9_000, 9_500, 9_700, 9_900, 10_000, 10_300]
    got = {r.k: r.t for r in spark.createDataFrame([(k, n) for k in ks], "k long, n long").select("k", quality.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect()}
    log = lambda j: math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)
    for k in ks:
        assert got[k] == pytest.approx(math.fsum(math.exp(log(j)) for j in range(max(0, k - 20_000), k + 1)), rel=1e-6)


def test_copies_of_a_text_are_one_draw(spark, docs):
    from tenderlake.llm import quality
    words = [f"w{k}" for k in range(60)]
    make = lambda mark, k: " ".join([*words, f"own{k}"]) + mark
    rows = [(k, make("", k % 20)) for k in range(2000)] + [(5000 + k, make(" ###" * 60, k)) for k in range(50)]
    labels = spark.createDataFrame([(d, int(d < 5000)) for d, _ in rows], "doc_id long, quality int")
    # twenty texts, however often they stand in the holdout, certify nothing
    assert quality.thresholds(quality.features(docs(rows)), labels, once=True).count() == 0
    assert quality.thresholds(quality.features(docs(rows)), labels).count() > 0
    own = [(k, make("", k)) for k in range(2000)] + rows[2000:]
    assert {r.rule for r in quality.thresholds(quality.features(docs(own)), labels, once=True).collect()} >= {"symbols"}
