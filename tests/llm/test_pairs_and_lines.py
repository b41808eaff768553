"""Operators 1, 5 and 6 against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tenderlake.llm import decontaminate, jaccard, lines
from tenderlake.llm.common import components, runs, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return s.translate({c: c + 32 for c in range(65, 91)})


def hashes(text):
    return words(pa.array([text]))[0]


# ------------------------------------------------------------------- kernels
def test_words_follow_the_contract():
    texts = ["Ab\tcd  ÉE\x0bx", None, "", " \n", "ab", "ÀB ab"]
    h, row, length = words(pa.array(texts))
    flat = [(i, w) for i, t in enumerate(texts) for w in WORD.findall(lower(t or ""))]
    assert row.tolist() == [i for i, _ in flat]
    assert length.tolist() == [len(w.encode()) for _, w in flat]
    for (a, x), (b, y) in itertools.combinations(zip(h.tolist(), [w for _, w in flat]), 2):
        assert (a == b) == (x == y)


def test_runs_stay_within_a_row():
    h, row, _ = words(pa.array(["a b c", "a b", "x a b c"]))
    g, at = runs(h, row, 3)
    assert at.tolist() == [0, 5, 6]
    assert g[0] == g[2] and g[0] != g[1]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(12)]
    group = {v: v for e in edges for v in e}
    for _ in group:
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: group[v] for v in linked}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- operator 1
def slow_tiles(item, text, least):
    """Greedy string tiling by trying every start, longest and leftmost first."""
    used_a, used_b, out = set(), set(), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while (i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]
                       and i + n not in used_a and j + n not in used_b):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        out.append((i, j, n))
        used_a |= set(range(i, i + n))
        used_b |= set(range(j, j + n))


def test_tiles_match_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        a = [rng.choice("abc") for _ in range(rng.randrange(0, 25))]
        b = [rng.choice("abc") for _ in range(rng.randrange(0, 40))]
        got = decontaminate.tile(hashes(" ".join(a)), hashes(" ".join(b)), 3)
        want = slow_tiles(a, b, 3)
        assert sorted(t[2] for t in got) == sorted(t[2] for t in want)
        assert sum(t[2] for t in got) == sum(t[2] for t in want)


def test_decontamination(spark, docs):
    rng = random.Random(1)
    item = [f"w{i}" for i in range(40)]
    noise = [f"n{rng.randrange(500)}" for _ in range(300)]
    moved = item[20:] + noise[:30] + item[:20]
    rows = [(1, " ".join(noise)), (2, " ".join(noise[:50] + item + noise[50:])), (3, " ".join(moved)),
            (4, " ".join(item[:25])), (5, None), (6, ""), (None, " ".join(item).upper()), (8, " ".join(item[:33])),
            (9, " ".join(item[:16] + ["x"] + item[17:])), (10, "w0 w1 w2 w3")]
    bench = spark.createDataFrame([(7, " ".join(item), "t"), (8, None, "t"), (9, "", "t"), (10, "w0 w1 w2 w3", "t"), (11, " ".join(["r"] * 20), "t")],
                                  "item_id long, text string, doc_id string")
    rows.append((11, " ".join(["r"] * 10)))  # one repeat of a repeating item covers half of it
    d = docs(rows)
    got = {(r.doc_id, r.item_id): (r.covered_words, r.tiles) for r in decontaminate.contaminated(d, bench).collect()}
    assert got == {(2, 7): (40, 1), (3, 7): (40, 2), (None, 7): (40, 1), (8, 7): (33, 1), (9, 7): (39, 2)}
    blocked = {(r.doc_id, r.item_id): (r.covered_words, r.tiles) for r in decontaminate.contaminated(d, bench, block_words=30).collect()}
    assert blocked == got
    kept = decontaminate.clean(d, bench, block_words=30)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 10, 11]
    assert decontaminate.contaminated(docs([(1, "a")]).limit(0), bench).count() == 0
    assert decontaminate.contaminated(d, bench.limit(0)).count() == 0


# ---------------------------------------------------------------- operator 5
def brute_components(rows):
    sets = {}
    for d, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[d] = {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
    root = {d: d for d in sets}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return {d: (len(sets[d]), root[d]) for d in sets}


def test_jaccard_components(spark, docs):
    rng = random.Random(11)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([12, 40, 120, 300]))]
        for k in range(14):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), (" " if k % 2 else "\n").join(w)))
    base = [f"q{rng.randrange(10**6)}" for _ in range(100)]
    for k in range(12):  # a chain: neighbours link, far ones do not
        base = base[:k * 6] + [f"c{k}"] + base[k * 6 + 1:]
        rows.append((len(rows), " ".join(base)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "one two"), (907, "one Two three")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.grouped(docs(rows)).collect()}
    assert got == brute_components(rows)
    kept = sorted(r.doc_id for r in jaccard.stage(docs(rows)).collect())
    assert kept == sorted(d for d, (_, c) in got.items() if c == d)


def test_jaccard_ids(docs):
    same = "a b c d e f g"
    got = jaccard.grouped(docs([(None, same), (5, same), (3, same), (3, same), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 3), (3, 3), (3, 3), (5, 3)]
    assert jaccard.grouped(docs([(1, "a")]).limit(0)).count() == 0


def test_pieces_never_miss_a_link():
    rng = np.random.default_rng(2)
    for n in (10, 19, 37, 150, 1000, 4000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for extra in range(0, a.size // 9 + 1, max(1, a.size // 30)):  # b = a and ``extra`` more, or fewer
            for b in (np.unique(np.concatenate([a, rng.integers(0, 2**63, extra, dtype=np.uint64)])), a[extra // 2:]):
                both = np.intersect1d(a, b).size
                if 100 * both >= 90 * (a.size + b.size - both) and not np.array_equal(a, b):
                    assert np.intersect1d(jaccard.keys(a), jaccard.keys(b)).size


# ---------------------------------------------------------------- operator 6
def brute_dropped(rows):
    def edits(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
        return d[-1]

    all_lines = [(d, i, tuple(WORD.findall(s))) for d, t in rows if t is not None for i, s in enumerate(t.split("\n"))]
    all_lines = sorted(x for x in all_lines if x[2])
    return {(d, i) for k, (d, i, w) in enumerate(all_lines)
            if any(v == w or (min(len(v), len(w)) >= lines.MIN_WORDS and edits(v, w) <= 1) for _, _, v in all_lines[:k])}


def test_lines_match_brute_force(docs):
    rng = random.Random(8)
    base = [[rng.choice("abcdef") + str(rng.randrange(30)) for _ in range(rng.choice([1, 3, 5, 6, 9, 20]))] for _ in range(12)]
    rows = []
    for d in range(40):
        text = []
        for _ in range(rng.randrange(1, 6)):
            w = list(rng.choice(base))
            for _ in range(rng.randrange(0, 3)):
                k, at = rng.randrange(3), rng.randrange(len(w)) if w else 0
                w = w[:at] + w[at + 1:] if k == 0 else w[:at] + [f"z{rng.randrange(9)}"] + w[at + (k == 1):]
            text.append(rng.choice(["", "  "]) + " ".join(w))
        rows.append((d, "\n".join(text)))
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "same same same same same same"), (54, "same same same same same"), (55, "\n \nnew line here\n")]
    got = {(r.doc_id, i): r for r in lines.deduped(docs(rows)).collect() for i in (r._dropped or [])}
    assert set(got) == brute_dropped(rows)


def test_line_stage(docs):
    d = docs([(2, "p q\nfresh words are here\np q"), (1, "p q"), (3, "p q\n\n"), (4, "\n"), (None, "p q"), (5, None), (6, "p q"), (6, "p q")])
    out = lines.stage(d)
    assert out.columns == d.columns and out.schema == d.schema
    assert sorted(((r.doc_id or 0, r.text, r.n_chars) for r in out.collect()), key=str) == sorted(
        [(2, "fresh words are here", 20), (1, "p q", 3), (4, "\n", 1), (0, "p q", 3), (5, None, None)], key=str)
    assert lines.stage(d.limit(0)).count() == 0


def near_copies(rng, groups):
    """Texts around bases that may themselves be missing: edits, cuts and additions shared by some."""
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(rng.choice([60, 110]))]
        tail = [f"t{g}x{i}" for i in range(6)]
        for _ in range(24):
            w = list(base)
            kind = rng.randrange(4)
            for _ in range(rng.randrange(0, 5)):
                at = rng.randrange(len(w))
                w[at:at + 1] = [[f"e{rng.randrange(8)}"], [], [f"e{rng.randrange(10**6)}"], [w[at], "more"]][kind]
            if kind == 1:
                w = w[:len(w) - rng.randrange(0, 14)]
            rows.append((len(rows), " ".join(w + (tail if rng.random() < 0.4 else []))))
    return rows


def test_jaccard_large_keys(docs, monkeypatch):
    """With no key small enough to be compared pairwise, centres and refined keys do all the work."""
    monkeypatch.setattr(jaccard, "FEW", 1)
    monkeypatch.setattr(jaccard, "FEW_LATER", 1)
    rows = near_copies(random.Random(4), 3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.grouped(docs(rows)).collect()}
    assert got == brute_components(rows)


def brute_kept(rows, shingle, num):
    """Smallest id of every component at ``num`` % of ``shingle``-word shingles."""
    sets = {}
    for d, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[d] = {tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} if w else set()
    root = {d: d for d in sets}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return sorted(d for d in sets if root[d] == d)


def looser_copies(rng):
    """Copies with 0 to 30 % added or cut, some with edits too, and texts about as short as a shingle."""
    rows = []
    for g in range(5):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(rng.choice([11, 45, 90, 200]))]
        for _ in range(12):
            w = base + [f"a{rng.randrange(10**6)}" for _ in range(rng.randrange(0, len(base) * 3 // 10))]
            w = w[rng.randrange(0, max(1, len(base) // 10)):]
            for _ in range(rng.randrange(0, 1 + len(base) // 60)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    return rows + [(900, None), (901, ""), (902, "one two three four"), (903, "one two three FOUR"), (904, "one two three"), (905, "one two three four five")]


def test_pipeline_takes_five_words_and_80(spark, docs):
    import corpus_pipeline as cp

    base = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(base)), (2, " ".join([*base, *(f"more{i}" for i in range(15))]))]  # 0.865 on five words and 0.867 on three
    assert [r.doc_id for r in cp.ngram_jaccard(spark, docs(rows), "").collect()] == [1]
    assert sorted(r.doc_id for r in jaccard.stage(docs(rows)).collect()) == [1, 2]
    rows = looser_copies(random.Random(6))
    kept = sorted(r.doc_id for r in cp.ngram_jaccard(spark, docs(rows), "").collect())
    assert kept == brute_kept(rows, 5, 80) != brute_kept(rows, 3, 90)


def test_jaccard_large_keys_at_80(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "FEW", 1)
    monkeypatch.setattr(jaccard, "FEW_LATER", 1)
    for rows in (near_copies(random.Random(9), 3), looser_copies(random.Random(7))):
        assert sorted(r.doc_id for r in jaccard.stage(docs(rows), 5, 80).collect()) == brute_kept(rows, 5, 80)


def test_pieces_never_miss_a_link_at_80():
    rng = np.random.default_rng(5)
    for n in (5, 9, 37, 150, 1000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for extra in range(0, a.size // 4 + 1, max(1, a.size // 30)):
            for b in (np.unique(np.concatenate([a, rng.integers(0, 2**63, extra, dtype=np.uint64)])), a[extra * 4 // 5:]):
                both = np.intersect1d(a, b).size
                if 100 * both >= 80 * (a.size + b.size - both) and not np.array_equal(a, b):
                    assert np.intersect1d(jaccard.keys(a, 80), jaccard.keys(b, 80)).size


def edit_distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
    return d[-1]


def test_edits_grow_with_the_line(docs):
    rng = random.Random(12)
    base = [[rng.choice("abcdef") + str(rng.randrange(30)) for _ in range(n)] for n in (6, 18, 20, 31, 57, 57)] + [["same"] * 24, ["x", "y"] * 15]
    lines_in = []
    for w in base:
        for _ in range(9):
            v = list(w)
            for _ in range(rng.randrange(0, 2 + len(w) // 10)):
                k, at = rng.randrange(3), rng.randrange(len(v))
                v = v[:at] + v[at + 1:] if k == 0 else v[:at] + [f"z{rng.randrange(9)}"] + v[at + (k == 1):]
            lines_in.append(tuple(v))
    rng.shuffle(lines_in)
    rows = [(d, "\n".join(" ".join(w) for w in lines_in[3 * d:3 * d + 3])) for d in range(len(lines_in) // 3)]

    def near(v, w, most):
        return v == w or (min(len(v), len(w)) >= lines.MIN_WORDS and edit_distance(v, w) <= most(max(len(v), len(w))))

    def brute(most):
        return {(k // 3, k % 3) for k, w in enumerate(lines_in) if any(near(v, w, most) for v in lines_in[:k])}

    got = {(r.doc_id, i) for r in lines.deduped(docs(rows), 10).select("doc_id", "_dropped").collect() for i in (r._dropped or [])}
    assert got == brute(lambda n: max(1, n // 10)) != brute(lambda n: 1)


def test_line_stage_takes_a_tenth(docs):
    w = [f"w{i}" for i in range(57)]
    two = [*w[:10], "p", *w[11:40], "q", *w[41:]]  # two edits
    six = [*("r" if i % 10 == 5 else x for i, x in enumerate(w)), "s"]  # seven edits
    out = lines.stage(docs([(1, " ".join(w)), (2, " ".join(two)), (3, " ".join(six))]))
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_lines_write_their_first_runs_only(docs, monkeypatch):
    rng, rows, real = random.Random(3), {}, lines.written

    def spy(spark, df, name, **options):
        out = real(spark, df, name, **options)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(lines, "written", spy)
    lines.deduped(docs([(d, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for d in range(40)]), 10).count()
    assert 0 < rows["line-runs"] <= 40 * (2 * (60 // 9) + 1)


def test_words_of_one_character_are_told_apart(spark):
    code = F.pmod(F.xxhash64("word"), F.lit(1 << 20))
    twins = [r.both[:2] for r in spark.range(9000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
             .groupBy(code).agg(F.collect_list("word").alias("both")).filter("size(both) > 1").limit(3).collect()]
    rest = [f"x{i}" for i in range(17)]
    a, b = ([*rest, *(t[k] for t in twins)] for k in (0, 1))  # three edits, two are allowed
    df = spark.createDataFrame([(0, a, b), (1, a, a), (2, a, [*rest, a[17], b[18], b[19]]), (3, a, [*rest[1:], *b[17:]])], "k int, w array<string>, w2 array<string>")
    got = df.select("k", lines.within_edits(F.col("w"), F.col("w2"), 10).alias("near")).collect()
    assert {r.k: r.near for r in got} == {0: False, 1: True, 2: True, 3: False}


def test_jaccard_unlike_texts_share_no_key(docs):
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(rng.randint(20, 120)))) for i in range(400)]
    rows += [(400 + i, rows[i][1] + " more") for i in range(3)]
    slim, met = jaccard.opened(docs(rows).select("doc_id", "text"), 5, 80)
    assert slim.count() == 403
    assert {r.name for r in met.collect()} == {r.name for r in slim.filter("doc_id < 3 or doc_id >= 400").collect()}
