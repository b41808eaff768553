"""Operators 2, 3, 7 and 9 against brute force and on held-out rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenderlake.llm import language, lm, pii, quality
from tenderlake.llm.common import read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return s.translate({c: c + 32 for c in range(65, 91)})


# ---------------------------------------------------------------- operator 2
def check_base(rows, got):
    toks = {d: [*WORD.findall(lower(t or "")), "\0"] for d, t in rows}
    count = Counter(w for d, ws in toks.items() if d is not None and zlib.crc32(str(d).encode()) % 7 != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    for r in got:
        ws = toks[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws))
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert r.score < 0 and r.bits_per_byte >= 0


def test_scores_of_odd_texts(docs):
    rows = [(1, "a A b"), (2, None), (3, ""), (4, " \n\t"), (5, "x" * 5000), (None, "a zz"), (6, "é É a\x0bb"), (7, "a a a a"), (7, "a a a a"), (9, " ".join(["b c"] * 400))]
    got = lm.scored(docs(rows)).collect()
    assert len(got) == len(rows)
    train = Counter(w for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 7 != 2 for w in [*WORD.findall(lower(t or "")), "\0"])
    assert {r.train_tokens for r in got} == {sum(train.values())}
    assert lm.scored(docs([(1, "a")]).limit(0)).count() == 0


def test_scores_on_held_out_rows(spark, small):
    d = read(spark, small, "documents")
    rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    got = lm.query(spark, small).collect()
    check_base(rows, got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_bits_are_probabilities():
    """Over all classes of the next token the model's probabilities add up to 1."""
    rng = np.random.default_rng(4)
    odds = lm.log_odds(rng.integers(0, 50, (lm.CONTEXTS, lm.BUCKETS, lm.CLASSES)).astype(float))
    m = lm.Model(odds, np.zeros(0, np.int64), np.zeros(0), np.zeros(lm.CLASSES))
    prefix = rng.integers(0, 2**63, 70, dtype=np.uint64)  # more than two blocks
    ends = (np.arange(lm.CLASSES, dtype=np.uint64) << np.uint64(64 - lm.BITS)) + np.uint64(12345)
    h = np.concatenate([np.append(prefix, e) for e in ends])
    row = np.repeat(np.arange(lm.CLASSES), prefix.size + 1)
    length = np.tile(rng.integers(1, 9, prefix.size + 1), lm.CLASSES)
    full = m.bits(h, row, length, lm.CLASSES)
    start = m.bits(prefix, np.zeros(prefix.size, np.int64), length[:prefix.size], 1)[0]
    assert (10.0 ** (full - start)).sum() == pytest.approx(1, abs=1e-4)


def test_contexts_are_kept_apart(docs):
    """20,000 words, each followed by a word of its own: what follows is known in texts never seen."""
    rng = random.Random(8)
    pairs = [f"x{i} y{i}" for i in range(20_000)]

    def texts(ids):
        order = rng.sample(pairs, len(pairs))
        return [(d, " ".join(order[k::len(ids)])) for k, d in enumerate(ids)]

    held = [i for i in range(1, 2000) if zlib.crc32(str(i).encode()) % 7 == 2]
    learned = [i for i in range(1, 2000) if i not in held]
    rows = [t for k in range(3) for t in texts(learned[k * 50:k * 50 + 50])] + texts(held[:50])
    got = [r for r in lm.scored(docs(rows)).collect() if r.held_out]
    assert sum(r.score - r.base_score for r in got) / sum(r.n_tokens for r in got) > 0.5


def test_tokens_end_every_row():
    h, row, length = lm.tokens(pa.array(["a b", "", None, "c"]))
    assert row.tolist() == [0, 0, 0, 1, 2, 3, 3]
    assert [i for i, x in enumerate(h) if x == lm.END] == [2, 3, 4, 6]
    assert length[[2, 3, 4, 6]].tolist() == [0, 0, 0, 0]


# ---------------------------------------------------------------- operator 3
def features(t):
    t = t or ""
    w = WORD.findall(t)
    window = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    marked = {j for i in range(len(w) - 2) if window[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for s in t.split("\n"):
        if WORD.search(s):
            dup += s in seen
            seen.add(s)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(marked)


def test_quality_features(docs):
    rng = random.Random(6)
    rows = [(1, None), (2, ""), (3, "a b c"), (4, "a a a a"), (5, "a b c a b c"), (6, "x\n x\nx\nx\n\n\n"), (7, "#*$%&|<> é"), (8, "a b\x0bc\x1cd e"), (None, "q w e")]
    rows += [(10 + i, "".join(rng.choice("ab#|\n \t") for _ in range(rng.randrange(200)))) for i in range(40)]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.features(docs(rows)).collect()}
    assert got == {d: features(t) for d, t in rows}


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10), (3, 10), (10, 10), (5, 2000), (100, 2000), (0, 1), (40, 60)]
    for p in (0.01, 0.3):
        got = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect()
        for r in got:
            assert r.t == pytest.approx(sum(math.comb(r.n, j) * p**j * (1 - p) ** (r.n - j) for j in range(r.k + 1)), rel=1e-9)


def test_cutoffs_are_certified(spark, docs):
    words = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(3000):
        bad = i % 3 == 0
        text = " ".join(w + ("#$%" if bad else "#" if i % 500 == 1 else "") for w in words)
        rows.append((i, text, "en" if i < 2900 else "xx"))  # too few labels in xx to certify anything
        labels.append((i, 0 if bad else 1, "z"))
    labels += [(None, 1, "z"), (1, None, "z"), (2, 0, "z")]  # 2 has both labels: good
    lab = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    d = docs([*rows, (9000, rows[0][1], None), (9001, "short", "en"), (9002, None, "en")])
    out = {r.doc_id: r for r in quality.judged(d, lab).collect()}
    assert not any(out[i].kept for i in range(0, 2900, 3))
    assert all(out[i].kept for i in range(2900) if i % 3 and i % 500 != 1)
    assert all(out[i].kept for i in range(2900, 3000)) and out[9000].kept
    assert out[9001].base_failed and out[9002].base_failed and not out[9001].kept
    cuts = quality.thresholds(quality.features(d), lab).collect()
    tests = 2 * len(quality.RULES) * (quality.GRID + 1)
    assert cuts and all(r.stratum == "en" for r in cuts)
    for r in cuts:
        p = quality.ALPHA / len(quality.RULES)
        assert sum(math.comb(r.n_good, j) * p**j * (1 - p) ** (r.n_good - j) for j in range(r.k + 1)) <= quality.DELTA / tests
    none = quality.judged(d, lab.limit(0)).filter("kept").count()
    assert none == 3001 and quality.judged(d.limit(0), lab).count() == 0


# ---------------------------------------------------------------- operator 7
KINDS = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def brute_spans(t):
    out = []
    for k, (kind, rx) in enumerate(KINDS.items()):
        for m in rx.finditer(t):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) < 256 for x in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


def test_base_spans_match_the_patterns():
    rng = random.Random(9)
    for text in ["a@b.c_d@e.f", "a@b@c.de", "@x.y", "1.2.3.4.5.6.7.8", "0000000001.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (555) 555-0100 x", "é a@b.co.", "+1 2", "a@b.", "x@y.z@w.v",
                 "4111-1111-1111-1111-1", "++1234567890"] + ["".join(rng.choice("a1.@+ -()9_") for _ in range(60)) for _ in range(3000)]:
        assert pii.base_spans(text) == brute_spans(text)


def test_long_runs_take_linear_time():
    for c in "a1.@+-(":
        pii.base_spans(c * 300_000)
        list(pii.tokens(c * 300_000, []))


def test_patterns_find_unseen_identifiers(docs):
    rng = random.Random(2)
    rows = [(i, f"{'foo bar ' * (i % 3)}please mail me at user{i}@mail.example.com today or so") for i in range(40)]
    rows += [(100, "please mail me at user(at)mail7.example today or so"), (101, "nothing to see 123456 here"), (102, "see 12 or 1234567 there"),
             (103, "you can mail me at node-4711 today"), (None, None), (105, "")]
    rows += [(200 + i, f"the order number {rng.randrange(10**6, 10**7)} came") for i in range(30)]
    got = {r.doc_id: r for r in pii.found(docs(rows)).collect()}
    assert len(got) == len(rows)
    more = {d: [(s["kind"], rows_text[s["start"]:s["end"]]) for s in r.more] for d, r in got.items() if r.more for rows_text in [dict(rows)[d]]}
    assert more == {100: [("context-email", "user(at)mail7.example")], 103: [("context-email", "node-4711")]}
    for d, t in rows:
        base = [(s["start"], s["end"], s["kind"]) for s in got[d].base]
        assert base == brute_spans(t or "")
        assert got[d].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
    assert pii.found(docs([(1, "a")]).limit(0)).count() == 0

def test_assigned_secrets_are_learned_from_their_assignment(docs):
    rng = random.Random(4)
    key = lambda: "".join(rng.choice("0123456789") + rng.choice("abcdef") for _ in range(20))  # noqa: E731  (no run of digits is a card)
    rows = [(i, f'{rng.choice(["x", "y z", "so"])} token = "{key()}" and on') for i in range(8)]
    rows += [(50, 'new token = "hunter2" there'), (51, "token: hunter2"), (52, f"a commit {key()} of git"), (53, f'Token="{key()}"'), (54, 'password = "hunter2"'), (55, "x = 7 and y = 12345678")]
    got = {r.doc_id: [(s["kind"], dict(rows)[r.doc_id][s["start"]:s["end"]]) for s in sorted(r.more or [])] for r in pii.found(docs(rows)).collect()}
    assert all(len(got[i]) == 1 and got[i][0][0] == "context-secret" and got[i][0][1] in dict(rows)[i] for i in range(8))
    assert got[50] == [("context-secret", "hunter2")]  # no key by its looks, found by its place
    assert not got[52] and not got[54] and not got[55] and not got[51]
    assert not got[53]  # other signs: another pattern, with one seed


def test_instances_are_runs_and_assigned_values():
    def shown(text):
        return [text[a:b] for a, b in pii.tokens(text, pii.base_spans(text))]

    assert shown("call (555) 123-4567 now, or 12 34.") == ["(555) 123-4567"]
    assert shown("user@localhost and a1b2c3d, jane") == ["user@localhost", "a1b2c3d"]
    assert shown('key: abc, k2 = "x y"') == ["abc", "x"]
    assert shown("mail a@b.co 1.2.3.4") == [] and shown("") == []


def test_contexts_are_whole_words():
    text = f"{'v' * 500} at user@localhost {'w' * 300}"
    around = pii.Surroundings(text)
    own = pii.patterns(around, text.index("user"), text.index(" www"))
    assert own == [f"L2|{hashlib.sha256(b'v' * 500).hexdigest()} at", f"LR|at|{hashlib.sha256(b'w' * 300).hexdigest()}"]
    assert 'A|token|="' in pii.patterns(pii.Surroundings('a (token = "x")'), 12, 13) and "A|k|=" in pii.patterns(pii.Surroundings("k=7"), 2, 3)
    many = "a@b.co,1234567;" * 20_000  # one word of 300,000 characters
    assert len(pii.occurrences(many, pii.base_spans(many))) >= 20_000


def test_graph_scores_match_brute_force(spark):
    rng = random.Random(6)
    edges = {(f"p{rng.randrange(14)}", f"i{rng.randrange(60)}") for _ in range(400)}
    kind = {f"i{k}": rng.choice(["email", "ip", "secret", "", ""]) for k in range(60)}
    rows = [(p, i, kind[i]) for p, i in edges]
    want = {}
    for target in ("email", "ip", "secret"):
        own = {p: [i for q, i in edges if q == p] for p in {p for p, _ in edges}}
        own = {p: x for p, x in own.items() if sum(kind[i] == target for i in x) >= pii.MIN_SEEDS}
        belief = {i: float(kind[i] == target) for i in kind}
        for k in range(pii.ROUNDS):
            score = {p: sum(belief[i] for i in x) / (len(x) + pii.DOUBT) for p, x in own.items()}
            belief = {i: max((score[p] for p, x in own.items() if i in x), default=0.0) if kind[i] == "" else belief[i] for i in kind}
        want.update({(p, target): (c, sum(kind[i] == target for i in own[p])) for p, c in score.items()})
    got = {(r.pattern, r.kind): (r.confidence, r.seeds) for r in pii.scored(spark.createDataFrame(rows, "pattern string, instance string, kind string")).collect()}
    assert got.keys() == want.keys() and want
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_pii_query_columns(spark, small):
    rows = {r.doc_id: r.text or "" for r in read(spark, small, "documents").collect()}
    for r in pii.query(spark, small).collect():
        base = brute_spans(rows[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[2] == k for s in base) for k in KINDS)
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans == text or r.n_context


# ---------------------------------------------------------------- operator 9
def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in read(spark, sf, "documents").select("doc_id", "lang").collect()}
    held = [r for r in language.query(spark, sf).collect() if r.held_out]
    assert {zlib.crc32(str(r.doc_id).encode()) % 5 for r in held} == {0}
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_language_of_odd_texts(spark, docs):
    rows = [(i, "the cat and the dog sat on the mat", "en") for i in range(9)] + [(20 + i, "der hund und die katze sind nicht hier", "de") for i in range(9)]
    rows += [(40, None, "en"), (41, "", "en"), (42, "12 #! 7", "de"), (43, "漢字 かな", None), (None, "the dog", None), (45, "katze " * 3000, None), (46, "THE CAT", "de")]
    d = docs(rows)
    filters = language.learn(language.training(d))
    assert filters.langs == ["de", "en"]
    got = {r.doc_id: r for r in language.predict(d, filters).collect()}
    assert [got[k].lang_pred for k in (40, 41, 42, None, 45, 46)] == ["und", "und", "und", "en", "de", "en"]
    assert got[40].score == 0 and got[43].lang_pred in ("de", "en") and got[43].score == 0
    kept = language.identified(d, filters)
    assert kept.schema == d.schema and {40, 41, 42, 43}.isdisjoint({r.doc_id for r in kept.collect()}) and kept.count() == len(rows) - 4
    none = language.learn(d.limit(0).select("lang", "text"))
    assert {r.lang_pred for r in language.predict(d, none).collect()} == {"und"}


def test_filters_return_all_languages():
    rng = np.random.default_rng(0)
    langs = [f"l{k:02}" for k in range(70)]  # more than one mask word
    own = [rng.integers(1, 2**60, 300) for _ in langs]
    f = language.Filters.build(langs, np.repeat(np.arange(70), 300), np.concatenate(own))
    assert f.slots.shape[0] == 2
    hits, total = f.hits(np.concatenate([own[3], own[69]]), np.repeat([0, 1], 300), 2)
    assert hits[0, 3] == pytest.approx(300) and hits[1, 69] == pytest.approx(300) and total.tolist() == [300, 300]
    assert np.delete(hits[0], 3).max() < 15
