"""Operator 7 - personal data by bootstrapped contextual extraction.

Base spans (email, ip, card, phone) come from fixed patterns and always stay.
They are seeds, and so are high-entropy tokens (kind ``secret``: long, letters
and digits, many different ones), which are reported only where a pattern
confirms them.  The surroundings of an occurrence are lexical patterns of its
kind: the two words before (L2), the words on both sides (LR), and, backing off
to one word, a word with the assignment signs between it and the occurrence (A,
as in ``token = "``).  Unlabelled instances have patterns of their own: tokens
with a digit or an @ (at least ``MIN_TOKEN`` characters), runs of neighbouring
tokens of digits and telephone signs, and whatever is assigned.  Patterns and
instances form a bipartite graph that Spark scores in rounds, per kind:

* a pattern's confidence is the mean confidence of its distinct instances
  (seeds 1 for their own kind, unlabelled ones what they had before, 0 first),
  with ``DOUBT`` pseudo-instances of confidence 0, and counts only with
  ``MIN_SEEDS`` distinct seeds;
* an instance's confidence is that of its best pattern.

Patterns with ``MIN_CONFIDENCE`` then yield their unlabelled occurrences, and
their secrets, as ``context-<kind>`` spans.

The text is read once: a narrow table of spans and occurrences feeds all
rounds.  (pattern, instance) edges are made distinct before they are joined,
so a frequent pattern or instance is one row per edge and sums before each
shuffle.

Defined cases: NULL or empty text has no spans; rows that repeat an id are
rows of their own; without seeds there are no patterns; other columns are
ignored.  Context words are whole, those of over ``LONG_WORD`` characters by
their digest; a context reaches back to the occurrence before at most.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, slices, written

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
ROUNDS, MIN_SEEDS, DOUBT, MIN_CONFIDENCE, MIN_TOKEN = 3, 5, 1.0, 0.8, 6
SECRET_CHARS, SECRET_MIX, SECRET_BITS = 20, 4, 3.0  # least length, letters and digits, bits per character
LONG_WORD = 64

# fixed patterns of the base spans
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
MARKED = re.compile(r"[0-9@]")
NUMBER = re.compile(r"[(+]?[0-9][0-9()+./-]*")
ASSIGNED = re.compile(r"[=:][\x20\x09]*[\"']?([^\x20\x09-\x0D\"']+)")
TOKEN_CHARS = re.compile(r"[A-Za-z0-9_+/=-]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = ".,;:!?\"'()[]{}<>|"
NUMBER_EDGE = ".,;:!?\"'[]{}<>|"
ASSIGN = EDGE + "="
SPACES = " \t\n\x0b\x0c\r"


def emails(text: str):
    """Leftmost, non-overlapping: the local part reaches back from each @ to the last match at most."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    out = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(*m.span(), "ip") for m in IP.finditer(text) if all(len(x) <= 3 and int(x or 0) <= 255 for x in (y.lstrip("0") for y in m[0].split(".")))]
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
        if "+" in text:
            out += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def is_secret(token: str) -> bool:
    """Whether a token looks like a key: long, letters and digits, high entropy."""
    if len(token) < SECRET_CHARS or not TOKEN_CHARS.fullmatch(token):
        return False
    digits, letters = sum(map(str.isdigit, token)), sum(map(str.isalpha, token))
    if min(digits, letters) < SECRET_MIX:
        return False
    return -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values()) >= SECRET_BITS


def tokens(text: str, spans: list[tuple[int, int, str]]):
    """Instances outside the base spans, in order: (start, end)."""
    out, done = [], 0
    for d in MARKED.finditer(text):
        if d.start() < done:
            continue
        begin = d.start()
        while begin > done and text[begin - 1] not in SPACES:
            begin -= 1
        m = WORD.match(text, begin)
        done = m.end()
        s, e = m.start() + len(m[0]) - len(m[0].lstrip(NUMBER_EDGE)), m.end() - (len(m[0]) - len(m[0].rstrip(NUMBER_EDGE)))
        if NUMBER.fullmatch(text, s, e):
            if out and out[-1][2] and s - out[-1][1] == 1:  # a run of numbers, one space between
                out[-1] = (out[-1][0], e, True)
                continue
            out.append((s, e, True))
        else:
            s, e = m.start() + len(m[0]) - len(m[0].lstrip(EDGE)), m.end() - (len(m[0]) - len(m[0].rstrip(EDGE)))
            quote = text.find('"', s, e)
            out.append((s, quote if quote > s else e, False))
    out = [(s, e) for s, e, _ in out if e - s >= MIN_TOKEN]
    known = {s for s, _ in out}
    for m in ASSIGNED.finditer(text):
        s, e = m.start(1), m.end(1) - (len(m[1]) - len(m[1].rstrip(EDGE)))
        if e > s and s not in known:
            out.append((s, e))
    last = taken = 0
    for s, e in sorted(out):
        while taken < len(spans) and spans[taken][1] <= s:
            taken += 1
        if s >= last and not any(a < e and s < b for a, b, _ in spans[max(0, taken - 4):taken + 8]):
            last = e
            yield s, e


def _short(word: str) -> str:
    return word if len(word) <= LONG_WORD else hashlib.sha256(word.encode()).hexdigest()


class Surroundings:
    """The words of a text around its occurrences."""

    def __init__(self, text: str):
        self.text = text
        self.begin, self.end = [], []
        for m in WORD.finditer(text):
            self.begin.append(m.start())
            self.end.append(m.end())

    def before(self, at: int, back: int, n: int = 3) -> list[str]:
        """The last ``n`` words, or parts of words, that end at ``at`` and begin at ``back`` or later; nearest first."""
        out = []
        for k in range(bisect_left(self.begin, at) - 1, -1, -1):
            a, b = max(self.begin[k], back), min(self.end[k], at)
            if len(out) == n or a >= b:
                break
            out.append(self.text[a:b])
        return out

    def after(self, at: int) -> str:
        """The next word, or the rest of the one at hand."""
        k = bisect_left(self.end, at + 1)
        while k < len(self.end):
            word = self.text[max(self.begin[k], at):self.end[k]]
            if k + 1 < len(self.end) and self.begin[k] < at and not word.strip(EDGE):
                k += 1  # only punctuation is left of it
                continue
            return word.strip(EDGE).lower()
        return ""


def patterns(around: Surroundings, start: int, end: int, back: int = 0) -> list[str]:
    """The lexical patterns of an occurrence: two words before; one before and one after; an assignment."""
    pieces = around.before(start, back)
    left = [_short(w.strip(EDGE).lower()) for w in reversed(pieces[:2])]
    right = _short(around.after(end))
    out = [f"L2|{' '.join(left)}"] if len(left) == 2 and any(map(str.isalnum, "".join(left))) else []
    if left and left[-1] and right:
        out.append(f"LR|{left[-1]}|{right}")
    sign = ""
    for piece in pieces:
        head = piece.rstrip(ASSIGN)
        sign = piece[len(head):] + sign
        if head:
            if "=" in sign or ":" in sign:
                out.append(f"A|{_short(head.lstrip(ASSIGN).lower())}|{_short(sign)}")
            break
    return out


def occurrences(text: str, spans: list[tuple[int, int, str]]) -> list[dict]:
    """Seeds and unlabelled instances (kind '') with their patterns, in order of their start."""
    found = [(a, b, k) for a, b, k in spans]
    found += [(a, b, SECRET if is_secret(text[a:b]) else "") for a, b in tokens(text, spans)]
    if not found:
        return []
    around, out, back, far = Surroundings(text), [], 0, 0
    for a, b, k in sorted(found):
        if a >= far:
            back = far
        out.append({"kind": k, "instance": text[a:b], "start": a, "end": b, "patterns": patterns(around, a, b, min(back, a))})
        far = max(far, b)
    return out


def scanned(docs: DataFrame) -> DataFrame:
    """One row per text: base spans, and the occurrences (kind, instance, start, end, patterns) of seeds and tokens."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("instance", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("patterns", pa.list_(pa.string()))]))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    schema = ("doc_id long, row string, base array<struct<start:long,end:long,kind:string>>, base_sha256 string, "
              "seen array<struct<kind:string,instance:string,start:long,end:long,patterns:array<string>>>")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                base, digest, seen = [], [], []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    spans = base_spans(text)
                    base.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
                    digest.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest())
                    seen.append(occurrences(text, spans))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), pa.array(base, span), pa.array(digest, pa.string()), pa.array(seen, kind)],
                                                 names=["doc_id", "row", "base", "base_sha256", "seen"])

    return docs.select(F.col("doc_id").cast("long"), F.uuid().alias("row"), "text").mapInArrow(run, schema)


def scored(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence, seeds) of distinct (pattern, instance, kind) edges; kind '' is unlabelled.

    The bipartite graph is scored once per kind: an instance that is a seed of
    another kind counts 0.
    """
    spark = edges.sparkSession
    seeds = edges.filter("kind <> ''").groupBy("pattern", "kind").agg(F.countDistinct("instance").alias("seeds")).filter(F.col("seeds") >= MIN_SEEDS)
    seeds = written(spark, seeds, "pii-seeds")
    live = seeds.select("pattern", F.col("kind").alias("target"))
    graph = written(spark, edges.join(live, "pattern")
                    .select("pattern", "instance", "target", (F.col("kind") == F.col("target")).cast("double").alias("fixed"), (F.col("kind") == "").alias("free")), "pii-graph")
    conf = graph.withColumn("belief", F.col("fixed"))
    for k in range(rounds):
        score = conf.groupBy("pattern", "target").agg((F.sum("belief") / (F.count("*") + DOUBT)).alias("confidence"))
        if k == rounds - 1:
            break
        belief = (graph.filter("free").join(score, ["pattern", "target"]).groupBy("instance", "target").agg(F.max("confidence").alias("b")))
        conf = written(spark, graph.join(belief, ["instance", "target"], "left")
                       .withColumn("belief", F.when(F.col("free"), F.coalesce("b", F.lit(0.0))).otherwise(F.col("fixed"))).drop("b"), "pii-belief")
    return score.join(seeds.withColumnRenamed("kind", "target"), ["pattern", "target"]).withColumnRenamed("target", "kind")


def found(docs: DataFrame) -> DataFrame:
    """Base and discovered spans of every row of (doc_id, text): see ``query``."""
    spark = docs.sparkSession
    rows = written(spark, scanned(docs), "pii-rows")
    seen = rows.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    uses = seen.select("row", "kind", "instance", "start", "end", F.explode("patterns").alias("pattern"))
    score = scored(uses.select("pattern", "instance", "kind").distinct())
    sure = written(spark, score.filter(F.col("confidence") >= MIN_CONFIDENCE).select("pattern", F.col("kind").alias("target"), "confidence"), "pii-patterns")
    new = (uses.join(sure, "pattern").filter((F.col("kind") == "") | ((F.col("kind") == SECRET) & (F.col("target") == SECRET))).groupBy("row", "start", "end")
           .agg(F.max_by("target", F.struct("confidence", "target")).alias("target")))
    new = new.groupBy("row").agg(F.collect_list(F.struct("start", "end", F.concat(F.lit("context-"), "target").alias("kind"))).alias("more"))  # spans of one text
    return rows.drop("seen").join(new, "row", "left")


def query(spark, sf_dir: str) -> DataFrame:
    out = found(read(spark, sf_dir, "documents"))
    order = F.transform("base", lambda s: F.struct(s["start"], F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("o"), s["end"], s["kind"]))
    more = F.transform(F.coalesce("more", F.array().cast("array<struct<start:long,end:long,kind:string>>")),
                       lambda s: F.struct(s["start"], F.lit(len(KINDS) + 1).cast("long").alias("o"), s["end"], s["kind"]))
    spans = F.array_join(F.transform(F.array_sort(F.concat(order, more)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *map(count, KINDS), "base_sha256", spans.alias("spans"), F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_context"))
