"""CSV records with line breaks inside quotes, read by many tasks per file.

A line starts either outside quotes or inside them, so a line, and any run of
lines, is a function of that one bit.  A first pass over the splits of all files
composes the function of every split; a running composition over the splits of
a file gives each split its true start.  In the second pass every task joins the
lines of its splits into records; only the records that cross a split, at most
one per split border, are put together by a shuffle.  Records are parsed by
Spark's own CSV parser.

A quote opens a field only as its first character and ``""`` stands for a quote
inside one, as in Spark's reader.  A file whose first line ends in ``\\r\\n``
has that line end everywhere, inside quotes it reads as ``\\n``; in other files
lines end in ``\\n`` and ``\\r`` is a character.  A quote that is still open at
the end of a file ends there, without the last line break.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

SPLITS = "file string, block long, to0 boolean, to1 boolean, crlf boolean"
PARTS = "file string, block long, kind int, first boolean, crlf boolean, record string"
WHOLE, HEAD, TAIL = 0, 1, 2  # a record; the end of one from an earlier split; the start of one that goes on
BATCH = 10_000


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that starts outside (or inside) quotes ends inside them."""
    at = 0
    if not inside:
        inside = line.startswith('"')
        at = 1
    while True:
        if not inside:
            at = line.find(',"', at - 1 if at else 0)
            if at < 0:
                return False
            at += 2
        at = line.find('"', at)
        if at < 0:
            return True
        inside = line.startswith('"', at + 1)
        at += 2 if inside else 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in file order within each split, with their split."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.coalesce("value", F.lit("")).alias("line")))


def _runs(batch: pa.RecordBatch):
    """(file, block, lines) of each run of lines of one split."""
    file, block = batch.column("file").to_pylist(), batch.column("block").to_numpy()
    lines = batch.column("line").to_pylist()
    cut = [0, *(k for k in range(1, len(lines)) if block[k] != block[k - 1] or file[k] != file[k - 1]), len(lines)]
    for lo, hi in zip(cut, cut[1:]):
        if hi > lo:
            yield file[lo], int(block[lo]), lines[lo:hi]


def _splits(lines: DataFrame) -> DataFrame:
    """SPLITS: where each split ends if it starts outside (to0) or inside (to1) quotes."""

    def run(batches):
        here, ends, crlf = None, (False, True), False
        done = []
        for batch in batches:
            for file, block, own in _runs(batch):
                if here != (file, block):
                    if here:
                        done.append((*here, *ends, crlf))
                    here, ends, crlf = (file, block), (False, True), block == 0 and own[0].endswith("\r")
                for line in own:
                    if '"' in line:
                        one = {s: ends_inside(line, s) for s in set(ends)}
                        ends = tuple(one[s] for s in ends)
        if here:
            done.append((*here, *ends, crlf))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["file", "block", "to0", "to1", "crlf"])

    return lines.mapInArrow(run, SPLITS)


def starts(splits: DataFrame) -> DataFrame:
    """(file, block, inside, crlf): the true start of every split, and the line end of a file in its first.

    A split either forgets its start (to0 = to1), keeps it or turns it; so the
    start of a split is the end of the last one that forgot, turned as often as
    splits since then turn it."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turn = F.coalesce(F.sum(F.when(F.col("to0") & ~F.col("to1"), 1).otherwise(0)).over(before), F.lit(0))
    forgets = F.when(F.col("to0") == F.col("to1"), F.struct(F.col("to0").alias("end"), (F.col("turns") + 0).alias("turns")))
    x = splits.withColumn("turns", turn).withColumn("last", F.last(forgets, ignorenulls=True).over(before))
    since = F.col("turns") - F.coalesce("last.turns", F.lit(0))
    return x.select("file", "block", "crlf", (F.coalesce("last.end", F.lit(False)) != (since % 2 == 1)).alias("inside"))


def _parts(lines: DataFrame, inside: dict, crlf: set) -> DataFrame:
    """PARTS: whole records, and the pieces of those that cross splits."""

    def run(batches):
        here, state, held, kind, first, out = None, False, [], WHOLE, False, []

        def close(kind, text):
            out.append((*here, kind, first, here[0] in crlf, text))

        def flush():
            cols = list(zip(*out))
            out.clear()
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["file", "block", "kind", "first", "crlf", "record"])

        for batch in batches:
            for file, block, own in _runs(batch):
                if here != (file, block):
                    if held:
                        close(kind if kind == HEAD else TAIL, "\n".join(held))
                    here, held, first = (file, block), [], block == 0
                    if here not in inside:
                        raise RuntimeError("the files or their splits changed between the two passes")
                    state = inside[here]
                    kind = HEAD if state else WHOLE
                for line in own:
                    held.append(line)
                    if '"' in line:
                        state = ends_inside(line, state)
                    if not state:
                        close(kind, held[0] if len(held) == 1 else "\n".join(held))
                        held, kind, first = [], WHOLE, False
                if len(out) >= BATCH:
                    yield flush()
        if held:
            close(kind if kind == HEAD else TAIL, "\n".join(held))
        if out:
            yield flush()

    return lines.mapInArrow(run, PARTS)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(first, record): the records of all CSV files under ``path``; ``first`` marks each file's first."""
    lines = _lines(spark, path)
    inside, crlf = {}, set()  # an entry per split, so some 100 bytes for every 128 MB of input
    for r in starts(_splits(lines)).toLocalIterator():
        inside[r["file"], r["block"]] = r["inside"]
        if r["crlf"]:
            crlf.add(r["file"])
    parts = _parts(lines, inside, crlf)
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    began = F.last(F.when(F.col("kind") == TAIL, F.col("block")), ignorenulls=True).over(order)
    crossing = (parts.where(F.col("kind") != WHOLE).withColumn("began", began).groupBy("file", "began", "crlf")
                .agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("p"))
                .select("first", "crlf", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    out = parts.where(F.col("kind") == WHOLE).select("first", "crlf", "record").unionByName(crossing)
    unix = F.regexp_replace(F.regexp_replace("record", r"\r\z", ""), r"\r\n", "\n")
    return out.select("first", F.when(F.col("crlf"), unix).otherwise(F.col("record")).alias("record"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of CSV files with a header, quoted multi-line text and ``""`` quotes; all columns are text.

    The same rows as Spark's ``multiLine`` reader, which gives a whole file to
    one task; the order of rows is not kept.
    """
    header = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
              .option("inferSchema", False).option("encoding", "UTF-8").csv(path))
    fields = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(header.columns))])
    rows = csv_records(spark, path).where(~F.col("first") & (F.col("record") != ""))
    parsed = rows.select(F.from_csv("record", fields.simpleString()[7:-1].replace(":", " "), {"escape": '"', "multiLine": "true"}).alias("r"))
    return parsed.select(*[F.col(f"r.c{k}").alias(name) for k, name in enumerate(header.columns)])
