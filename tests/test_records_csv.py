"""Multi-line CSV read by many tasks, against Spark's one-task reader."""

import random
from collections import Counter

import pytest

from tenderlake.sources import files, records_csv


def whole(spark, path):
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path))


def both(spark, path, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        want, got = whole(spark, path), files.read_labels(spark, path)
        assert got.columns == want.columns
        return Counter(map(tuple, want.collect())), Counter(map(tuple, got.collect())), records_csv._lines(spark, path).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def field(rng):
    plain = ["a", "ção", " b ", "1", "x y", "", "it's", 'size 5" pipe', "é" * 30]
    quoted = ["line\nbreak", "two\n\nbreaks", "crlf\r\nin", "comma, in", 'a "quoted" word', '"', '""', "\n", "", "end\n", '\n"', ',"', '",', "long " * 40 + "\n" + "text " * 40]
    if rng.random() < 0.5:
        return rng.choice(plain)
    return '"' + rng.choice(quoted).replace('"', '""') + '"'


@pytest.mark.parametrize("seed", range(6))
def test_same_rows_as_the_one_task_reader(spark, tmp_path, seed):
    rng = random.Random(seed)
    end = rng.choice(["\n", "\r\n"])
    folder = tmp_path / "csv"
    folder.mkdir()
    for f in range(3):
        body = ["Objeto,Relevante,outra"] + [",".join(field(rng) for _ in range(3)) if rng.random() < 0.95 else rng.choice(["", "one,two", "a,b,c,d"]) for _ in range(120)]
        text = end.join(body) + rng.choice(["", end])
        (folder / f"{f}.csv").write_bytes((b"\xef\xbb\xbf" if f == 1 else b"") + text.encode())
    want, got, tasks = both(spark, str(folder), rng.choice([64, 300, 1000]))
    assert got == want and tasks > 6


def test_a_record_of_many_splits_and_small_files(spark, tmp_path):
    for name, text in {"long": 'a,b\n1,"' + "x\n" * 3000 + '"\n2,y\n', "open": 'a,b\n1,"never\nclosed', "head": "a,b\n", "one": "a,b\n1,2"}.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        want, got, _ = both(spark, str(path), 128)
        assert got == want, name


def test_line_functions():
    assert records_csv.ends_inside('a,"b', False) and not records_csv.ends_inside('a,b"', False)
    assert records_csv.ends_inside('a "" b', True) and not records_csv.ends_inside('a" b', True)
    assert records_csv.ends_inside('x",1,"y', True) and not records_csv.ends_inside('"a""b",c', False)
    assert records_csv.ends_inside('"', False) and not records_csv.ends_inside('"', True) and not records_csv.ends_inside("", False)


def test_starts_compose_the_splits(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for file in "xyz":
        inside = False
        for block in range(40):
            to = rng.choice([(False, True), (True, False), (False, False), (True, True)])
            rows.append((file, block, *to, False))
            want[file, block] = inside
            inside = to[inside]
    rng.shuffle(rows)
    got = records_csv.starts(spark.createDataFrame(rows, records_csv.SPLITS)).collect()
    assert {(r.file, r.block): r.inside for r in got} == want
