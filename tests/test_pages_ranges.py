import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tenderlake.operators import ranges as RG
from tenderlake.sources import pages as PG

REC = {"numeroControlePNCP": "K"}


def test_envelopes(spark):
    docs = [json.dumps({"data": [REC, REC], "totalPaginas": 3, "paginasRestantes": 2}),
            json.dumps({"items": [REC], "total": 1}), json.dumps({"content": [REC]}),
            json.dumps({"dados": [REC]}), json.dumps([REC]),
            json.dumps({"modalidades": {"A": {"dados": [REC]}, "B": {"dados": [REC, REC]}}}),
            json.dumps({"x": 1}), "not json", ""]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, value string")
    out = PG.parse_pages(df.select("value"), "value").count()
    assert out == 2 + 1 + 1 + 1 + 1 + 3


def test_announced_pages(spark):
    cases = [({"totalPaginas": "4"}, 4), ({"totalRegistros": 101, "tamanhoPagina": 50}, 3), ({"totalRegistros": 101}, 6),
             ({"numeroPagina": 2, "paginasRestantes": 3}, 5), ({}, 1), ({"totalPaginas": 0}, 1), ([1], 1), ({"totalPaginas": "x"}, 1)]
    df = spark.createDataFrame([(json.dumps(c), n) for c, n in cases], "d string, n int")
    got = df.select("n", PG.announced_pages(F.parse_json("d"), 20).alias("got")).collect()
    assert [r.got for r in got] == [r.n for r in got]


def test_paged_source(spark, tmp_path):
    def land(m, p, text):
        d = tmp_path / f"modalidade={m}" / f"pagina={p}"
        d.mkdir(parents=True)
        (d / "x.txt").write_text(text)

    land("a", 1, "broken")  # the first readable page tells the count
    land("a", 2, json.dumps({"resposta": {"data": [REC, REC], "totalPaginas": 3}}))
    land("a", 3, json.dumps([REC]))
    land("a", 4, json.dumps([REC]))
    land("b", 1, json.dumps({"items": [REC]}))
    got = sorted((r.modalidade, r.pagina, r.pos) for r in PG.paged_source(spark, f"file://{tmp_path}").collect())
    assert got == [("a", 2, 0), ("a", 2, 1), ("a", 3, 0), ("b", 1, 0)]
    with pytest.raises(AnalysisException):
        PG.paged_source(spark, f"{tmp_path}/missing")


def test_paged_source_by_lines(spark, tmp_path):
    """Fetch records, one per line, say their own page; broken lines give no rows."""
    def record(p, env):
        return json.dumps({"fonte": "x", "pagina": p, "resposta": env})

    (tmp_path / "modalidade=1").mkdir()
    lines = [record(2, [REC]), "broken", record(1, {"data": [REC, REC], "totalPaginas": 2}), record(3, [REC])]
    (tmp_path / "modalidade=1" / "x.txt").write_text("\n".join(lines))
    df = PG.paged_source(spark, f"file://{tmp_path}")
    assert sorted((r.modalidade, r.pagina, r.pos) for r in df.collect()) == [("1", 1, 0), ("1", 1, 1), ("1", 2, 0)]


def test_pages_are_parsed_once(spark, tmp_path):
    def parses(df):
        return df._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson")

    (tmp_path / "modalidade=1").mkdir()
    (tmp_path / "modalidade=1" / "x.txt").write_text("[]")
    assert parses(PG.read_pages(spark, f"file://{tmp_path}")) == 1
    assert parses(PG.paged_source(spark, f"file://{tmp_path}")) == 2  # one for the limits, one for the records


def test_paging_stop(spark):
    def kept(counts, max_pages=None):
        df = spark.createDataFrame([("q", i + 1, n) for i, n in enumerate(counts)], "q string, p int, n int")
        return sorted(r.p for r in PG.take_until_end(df, "q", "p", "n", 50, max_pages).collect())
    assert kept([50, 50, 20, 50]) == [1, 2, 3]
    assert kept([50, 0, 50]) == [1]
    assert kept([50, 50, 50], 2) == [1, 2]


def test_windows(spark):
    w = RG.date_windows(spark, "2026-01-01", "2026-01-08", 7).collect()
    assert [(str(r.inicio), str(r.fim)) for r in w] == [("2026-01-01", "2026-01-07"), ("2026-01-08", "2026-01-08")]


def test_bisect(spark):
    daily = spark.createDataFrame([("2026-01-01", 6), ("2026-01-02", 6), ("2026-01-03", 3), ("2026-01-04", 4)],
                                  "d string, n long").selectExpr("to_date(d) AS dia", "n")
    out = sorted((str(r.lo), str(r.hi), r.n, r.overflow) for r in RG.bisect_ranges(daily, "2026-01-01", "2026-01-04", 10).collect())
    assert out == [("2026-01-01", "2026-01-01", 6, False), ("2026-01-02", "2026-01-02", 6, False),
                   ("2026-01-03", "2026-01-04", 7, False)]
    one = spark.createDataFrame([("2026-01-01", 12)], "d string, n long").selectExpr("to_date(d) AS dia", "n")
    out = [(r.n, r.overflow) for r in RG.bisect_ranges(one, "2026-01-01", "2026-01-01", 10).collect()]
    assert out == [(12, True)]
