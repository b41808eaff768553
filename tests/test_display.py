from pyspark.sql import functions as F

from tenderlake.functions import display as D
from tenderlake.operators import records as R


def one(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_parse_control_and_link(spark):
    vals = ["46523049000120-1-000021/2026", "46523049000120-1-21/2026", "46523049000120-2-000021/2026", "abc"]
    out = one(spark, vals, D.parse_control)
    assert [tuple(o) if o else None for o in out] == [("46523049000120", "21", "2026")] * 2 + [None, None]
    assert one(spark, vals[:1], D.portal_link) == ["https://pncp.gov.br/editais/46523049000120/2026/21"]


def test_fmt_date(spark):
    out = one(spark, ["2026-03-02T08:00:00", "2026-03-02T08:00", "2026-03-02", "", "x"], D.fmt_date)
    assert out == ["02/03/2026 08:00", "02/03/2026 08:00", "02/03/2026", "Não informado", "x"]
    out = one(spark, ["2026-03-03T11:10:35", ""], lambda c: D.fmt_date(c, "listing"))
    assert out == ["03/03/2026 - 11:10:35", "—"]


def test_fmt_brl_cnpj(spark):
    out = one(spark, ["50142.0", "1234567.5", "0.125", "", "abc"], D.fmt_brl)
    assert out == ["R$ 50.142,00", "R$ 1.234.567,50", "R$ 0,12", "Não informado", "abc"]
    assert one(spark, ["46523049000120", "123", ""], D.fmt_cnpj) == ["46.523.049/0001-20", "123", "Não informado"]


def test_deadline(spark):
    days = ["2026-03-25", "2026-03-23", "2026-03-22", "2026-03-21", "2026-03-20", "2026-03-19", "2026-03-18",
            "2026-03-10", ""]
    out = one(spark, days, lambda c: D.deadline_status(c, "2026-03-20"))
    assert out == ["Vence em 5 dias", "Vence em 3 dias", "Vence depois de amanhã", "Vence amanhã", "Vence hoje",
                   "Venceu ontem", "Venceu antes de ontem", "Vencido há 10 dias", ""]


def test_valid_link(spark):
    out = one(spark, ["https://a", " HTTP://b ", "banco de dados", "ftp://x", None], D.valid_link)
    assert out == ["https://a", "HTTP://b", None, None, None]


def test_category_name(spark):
    out = one(spark, ["cftv", "controle_acesso", "outra_coisa", ""], D.category_name)
    assert out == ["CFTV / Câmeras", "Controle de Acesso", "Outra_Coisa", "—"]


def test_pruned_json(spark):
    df = spark.createDataFrame(
        [(None, "", [], ("",), [(None,), (None,)], float("nan"), 0, False)],
        "a string, b string, c array<string>, d struct<x:string>, e array<struct<y:string>>, f double, g int, h boolean")
    j = R.to_pruned_json(df).first()[0]
    assert j == '{"g":0,"h":false}'


def test_explode_attachments(spark):
    docs = [("k1", '{"Arquivos":[{"titulo":"a","url":"u"},{"nome":"b","link":"l","url":"u2"}]}'),
            ("k2", '{"arquivos":[{"titulo":"c"}]}'), ("k3", "{}")]
    df = spark.createDataFrame(docs, "pncp_id string, raw string")
    out = [(r.pncp_id, r.titulo, r.link) for r in R.explode_attachments(df).orderBy("pncp_id", "posicao").collect()]
    assert out == [("k1", "a", "u"), ("k1", "b", "l"), ("k2", "c", None)]
