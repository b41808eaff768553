import unicodedata

from pyspark.sql import functions as F

from tenderlake.functions import text as X
from tenderlake.operators import filters as FL
from tenderlake.operators.records import top_keywords_inline


def one(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_clean_text(spark):
    out = one(spark, ["Pregão Eletrônico para Aquisição de 10 (dez) notebooks i7.", "müller ação", None],
              X.clean_text)
    assert out == ["pregão eletrônico aquisição dez notebooks", "ação", ""]


def test_fold(spark):
    assert one(spark, ["  Ação ÿ ß ", None], X.fold) == ["acao y ", ""]


def test_fold_whole_unicode(spark):
    odd = ["ﬁscalização", "ＡＢＣ１", "Ⅳ etapa", "fim…", "Marca™", "½ kg ㎏", "漢字 ok", "ǅ ﬃ ℌ", "İstanbul", "𝐀𝟗", "e\u0301 ñ", "Å — “x”"]
    want = [unicodedata.normalize("NFKD", s.lower().strip()).encode("ascii", "ignore").decode() for s in odd]
    assert one(spark, odd, X.fold) == want


def test_squash(spark):
    assert one(spark, [" a \n\t b  ", None], X.squash) == ["a b", ""]


def test_matched_keywords(spark):
    out = one(spark, ["Instalação de HID leitor de cartões", "acidhide"],
              lambda c: X.matched_keywords(c, ["hid", "leitor facial"]))
    assert out == [["hid"], []]


def test_flex_pattern(spark):
    pat = "(?iU)" + X.flex_pattern("controle de acesso")
    out = one(spark, ["controle-de_acesso", "controledeacesso", "controle do acesso"], lambda c: c.rlike(pat))
    assert out == [True, True, False]


def test_top_keywords_inline(spark):
    out = one(spark, ["Aquisição de catraca e catraca facial"], lambda c: top_keywords_inline(X.tokens(c)))
    assert out == [["catraca", "facial"]]


def test_categorize_reference_dictionary(spark):
    out = one(spark, ["Aquisição de notebook para escola", "Reforma da escola municipal",
                      "Prestação de serviços de limpeza", "xyz"], X.categorize)
    assert out == ["tecnologia", "engenharia_obras", "servicos_gerais", "outros"]


def test_slug(spark):
    assert one(spark, ["Relógio de ponto", "iDFace", "!!!"], X.slug) == ["relogio_de_ponto", "idface", "termo"]


def test_parse_label(spark):
    out = one(spark, ["0", " 1 ", "00", "0\n0", "11", "01", "2", None], X.parse_label)
    assert out == [0, 1, 0, 0, 1, None, None, None]


def test_parse_response(spark):
    vals = ['```json\n{"relevante":1,"categoria":"cftv","motivo":"ok"}\n```',
            '{"relevante":"1","categoria":"xyz"}', '{"relevante":true}', '{"relevante":1.9}',
            '{"relevante":null}', "oops"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    p = X.parse_response(F.col("v"))
    got = [(r[0], r[1], r[2], r[3]) for r in df.select(p.relevante, p.categoria, p.motivo, p.ok).collect()]
    assert got[:4] == [(1, "cftv", "ok", True), (1, None, "", True), (1, None, "", True), (1, None, "", True)]
    assert [g[0] for g in got[4:]] == [0, 0] and [g[1] for g in got[4:]] == [None, None]
    assert all(g[2].startswith("Erro ao parsear") and not g[3] for g in got[4:])


def test_keyword_filter(spark):
    df = spark.createDataFrame([("Controle de Acesso facial",)], "t string")
    assert FL.filter_keywords(df, "t", any_=["ponto", "acesso"]).count() == 1
    assert FL.filter_keywords(df, "t", all_=["acesso", "catraca"]).count() == 0
    assert FL.filter_keywords(df, "t", any_=[" "]).count() == 1


def test_null_text(spark):
    df = spark.createDataFrame([(" ",), ("NaN",), ("none",), (" a  b ",)], "t string")
    assert [r[0] for r in FL.drop_null_text(df, "t").collect()] == ["a b"]
