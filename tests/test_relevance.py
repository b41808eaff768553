import math

from pyspark.sql import functions as F

from tenderlake.operators import filters as FL
from tenderlake.operators import model as M
from tenderlake.operators import relevance as RV
from tenderlake.operators import summary as A

REGEX_TEXTS = [
    "LOCAÇÃO DE CATRACAS-ELETRÔNICAS tipo pedestal bidirecional com software gerenciador de controle-de-acesso",
    "Aquisição de medicamentos hospitalares",
    "Sistema com aplicativo facial para controle de frequência",
    "Fechaduras eletromagnéticas para porta automática",
    "Conjunto controle acesso área restrita com leitor facial e botoeira",
    "Estação de solda com controle termostático",
    "Serviço de vigilância patrimonial com controle de entrada e saída de pessoas",
]


def test_regex_goldens(spark):
    df = spark.createDataFrame(list(enumerate(REGEX_TEXTS)), "i int, t string")
    out = RV.regex_decision(df, "t").orderBy("i").collect()
    got = [(r.status_final, r.termos_positivos_batidos, r.termos_negativos_batidos) for r in out]
    assert got == [
        ("relevante", "catraca_eletronica, controle_acesso", ""),
        ("nao_relevante", "", "medicamentos"),
        ("relevante", "controle_frequencia, sistema_aplicativo_facial", ""),
        ("relevante", "porta_automatica", ""),
        ("relevante", "leitor_facial, conjunto_controle_area_restrita, botoeira", ""),
        ("nao_relevante", "", "estacao_solda, solda"),
        ("revisar", "", ""),
    ]


TERM_TEXTS = [
    "Estação Solda tipo corrente: alternada, tensão alimentação: 110, tipo ponta: removível",
    "LOCAÇÃO DE CATRACA ELETRÔNICA TIPO PEDESTAL COM SOFTWARE GERENCIADOR DE CONTROLE DE ACESSO",
    "Aquisição de medicamentos hospitalares",
    "Terminal de controle de acesso multibiométrico com reconhecimento facial",
    "Software de gestão de multas e infrações de trânsito",
    "Relógio de ponto biométrico com emissão de AFD",
    "Serviço de vigilância patrimonial com controle de entrada e saída de pessoas",
    "controle de acesso da frota",
]


def test_term_rule_goldens(spark):
    df = spark.createDataFrame(list(enumerate(TERM_TEXTS)), "i int, t string")
    out = [(r.classe_regra, r.status_regra) for r in RV.rule_decision(df, "t").orderBy("i").collect()]
    assert out == [(0, "nao_relevante"), (1, "relevante"), (0, "nao_relevante"), (1, "relevante"),
                   (None, "sem_regra"), (1, "relevante"), (None, "sem_regra"), (None, "revisar")]


def test_thresholds_hybrid_gate(spark):
    df = spark.createDataFrame([(0.85,), (0.8499,), (0.40,), (0.39,)], "p double")
    cls, st = RV.threshold_decision(F.col("p"))
    assert [(r[0], r[1]) for r in df.select(cls, st).collect()] == [
        (1, "relevante"), (None, "revisar"), (None, "revisar"), (0, "nao_relevante")]
    h = spark.createDataFrame([("relevante", 0.01), ("sem_regra", 0.5), ("sem_regra", 0.1)], "r string, p double")
    c, s, o = RV.hybrid_decision(F.col("r"), F.col("p"))
    assert [(x[0], x[1], x[2]) for x in h.select(c, s, o).collect()] == [
        (1, "relevante", "regra_forte_positiva"), (None, "revisar", "modelo_inseguro"),
        (0, "nao_relevante", "modelo_confiante")]
    g = spark.createDataFrame([(1, 0.80), (0, 0.79)], "l int, c double")
    st, mo, cl = RV.review_gate(F.col("l"), F.col("c"))
    assert [(x[0], x[1]) for x in g.select(st, cl).collect()] == [
        ("aprovado_pelo_modelo", "atende"), ("validacao_humana", "nao_atende")]


def test_ambiguity(spark):
    df = spark.createDataFrame([("ambiguo", "alta", ""), ("catraca", "baixa", ""),
                                ("catraca", "alta", "texto genérico"), ("catraca", "alta", "ok")],
                               "c string, f string, m string")
    assert [r[0] for r in df.select(FL.is_ambiguous("c", "f", "m")).collect()] == [True, True, True, False]


def test_binary_metrics(spark):
    df = spark.createDataFrame(list(zip([1, 1, 0, 0, 1], [1, 0, 0, 1, 1])), "y int, p int")
    r = A.binary_metrics(df).first()
    assert r.accuracy == 0.6 and abs(r.precision - 2 / 3) < 1e-6 and abs(r.f1 - 2 / 3) < 1e-6
    z = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    r = A.binary_metrics(z).first()
    assert r.precision == 0.0 and r.f1 == 0.0


def test_softmax(spark):
    df = spark.createDataFrame([([1.0, 3.0],), ([0.0, 0.0],)], "l array<double>")
    lab, conf, probs = M.softmax_argmax(F.col("l"))
    out = df.select(lab, F.round(probs[0], 6), F.round(probs[1], 6)).collect()
    assert (out[0][0], out[0][1], out[0][2]) == (1, 0.119203, 0.880797)
    assert (out[1][0], out[1][1], out[1][2]) == (0, 0.5, 0.5)


def test_scorer_fallback(spark):
    class BadScorer:  # local class: shipped to the Python workers by value
        def classify(self, texts):
            if len(texts) > 1:
                return []
            return [{"serve_para_mim": True, "categoria": "x", "confianca": "alta", "motivo": "ok"}]

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, t string").coalesce(1)
    out = RV.score(df, "t", BadScorer(), batch_size=2).orderBy("id").collect()
    assert [r.categoria for r in out] == ["erro_classificacao", "erro_classificacao", "x"]
    assert not math.isnan(out[0].id)


def test_build_label_set(spark):
    import pytest
    raw = spark.createDataFrame(
        [("a  b", True, "x", "alta", "ok"), ("a b", True, "x", "alta", "ok"), ("c", False, "x", "alta", "ok"),
         ("nan", True, "x", "alta", "ok"), ("d", True, "ambiguo", "alta", "ok"), ("e", False, "x", "baixa", "ok")],
        "texto string, serve_para_mim boolean, categoria string, confianca string, motivo string")
    out = sorted((r.text, r.label) for r in RV.build_label_set(raw).collect())
    assert out == [("a b", 1), ("c", 0)]
    with pytest.raises(ValueError):
        RV.build_label_set(raw.where("serve_para_mim"))


def test_run_relevance(spark):
    df = spark.createDataFrame([(1, "controle de acesso"), (2, "medicamentos"), (3, "catraca")], "id long, t string")
    done = spark.createDataFrame([(3,)], "id long")
    new, log = RV.run_relevance(df, done, "id", "t", RV.TermScorer())
    assert [r.id for r in new.collect()] == [1]
    assert sorted((r.id, r.status) for r in log.collect()) == [(1, "ok"), (2, "ok")]
