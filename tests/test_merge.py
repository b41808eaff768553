from pyspark.sql import functions as F

from tenderlake.operators import dedupe as W
from tenderlake.operators import merge as J
from tenderlake.operators import summary as A
from tenderlake.sources import sinks as K

SCHEMA = ("seq long, _origem string, numeroControlePNCP string, dataAtualizacaoGlobal string, titulo string, "
          "processo string, orgaoEntidade struct<cnpj:string, razaoSocial:string>")
ROWS = [
    (1, "search", "K1", "2026-03-10", "T", None, ("1", None)),
    (2, "consulta", "K1", "2026-03-12", "", "P9", ("", "X")),
    (3, "search", "K2", "2026-03-10", "first", None, ("2", "A")),
    (4, "consulta", "K2", "2026-03-10", "second", "P2", ("3", "B")),
    (5, "search", None, "2026-03-01", "u", None, ("4", "C")),
    (6, "consulta", None, "2026-03-01", "u", None, ("4", "C")),
]


def test_merge_feeds_fixture(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    m = J.merge_feeds(df, "numeroControlePNCP", "dataAtualizacaoGlobal", "seq")
    got = {r.seq: (r.numeroControlePNCP, r.dataAtualizacaoGlobal, r.titulo, r.processo, r.orgaoEntidade.cnpj,
                   r.orgaoEntidade.razaoSocial, r._origem) for r in m.collect()}
    assert got[1] == ("K1", "2026-03-12", "T", "P9", "1", "X", "ambos")
    assert got[3] == ("K2", "2026-03-10", "first", "P2", "2", "A", "ambos")
    assert got[5][0] is None and got[6][0] is None and len(got) == 4
    s = A.merge_summary(df.where("_origem = 'search'"), df.where("_origem = 'consulta'"), m).first()
    assert (s.total_search, s.total_consulta, s.unicos_com_chave, s.sem_chave, s.total_final) == (3, 3, 2, 2, 4)
    assert (s.origem_search, s.origem_consulta, s.origem_ambos) == (0, 0, 2)


def test_merge_latest_fixture(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    m = J.merge_latest(df, "numeroControlePNCP", "dataAtualizacaoGlobal", "seq")
    assert sorted(r.seq for r in m.collect()) == [2, 3, 5, 6]


def test_merge_idempotent(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    once = J.merge_latest(df, "numeroControlePNCP", "dataAtualizacaoGlobal", "seq")
    twice = J.merge_latest(once.unionByName(once), "numeroControlePNCP", "dataAtualizacaoGlobal", "seq")
    assert sorted(r.seq for r in once.collect()) == sorted(r.seq for r in twice.collect())


def test_dedupe_keeps_keyless(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "")], "seq long, k string")
    assert sorted(r.seq for r in W.dedupe_first(df, "k", "seq").collect()) == [1, 3, 4, 5]


def test_fallback_key(spark):
    df = spark.createDataFrame([(1, "", "7", None), (2, None, None, "5"), (3, None, None, None)],
                               "seq long, numeroControlePNCP string, id string, sequencialCompra string")
    k = W.fallback_key(df, ["numeroControlePNCP", "id", "sequencialCompra"], ["numeroControlePNCP", "id",
                                                                              "sequencialCompra"])
    out = [r[0] for r in df.orderBy("seq").select(k).collect()]
    assert out[:2] == ["id:7", "sequencialCompra:5"] and out[2].startswith("hash:")


def test_insert_and_upsert(spark):
    existing = spark.createDataFrame([("A", 0)], "k string, seq long")
    batch = spark.createDataFrame([("B", 1), ("B", 2), ("A", 3), (None, 4), (None, 5)], "k string, seq long")
    ins = K.insert_if_absent(existing, batch, "k", "seq")
    assert sorted((r.k or "", r.seq) for r in ins.collect()) == [("", 4), ("", 5), ("B", 1)]
    up = K.upsert(existing, batch, "k", "seq")
    assert sorted((r.k or "", r.seq) for r in up.collect()) == [("", 4), ("", 5), ("A", 3), ("B", 2)]


def test_slices_and_index(spark):
    df = spark.range(10).withColumnRenamed("id", "i")
    s = W.slices(df, 4, ["i"]).orderBy("i").collect()
    bounds = sorted({(r.slice_offset, r.slice_size) for r in s})
    assert bounds == [(0, 3), (3, 3), (6, 2), (8, 2)]
    few = W.slices(spark.range(2), 5, ["id"]).collect()
    assert sorted((r.slice_offset, r.slice_size) for r in few) == [(0, 1), (1, 1)]
    big = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    idx = W.with_index(big, ["k"], "n").orderBy("k").collect()
    assert [r.n for r in idx] == list(range(1, 5001))
    gi = W.with_index(big, ["k"], "n", partition_by=["g"]).collect()
    for g in range(3):
        ks = sorted(r.k for r in gi if r.g == g)
        assert sorted((r.k, r.n) for r in gi if r.g == g) == [(k, i + 1) for i, k in enumerate(ks)]


def test_match_pairs_blocks_agree(spark):
    docs = spark.createDataFrame([(1, "the license of apache"), (2, "le chat und mentionou"), (3, "nada"), (4, "xn/ab yn/a b"), (5, "a n/a b")],
                                 "doc_id long, text string")
    kw = spark.createDataFrame([("license",), ("apache",), ("le",), ("ment",), ("und",), ("of",), ("n/a",)], "term string")
    want = [(1, "apache"), (1, "license"), (1, "of"), (2, "le"), (2, "und"), (5, "n/a")]
    for size in (200, 12, 1):
        assert sorted((r.doc_id, r.keyword) for r in J.match_pairs(docs, kw, "text", lexicon_chars=size).collect()) == want
    assert J.match_pairs(docs, kw.limit(0), "text").count() == 0


def test_nested_group_lists_every_notice(spark):
    rows = [(1, 8, "Pregao", "2026-02-01", "p", "b"), (2, None, "Pregao", "2026-01-01", "p", "Z"), (3, 8, "Pregao", "2026-02-01", "p", "A"),
            (4, 6, None, None, None, None), (5, 8, "Pregao", "2026-02-01", "p", "B"), (6, 7, "Dispensa", "", "q", "x"), (7, 6, "", "", "", "")]
    df = spark.createDataFrame(rows, "ingest_seq long, modalidade_id int, modalidade_nome string, encerramento_proposta string,"
                                     " publicacao_pncp string, objeto_compra string")
    got = [(r.modalidade, r.modalidadeId, r.codigo_modalidade, r.quantidade, r.parte, [x.ingest_seq for x in r.dados])
           for r in A.group_by_modality(df, per=2).collect()]
    assert got == [("Sem modalidade", 6, "6", 2, 1, [4, 7]), ("Dispensa", 7, "7", 1, 1, [6]),
                   ("Pregao", None, None, 4, 1, [2, 3]), ("Pregao", None, None, 4, 2, [1, 5])]
    assert A.group_by_modality(df.limit(0)).count() == 0
