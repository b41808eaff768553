"""Premium summaries, report rows and display formatting over the notices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import display as D
from ..functions import fixed
from ..operators import dedupe as W
from ..operators import records as R
from ..operators import summary as A
from ..tables import table
from . import query
from . import sqlfrag as S
from .adapters import FEEDS_SQL, NOTICES_SQL, feeds_raw, notices, with_ctes

# Category dictionary for the derived notices' vocabulary (part names);
# the operator default is the procurement dictionary.
NOTICE_CATEGORIES = [
    ("ferragens", ["bolt", "rod", "anvil"]),
    ("mecanica", ["gear", "ring", "plate"]),
    ("dispositivos", ["widget", "gizmo"]),
]
TODAY = "1998-08-02"


def _j(p):
    return f"json_extract_string(raw, '$.{p}')"


# ---------------------------------------------------------------- premium records
def premium(spark, sf_dir):
    """Consulta feed -> W01 dedupe by key (keyless kept) -> P07 -> flat."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "consulta")
    k = f.select("ingest_seq", "seq", "raw",
                 F.get_json_object("raw", "$.numeroControlePNCP").alias("_k"))
    d = W.dedupe_first(k, "_k", "seq").drop("_k")
    return R.premium_flat(R.normalize_premium(d, categories=NOTICE_CATEGORIES))


PREM_SQL = f"""
prem AS (
  SELECT ingest_seq, seq,
    {_j('numeroControlePNCP')} AS numero_controle_pncp,
    {_j('objetoCompra')} AS objeto_compra,
    TRY_CAST({_j('valorTotalEstimado')} AS DOUBLE) AS valor_total_estimado,
    {S.categorize("coalesce(" + _j('objetoCompra') + ", '')", NOTICE_CATEGORIES, 'outros')} AS categoria_objeto,
    TRY_CAST({_j('modalidadeId')} AS INTEGER) AS modalidade_id,
    {_j('modalidadeNome')} AS modalidade_nome,
    {_j('dataPublicacaoPncp')} AS publicacao_pncp,
    {_j('dataEncerramentoProposta')} AS encerramento_proposta,
    {_j('unidadeOrgao.ufSigla')} AS uf_sigla,
    {_j('unidadeOrgao.municipioNome')} AS municipio_nome
  FROM feeds WHERE feed = 'consulta'
  QUALIFY row_number() OVER (PARTITION BY coalesce(nullif({_j('numeroControlePNCP')}, ''), '#' || CAST(seq AS VARCHAR))
                             ORDER BY seq) = 1
)"""
PREM_BASE = with_ctes(NOTICES_SQL, FEEDS_SQL, PREM_SQL)

_KW_SQL = f"""
kw_t AS (SELECT ingest_seq, {S.tokens("coalesce(objeto_compra, '')", fixed.TOKEN_STOPWORDS)} AS toks FROM prem),
kw_e AS (SELECT ingest_seq, unnest(toks) AS tok, unnest(range(CAST(len(toks) AS BIGINT))) AS pos FROM kw_t),
kw_c AS (SELECT ingest_seq, tok, count(*) AS n, min(pos) AS first FROM kw_e GROUP BY ingest_seq, tok),
kw_r AS (SELECT ingest_seq, tok, row_number() OVER (PARTITION BY ingest_seq ORDER BY n DESC, first) AS rk FROM kw_c
         QUALIFY rk <= 8),
kw AS (SELECT p.ingest_seq, coalesce(string_agg(tok, ',' ORDER BY rk), '') AS palavras_chave
       FROM prem p LEFT JOIN kw_r r ON r.ingest_seq = p.ingest_seq GROUP BY p.ingest_seq)"""

PREM_COLS = ["numero_controle_pncp", "objeto_compra", "valor_total_estimado", "categoria_objeto",
             "modalidade_id", "modalidade_nome", "publicacao_pncp", "encerramento_proposta", "uf_sigla",
             "municipio_nome"]


@query("normalize_premium", PREM_BASE + "," + _KW_SQL + f"""
SELECT p.ingest_seq, {', '.join('p.' + c for c in PREM_COLS)}, kw.palavras_chave
FROM prem p JOIN kw ON kw.ingest_seq = p.ingest_seq""")
def q_normalize_premium(spark, sf_dir):
    """P07 (+T08/T09/W01): premium records with category and keywords."""
    p = premium(spark, sf_dir)
    return p.select("ingest_seq", *PREM_COLS, F.array_join("palavras_chave", ",").alias("palavras_chave"))


@query("summary_modality", PREM_BASE + """
SELECT modalidade_id AS modalidadeId, modalidade_nome AS modalidadeNome, count(*) AS quantidade FROM prem
WHERE modalidade_id IS NOT NULL AND coalesce(modalidade_nome, '') <> '' GROUP BY ALL""")
def q_summary_modality(spark, sf_dir):
    """Count per (modality id, name), both present."""
    return A.summary_modality(premium(spark, sf_dir))


@query("summary_state", PREM_BASE + """
SELECT uf_sigla AS uf, count(*) AS quantidade FROM prem WHERE coalesce(uf_sigla, '') <> '' GROUP BY ALL""")
def q_summary_state(spark, sf_dir):
    """Count per state."""
    return A.summary_state(premium(spark, sf_dir))


@query("summary_city", PREM_BASE + """
SELECT municipio_nome AS municipio, uf_sigla AS uf, count(*) AS quantidade FROM prem
WHERE coalesce(municipio_nome, '') <> '' AND coalesce(uf_sigla, '') <> ''
GROUP BY ALL ORDER BY quantidade DESC, municipio, uf LIMIT 20""")
def q_summary_city(spark, sf_dir):
    """Top-20 (municipality, state)."""
    return A.summary_city(premium(spark, sf_dir))


_STATS_SQL = """
SELECT count(*) AS total_registros,
  count(DISTINCT CASE WHEN modalidade_id IS NOT NULL AND coalesce(modalidade_nome, '') <> ''
                      THEN CAST(modalidade_id AS VARCHAR) || '|' || modalidade_nome END) AS total_modalidades,
  coalesce(CAST(sum(CAST(valor_total_estimado AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS valor_total_estimado_somado,
  coalesce(CAST(round(sum(CAST(valor_total_estimado AS DECIMAL(18,2))) / count(valor_total_estimado), 2) AS DOUBLE), 0.0)
    AS valor_total_estimado_medio,
  min(nullif(publicacao_pncp, '')) AS menor_data_publicacao,
  max(nullif(publicacao_pncp, '')) AS maior_data_publicacao,
  array_to_string(list_sort(list_distinct(list(CASE WHEN modalidade_id IS NOT NULL AND coalesce(modalidade_nome, '') <> ''
                      THEN CAST(modalidade_id AS VARCHAR) END))), ',') AS modalidades
FROM prem"""


@query("general_stats", PREM_BASE + _STATS_SQL)
def q_general_stats(spark, sf_dir):
    """One-row statistics (decimal money sums)."""
    return A.general_stats(premium(spark, sf_dir))


_ITEM = ["ingest_seq", "seq", "numero_controle_pncp", "objeto_compra", "valor_total_estimado", "categoria_objeto", "modalidade_id",
         "publicacao_pncp", "encerramento_proposta", "uf_sigla", "municipio_nome"]


@query("nested_group", PREM_BASE + f""", grp AS (
SELECT coalesce(nullif(modalidade_nome, ''), 'Sem modalidade') AS modalidade,
  arg_min(modalidade_id, (coalesce(encerramento_proposta, ''), coalesce(publicacao_pncp, ''),
                          lower(coalesce(objeto_compra, '')), ingest_seq)) AS modalidadeId,
  CAST(arg_min(modalidade_id, (coalesce(encerramento_proposta, ''), coalesce(publicacao_pncp, ''),
                          lower(coalesce(objeto_compra, '')), ingest_seq)) AS VARCHAR) AS codigo_modalidade,
  count(*) AS quantidade
FROM prem GROUP BY 1)
SELECT grp.*, row_number() OVER (PARTITION BY grp.modalidade ORDER BY coalesce(encerramento_proposta, ''), coalesce(publicacao_pncp, ''),
                                 lower(coalesce(objeto_compra, '')), ingest_seq) AS posicao, {', '.join(_ITEM)}
FROM prem JOIN grp ON grp.modalidade = coalesce(nullif(modalidade_nome, ''), 'Sem modalidade')""")
def q_nested_group(spark, sf_dir):
    """Modality groups (first notice's id, count, group order) with their
    notices in display order, every entry of the lists compared at its place."""
    per = 1000
    g = A.group_by_modality(premium(spark, sf_dir).select(*_ITEM, "modalidade_nome"), per=per)
    return g.select("modalidade", "modalidadeId", "codigo_modalidade", "quantidade", "parte", F.posexplode("dados").alias("_pos", "_n")).select(
        "modalidade", "modalidadeId", "codigo_modalidade", "quantidade", ((F.col("parte") - 1) * per + F.col("_pos") + 1).alias("posicao"),
        *[F.col(f"_n.{c}").alias(c) for c in _ITEM])


def _joined(sql, order):
    return f"(SELECT coalesce(string_agg(t, ';' ORDER BY {order}), '') FROM ({sql}))"


@query("premium_payload", PREM_BASE + """
SELECT (SELECT count(*) FROM prem) AS total_registros,
  (SELECT count(*) FROM (SELECT DISTINCT modalidade_id, modalidade_nome FROM prem
     WHERE modalidade_id IS NOT NULL AND coalesce(modalidade_nome, '') <> '')) AS total_modalidades,
  """ + _joined("""SELECT modalidade_id AS i, modalidade_nome AS n, modalidade_id || '|' || modalidade_nome || '|' || count(*) AS t FROM prem
    WHERE modalidade_id IS NOT NULL AND coalesce(modalidade_nome, '') <> '' GROUP BY modalidade_id, modalidade_nome""", "i, n") + """ AS modalidades,
  """ + _joined("""SELECT uf_sigla AS u, count(*) AS q, uf_sigla || '|' || count(*) AS t FROM prem WHERE coalesce(uf_sigla, '') <> '' GROUP BY uf_sigla""",
                "q DESC, u") + """ AS ufs,
  """ + _joined("""SELECT municipio_nome AS m, uf_sigla AS u, count(*) AS q, municipio_nome || '|' || uf_sigla || '|' || count(*) AS t FROM prem
    WHERE coalesce(municipio_nome, '') <> '' AND coalesce(uf_sigla, '') <> '' GROUP BY municipio_nome, uf_sigla ORDER BY q DESC, m, u LIMIT 20""", "q DESC, m, u") + """ AS municipios,
  """ + _joined("""SELECT categoria_objeto AS c, count(*) AS q, categoria_objeto || '|' || count(*) AS t FROM prem GROUP BY categoria_objeto""",
                "q DESC, c") + """ AS categorias,
  (SELECT coalesce(CAST(sum(CAST(valor_total_estimado AS DECIMAL(18,2))) AS DOUBLE), 0.0) FROM prem) AS soma,
  (SELECT min(nullif(publicacao_pncp, '')) FROM prem) AS menor_data_publicacao,
  (SELECT max(nullif(publicacao_pncp, '')) FROM prem) AS maior_data_publicacao""")
def q_premium_payload(spark, sf_dir):
    """One JSON document with metadata and the bounded summaries
    (A02-A06), every entry compared; the grouped notices stay a table (A07)."""
    doc = premium_payload(premium(spark, sf_dir))

    def rows(path, fields):
        schema = "array<struct<" + ", ".join(f"{f}:string" for f in (*fields, "quantidade")) + ">>"
        parsed = F.from_json(F.get_json_object("payload", path), schema)
        return F.array_join(F.transform(parsed, lambda e: F.concat_ws("|", *[e[f] for f in (*fields, "quantidade")])), ";")

    g = lambda path, t="string": F.get_json_object("payload", path).cast(t)
    return doc.select(g("$.metadata.totalRegistros", "bigint").alias("total_registros"),
                      g("$.metadata.totalModalidades", "bigint").alias("total_modalidades"),
                      rows("$.resumoModalidades", ["modalidadeId", "modalidadeNome"]).alias("modalidades"),
                      rows("$.resumoPorUF", ["uf"]).alias("ufs"),
                      rows("$.resumoPorMunicipio", ["municipio", "uf"]).alias("municipios"),
                      rows("$.resumoPorCategoria", ["categoria"]).alias("categorias"),
                      g("$.estatisticasGerais.valor_total_estimado_somado", "double").alias("soma"),
                      g("$.estatisticasGerais.menor_data_publicacao").alias("menor_data_publicacao"),
                      g("$.estatisticasGerais.maior_data_publicacao").alias("maior_data_publicacao"))


def premium_payload(p):
    """A16 builder in ONE aggregation pass: grouping sets compute the
    modality, state, city and category counts and the overall statistics
    together (one scan, one shuffle).  Every summary is bounded
    (modalities, states, top-20 cities, categories, one stats row), so the
    final single-group aggregate that folds them into JSON arrays holds a
    bounded number of rows."""
    mid, mname, uf, city, cat = "modalidade_id", "modalidade_nome", "uf_sigla", "municipio_nome", "categoria_objeto"
    v = F.col("valor_total_estimado").cast("decimal(18,2)")
    pub = F.when(F.col("publicacao_pncp") != "", F.col("publicacao_pncp"))
    has_mod = F.col(mid).isNotNull() & (F.coalesce(F.col(mname), F.lit("")) != "")
    base = p.select(mid, mname, uf, city, F.coalesce(F.col(cat), F.lit("outros")).alias(cat),
                    v.alias("_v"), pub.alias("_pub"), F.when(has_mod, F.col(mid).cast("string")).alias("_mid_ok"))
    g = base.groupingSets([[mid, mname], [uf], [city, uf], [cat], []], mid, mname, uf, city, cat).agg(
        F.count(F.lit(1)).alias("quantidade"), F.sum("_v").alias("_sum"), F.count("_v").alias("_cnt"),
        F.min("_pub").alias("_min"), F.max("_pub").alias("_max"),
        F.array_join(F.sort_array(F.collect_set("_mid_ok")), ",").alias("_mods"),
        F.grouping_id().alias("_gid"))
    # grouping_id bits, highest first: modalidade_id, modalidade_nome, uf, municipio, categoria
    gid = F.col("_gid")
    is_mod, is_uf, is_city, is_cat, is_all = (gid == 0b00111), (gid == 0b11011), (gid == 0b11001), \
        (gid == 0b11110), (gid == 0b11111)
    ok_mod = is_mod & F.col(mid).isNotNull() & (F.coalesce(F.col(mname), F.lit("")) != "")
    ok_uf = is_uf & (F.coalesce(F.col(uf), F.lit("")) != "")
    ok_city = is_city & (F.coalesce(F.col(city), F.lit("")) != "") & (F.coalesce(F.col(uf), F.lit("")) != "")
    tag = (F.when(ok_mod, "m").when(ok_uf, "u").when(ok_city, "c").when(is_cat, "k").when(is_all, "s"))
    q = F.col("quantidade")
    k1 = F.when(ok_mod, F.col(mid).cast("bigint")).when(is_all, F.lit(0)).otherwise(-q)
    k2 = (F.when(ok_mod, F.col(mname)).when(ok_uf, F.col(uf)).when(ok_city, F.concat_ws("\u0000", city, uf))
           .when(is_cat, F.col(cat)).otherwise(F.lit("")))
    j = (F.when(ok_mod, F.to_json(F.struct(F.col(mid).alias("modalidadeId"), F.col(mname).alias("modalidadeNome"), q)))
          .when(ok_uf, F.to_json(F.struct(F.col(uf).alias("uf"), q)))
          .when(ok_city, F.to_json(F.struct(F.col(city).alias("municipio"), F.col(uf).alias("uf"), q)))
          .when(is_cat, F.to_json(F.struct(F.col(cat).alias("categoria"), q)))
          .otherwise(F.to_json(F.struct(
              q.alias("total_registros"),
              F.coalesce(F.col("_sum").cast("double"), F.lit(0.0)).alias("valor_total_estimado_somado"),
              F.coalesce(F.round(F.col("_sum") / F.col("_cnt"), 2).cast("double"), F.lit(0.0))
               .alias("valor_total_estimado_medio"),
              F.col("_min").alias("menor_data_publicacao"), F.col("_max").alias("maior_data_publicacao"),
              F.col("_mods").alias("modalidades")))))
    # one row per group; every task sends its own top 20 of the cities
    t = g.select(tag.alias("_t"), k1.alias("_k1"), k2.alias("_k2"), j.alias("_j")).where(F.col("_t").isNotNull()).checkpoint()
    t = t.where("_t <> 'c'").unionByName(t.where("_t = 'c'").orderBy("_k1", "_k2").limit(20))

    def arr(tag_):
        lst = F.array_sort(F.collect_list(F.when(F.col("_t") == tag_, F.struct("_k1", "_k2", "_j"))))
        return F.concat(F.lit("["), F.array_join(F.transform(lst, lambda e: e["_j"]), ","), F.lit("]"))

    stats = F.max(F.when(F.col("_t") == "s", F.col("_j")))
    n_mod = F.count_if(F.col("_t") == "m")
    meta = F.concat(F.lit('{"totalRegistros":'), F.get_json_object(stats, "$.total_registros"),
                    F.lit(',"totalModalidades":'), n_mod.cast("string"),
                    F.lit(',"versao_schema":"3.0","estrutura":"premium_plus"}'))
    doc = F.concat(F.lit('{"metadata":'), meta, F.lit(',"resumoModalidades":'), arr("m"),
                   F.lit(',"resumoPorUF":'), arr("u"), F.lit(',"resumoPorMunicipio":'), arr("c"),
                   F.lit(',"resumoPorCategoria":'), arr("k"), F.lit(',"estatisticasGerais":'), stats, F.lit("}"))
    return t.agg(doc.alias("payload"))


@query("count_rows", with_ctes(NOTICES_SQL) + "SELECT count(*) AS total FROM notices")
def q_count_rows(spark, sf_dir):
    """COUNT(*)."""
    return A.count_rows(notices(spark, sf_dir).select("ingest_seq"))


@query("sort_premium", PREM_BASE + """
SELECT ingest_seq, encerramento_proposta, publicacao_pncp, objeto_compra FROM prem
ORDER BY coalesce(encerramento_proposta, ''), coalesce(publicacao_pncp, ''), lower(coalesce(objeto_compra, ''))""")
def q_sort_premium(spark, sf_dir):
    """Closing, publication, lower(text)."""
    p = premium(spark, sf_dir).select("ingest_seq", "encerramento_proposta", "publicacao_pncp", "objeto_compra")
    return A.sort_premium(p)


@query("latest_n", PREM_BASE + """
SELECT ingest_seq, numero_controle_pncp, substr(objeto_compra, 1, 80) AS preview FROM prem
ORDER BY ingest_seq DESC LIMIT 5""")
def q_latest_n(spark, sf_dir):
    """Newest five rows with an 80-char preview (top-k report)."""
    p = premium(spark, sf_dir)
    return A.latest_n(p, "ingest_seq", 5, "objeto_compra", 80, cols=["numero_controle_pncp"])


@query("row_index", with_ctes(NOTICES_SQL) + """
SELECT ingest_seq, row_number() OVER (ORDER BY dataPublicacaoPncp, ingest_seq) AS idx FROM notices""")
def q_row_index(spark, sf_dir):
    """1-based display index in (publication, seq) order."""
    n = notices(spark, sf_dir).select("ingest_seq", "dataPublicacaoPncp")
    return W.with_index(n, ["dataPublicacaoPncp", "ingest_seq"], "idx").select("ingest_seq", "idx")


@query("offset_page", with_ctes(NOTICES_SQL) + """
SELECT ingest_seq, numeroControlePNCP FROM notices ORDER BY ingest_seq LIMIT 200 OFFSET 400""")
def q_offset_page(spark, sf_dir):
    """Reader page (LIMIT 200 OFFSET 400, row order)."""
    n = notices(spark, sf_dir).select("ingest_seq", "numeroControlePNCP")
    return W.page(n, 400, 200, ["ingest_seq"])


@query("offset_tail", with_ctes(NOTICES_SQL) + """
SELECT ingest_seq, numeroControlePNCP FROM notices ORDER BY numeroControlePNCP NULLS FIRST, ingest_seq
LIMIT (SELECT count(*) FROM notices) OFFSET 1000""")
def q_offset_tail(spark, sf_dir):
    """All rows but the first 1000 (no limit), in the order of a column with NULLs."""
    n = notices(spark, sf_dir).select("ingest_seq", "numeroControlePNCP")
    return W.page(n, 1000, None, ["numeroControlePNCP", "ingest_seq"])


# ---------------------------------------------------------------- display
@query("parse_control", with_ctes(NOTICES_SQL) + r"""
SELECT ingest_seq, regexp_extract(numeroControlePNCP, '^(\d+)-1-(\d+)/(\d+)', 1) AS cnpj,
  regexp_replace(regexp_extract(numeroControlePNCP, '^(\d+)-1-(\d+)/(\d+)', 2), '^0+(\d)', '\1') AS seq,
  regexp_extract(numeroControlePNCP, '^(\d+)-1-(\d+)/(\d+)', 3) AS ano,
  regexp_matches(replace(numeroControlePNCP, '-1-', '-2-'), '^(\d+)-1-(\d+)/(\d+)') AS other_series_ok
FROM notices WHERE numeroControlePNCP IS NOT NULL""")
def q_parse_control(spark, sf_dir):
    """Control number -> (cnpj, seq without zeros, year); other series -> NULL."""
    n = notices(spark, sf_dir).where(F.col("numeroControlePNCP").isNotNull())
    p = D.parse_control("numeroControlePNCP")
    o = D.parse_control(F.replace(F.col("numeroControlePNCP"), F.lit("-1-"), F.lit("-2-")))
    return n.select("ingest_seq", p.cnpj.alias("cnpj"), p.seq.alias("seq"), p.ano.alias("ano"),
                    o.isNotNull().alias("other_series_ok"))


@query("build_links", with_ctes(NOTICES_SQL, FEEDS_SQL) + r"""
SELECT ingest_seq,
  CASE WHEN regexp_matches(nk, '^(\d+)-1-(\d+)/(\d+)') THEN 'https://pncp.gov.br/editais/' ||
       regexp_extract(nk, '^(\d+)-1-(\d+)/(\d+)', 1) || '/' || regexp_extract(nk, '^(\d+)-1-(\d+)/(\d+)', 3) || '/' ||
       regexp_replace(regexp_extract(nk, '^(\d+)-1-(\d+)/(\d+)', 2), '^0+(\d)', '\1') END AS link_pncp,
  'https://pncp.gov.br' || json_extract_string(raw, '$.item_url') AS link_item
FROM (SELECT *, json_extract_string(raw, '$.numero_controle_pncp') AS nk FROM feeds WHERE feed = 'search')""")
def q_build_links(spark, sf_dir):
    """Portal link from the control number; relative item URL -> absolute."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "search")
    r = F.from_json("raw", "numero_controle_pncp string, item_url string")
    x = f.select("ingest_seq", r.alias("r"))
    return x.select("ingest_seq", D.portal_link("r.numero_controle_pncp").alias("link_pncp"),
                    D.absolute_url("r.item_url").alias("link_item"))


def _sql_fmt_date(x):
    ts = f"coalesce(try_strptime({x}, '%Y-%m-%dT%H:%M:%S'), try_strptime({x}, '%Y-%m-%dT%H:%M'))"
    d = f"try_strptime({x}, '%Y-%m-%d')"
    return (f"CASE WHEN {x} IS NULL OR trim({x}) IN ('', 'None', 'null') THEN 'Não informado' "
            f"WHEN {ts} IS NOT NULL THEN strftime({ts}, '%d/%m/%Y %H:%M') "
            f"WHEN {d} IS NOT NULL THEN strftime({d}, '%d/%m/%Y') ELSE {x} END")


def _sql_fmt_listing(x):
    ts = (f"coalesce(try_strptime({x}, '%Y-%m-%dT%H:%M:%S'), try_strptime({x}, '%Y-%m-%dT%H:%M'), "
          f"try_strptime({x}, '%Y-%m-%d'))")
    return (f"CASE WHEN coalesce({x}, '') = '' THEN '—' "
            f"WHEN {ts} IS NOT NULL AND contains({x}, 'T') THEN strftime({ts}, '%d/%m/%Y - %H:%M:%S') "
            f"WHEN {ts} IS NOT NULL THEN strftime({ts}, '%d/%m/%Y') ELSE {x} END")


@query("fmt_date", with_ctes(NOTICES_SQL) + f"""
SELECT ingest_seq,
  {_sql_fmt_date('dataEncerramentoProposta')} AS encerramento,
  {_sql_fmt_date('substr(dataPublicacaoPncp, 1, 16)')} AS publicacao_min,
  {_sql_fmt_date('substr(dataPublicacaoPncp, 1, 10)')} AS publicacao_dia,
  {_sql_fmt_date("CASE WHEN ingest_seq % 11 = 0 THEN '' ELSE situacaoCompraNome END")} AS texto,
  {_sql_fmt_listing('dataAberturaProposta')} AS abertura_listagem
FROM notices""")
def q_fmt_date(spark, sf_dir):
    """Report and listing date formats; blank and text inputs."""
    n = notices(spark, sf_dir)
    txt = F.when(F.col("ingest_seq") % 11 == 0, F.lit("")).otherwise(F.col("situacaoCompraNome"))
    return n.select("ingest_seq", D.fmt_date("dataEncerramentoProposta").alias("encerramento"),
                    D.fmt_date(F.substring("dataPublicacaoPncp", 1, 16)).alias("publicacao_min"),
                    D.fmt_date(F.substring("dataPublicacaoPncp", 1, 10)).alias("publicacao_dia"),
                    D.fmt_date(txt).alias("texto"),
                    D.fmt_date("dataAberturaProposta", "listing").alias("abertura_listagem"))


@query("fmt_brl", with_ctes(NOTICES_SQL) + """
SELECT ingest_seq, 'R$ ' || translate(format('{:,.2f}', valorTotalEstimado), ',.', '.,') AS valor,
  'R$ ' || translate(format('{:,.2f}', valorTotalEstimado / 1000), ',.', '.,') AS valor_mil
FROM notices""")
def q_fmt_brl(spark, sf_dir):
    """BRL money display."""
    n = notices(spark, sf_dir)
    return n.select("ingest_seq", D.fmt_brl("valorTotalEstimado").alias("valor"),
                    D.fmt_brl(F.col("valorTotalEstimado") / 1000).alias("valor_mil"))


@query("fmt_cnpj", with_ctes(NOTICES_SQL) + r"""
SELECT ingest_seq, regexp_replace(orgao_cnpj, '^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$', '\1.\2.\3/\4-\5') AS cnpj,
  substr(orgao_cnpj, 3) AS curto
FROM notices""")
def q_fmt_cnpj(spark, sf_dir):
    """CNPJ display (14 digits formatted, others unchanged)."""
    n = notices(spark, sf_dir)
    return n.select("ingest_seq", D.fmt_cnpj("orgao_cnpj").alias("cnpj"),
                    D.fmt_cnpj(F.substring("orgao_cnpj", 3, 100)).alias("curto"))


@query("deadline_status", with_ctes(NOTICES_SQL) + f"""
SELECT ingest_seq, CASE
  WHEN d >= 3 THEN 'Vence em ' || CAST(d AS VARCHAR) || ' dias' WHEN d = 2 THEN 'Vence depois de amanhã'
  WHEN d = 1 THEN 'Vence amanhã' WHEN d = 0 THEN 'Vence hoje' WHEN d = -1 THEN 'Venceu ontem'
  WHEN d = -2 THEN 'Venceu antes de ontem' ELSE 'Vencido há ' || CAST(abs(d) AS VARCHAR) || ' dias' END AS prazo
FROM (SELECT ingest_seq, date_diff('day', DATE '{TODAY}', CAST(strptime(dataEncerramentoProposta, '%Y-%m-%dT%H:%M:%S') AS DATE)) AS d
      FROM notices)""")
def q_deadline_status(spark, sf_dir):
    """Closing-date badge relative to a given day."""
    n = notices(spark, sf_dir)
    return n.select("ingest_seq", D.deadline_status("dataEncerramentoProposta", TODAY).alias("prazo"))


@query("valid_link", """
SELECT page_id,
  CASE WHEN lower(trim(url)) LIKE 'http%' THEN trim(url) END AS url_ok,
  CASE WHEN lower(trim(substr(url, 5))) LIKE 'http%' THEN trim(substr(url, 5)) END AS cortado,
  CASE WHEN lower(trim(upper(url))) LIKE 'http%' THEN trim(upper(url)) END AS maiusculo
FROM pages""")
def q_valid_link(spark, sf_dir):
    """usable links only (http..., any case), else NULL."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", D.valid_link("url").alias("url_ok"),
                    D.valid_link(F.substring("url", F.lit(5), F.length("url"))).alias("cortado"),
                    D.valid_link(F.upper("url")).alias("maiusculo"))


_CD_RE = S.q(r"""(?i)filename\*?=["']?(?:UTF-8'')?([^"';\r\n]+)""")
_QUOTES_RE = S.q(r"""^["']+|["']+$""")


@query("file_names", r"""
WITH t AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages),
c AS (SELECT page_id, title,
        regexp_replace(trim(regexp_extract('attachment; filename="' || title || '"', """ + _CD_RE + r""", 1)),
                       """ + _QUOTES_RE + r""", '', 'g') AS m
      FROM t)
SELECT page_id,
  trim(regexp_replace(title, '[\\/:*?"<>|]', '_', 'g')) || '.html' AS nome,
  CASE WHEN m <> '' THEN trim(regexp_replace(m, '[\\/:*?"<>|]', '_', 'g')) END AS de_cabecalho
FROM c""")
def q_file_names(spark, sf_dir):
    """Sanitised file name + extension by content type; name from a
    Content-Disposition header."""
    p = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    cd = F.concat(F.lit('attachment; filename="'), title, F.lit('"'))
    return p.select("page_id",
                    F.concat(D.sanitize_name(title), D.ext_for_content_type(F.lit("text/html; charset=utf-8")))
                     .alias("nome"),
                    D.name_from_disposition(cd).alias("de_cabecalho"))
