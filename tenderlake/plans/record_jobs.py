"""Record shaping, merges and set operations over the derived notices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import display as D
from ..operators import dedupe as W
from ..operators import merge as J
from ..operators import records as R
from ..operators import summary as A
from ..tables import table
from . import query
from .adapters import (DOCS_SQL, FEEDS_SQL, ITEMS_SQL, NOTICES_SQL, consulta_raw, feeds_raw, notice_docs, notices, with_ctes)


def _sql_t(*paths):
    return "coalesce(" + ", ".join(f"nullif(json_extract_string(raw, '$.{p}'), '')" for p in paths) + ")"


def _j(p):
    return f"json_extract_string(raw, '$.{p}')"


# ---------------------------------------------------------------- P04/P06
def _flat_name(column):
    return column.replace("orgaoEntidade.", "orgao_").replace("unidadeOrgao.", "unidade_")


def _norm_value(column, spec):
    """A common-notice column of one feed as SQL over its JSON."""
    paths = [p for p in spec.split("|") if p]
    if column == "fontesOrcamentarias":  # compared as joined text
        return f"coalesce(array_to_string(json_extract_string(raw, '$.{paths[0]}[*]'), ','), '')"
    value = _sql_t(*paths) if paths else "CAST(NULL AS VARCHAR)"
    if column in R.MONEY:
        return f"TRY_CAST({value} AS DOUBLE)"
    if column == "linkSistemaOrigem" and paths[0] == "item_url":
        return f"CASE WHEN {value} LIKE 'http%://%' THEN {value} ELSE 'https://pncp.gov.br' || {value} END"
    return value


def _norm_sql(feed, k):
    cols = ",\n    ".join(f"{_norm_value(f[0], f[k])} AS {_flat_name(f[0])}" for f in R.COMMON_FIELDS)
    return f"SELECT feed, ingest_seq, seq,\n    {cols}, '{feed}' AS _origem\n  FROM feeds WHERE feed = '{feed}'"


NORM_SQL = f"""
norm AS (
  {_norm_sql('search', 1)}
  UNION ALL
  {_norm_sql('consulta', 2)}
)"""

FLAT = [*[_flat_name(f[0]) for f in R.COMMON_FIELDS], "_origem"]


def _flat(df):
    rest = [c for c in df.columns if c not in R.COMMON_COLUMNS]
    cols = [(F.array_join("fontesOrcamentarias", ",") if f[0] == "fontesOrcamentarias" else F.col(f[0])).alias(_flat_name(f[0]))
            for f in R.COMMON_FIELDS]
    return df.select(*rest, *cols, "_origem")


def normalized_feeds(spark, sf_dir):
    """Both feeds normalised in one pass (P04 + P06, U01 by construction)."""
    return R.normalize_feeds(feeds_raw(spark, sf_dir), "raw", "feed")


NORM_BASE = with_ctes(NOTICES_SQL, FEEDS_SQL, NORM_SQL)
_FLAT_SQL = ", ".join(FLAT)


@query("normalize_search", NORM_BASE + f"SELECT ingest_seq, {_FLAT_SQL} FROM norm WHERE feed = 'search'")
def q_normalize_search(spark, sf_dir):
    """Search feed -> common notice."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "search").select("ingest_seq", "raw")
    return _flat(R.normalize_search(f)).select("ingest_seq", *FLAT)


@query("normalize_consulta", NORM_BASE + f"SELECT ingest_seq, {_FLAT_SQL} FROM norm WHERE feed = 'consulta'")
def q_normalize_consulta(spark, sf_dir):
    """Consulta feed -> common notice."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "consulta").select("ingest_seq", "raw")
    return _flat(R.normalize_consulta(f)).select("ingest_seq", *FLAT)


@query("union_feeds", NORM_BASE + f"SELECT feed, ingest_seq, seq, {_FLAT_SQL} FROM norm")
def q_union_feeds(spark, sf_dir):
    """Union by name of the two normalised feeds (missing columns NULL)."""
    f = feeds_raw(spark, sf_dir)
    s = R.normalize_search(f.where(F.col("feed") == "search"))
    c = R.normalize_consulta(f.where(F.col("feed") == "consulta"))
    return _flat(J.union_feeds(s, c)).select("feed", "ingest_seq", "seq", *FLAT)


# premium records are told from the feed's own shape row by row
@query("normalize_consulta_mixed", NORM_BASE + f"""
SELECT ingest_seq, {', '.join(f"CASE WHEN ingest_seq % 2 = 0 THEN {c} END AS {c}" if c in ("unidade_ufNome", "unidade_codigoIbge") else c for c in FLAT)}
FROM norm WHERE feed = 'consulta'""")
def q_normalize_consulta_mixed(spark, sf_dir):
    """Rows in the feed's shape and premium records (P07 as JSON) mixed."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "consulta").select("ingest_seq", "raw")
    p = R.normalize_premium(f.where(F.col("ingest_seq") % 2 == 1))
    premium = p.select("ingest_seq", F.to_json(F.struct(*[c for c in p.columns if c != "ingest_seq"])).alias("raw"))
    mixed = f.where(F.col("ingest_seq") % 2 == 0).unionByName(premium)
    return _flat(R.normalize_consulta(mixed)).select("ingest_seq", *FLAT)


def _flat_value(column, key):
    if column in ("cancelado", "temResultado"):
        return f"CAST({_j(key)} AS BOOLEAN)"
    if column == "valorGlobal":
        return f"TRY_CAST({_j(key)} AS DOUBLE)"
    if column == "urlPncp":
        return f"'https://pncp.gov.br' || {_j(key)}"
    if column == "fonteOrcamentaria":
        return f"array_to_string(json_extract_string(raw, '$.{key}[*]'), ',')"
    return _j(key)


@query("normalize_search_flat", with_ctes(NOTICES_SQL, FEEDS_SQL) + f"""
SELECT ingest_seq, {', '.join(f'{_flat_value(c, k)} AS "{c}"' for c, k in R.SEARCH_FLAT_FIELDS)}, 'widget' AS termo_busca
FROM feeds WHERE feed = 'search'""")
def q_normalize_search_flat(spark, sf_dir):
    """Search feed -> flat notice (41 fields) tagged with the term."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "search").select("ingest_seq", "raw")
    n = R.normalize_search_flat(f, term="widget")
    return n.withColumn("fonteOrcamentaria", F.coalesce(F.array_join("fonteOrcamentaria", ","), F.lit("")))


# ---------------------------------------------------------------- J01 / A08
def _first_ne(c, empty_is_blank=True):
    cond = f"coalesce({c}, '') <> ''" if empty_is_blank else f"{c} IS NOT NULL"
    return (f"coalesce(first({c} ORDER BY ref DESC, seq) FILTER (WHERE {cond}), "
            f"first({c} ORDER BY ref DESC, seq)) AS {c}")


MERGE_SQL = """
m AS (
  SELECT coalesce(numeroControlePNCP, '#' || CAST(seq AS VARCHAR)) AS g, *,
         coalesce(nullif(dataAtualizacaoGlobal, ''), nullif(dataPublicacaoPncp, ''),
                  nullif(dataEncerramentoProposta, ''), '') AS ref
  FROM norm
),
merged AS (
  SELECT """ + ",\n    ".join(
    [_first_ne(c, empty_is_blank=c not in R.MONEY) for c in FLAT if c != "_origem"]
    + [
       "CASE WHEN min(_origem) <> max(_origem) THEN 'ambos' ELSE first(_origem ORDER BY ref DESC, seq) END AS _origem",
       "min(seq) AS seq"]) + """
  FROM m GROUP BY g
)"""


def merged_feeds(spark, sf_dir):
    u = normalized_feeds(spark, sf_dir).withColumn("_ref", R.reference_date())
    m = J.merge_feeds(u.drop("feed", "ingest_seq"), "numeroControlePNCP", "_ref", "seq")
    return _flat(m.drop("_ref"))


@query("merge_feeds", NORM_BASE + "," + MERGE_SQL + f"\nSELECT {_FLAT_SQL}, seq FROM merged")
def q_merge_feeds(spark, sf_dir):
    """Two-feed merge with field fill; ties keep the earlier arrival."""
    return merged_feeds(spark, sf_dir).select(*FLAT, "seq")


@query("merge_summary", NORM_BASE + "," + MERGE_SQL + """
SELECT (SELECT count(*) FROM norm WHERE feed = 'search') AS total_search,
       (SELECT count(*) FROM norm WHERE feed = 'consulta') AS total_consulta,
       count(*) FILTER (WHERE coalesce(numeroControlePNCP, '') <> '') AS unicos_com_chave,
       count(*) FILTER (WHERE coalesce(numeroControlePNCP, '') = '') AS sem_chave,
       count(*) AS total_final,
       count(*) FILTER (WHERE coalesce(numeroControlePNCP, '') <> '' AND _origem = 'search') AS origem_search,
       count(*) FILTER (WHERE coalesce(numeroControlePNCP, '') <> '' AND _origem = 'consulta') AS origem_consulta,
       count(*) FILTER (WHERE coalesce(numeroControlePNCP, '') <> '' AND _origem = 'ambos') AS origem_ambos
FROM merged""")
def q_merge_summary(spark, sf_dir):
    """Feed totals, keyed/keyless, final and per-origin counts."""
    # the normalised feeds feed three branches (two totals and the merge):
    # materialise them once in the shared checkpoint folder
    u = normalized_feeds(spark, sf_dir).checkpoint()
    m = _flat(J.merge_feeds(u.withColumn("_ref", R.reference_date()).drop("feed", "ingest_seq"),
                            "numeroControlePNCP", "_ref", "seq").drop("_ref"))
    return A.merge_summary(u.where(F.col("_origem") == "search"), u.where(F.col("_origem") == "consulta"), m)


@query("feeds_intersect", NORM_BASE + """
SELECT numeroControlePNCP FROM norm WHERE feed = 'search' AND numeroControlePNCP IS NOT NULL
INTERSECT
SELECT numeroControlePNCP FROM norm WHERE feed = 'consulta' AND numeroControlePNCP IS NOT NULL""")
def q_feeds_intersect(spark, sf_dir):
    """Keys present in both feeds (they become 'ambos')."""
    return J.keys_of_both(normalized_feeds(spark, sf_dir), "numeroControlePNCP", F.col("_origem"))


# ---------------------------------------------------------------- P02/P03/P09/P10
@query("first_truthy", with_ctes(NOTICES_SQL) + """
SELECT ingest_seq,
  coalesce(CASE WHEN modalidadeId <> 0 THEN modalidadeId END, anoCompra) AS modalidade_or_ano,
  coalesce(nullif(modalidadeNome, ''), nullif(situacaoCompraNome, ''), '') AS modalidade_or_situacao,
  coalesce(nullif(numeroControlePNCP, ''), 'sem-chave') AS chave
FROM notices""")
def q_first_truthy(spark, sf_dir):
    """First truthy value per type (0 / '' / NULL fall through)."""
    n = notices(spark, sf_dir)
    return n.select(
        "ingest_seq",
        D.truthy_coalesce(n, ["modalidadeId", "anoCompra"]).alias("modalidade_or_ano"),
        D.truthy_coalesce(n, ["modalidadeNome", "situacaoCompraNome"], default="").alias("modalidade_or_situacao"),
        D.truthy_coalesce(n, ["numeroControlePNCP"], default="sem-chave").alias("chave"))


def _sql_safe(path, default="''"):
    v = f"json_extract_string(raw, '$.{path}')"
    return f"CASE WHEN {v} IS NULL OR lower(trim({v})) IN ('none', 'null', '') THEN {default} ELSE trim({v}) END"


@query("safe_path", with_ctes(NOTICES_SQL, FEEDS_SQL) + f"""
SELECT ingest_seq,
  {_sql_safe('unidadeOrgao.municipioNome')} AS municipio,
  {_sql_safe('orgaoEntidade.razaoSocial')} AS orgao,
  {_sql_safe('amparoLegal.nome', "'n/d'")} AS amparo
FROM feeds WHERE feed = 'consulta'""")
def q_safe_path(spark, sf_dir):
    """Nested getter with defaults for missing / 'none' / blank."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "consulta")
    return f.select("ingest_seq",
                    D.safe_path("raw", "unidadeOrgao", "municipioNome").alias("municipio"),
                    D.safe_path("raw", "orgaoEntidade", "razaoSocial").alias("orgao"),
                    D.safe_path("raw", "amparoLegal", "nome", default="n/d").alias("amparo"))


@query("safe_cast", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       TRY_CAST(event_type AS DOUBLE) AS bad, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS v
FROM events""")
def q_safe_cast(spark, sf_dir):
    """Text -> double, NULL on blank or unparseable."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", D.safe_double(F.get_json_object("props", "$.k")).alias("k"),
                    D.safe_double("event_type").alias("bad"), D.safe_double("value").alias("v"))


@query("object_text", with_ctes(NOTICES_SQL, FEEDS_SQL) + """
SELECT feed, ingest_seq,
  coalesce(nullif(json_extract_string(raw, '$.objetoCompra'), ''), nullif(json_extract_string(raw, '$.objeto_compra'), ''),
           nullif(json_extract_string(raw, '$.Objeto'), ''), nullif(json_extract_string(raw, '$.objeto'), ''), '') AS objeto
FROM feeds""")
def q_object_text(spark, sf_dir):
    """P10: object text fallback chain (search-feed rows have none -> '')."""
    f = feeds_raw(spark, sf_dir)
    return f.select("feed", "ingest_seq", R.object_text(f, raw="raw", column="objeto_compra").alias("objeto"))


# ---------------------------------------------------------------- P12/K07
@query("select_existing", NORM_BASE + """
SELECT numeroControlePNCP, objetoCompra, unidade_ufSigla FROM norm WHERE feed = 'search'""")
def q_select_existing(spark, sf_dir):
    """Keep the wanted columns that exist (others silently skipped)."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "search").select("raw")
    n = _flat(R.normalize_search(f))
    return R.select_existing(n, ["numeroControlePNCP", "objetoCompra", "nao_existe", "unidade_ufSigla"])


@query("flatten_struct", with_ctes(NOTICES_SQL, FEEDS_SQL) + """
SELECT ingest_seq, json_extract_string(raw, '$.numeroControlePNCP') AS "numeroControlePNCP",
       """ + ", ".join(f"""{_j(f[2])} AS "{f[0]}\"""" for f in R.COMMON_FIELDS if "." in f[0]) + """
FROM feeds WHERE feed = 'consulta'""")
def q_flatten_struct(spark, sf_dir):
    """Nested record -> dotted columns."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "consulta")
    x = f.select("ingest_seq", F.from_json("raw", R.CONSULTA_SCHEMA).alias("r")).select(
        "ingest_seq", "r.numeroControlePNCP", "r.orgaoEntidade", "r.unidadeOrgao")
    return R.flatten(x)


# ---------------------------------------------------------------- W02
@query("dedupe_fallback", with_ctes(NOTICES_SQL, FEEDS_SQL) + """,
k AS (
  SELECT feed, ingest_seq, seq,
    coalesce('numeroControlePNCP:' || nullif(json_extract_string(raw, '$.numeroControlePNCP'), ''),
             'numero_controle_pncp:' || nullif(json_extract_string(raw, '$.numero_controle_pncp'), ''),
             'sequencialCompra:' || nullif(json_extract_string(raw, '$.sequencialCompra'), ''),
             'hash:' || raw) AS k
  FROM feeds
)
SELECT feed, ingest_seq, seq, CASE WHEN k LIKE 'hash:%' THEN 'hash' ELSE k END AS chave FROM k
QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1""")
def q_dedupe_fallback(spark, sf_dir):
    """Dedupe by the first non-empty of several key fields (prefixed by
    its name), else by the canonical JSON of the record."""
    f = feeds_raw(spark, sf_dir)
    r = F.from_json("raw", "numeroControlePNCP string, numero_controle_pncp string, sequencialCompra string")
    x = f.select("feed", "ingest_seq", "seq", "raw", r.alias("r")).select(
        "feed", "ingest_seq", "seq", "raw", "r.*")
    d = W.dedupe_fallback(x, ["numeroControlePNCP", "numero_controle_pncp", "sequencialCompra"], "seq",
                          keep=["feed", "ingest_seq", "seq"])
    k = F.col("_dedupe_key")
    return d.select("feed", "ingest_seq", "seq",
                    F.when(k.startswith("hash:"), F.lit("hash")).otherwise(k).alias("chave"))


# ---------------------------------------------------------------- P13-P15, J05
@query("explode_attachments", with_ctes(NOTICES_SQL, ITEMS_SQL, DOCS_SQL) + """,
a AS (
  SELECT pncp_id, ingest_seq,
         coalesce(CASE WHEN json_type(raw, '$.Arquivos') = 'ARRAY' THEN json_extract(raw, '$.Arquivos') END,
                  CASE WHEN json_type(raw, '$.arquivos') = 'ARRAY' THEN json_extract(raw, '$.arquivos') END) AS arr
  FROM docs
),
e AS (
  SELECT pncp_id, ingest_seq, unnest(range(CAST(json_array_length(arr) AS BIGINT))) AS i, arr FROM a WHERE arr IS NOT NULL
)
SELECT pncp_id, ingest_seq, i + 1 AS posicao,
  coalesce(nullif(json_extract_string(arr, '$[' || i || '].titulo'), ''), nullif(json_extract_string(arr, '$[' || i || '].nome'), '')) AS titulo,
  coalesce(nullif(json_extract_string(arr, '$[' || i || '].tipo'), ''), nullif(json_extract_string(arr, '$[' || i || '].tipoDocumentoNome'), ''),
           nullif(json_extract_string(arr, '$[' || i || '].tipoDocumentoDescricao'), '')) AS tipo,
  coalesce(nullif(json_extract_string(arr, '$[' || i || '].data'), ''), nullif(json_extract_string(arr, '$[' || i || '].dataPublicacaoPncp'), '')) AS data,
  coalesce(nullif(json_extract_string(arr, '$[' || i || '].link'), ''), nullif(json_extract_string(arr, '$[' || i || '].url'), ''),
           nullif(json_extract_string(arr, '$[' || i || '].uri'), '')) AS link
FROM e""")
def q_explode_attachments(spark, sf_dir):
    """Attachments array (either spelling) -> one row each."""
    return _explode_with_seq(notice_docs(spark, sf_dir))


def _explode_with_seq(d):
    x = R.explode_attachments(d.select(F.struct("pncp_id", "ingest_seq").alias("k"), "raw"), "raw", key="k")
    return x.select("k.pncp_id", "k.ingest_seq", "posicao", "titulo", "tipo", "data", "link")


# ---------------------------------------------------------------- P14/P15/J05/P11/P08
def _arr_sql(key):
    return f"CASE WHEN json_type(raw, '$.{key}') = 'ARRAY' THEN json_extract(raw, '$.{key}') END"


_ATT_SQL = f""",
a AS (SELECT pncp_id, ingest_seq, coalesce({_arr_sql('Arquivos')}, {_arr_sql('arquivos')}) AS arr FROM docs),
e AS (SELECT pncp_id, ingest_seq, unnest(range(CAST(json_array_length(arr) AS BIGINT))) AS i, arr FROM a WHERE arr IS NOT NULL),
f AS (SELECT pncp_id, ingest_seq, i,
  json_extract_string(arr, '$[' || i || '].sequencialDocumento') AS sd,
  json_extract_string(arr, '$[' || i || '].titulo') AS titulo,
  json_extract_string(arr, '$[' || i || '].tipoDocumentoNome') AS tnome,
  json_extract_string(arr, '$[' || i || '].tipoDocumentoDescricao') AS tdesc,
  json_extract_string(arr, '$[' || i || '].tipo') AS tipo,
  json_extract_string(arr, '$[' || i || '].dataPublicacaoPncp') AS dpub,
  json_extract_string(arr, '$[' || i || '].data') AS data,
  json_extract_string(arr, '$[' || i || '].url') AS url,
  json_extract_string(arr, '$[' || i || '].uri') AS uri,
  json_extract_string(arr, '$[' || i || '].link') AS link FROM e)"""


@query("attachment_listing", with_ctes(NOTICES_SQL, ITEMS_SQL, DOCS_SQL) + _ATT_SQL + """
SELECT pncp_id, ingest_seq, CASE WHEN coalesce(sd, '') NOT IN ('', '0') THEN sd ELSE CAST(i + 1 AS VARCHAR) END AS seq,
  substr(coalesce(nullif(titulo, ''), '—'), 1, 39) AS titulo,
  CASE WHEN coalesce(nullif(dpub, ''), nullif(data, '')) IS NULL THEN '—'
       ELSE strftime(strptime(coalesce(nullif(dpub, ''), nullif(data, '')), '%Y-%m-%dT%H:%M:%S'), '%d/%m/%Y - %H:%M:%S') END AS data,
  substr(coalesce(nullif(tnome, ''), nullif(tdesc, ''), nullif(tipo, ''), '—'), 1, 27) AS tipo,
  coalesce(nullif(url, ''), nullif(uri, ''), nullif(link, ''), '') AS link
FROM f""")
def q_attachment_listing(spark, sf_dir):
    """Attachment listing rows (sequence, title <= 39, date, type <= 27, link)."""
    d = notice_docs(spark, sf_dir)
    arr = F.coalesce(F.from_json(F.get_json_object("raw", "$.Arquivos"), R.ATTACHMENT_SCHEMA),
                     F.from_json(F.get_json_object("raw", "$.arquivos"), R.ATTACHMENT_SCHEMA))
    x = d.select(F.struct("pncp_id", "ingest_seq").alias("k"), F.posexplode(arr).alias("pos", "a"))
    x = x.withColumn("pos", F.col("pos") + 1)
    out = R.attachment_listing(x, key="k")
    return out.select("k.pncp_id", "k.ingest_seq", "seq", "titulo", "data", "tipo", "link")


@query("explode_items", with_ctes(NOTICES_SQL, ITEMS_SQL, DOCS_SQL) + """,
a AS (SELECT pncp_id, ingest_seq, json_extract(raw, '$.Itens') AS arr FROM docs WHERE json_type(raw, '$.Itens') = 'ARRAY'),
e AS (SELECT pncp_id, ingest_seq, unnest(range(CAST(json_array_length(arr) AS BIGINT))) AS i, arr FROM a)
SELECT pncp_id, ingest_seq,
  coalesce(json_extract_string(arr, '$[' || i || '].sequencialItem'), CAST(i + 1 AS VARCHAR)) AS seq,
  coalesce(nullif(json_extract_string(arr, '$[' || i || '].descricao'), ''), '—') AS descricao,
  coalesce(nullif(json_extract_string(arr, '$[' || i || '].quantidade'), ''), '—') AS quantidade,
  coalesce(nullif(json_extract_string(arr, '$[' || i || '].unidade'), ''), '—') AS unidade,
  'R$ ' || translate(format('{:,.2f}', CAST(json_extract_string(arr, '$[' || i || '].valorUnitario') AS DOUBLE)), ',.', '.,') AS valor_unitario,
  'R$ ' || translate(format('{:,.2f}', CAST(json_extract_string(arr, '$[' || i || '].valorTotal') AS DOUBLE)), ',.', '.,') AS valor_total
FROM e""")
def q_explode_items(spark, sf_dir):
    """Own item arrays -> display rows with BRL money."""
    d = notice_docs(spark, sf_dir)
    x = R.explode_items(d.select(F.struct("pncp_id", "ingest_seq").alias("k"), "raw"), "raw", key="k")
    return x.select("k.pncp_id", "k.ingest_seq", "seq", "descricao", "quantidade", "unidade",
                    "valor_unitario", "valor_total")


@query("enrich_left", with_ctes(NOTICES_SQL) + """,
l AS (SELECT l_orderkey, count(*) AS n, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS seqs
      FROM lineitem GROUP BY l_orderkey),
j AS (SELECT numeroControlePNCP AS pncp_id, ingest_seq, ingest_seq % 4 = 0 AND l.n IS NOT NULL AS own, l.n, l.seqs
      FROM notices LEFT JOIN l ON l.l_orderkey = ingest_seq AND (ingest_seq % 4 = 0 OR numeroControlePNCP IS NOT NULL))
SELECT pncp_id, ingest_seq, coalesce(n, 0) AS n_itens, coalesce(seqs, '') AS itens,
       CASE WHEN own THEN 'proprio' WHEN n IS NOT NULL THEN 'consulta' ELSE 'vazio' END AS origem FROM j""")
def q_enrich_left(spark, sf_dir):
    """Own items win, else looked up by the parsed key, else empty."""
    d = notice_docs(spark, sf_dir)
    own = F.from_json(F.get_json_object("raw", "$.Itens"), "array<struct<sequencialItem:int>>")
    x = d.select("pncp_id", "ingest_seq", own.alias("itens"),
                 D.parse_control("pncp_id").seq.cast("bigint").alias("seqk"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").cast("int").alias("sequencialItem")))).alias("lookup"))
    e = J.enrich(x.withColumn("_own_n", F.size("itens")), lines, "itens", "seqk", "l_orderkey", "lookup")
    return e.select("pncp_id", "ingest_seq", F.size("itens").cast("bigint").alias("n_itens"),
                    F.array_join(F.transform("itens", lambda i: i["sequencialItem"].cast("string")), ",").alias("itens"),
                    F.when(F.col("_own_n") > 0, "proprio").when(F.size("itens") > 0, "consulta")
                     .otherwise("vazio").alias("origem"))


def _safe_sql(path):
    v = f"json_extract_string(dados_json, '$.{path}')"
    return f"CASE WHEN {v} IS NULL OR lower(trim({v})) IN ('none', 'null', '') THEN '' ELSE trim({v}) END"


FILTERED_SQL = """filt AS (SELECT pncp_id, CAST(NULL AS VARCHAR) AS orgao_nome,
  json_extract_string(raw, '$.unidadeOrgao.ufSigla') AS uf_sigla,
  upper(json_extract_string(raw, '$.objetoCompra')) AS objeto_compra, raw AS dados_json,
  CASE WHEN ingest_seq % 2 = 0 THEN 'controle_acesso' ELSE '' END AS categoria, 'regra' AS motivo FROM docs)"""


def filtered_table(spark, sf_dir):
    """The filtered (classified) table shape: table columns + JSON."""
    d = notice_docs(spark, sf_dir)
    return d.select("pncp_id", F.lit(None).cast("string").alias("orgao_nome"),
                    F.get_json_object("raw", "$.unidadeOrgao.ufSigla").alias("uf_sigla"),
                    F.upper(F.get_json_object("raw", "$.objetoCompra")).alias("objeto_compra"),
                    F.col("raw").alias("dados_json"),
                    F.when(F.col("ingest_seq") % 2 == 0, "controle_acesso").otherwise("").alias("categoria"),
                    F.lit("regra").alias("motivo"))


@query("report_rows", with_ctes(NOTICES_SQL, ITEMS_SQL, DOCS_SQL, FILTERED_SQL) + f"""
SELECT coalesce(nullif(pncp_id, ''), nullif({_safe_sql('numeroControlePNCP')}, '')) AS pncp_id,
  coalesce(nullif({_safe_sql('numeroControlePNCP')}, ''), nullif(pncp_id, ''), '') AS numero_controle,
  {_safe_sql('anoCompra')} AS ano_compra, {_safe_sql('processo')} AS processo,
  coalesce(nullif({_safe_sql('orgaoEntidade.razaoSocial')}, ''), nullif(orgao_nome, ''), nullif({_safe_sql('unidadeOrgao.nomeUnidade')}, ''), '') AS orgao_nome,
  {_safe_sql('orgaoEntidade.cnpj')} AS cnpj,
  coalesce(nullif(uf_sigla, ''), nullif({_safe_sql('unidadeOrgao.ufSigla')}, ''), '') AS uf_sigla,
  {_safe_sql('unidadeOrgao.municipioNome')} AS municipio, {_safe_sql('unidadeOrgao.ufNome')} AS uf_nome,
  coalesce(nullif(objeto_compra, ''), nullif({_safe_sql('objetoCompra')}, ''), '') AS objeto_compra,
  {_safe_sql('modalidadeNome')} AS modalidade, {_safe_sql('valorTotalEstimado')} AS valor_estimado,
  {_safe_sql('dataEncerramentoProposta')} AS data_encerramento, {_safe_sql('amparoLegal.nome')} AS amparo_legal,
  CASE WHEN regexp_matches(coalesce(nullif({_safe_sql('numeroControlePNCP')}, ''), pncp_id), '^(\\d+)-1-(\\d+)/(\\d+)')
       THEN 'https://pncp.gov.br/editais/' || regexp_extract(coalesce(nullif({_safe_sql('numeroControlePNCP')}, ''), pncp_id), '^(\\d+)-1-(\\d+)/(\\d+)', 1)
            || '/' || regexp_extract(coalesce(nullif({_safe_sql('numeroControlePNCP')}, ''), pncp_id), '^(\\d+)-1-(\\d+)/(\\d+)', 3) || '/'
            || CAST(CAST(regexp_extract(coalesce(nullif({_safe_sql('numeroControlePNCP')}, ''), pncp_id), '^(\\d+)-1-(\\d+)/(\\d+)', 2) AS BIGINT) AS VARCHAR) END AS link_pncp,
  coalesce(nullif(categoria, ''), '') AS categoria,
  CAST(CASE WHEN json_type(dados_json, '$.Arquivos') = 'ARRAY' THEN json_array_length(dados_json, '$.Arquivos') ELSE 0 END AS BIGINT) AS n_arquivos,
  CAST(CASE WHEN json_type(dados_json, '$.Itens') = 'ARRAY' THEN json_array_length(dados_json, '$.Itens') ELSE 0 END AS BIGINT) AS n_itens,
  'R$ ' || translate(format('{{:,.2f}}', CAST({_safe_sql('valorTotalEstimado')} AS DOUBLE)), ',.', '.,') AS valor_estimado_fmt,
  strftime(strptime({_safe_sql('dataEncerramentoProposta')}, '%Y-%m-%dT%H:%M:%S'), '%d/%m/%Y %H:%M') AS data_encerramento_fmt,
  regexp_replace({_safe_sql('orgaoEntidade.cnpj')}, '^(\\d{{2}})(\\d{{3}})(\\d{{3}})(\\d{{4}})(\\d{{2}})$', '\\1.\\2.\\3/\\4-\\5') AS cnpj_fmt
FROM filt""")
def q_report_rows(spark, sf_dir):
    """Report-ready rows (JSON first; table column first for id, UF and object)."""
    r = R.report_rows(filtered_table(spark, sf_dir), "dados_json")
    return r.select("pncp_id", "numero_controle", "ano_compra", "processo", "orgao_nome", "cnpj", "uf_sigla",
                    "municipio", "uf_nome", "objeto_compra", "modalidade", "valor_estimado", "data_encerramento",
                    "amparo_legal", "link_pncp", "categoria", "n_arquivos", "n_itens", "valor_estimado_fmt",
                    "data_encerramento_fmt", "cnpj_fmt")


_PRUNED = [(c, p, k) for c, p, k in R.PREMIUM_FIELDS if k not in ("category", "keywords")]


@query("pruned_json", with_ctes(NOTICES_SQL, FEEDS_SQL) + f"""
SELECT ingest_seq, """ + ", ".join(
    (f"nullif(array_to_string(json_extract_string(raw, '$.{p}[*]'), ','), '')" if p == "fontesOrcamentarias" else
     f"CAST(TRY_CAST({_j(p)} AS DOUBLE) AS DOUBLE)" if k == "double" else f"nullif({_j(p)}, '')")
    + f' AS "{c.replace(".", "_")}"' for c, p, k in _PRUNED) + """,
  false AS tem_vazio
FROM feeds WHERE feed = 'consulta'""")
def q_pruned_json(spark, sf_dir):
    """Premium record emitted as JSON with empty fields removed (NULL, '',
    [], {} -- recursively): every field read back, and no empty value left."""
    f = consulta_raw(spark, sf_dir)
    p = R.normalize_premium(f)
    cols = [c for c in p.columns if c != "ingest_seq"]
    j = R.to_pruned_json(p, cols, "json", keep=["ingest_seq"])
    back = j.select("ingest_seq", "json", F.from_json("json", R.paths_schema([c for c, _, _ in _PRUNED])).alias("r"))

    def value(c, k):
        col = F.col(f"r.{c}")
        return (F.array_join(col, ",") if c == "fontes_orcamentarias" else col.cast("double") if k == "double" else col).alias(c.replace(".", "_"))

    return back.select("ingest_seq", *[value(c, k) for c, _, k in _PRUNED],
                       F.col("json").rlike(r':(""|\[\]|\{\}|null)[,}]').alias("tem_vazio"))
