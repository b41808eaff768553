"""Notice jobs over the two derived feeds (bronze JSON) and silver notices."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import display as D
from ..operators import dedupe as W
from ..operators import filters as FL
from ..operators import merge as J
from ..operators import records as R
from ..operators import summary as A
from . import query
from .adapters import FEEDS_SQL, NOTICES_SQL, feeds_raw, notices, with_ctes

# --------------------------------------------------------------------------
# Feed projection shared by the merge jobs: every field is the first truthy
# of its names in the two feeds (P02 over P01).
FEED_FIELDS = {
    "numeroControlePNCP": ["numeroControlePNCP", "numero_controle_pncp"],
    "objetoCompra": ["objetoCompra", "description"],
    "dataAtualizacao": ["dataAtualizacaoGlobal", "dataAtualizacaoPncp", "dataAtualizacao",
                        "data_atualizacao_pncp"],
    "dataEncerramentoProposta": ["dataEncerramentoProposta", "data_fim_vigencia"],
    "dataPublicacaoPncp": ["dataPublicacaoPncp", "data_publicacao_pncp"],
    "uf": ["unidadeOrgao.ufSigla", "uf"],
}
_FEED_SCHEMA = T.StructType([
    *[T.StructField(n, T.StringType()) for n in sorted({p for ps in FEED_FIELDS.values()
                                                         for p in ps if "." not in p})],
    T.StructField("unidadeOrgao", T.StructType([T.StructField("ufSigla", T.StringType())])),
])


def projected_feeds(spark, sf_dir):
    f = feeds_raw(spark, sf_dir)
    x = f.select("feed", "ingest_seq", "seq", F.from_json("raw", _FEED_SCHEMA).alias("r"))
    cols = [D.first_truthy(*[F.col("r." + p) for p in ps]).alias(n) for n, ps in FEED_FIELDS.items()]
    return x.select("feed", "ingest_seq", "seq", *cols)


def _sql_truthy(paths):
    parts = [f"nullif(json_extract_string(raw, '$.{p}'), '')" for p in paths]
    return f"coalesce({', '.join(parts)})"


PROJ_SQL = "proj AS (\n  SELECT feed, ingest_seq, seq,\n" + ",\n".join(
    f"    {_sql_truthy(ps)} AS {n}" for n, ps in FEED_FIELDS.items()) + "\n  FROM feeds\n)"

BASE = with_ctes(NOTICES_SQL, FEEDS_SQL, PROJ_SQL)
LATEST_SQL = """latest AS (
  SELECT * FROM proj
  QUALIFY row_number() OVER (PARTITION BY coalesce(numeroControlePNCP, '#' || CAST(seq AS VARCHAR))
                             ORDER BY coalesce(dataAtualizacao, '') DESC, seq ASC) = 1
)"""

OUT = ["numeroControlePNCP", "objetoCompra", "dataAtualizacao", "dataEncerramentoProposta",
       "dataPublicacaoPncp", "uf", "feed", "ingest_seq"]
OUT_SQL = ", ".join(OUT)

FLAGSHIP_ANY = ["widget", "gear"]
FLAGSHIP_OPEN_ON = "19980101"


# --------------------------------------------------------------------------
def open_notices(spark, sf_dir, any_=FLAGSHIP_ANY, all_=(), open_on=FLAGSHIP_OPEN_ON):
    """Flagship: open notices matching my terms, newest feed version.

    bronze JSON of both feeds -> P01/P02 projection -> J02 latest-wins merge
    -> F03 still open on ``open_on`` -> F01 keyword filter -> O01 sort.
    """
    p = projected_feeds(spark, sf_dir)
    m = J.merge_latest(p, "numeroControlePNCP", "dataAtualizacao", "seq")
    m = FL.select_notices(m, mode="proposta", fim=open_on)
    m = FL.filter_keywords(m, "objetoCompra", any_=list(any_), all_=list(all_))
    return A.sort_closing(m).select(*OUT)


query("open_notices", BASE + "," + LATEST_SQL + f"""
SELECT {OUT_SQL} FROM latest
WHERE replace(substr(dataEncerramentoProposta, 1, 10), '-', '') >= '{FLAGSHIP_OPEN_ON}'
  AND (contains(lower(objetoCompra), 'widget') OR contains(lower(objetoCompra), 'gear'))
""")(open_notices)


@query("merge_latest", BASE + "," + LATEST_SQL + f"\nSELECT {OUT_SQL} FROM latest")
def q_merge_latest(spark, sf_dir):
    """J02 over both feeds."""
    p = projected_feeds(spark, sf_dir)
    return J.merge_latest(p, "numeroControlePNCP", "dataAtualizacao", "seq").select(*OUT)


@query("json_project", with_ctes(NOTICES_SQL, FEEDS_SQL) + """
SELECT ingest_seq,
       json_extract_string(raw, '$.numeroControlePNCP') AS pncp_id,
       json_extract_string(raw, '$.orgaoEntidade.razaoSocial') AS orgao_nome,
       json_extract_string(raw, '$.orgaoEntidade.razaosocial') AS orgao_nome_lower,
       json_extract_string(raw, '$.unidadeOrgao.ufSigla') AS uf_sigla,
       json_extract_string(raw, '$.objetoCompra') AS objeto_compra,
       json_extract_string(raw, '$.valorTotalEstimado') AS valor_txt
FROM feeds WHERE feed = 'consulta'""")
def q_json_project(spark, sf_dir):
    """Generated columns of the bronze table (nested paths, missing ->
    NULL; paths are case-sensitive, so the lower-case spelling is NULL)."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "consulta")
    return R.json_fields(f, "raw", {
        "pncp_id": "$.numeroControlePNCP",
        "orgao_nome": "$.orgaoEntidade.razaoSocial",
        "orgao_nome_lower": "$.orgaoEntidade.razaosocial",
        "uf_sigla": "$.unidadeOrgao.ufSigla",
        "objeto_compra": "$.objetoCompra",
        "valor_txt": "$.valorTotalEstimado",
    }, keep=["ingest_seq"])


@query("dedupe_first", BASE + """
SELECT feed, ingest_seq, seq, numeroControlePNCP FROM proj
QUALIFY row_number() OVER (PARTITION BY coalesce(numeroControlePNCP, '#' || CAST(seq AS VARCHAR))
                           ORDER BY seq) = 1""")
def q_dedupe_first(spark, sf_dir):
    """Keep the first arrival per control number; keyless rows kept."""
    p = projected_feeds(spark, sf_dir).select("feed", "ingest_seq", "seq", "numeroControlePNCP")
    return W.dedupe_first(p, "numeroControlePNCP", "seq")


@query("dedupe_counts", BASE + """,
d AS (SELECT * FROM proj QUALIFY row_number() OVER (
        PARTITION BY coalesce(numeroControlePNCP, '#' || CAST(seq AS VARCHAR)) ORDER BY seq) = 1)
SELECT (SELECT count(*) FROM proj) AS antes,
       (SELECT count(*) FROM proj) - (SELECT count(*) FROM d) AS removidos,
       (SELECT count(*) FROM d) AS depois""")
def q_dedupe_counts(spark, sf_dir):
    """W01 counters: before / removed / after."""
    p = projected_feeds(spark, sf_dir)
    return W.dedupe_counts(p, W.dedupe_first(p, "numeroControlePNCP", "seq"))


@query("sort_closing", with_ctes(NOTICES_SQL) + """
SELECT ingest_seq, numeroControlePNCP, dataEncerramentoProposta, dataPublicacaoPncp FROM notices
ORDER BY coalesce(dataEncerramentoProposta, ''), coalesce(dataPublicacaoPncp, ''),
         coalesce(numeroControlePNCP, '')""")
def q_sort_closing(spark, sf_dir):
    """Closing, publication, key -- NULL as ''."""
    n = notices(spark, sf_dir).select("ingest_seq", "numeroControlePNCP", "dataEncerramentoProposta",
                                      "dataPublicacaoPncp")
    return A.sort_closing(n)
