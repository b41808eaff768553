"""Driver tables -> procurement-notice views.

The engine's operators work on notices (one row per procurement notice, kept
raw as JSON in bronze, projected into columns in silver).  The driver ships
TPC-H-like tables, so this module derives notices from them, in Spark and --
with the same rules -- as DuckDB SQL for the oracle.

Silver notice columns (flat): see ``NOTICE_COLUMNS``.  Two feeds are derived
from the same orders: the "consulta" feed (camelCase JSON with nested
structs, ``o_orderkey % 3 <> 0``) and the "search" feed (flat snake_case
JSON, ``o_orderkey % 3 <> 1``); keys ``% 3 = 2`` appear in both feeds, with
their own update dates.  Every order becomes a notice; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import table

ISO = "yyyy-MM-dd'T'HH:mm:ss"

NOTICE_COLUMNS = [
    "ingest_seq", "numeroControlePNCP", "anoCompra", "sequencialCompra", "objetoCompra",
    "modalidadeId", "modalidadeNome", "situacaoCompraNome", "valorTotalEstimado",
    "dataPublicacaoPncp", "dataAberturaProposta", "dataEncerramentoProposta",
    "dataAtualizacaoGlobal", "dataAtualizacaoSearch", "orgao_cnpj", "orgao_razao",
    "uf_sigla", "municipio_nome", "in_consulta", "in_search",
]


def _iso_plus_days(ts: Column, days: Column | int) -> Column:
    d = days if isinstance(days, Column) else F.lit(days)
    return F.date_format(F.timestamp_add("DAY", d, ts), ISO)


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver notices derived from orders/customer/nation/part.

    nation is a fixed 25-row dimension (TPC-H), so broadcasting it has a
    proven size bound.  customer and part are left to the planner: AQE
    broadcasts them only when the measured size is under the threshold and
    otherwise runs a sort-merge join.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    p_all = table(spark, sf_dir, "part")
    n_part = p_all.count()  # scalar from parquet footers, not data
    p = p_all.select("p_partkey", "p_name")

    cn = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    j = (o.join(cn, o.o_custkey == cn.c_custkey, "left")
          .join(p, p.p_partkey == (o.o_orderkey % F.lit(n_part)), "left"))

    k = F.col("o_orderkey")
    cnpj = F.format_string("%014d", F.col("o_custkey"))
    key = F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(cnpj, F.lit("-1-"), F.format_string("%06d", k), F.lit("/"),
                 F.year("o_orderdate").cast("string")))
    prio = F.col("o_orderpriority")
    return j.select(
        k.alias("ingest_seq"),
        key.alias("numeroControlePNCP"),
        F.year("o_orderdate").cast("int").alias("anoCompra"),
        k.alias("sequencialCompra"),
        F.concat(F.col("p_name"), F.lit(" "), prio).alias("objetoCompra"),
        F.when(k % 53 == 0, F.lit(None).cast("int"))
         .otherwise(F.substring(prio, 1, 1).cast("int")).alias("modalidadeId"),
        F.when(k % 59 == 0, F.lit(None).cast("string")).otherwise(prio).alias("modalidadeNome"),
        F.col("o_orderstatus").alias("situacaoCompraNome"),
        F.col("o_totalprice").alias("valorTotalEstimado"),
        F.date_format("o_orderdate", ISO).alias("dataPublicacaoPncp"),
        _iso_plus_days(F.col("o_orderdate"), 7).alias("dataAberturaProposta"),
        _iso_plus_days(F.col("o_orderdate"), 30).alias("dataEncerramentoProposta"),
        _iso_plus_days(F.col("o_orderdate"), (k % 5).cast("int")).alias("dataAtualizacaoGlobal"),
        _iso_plus_days(F.col("o_orderdate"), (k % 7).cast("int")).alias("dataAtualizacaoSearch"),
        cnpj.alias("orgao_cnpj"),
        F.col("c_name").alias("orgao_razao"),
        F.col("n_name").alias("uf_sigla"),
        F.col("c_mktsegment").alias("municipio_nome"),
        (k % 3 != 0).alias("in_consulta"),
        (k % 3 != 1).alias("in_search"),
    )


def consulta_struct(n: DataFrame) -> Column:
    """The consulta-feed record (camelCase, nested) of a silver notice row."""
    return F.struct(
        F.col("numeroControlePNCP"), F.col("objetoCompra"), F.col("anoCompra"),
        F.col("sequencialCompra"),
        F.concat(F.lit("PROC-"), F.col("sequencialCompra").cast("string")).alias("processo"),
        F.col("modalidadeId"), F.col("modalidadeNome"),
        F.col("situacaoCompraNome"), F.col("valorTotalEstimado"),
        F.col("dataPublicacaoPncp"), F.col("dataAberturaProposta"),
        F.col("dataEncerramentoProposta"), F.col("dataAtualizacaoGlobal"),
        F.struct(F.col("orgao_cnpj").alias("cnpj"), F.col("orgao_razao").alias("razaoSocial"),
                 _code(3).alias("poderId"), _code(4).alias("esferaId")).alias("orgaoEntidade"),
        F.struct(F.col("uf_sigla").alias("ufSigla"), F.col("municipio_nome").alias("municipioNome"),
                 F.concat(F.lit("Estado "), F.col("uf_sigla")).alias("ufNome"), _tag("U").alias("codigoUnidade"),
                 F.concat(F.lit("Unidade "), F.col("orgao_razao")).alias("nomeUnidade"), _tag("IBGE").alias("codigoIbge")).alias("unidadeOrgao"),
        F.concat(F.col("sequencialCompra").cast("string"), F.lit("/"), F.col("anoCompra").cast("string")).alias("numeroCompra"),
        (F.col("sequencialCompra") % 4).cast("int").alias("tipoInstrumentoConvocatorioCodigo"),
        F.when(F.col("sequencialCompra") % 11 != 0, F.lit("Edital")).alias("tipoInstrumentoConvocatorioNome"),
        (F.col("sequencialCompra") % 5).cast("int").alias("situacaoCompraId"),
        F.when(F.col("sequencialCompra") % 3 == 1, F.round(F.col("valorTotalEstimado"), 0)).alias("valorTotalHomologado"),
        (F.col("sequencialCompra") % 6).cast("int").alias("modoDisputaId"),
        F.when(F.col("sequencialCompra") % 6 != 0, F.lit("Aberto")).alias("modoDisputaNome"),
        F.when(F.col("sequencialCompra") % 5 != 0, _tag("https://portal.example/")).alias("linkSistemaOrigem"),
        F.when(F.col("sequencialCompra") % 8 == 0, _tag("https://processo.example/")).alias("linkProcessoEletronico"),
        F.when(F.col("sequencialCompra") % 7 == 0, F.array().cast("array<string>"))
         .otherwise(F.array(F.lit("Federal"), _tag("Fonte "))).alias("fontesOrcamentarias"),
        F.when(F.col("sequencialCompra") % 9 != 0, _tag("usuario ")).alias("usuarioNome"),
        F.struct((F.col("sequencialCompra") % 10).alias("codigo"), F.lit("Lei 14.133").alias("nome"), F.lit("").alias("descricao")).alias("amparoLegal"),
        F.when(F.col("sequencialCompra") % 2 == 0, F.lit("com anexos")).otherwise("").alias("informacaoComplementar"),
        (F.col("sequencialCompra") % 2 == 1).alias("srp"),
        F.col("dataPublicacaoPncp").alias("dataInclusao"), F.col("dataAtualizacaoGlobal").alias("dataAtualizacao"),
    )


def _tag(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("sequencialCompra").cast("string"))


def _code(n: int) -> Column:
    """A letter by order number, or NULL."""
    return F.when(F.col("sequencialCompra") % n != 0, F.substring(F.lit("FEMD"), (F.col("sequencialCompra") % n).cast("int"), F.lit(1)))


def search_struct(n: DataFrame) -> Column:
    """The search-feed record (flat snake_case) of a silver notice row."""
    return F.struct(
        F.col("numeroControlePNCP").alias("numero_controle_pncp"),
        F.col("objetoCompra").alias("description"),
        F.concat(F.lit("Edital "), F.col("sequencialCompra").cast("string"), F.lit("/"),
                 F.col("anoCompra").cast("string")).alias("title"),
        F.col("anoCompra").alias("ano"), F.col("sequencialCompra").alias("numero_sequencial"),
        F.col("orgao_cnpj"), F.col("orgao_razao").alias("orgao_nome"),
        F.col("uf_sigla").alias("uf"), F.col("municipio_nome"),
        F.col("modalidadeId").alias("modalidade_licitacao_id"),
        F.col("modalidadeNome").alias("modalidade_licitacao_nome"),
        F.col("situacaoCompraNome").alias("situacao_nome"),
        F.col("dataPublicacaoPncp").alias("data_publicacao_pncp"),
        F.col("dataAtualizacaoSearch").alias("data_atualizacao_pncp"),
        F.col("dataEncerramentoProposta").alias("data_fim_vigencia"),
        F.col("valorTotalEstimado").alias("valor_global"),
        F.concat(F.lit("/editais/"), F.col("orgao_cnpj"), F.lit("/"), F.col("anoCompra").cast("string"),
                 F.lit("/"), F.col("sequencialCompra").cast("string")).alias("item_url"),
        F.lit("edital").alias("document_type"),
        (F.col("situacaoCompraNome") == "F").alias("tem_resultado"),
        F.lit(False).alias("cancelado"),
        F.concat(F.lit("id-"), F.col("sequencialCompra").cast("string")).alias("id"),
        F.concat(F.lit("n"), F.col("sequencialCompra").cast("string")).alias("numero"),
        (F.col("sequencialCompra") % 4).cast("int").alias("tipo_id"), F.lit("Aviso").alias("tipo_nome"),
        (F.col("sequencialCompra") % 5).cast("int").alias("situacao_id"),
        _tag("o").alias("orgao_id"), _tag("i").alias("unidade_id"), _tag("c").alias("unidade_codigo"),
        F.concat(F.lit("Setor "), F.col("orgao_razao")).alias("unidade_nome"),
        _code(3).alias("esfera_id"), F.lit("Municipal").alias("esfera_nome"), _code(4).alias("poder_id"), F.lit("Executivo").alias("poder_nome"),
        _tag("m").alias("municipio_id"), F.col("dataAberturaProposta").alias("data_inicio_vigencia"),
        F.col("dataPublicacaoPncp").alias("data_assinatura"),
        F.when(F.col("sequencialCompra") % 3 == 2, F.array(_tag("Recurso "))).alias("fonte_orcamentaria"),
        (F.col("sequencialCompra") % 3).cast("int").alias("fonte_orcamentaria_id"), F.lit("Recurso").alias("fonte_orcamentaria_nome"),
        F.col("dataPublicacaoPncp").alias("createdAt"),
    )


def feeds_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of both feeds from ONE pass over the silver notices:
    ``feed, ingest_seq, seq, raw``.  ``seq`` is the arrival order (search
    version of an order arrives before its consulta version)."""
    n = notices(spark, sf_dir)
    # the texts are made in a projection, which is compiled; a generator's argument is interpreted
    made = n.select("ingest_seq", "in_search", "in_consulta",
                    F.when(F.col("in_search"), F.to_json(search_struct(n))).alias("_search"),
                    F.when(F.col("in_consulta"), F.to_json(consulta_struct(n))).alias("_consulta"))
    recs = F.array(
        F.when(F.col("in_search"), F.struct(F.lit("search").alias("feed"),
                                            (F.col("ingest_seq") * 2).alias("seq"),
                                            F.col("_search").alias("raw"))),
        F.when(F.col("in_consulta"), F.struct(F.lit("consulta").alias("feed"),
                                              (F.col("ingest_seq") * 2 + 1).alias("seq"),
                                              F.col("_consulta").alias("raw"))),
    )
    return (made.select("ingest_seq", F.explode(recs).alias("r")).where(F.col("r").isNotNull())
             .select(F.col("r.feed").alias("feed"), "ingest_seq", F.col("r.seq").alias("seq"),
                     F.col("r.raw").alias("raw")))


def consulta_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of the consulta feed: ``ingest_seq, raw`` (JSON text)."""
    n = notices(spark, sf_dir)
    return n.where("in_consulta").select("ingest_seq", F.to_json(consulta_struct(n)).alias("raw"))


def search_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of the search feed: ``ingest_seq, raw`` (JSON text)."""
    n = notices(spark, sf_dir)
    return n.where("in_search").select("ingest_seq", F.to_json(search_struct(n)).alias("raw"))


def line_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items packed per order as ``Itens`` and ``Arquivos`` arrays.

    A group is the lines of one order (17 at most in the tables given), which
    the notice document holds as one record anyway.  Array order is
    total: (linenumber, partkey, suppkey, extendedprice).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate", "l_returnflag")
    ln, pk, sk = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    item = F.struct(
        ln.alias("sequencialItem"), pk.alias("l_partkey"), sk.alias("l_suppkey"),
        F.col("l_extendedprice").alias("valorTotal"),
        F.col("l_quantity").alias("quantidade"),
        F.concat(F.lit("item "), pk.cast("string")).alias("descricao"),
        F.col("l_returnflag").alias("unidade"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("valorUnitario"),
        F.date_format("l_shipdate", ISO).alias("dataPublicacaoPncp"),
    )
    att = F.struct(
        ln.alias("_ln"), pk.alias("_pk"), sk.alias("_sk"), F.col("l_extendedprice").alias("_ep"),
        F.when(ln % 3 != 0, ln).alias("sequencialDocumento"),
        F.when(ln % 2 == 1, F.concat(F.lit("Edital parte "), ln.cast("string"))).alias("titulo"),
        F.concat(F.lit("arquivo_"), pk.cast("string"), F.lit(".pdf")).alias("nome"),
        F.when(pk % 2 == 0, F.lit("Edital")).alias("tipoDocumentoNome"),
        F.lit("Anexo").alias("tipoDocumentoDescricao"),
        F.date_format("l_shipdate", ISO).alias("dataPublicacaoPncp"),
        F.when(sk % 2 == 0, F.concat(F.lit("https://pncp.gov.br/pncp-api/v1/arquivos/"), pk.cast("string")))
         .alias("url"),
        F.concat(F.lit("https://pncp.gov.br/uri/"), pk.cast("string")).alias("uri"),
    )
    g = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("Itens"),
                                     F.array_sort(F.collect_list(att)).alias("_att"))
    keep = ["sequencialDocumento", "titulo", "nome", "tipoDocumentoNome",
            "tipoDocumentoDescricao", "dataPublicacaoPncp", "url", "uri"]
    return g.select("l_orderkey", "Itens", F.transform("_att", lambda a: F.struct(
        *[a[k].alias(k) for k in keep])).alias("Arquivos"))


def notice_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full consulta documents: ``pncp_id, ingest_seq, raw`` where the JSON
    carries the attachments (under ``Arquivos`` for even orders, lower-case
    ``arquivos`` for odd ones) and, for orders divisible by 4, its own
    ``Itens``.  Orders without line items carry no attachment key."""
    n = notices(spark, sf_dir)
    la = line_arrays(spark, sf_dir)
    j = n.join(la, n.ingest_seq == la.l_orderkey, "left")
    even = F.col("ingest_seq") % 2 == 0
    base = consulta_struct(n)
    rec = F.struct(
        *[base[f].alias(f) for f in [
            "numeroControlePNCP", "objetoCompra", "anoCompra", "sequencialCompra", "processo",
            "modalidadeId", "modalidadeNome", "situacaoCompraNome", "valorTotalEstimado",
            "dataPublicacaoPncp", "dataAberturaProposta", "dataEncerramentoProposta",
            "dataAtualizacaoGlobal"]],
        F.struct(F.col("orgao_cnpj").alias("cnpj"), F.col("orgao_razao").alias("razaoSocial")).alias("orgaoEntidade"),
        F.struct(F.col("uf_sigla").alias("ufSigla"), F.col("municipio_nome").alias("municipioNome")).alias("unidadeOrgao"),
        F.when(even, F.col("Arquivos")).alias("Arquivos"),
        F.when(~even, F.col("Arquivos")).alias("arquivos"),
        F.when(F.col("ingest_seq") % 4 == 0, F.col("Itens")).alias("Itens"),
    )
    return j.select(F.col("numeroControlePNCP").alias("pncp_id"), "ingest_seq",
                    F.to_json(rec).alias("raw"))


NOTICES_SQL = r"""
notices AS (
  SELECT
    o.o_orderkey AS ingest_seq,
    CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
         ELSE printf('%014d', o.o_custkey) || '-1-' || printf('%06d', o.o_orderkey) || '/'
              || CAST(year(o.o_orderdate) AS VARCHAR) END AS numeroControlePNCP,
    CAST(year(o.o_orderdate) AS INTEGER) AS anoCompra,
    o.o_orderkey AS sequencialCompra,
    p.p_name || ' ' || o.o_orderpriority AS objetoCompra,
    CASE WHEN o.o_orderkey % 53 = 0 THEN NULL
         ELSE CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) END AS modalidadeId,
    CASE WHEN o.o_orderkey % 59 = 0 THEN NULL ELSE o.o_orderpriority END AS modalidadeNome,
    o.o_orderstatus AS situacaoCompraNome,
    o.o_totalprice AS valorTotalEstimado,
    strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') AS dataPublicacaoPncp,
    strftime(o.o_orderdate + INTERVAL 7 DAY, '%Y-%m-%dT%H:%M:%S') AS dataAberturaProposta,
    strftime(o.o_orderdate + INTERVAL 30 DAY, '%Y-%m-%dT%H:%M:%S') AS dataEncerramentoProposta,
    strftime(o.o_orderdate + to_days(CAST(o.o_orderkey % 5 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS dataAtualizacaoGlobal,
    strftime(o.o_orderdate + to_days(CAST(o.o_orderkey % 7 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS dataAtualizacaoSearch,
    printf('%014d', o.o_custkey) AS orgao_cnpj,
    c.c_name AS orgao_razao,
    n.n_name AS uf_sigla,
    c.c_mktsegment AS municipio_nome,
    o.o_orderkey % 3 <> 0 AS in_consulta,
    o.o_orderkey % 3 <> 1 AS in_search
  FROM orders o
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN part p ON p.p_partkey = o.o_orderkey % (SELECT count(*) FROM part)
)"""

ITEMS_SQL = r"""
itens AS (
  SELECT l_orderkey,
    list({'sequencialItem': l_linenumber, 'l_partkey': l_partkey, 'l_suppkey': l_suppkey,
          'valorTotal': l_extendedprice, 'quantidade': l_quantity,
          'descricao': 'item ' || CAST(l_partkey AS VARCHAR), 'unidade': l_returnflag,
          'valorUnitario': l_extendedprice / l_quantity,
          'dataPublicacaoPncp': strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')}
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS Itens,
    list({'sequencialDocumento': CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber END,
          'titulo': CASE WHEN l_linenumber % 2 = 1 THEN 'Edital parte ' || CAST(l_linenumber AS VARCHAR) END,
          'nome': 'arquivo_' || CAST(l_partkey AS VARCHAR) || '.pdf',
          'tipoDocumentoNome': CASE WHEN l_partkey % 2 = 0 THEN 'Edital' END,
          'tipoDocumentoDescricao': 'Anexo',
          'dataPublicacaoPncp': strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S'),
          'url': CASE WHEN l_suppkey % 2 = 0 THEN 'https://pncp.gov.br/pncp-api/v1/arquivos/' || CAST(l_partkey AS VARCHAR) END,
          'uri': 'https://pncp.gov.br/uri/' || CAST(l_partkey AS VARCHAR)}
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS Arquivos
  FROM lineitem GROUP BY l_orderkey
)"""

DOCS_SQL = r"""
docs AS (
  SELECT n.numeroControlePNCP AS pncp_id, n.ingest_seq,
    json_object('numeroControlePNCP', numeroControlePNCP, 'objetoCompra', objetoCompra,
      'anoCompra', anoCompra, 'sequencialCompra', sequencialCompra,
      'processo', 'PROC-' || CAST(sequencialCompra AS VARCHAR), 'modalidadeId', modalidadeId,
      'modalidadeNome', modalidadeNome, 'situacaoCompraNome', situacaoCompraNome,
      'valorTotalEstimado', valorTotalEstimado, 'dataPublicacaoPncp', dataPublicacaoPncp,
      'dataAberturaProposta', dataAberturaProposta, 'dataEncerramentoProposta', dataEncerramentoProposta,
      'dataAtualizacaoGlobal', dataAtualizacaoGlobal,
      'orgaoEntidade', {'cnpj': orgao_cnpj, 'razaoSocial': orgao_razao},
      'unidadeOrgao', {'ufSigla': uf_sigla, 'municipioNome': municipio_nome},
      'Arquivos', CASE WHEN n.ingest_seq % 2 = 0 THEN i.Arquivos END,
      'arquivos', CASE WHEN n.ingest_seq % 2 = 1 THEN i.Arquivos END,
      'Itens', CASE WHEN n.ingest_seq % 4 = 0 THEN i.Itens END)::VARCHAR AS raw
  FROM notices n LEFT JOIN itens i ON i.l_orderkey = n.ingest_seq
)"""


def _code_sql(n: int) -> str:
    return f"CASE WHEN sequencialCompra % {n} <> 0 THEN substr('FEMD', CAST(sequencialCompra % {n} AS INTEGER), 1) END"


CONSULTA_JSON_SQL = r"""to_json({'numeroControlePNCP': numeroControlePNCP, 'objetoCompra': objetoCompra,
  'anoCompra': anoCompra, 'sequencialCompra': sequencialCompra,
  'processo': 'PROC-' || CAST(sequencialCompra AS VARCHAR), 'modalidadeId': modalidadeId,
  'modalidadeNome': modalidadeNome, 'situacaoCompraNome': situacaoCompraNome,
  'valorTotalEstimado': valorTotalEstimado, 'dataPublicacaoPncp': dataPublicacaoPncp,
  'dataAberturaProposta': dataAberturaProposta, 'dataEncerramentoProposta': dataEncerramentoProposta,
  'dataAtualizacaoGlobal': dataAtualizacaoGlobal,
  'orgaoEntidade': {'cnpj': orgao_cnpj, 'razaoSocial': orgao_razao, 'poderId': """ + _code_sql(3) + """, 'esferaId': """ + _code_sql(4) + """},
  'unidadeOrgao': {'ufSigla': uf_sigla, 'municipioNome': municipio_nome, 'ufNome': 'Estado ' || uf_sigla,
    'codigoUnidade': 'U' || CAST(sequencialCompra AS VARCHAR), 'nomeUnidade': 'Unidade ' || orgao_razao,
    'codigoIbge': 'IBGE' || CAST(sequencialCompra AS VARCHAR)},
  'numeroCompra': CAST(sequencialCompra AS VARCHAR) || '/' || CAST(anoCompra AS VARCHAR),
  'tipoInstrumentoConvocatorioCodigo': sequencialCompra % 4,
  'tipoInstrumentoConvocatorioNome': CASE WHEN sequencialCompra % 11 <> 0 THEN 'Edital' END,
  'situacaoCompraId': sequencialCompra % 5,
  'valorTotalHomologado': CASE WHEN sequencialCompra % 3 = 1 THEN round(valorTotalEstimado, 0) END,
  'modoDisputaId': sequencialCompra % 6, 'modoDisputaNome': CASE WHEN sequencialCompra % 6 <> 0 THEN 'Aberto' END,
  'linkSistemaOrigem': CASE WHEN sequencialCompra % 5 <> 0 THEN 'https://portal.example/' || CAST(sequencialCompra AS VARCHAR) END,
  'linkProcessoEletronico': CASE WHEN sequencialCompra % 8 = 0 THEN 'https://processo.example/' || CAST(sequencialCompra AS VARCHAR) END,
  'fontesOrcamentarias': CASE WHEN sequencialCompra % 7 = 0 THEN [] ELSE ['Federal', 'Fonte ' || CAST(sequencialCompra AS VARCHAR)] END,
  'usuarioNome': CASE WHEN sequencialCompra % 9 <> 0 THEN 'usuario ' || CAST(sequencialCompra AS VARCHAR) END,
  'amparoLegal': {'codigo': sequencialCompra % 10, 'nome': 'Lei 14.133', 'descricao': ''},
  'informacaoComplementar': CASE WHEN sequencialCompra % 2 = 0 THEN 'com anexos' ELSE '' END,
  'srp': sequencialCompra % 2 = 1, 'dataInclusao': dataPublicacaoPncp, 'dataAtualizacao': dataAtualizacaoGlobal})::VARCHAR"""

SEARCH_JSON_SQL = r"""to_json({'numero_controle_pncp': numeroControlePNCP, 'description': objetoCompra,
  'title': 'Edital ' || CAST(sequencialCompra AS VARCHAR) || '/' || CAST(anoCompra AS VARCHAR),
  'ano': anoCompra, 'numero_sequencial': sequencialCompra,
  'orgao_cnpj': orgao_cnpj, 'orgao_nome': orgao_razao, 'uf': uf_sigla, 'municipio_nome': municipio_nome,
  'modalidade_licitacao_id': modalidadeId, 'modalidade_licitacao_nome': modalidadeNome,
  'situacao_nome': situacaoCompraNome, 'data_publicacao_pncp': dataPublicacaoPncp,
  'data_atualizacao_pncp': dataAtualizacaoSearch, 'data_fim_vigencia': dataEncerramentoProposta,
  'valor_global': valorTotalEstimado,
  'item_url': '/editais/' || orgao_cnpj || '/' || CAST(anoCompra AS VARCHAR) || '/' || CAST(sequencialCompra AS VARCHAR),
  'document_type': 'edital', 'tem_resultado': situacaoCompraNome = 'F', 'cancelado': false,
  'id': 'id-' || CAST(sequencialCompra AS VARCHAR), 'numero': 'n' || CAST(sequencialCompra AS VARCHAR),
  'tipo_id': sequencialCompra % 4, 'tipo_nome': 'Aviso', 'situacao_id': sequencialCompra % 5,
  'orgao_id': 'o' || CAST(sequencialCompra AS VARCHAR), 'unidade_id': 'i' || CAST(sequencialCompra AS VARCHAR),
  'unidade_codigo': 'c' || CAST(sequencialCompra AS VARCHAR), 'unidade_nome': 'Setor ' || orgao_razao,
  'esfera_id': """ + _code_sql(3) + """, 'esfera_nome': 'Municipal', 'poder_id': """ + _code_sql(4) + """, 'poder_nome': 'Executivo',
  'municipio_id': 'm' || CAST(sequencialCompra AS VARCHAR), 'data_inicio_vigencia': dataAberturaProposta,
  'data_assinatura': dataPublicacaoPncp,
  'fonte_orcamentaria': CASE WHEN sequencialCompra % 3 = 2 THEN ['Recurso ' || CAST(sequencialCompra AS VARCHAR)] END,
  'fonte_orcamentaria_id': sequencialCompra % 3, 'fonte_orcamentaria_nome': 'Recurso', 'createdAt': dataPublicacaoPncp})::VARCHAR"""

FEEDS_SQL = f"""
feeds AS (
  SELECT 'search' AS feed, ingest_seq, ingest_seq * 2 AS seq, {SEARCH_JSON_SQL} AS raw
  FROM notices WHERE in_search
  UNION ALL
  SELECT 'consulta' AS feed, ingest_seq, ingest_seq * 2 + 1 AS seq, {CONSULTA_JSON_SQL} AS raw
  FROM notices WHERE in_consulta
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
