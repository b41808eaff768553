"""Source and sink jobs: landed pages, paged connector, CSV / JSON / text
files, id logs, date partitions, bronze tables, upserts, batch checkpoints.

Every job derives its files from the driver tables, writes them below the
shared checkpoint folder (``spark.checkpoint.dir``) and reads them back
through the operator under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedupe as W
from ..operators import merge as J
from ..operators import relevance as RV
from ..session import scratch_path, stored
from ..sources import files as SF
from ..sources import keyed
from ..sources import pages as PG
from ..sources import sinks as K
from ..tables import table
from . import query
from .adapters import FEEDS_SQL, NOTICES_SQL, feeds_raw, notices, with_ctes
from .label_jobs import LAB_SQL, SCORE_SQL, doc_scorer, labelled
from .record_jobs import FLAT, NORM_SQL, _flat, normalized_feeds
from .text_jobs import _PAIRS_SQL, kw_table

PAGE_SIZE = 50


def _j(p):
    return f"json_extract_string(raw, '$.{p}')"


# ---------------------------------------------------------------- S01 landed pages
def page_docs(spark, sf_dir, feed="consulta", page_size=PAGE_SIZE, by_modality=False):
    """Page documents of a feed: ``[modalidade,] pagina, value`` where value
    is a landed fetch record; envelope shape rotates with the page number
    and pages divisible by 17 are truncated (unparseable)."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == feed).select("seq", "raw")
    grp = []
    if by_modality:
        f = f.withColumn("modalidade", F.coalesce(F.get_json_object("raw", "$.modalidadeId"), F.lit("0")))
        grp = ["modalidade"]
    idx = W.with_index(f, ["seq"], "_i", partition_by=grp or None)
    pg = idx.withColumn("pagina", (F.floor((F.col("_i") - 1) / page_size) + 1).cast("int"))
    g = pg.groupBy(*grp, "pagina").agg(F.array_sort(F.collect_list(F.struct("seq", "raw"))).alias("_l"))
    lst = F.concat(F.lit("["), F.array_join(F.transform("_l", lambda e: e["raw"]), ","), F.lit("]"))
    p = F.col("pagina")
    k = p % 6
    env = (F.when(k == 0, F.concat(F.lit('{"data":'), lst, F.lit(',"numeroPagina":'), p.cast("string"), F.lit("}")))
            .when(k == 1, F.concat(F.lit('{"items":'), lst, F.lit(',"total":'), F.size("_l").cast("string"), F.lit("}")))
            .when(k == 2, lst)
            .when(k == 3, F.concat(F.lit('{"content":'), lst, F.lit("}")))
            .when(k == 4, F.concat(F.lit('{"dados":'), lst, F.lit("}")))
            .otherwise(F.concat(F.lit('{"modalidades":{"A":{"dados":'), lst, F.lit('},"B":{"dados":[]}}}'))))
    if by_modality:
        last = pg.groupBy(*grp).agg(F.max("pagina").alias("_total")).withColumn("pagina", F.lit(1))
        g = g.join(last, [*grp, "pagina"], "left")  # the first page tells it; pages are dealt out so already
        total = F.col("_total")
        env = F.when(p == 1, F.concat(F.lit('{"data":'), lst, F.lit(',"totalPaginas":'), total.cast("string"),
                                      F.lit(',"numeroPagina":1}'))).otherwise(env)
    doc = F.concat(F.lit('{"fonte":"' + feed + '","pagina":'), p.cast("string"), F.lit(',"resposta":'), env, F.lit("}"))
    doc = F.when(p % 17 == 0, F.substring(doc, 1, 40)).otherwise(doc)
    return g.select(*grp, "pagina", doc.alias("value"))


PAGES_SQL = f"""pg AS (
  SELECT feed, seq, raw, CAST((row_number() OVER (ORDER BY seq) - 1) // {PAGE_SIZE} + 1 AS INTEGER) AS pagina,
         (row_number() OVER (ORDER BY seq) - 1) % {PAGE_SIZE} AS pos
  FROM feeds WHERE feed = 'consulta')"""


@query("scan_pages", with_ctes(NOTICES_SQL, FEEDS_SQL, PAGES_SQL) + f"""
SELECT 'consulta' AS fonte, pagina, pos, {_j('numeroControlePNCP')} AS numeroControlePNCP,
       {_j('sequencialCompra')} AS sequencialCompra
FROM pg WHERE pagina % 17 <> 0""")
def q_scan_pages(spark, sf_dir):
    """Landed pages (six envelope shapes, some corrupt) -> records."""
    path = scratch_path(spark, "pages")
    page_docs(spark, sf_dir).select("value").write.text(path)
    r = PG.read_pages(spark, path)
    return r.select("fonte", "pagina", "pos",
                    F.get_json_object("raw", "$.numeroControlePNCP").alias("numeroControlePNCP"),
                    F.get_json_object("raw", "$.sequencialCompra").alias("sequencialCompra"))


@query("paged_source", with_ctes(NOTICES_SQL, FEEDS_SQL) + f"""
, pg AS (SELECT coalesce({_j('modalidadeId')}, '0') AS modalidade, seq, raw FROM feeds WHERE feed = 'consulta'),
ix AS (SELECT modalidade, raw, row_number() OVER (PARTITION BY modalidade ORDER BY seq) - 1 AS i FROM pg)
SELECT modalidade, CAST(i // {PAGE_SIZE} + 1 AS INTEGER) AS pagina, CAST(i % {PAGE_SIZE} AS INTEGER) AS pos,
       {_j('numeroControlePNCP')} AS numeroControlePNCP
FROM ix WHERE (i // {PAGE_SIZE} + 1) % 17 <> 0 OR (i // {PAGE_SIZE} + 1) = 1""")
def q_paged_source(spark, sf_dir):
    """Landed pages per modality; the first page announces the page count
    (pages 17, 34, ... are corrupt and skipped)."""
    path = scratch_path(spark, "paged")
    docs = page_docs(spark, sf_dir, by_modality=True)
    docs.select("modalidade", "value").write.partitionBy("modalidade").text(path, compression="lz4")  # a page is a line; its record has the number
    return PG.paged_source(spark, path).select("modalidade", "pagina", "pos",
                     F.get_json_object("raw", "$.numeroControlePNCP").alias("numeroControlePNCP"))


@query("paging_stop", with_ctes(NOTICES_SQL, FEEDS_SQL) + f"""
, pg AS (SELECT coalesce({_j('modalidadeId')}, '0') AS modalidade, seq FROM feeds WHERE feed = 'consulta'),
ix AS (SELECT modalidade, (row_number() OVER (PARTITION BY modalidade ORDER BY seq) - 1) // 60 + 1 AS pagina FROM pg),
pages AS (SELECT modalidade, pagina, count(*) AS n FROM ix GROUP BY ALL),
st AS (SELECT modalidade, min(pagina) FILTER (WHERE n < 60 AND n > 0) AS sp FROM pages GROUP BY modalidade)
SELECT p.modalidade, p.pagina, p.n FROM pages p JOIN st USING (modalidade)
WHERE p.pagina <= least(coalesce(sp, 1 << 30), 20)""")
def q_paging_stop(spark, sf_dir):
    """A client reading pages of 60 stops at the short page or after 20 pages."""
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "consulta").select(
        "seq", F.coalesce(F.get_json_object("raw", "$.modalidadeId"), F.lit("0")).alias("modalidade"))
    ix = W.with_index(f, ["seq"], "_i", partition_by=["modalidade"])
    pages = (ix.groupBy("modalidade", (F.floor((F.col("_i") - 1) / 60) + 1).cast("bigint").alias("pagina"))
               .agg(F.count(F.lit(1)).alias("n")))
    return PG.take_until_end(pages, "modalidade", "pagina", "n", 60, max_pages=20)


# ---------------------------------------------------------------- S04/K05
@query("scan_csv_roundtrip", f"WITH {LAB_SQL} SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, CAST(label AS VARCHAR) AS label FROM lab")
def q_scan_csv_roundtrip(spark, sf_dir):
    """K05 + S04: label set -> CSV (quoted multi-line text) -> read back as text."""
    path = scratch_path(spark, "labels_csv")
    lab = labelled(spark, sf_dir).select("doc_id", F.col("text").alias("Objeto"), F.col("label").alias("Relevante"))
    K.write_csv(lab, path, ["doc_id", "Objeto", "Relevante", "nao_existe"])
    back = SF.read_labels(spark, path)
    return back.select("doc_id", F.coalesce(F.col("Objeto"), F.lit("")).alias("text"),
                       F.col("Relevante").alias("label"))


@query("csv_roundtrip", with_ctes(NOTICES_SQL) + """
SELECT CAST(ingest_seq AS VARCHAR) AS ingest_seq, coalesce(numeroControlePNCP, '') AS numeroControlePNCP,
       objetoCompra, CAST(valorTotalEstimado AS VARCHAR) AS valor FROM notices""")
def q_csv_roundtrip(spark, sf_dir):
    """Notice columns -> CSV -> back (empty string reads back as NULL)."""
    path = scratch_path(spark, "notices_csv")
    n = notices(spark, sf_dir).select("ingest_seq", "numeroControlePNCP", "objetoCompra",
                                      F.col("valorTotalEstimado").cast("string").alias("valor"))
    K.write_csv(n, path)
    b = SF.read_labels(spark, path)
    return b.select("ingest_seq", F.coalesce(F.col("numeroControlePNCP"), F.lit("")).alias("numeroControlePNCP"),
                    "objetoCompra", "valor")


@query("jsonl_roundtrip", "SELECT doc_id, text, lang FROM documents")
def q_jsonl_roundtrip(spark, sf_dir):
    """JSON-lines append sink (non-ASCII kept), read back."""
    path = scratch_path(spark, "docs_jsonl")
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    K.write_jsonl(d.where(F.col("lang") == "en"), path, append=True)
    K.write_jsonl(d.where(F.col("lang") != "en"), path, append=True)
    return spark.read.schema("doc_id long, text string, lang string").json(path)


# ---------------------------------------------------------------- S06/S07/S08/K04
@query("keyword_dim", f"WITH {_PAIRS_SQL} SELECT keyword, count(*) AS count FROM pairs GROUP BY keyword")
def q_keyword_dim(spark, sf_dir):
    """Keyword file (padded, blank lines) -> dimension -> hit counts."""
    path = scratch_path(spark, "keywords")
    lines = kw_table(spark, sf_dir).select(F.explode(F.array(
        F.concat(F.lit("  "), F.col("term"), F.lit(" ")), F.lit(""))).alias("value"))
    lines.coalesce(1).write.text(path)
    kw = SF.read_keywords(spark, path)
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    from ..operators.summary import keyword_counts
    return keyword_counts(J.match_pairs(d, kw, "text", "term"))


@query("id_log", "SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM labels")
def q_id_log(spark, sf_dir):
    """Progress log (ids repeated, padded, blank lines) -> distinct ids."""
    path = scratch_path(spark, "idlog")
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    lab.select(F.explode(F.array(F.col("id"), F.concat(F.lit(" "), F.col("id"), F.lit("\t")), F.lit("  ")))
               .alias("value")).write.text(path)
    return SF.read_id_log(spark, path, "id")


def _events_by_day(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.withColumn("data", F.to_date("ts"))


@query("date_overwrite", "SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS data FROM events")
def q_date_overwrite(spark, sf_dir):
    """Date-partitioned write; re-writing one date replaces only it."""
    path = scratch_path(spark, "events_by_day")
    e = _events_by_day(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "data")
    K.write_date(e, path)
    K.write_date(e.where(F.col("data") == F.lit("2024-01-10").cast("date")), path)
    return spark.read.parquet(path).select("event_id", "user_id", "event_type", "value", "data")


@query("date_reset", """SELECT event_id, CAST(ts AS DATE) AS data FROM events
WHERE CAST(ts AS DATE) <> (SELECT min(CAST(ts AS DATE)) FROM events)""")
def q_date_reset(spark, sf_dir):
    """Re-running a date without rows, with the date reset, empties it."""
    path = scratch_path(spark, "events_reset")
    e = _events_by_day(spark, sf_dir).select("event_id", "data")
    K.write_date(e, path)
    first = e.agg(F.min("data").cast("string")).first()[0]
    K.write_date(e.limit(0), path, reset=[first])
    return spark.read.parquet(path).select("event_id", "data")


@query("latest_partition", """SELECT event_id, CAST(ts AS DATE) AS data FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def q_latest_partition(spark, sf_dir):
    """Asked date missing -> newest partition."""
    path = scratch_path(spark, "events_days")
    K.write_date(_events_by_day(spark, sf_dir).select("event_id", "data"), path)
    return SF.read_date_or_latest(spark, path, "2099-01-01").select("event_id", "data")


@query("date_partition", """SELECT event_id, CAST(ts AS DATE) AS data FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def q_date_partition(spark, sf_dir):
    """Asked date present -> that partition only (pruned read)."""
    path = scratch_path(spark, "events_days2")
    K.write_date(_events_by_day(spark, sf_dir).select("event_id", "data"), path)
    return SF.read_date_or_latest(spark, path, "2024-01-15").select("event_id", "data")


# ---------------------------------------------------------------- S09/S10
@query("ordered_scan", with_ctes(NOTICES_SQL) + """
SELECT ingest_seq, numeroControlePNCP, objetoCompra FROM notices ORDER BY ingest_seq""")
def q_ordered_scan(spark, sf_dir):
    """Projection + order (limit 0 = whole table)."""
    n = notices(spark, sf_dir)
    return SF.scan(n, ["ingest_seq", "numeroControlePNCP", "objetoCompra"], ["ingest_seq"], 0)


@query("flex_reader", with_ctes(NOTICES_SQL, FEEDS_SQL) + f"""
SELECT coalesce(nullif({_j('numeroControlePNCP')}, ''), nullif({_j('numero_controle_pncp')}, ''), '') AS pncp_id,
  coalesce(nullif({_j('orgaoEntidade.razaoSocial')}, ''), nullif({_j('orgaoEntidade.razaosocial')}, ''), nullif({_j('orgao_nome')}, ''), '') AS orgao_nome,
  coalesce(nullif({_j('unidadeOrgao.ufSigla')}, ''), nullif({_j('uf')}, ''), '') AS uf_sigla,
  coalesce(nullif({_j('objetoCompra')}, ''), nullif({_j('objeto_compra')}, ''), nullif({_j('description')}, ''), '') AS objeto_compra,
  raw <> '' AS tem_json
FROM feeds""")
def q_flex_reader(spark, sf_dir):
    """Five non-NULL fields from a JSON-only table (both feeds)."""
    f = feeds_raw(spark, sf_dir).select(F.col("raw").alias("dados_json"))
    r = SF.read_notices(f)
    return r.select("pncp_id", "orgao_nome", "uf_sigla", "objeto_compra", (F.col("dados_json") != "").alias("tem_json"))


# ---------------------------------------------------------------- K01/K02/K03
@query("insert_if_absent", with_ctes(NOTICES_SQL, FEEDS_SQL) + f"""
, b AS (SELECT seq, {_j('numero_controle_pncp')} AS k FROM feeds WHERE feed = 'search'),
e AS (SELECT {_j('numeroControlePNCP')} AS k FROM feeds WHERE feed = 'consulta')
SELECT seq, k FROM b WHERE k IS NULL OR k NOT IN (SELECT k FROM e WHERE k IS NOT NULL)""")
def q_insert_if_absent(spark, sf_dir):
    """Search-feed batch into the consulta table: first write wins."""
    f = feeds_raw(spark, sf_dir)
    batch = f.where(F.col("feed") == "search").select("seq", F.get_json_object("raw", "$.numero_controle_pncp").alias("k"))
    existing = f.where(F.col("feed") == "consulta").select(F.get_json_object("raw", "$.numeroControlePNCP").alias("k"))
    return K.insert_if_absent(existing, batch, "k", "seq")


@query("upsert", with_ctes(NOTICES_SQL, FEEDS_SQL, NORM_SQL) + f"""
SELECT {', '.join(FLAT)}, seq FROM norm
QUALIFY row_number() OVER (PARTITION BY coalesce(numeroControlePNCP, '#' || feed || CAST(seq AS VARCHAR))
                           ORDER BY CASE WHEN feed = 'search' THEN 1 ELSE 0 END DESC, seq DESC) = 1""")
def q_upsert(spark, sf_dir):
    """Search batch upserted over the consulta table: last write wins."""
    u = _flat(normalized_feeds(spark, sf_dir))
    side = (F.col("_origem") == "search").cast("int")  # both sides are one frame: one scan, one shuffle
    return K.last_write(u.select(*FLAT, "seq"), "numeroControlePNCP", "seq", side).select(*FLAT, "seq")


@query("upsert_table", with_ctes(NOTICES_SQL, FEEDS_SQL, NORM_SQL) + f"""
SELECT {', '.join(FLAT)}, seq FROM norm
QUALIFY row_number() OVER (PARTITION BY coalesce(numeroControlePNCP, '#' || feed || CAST(seq AS VARCHAR))
                           ORDER BY CASE WHEN feed = 'search' THEN 1 ELSE 0 END DESC, seq DESC) = 1""")
def q_upsert_table(spark, sf_dir):
    """K02 on a keyed table: the consulta feed, then the search feed in two
    batches; each batch rewrites only the files that may hold its keys."""
    path = scratch_path(spark, "upsert_table")
    u = stored(_flat(normalized_feeds(spark, sf_dir)).select(*FLAT, "seq"), "upsert_feeds")
    for batch in (F.col("_origem") == "consulta", (F.col("_origem") == "search") & (F.col("seq") % 2 == 0),
                  (F.col("_origem") == "search") & (F.col("seq") % 2 == 1)):
        keyed.upsert(u.where(batch), path, "numeroControlePNCP", "seq")
        keyed.vacuum(spark, path)  # nobody reads the replaced files
        spark._jvm.System.gc()  # nor the batch's shuffles
    return keyed.read(spark, path)


@query("bronze_append", with_ctes(NOTICES_SQL, FEEDS_SQL) + f"""
SELECT ingest_seq, CAST(ingest_seq // {PAGE_SIZE} + 1 AS INTEGER) AS page, '2026-03-13 10:00:00' AS collected_at,
       {_j('numeroControlePNCP')} AS pncp_id, DATE '2026-03-13' AS data
FROM feeds WHERE feed = 'consulta' AND ingest_seq % 2 = 0
UNION ALL
SELECT ingest_seq, CAST(ingest_seq // {PAGE_SIZE} + 1 AS INTEGER), '2026-03-14 10:00:00', {_j('numeroControlePNCP')},
       DATE '2026-03-14'
FROM feeds WHERE feed = 'consulta' AND ingest_seq % 2 = 1""")
def q_bronze_append(spark, sf_dir):
    """Two collection runs appended to the date-partitioned bronze table."""
    path = scratch_path(spark, "bronze")
    f = feeds_raw(spark, sf_dir).where(F.col("feed") == "consulta")
    page = F.floor(F.col("ingest_seq") / PAGE_SIZE) + 1
    K.bronze_append(K.to_bronze(f.where(F.col("ingest_seq") % 2 == 0), "raw", page, "2026-03-13 10:00:00",
                                "2026-03-13"), path)
    K.bronze_append(K.to_bronze(f.where(F.col("ingest_seq") % 2 == 1), "raw", page, "2026-03-14 10:00:00",
                                "2026-03-14"), path)
    b = spark.read.parquet(path)
    return b.select("ingest_seq", "page", "collected_at",
                    F.get_json_object("raw", "$.numeroControlePNCP").alias("pncp_id"), "data")


# ---------------------------------------------------------------- K08/K09/K10
@query("per_term_output", f"""WITH {_PAIRS_SQL}
SELECT keyword, doc_id, CASE WHEN s = '' THEN 'termo' ELSE s END AS slug FROM (
  SELECT keyword, doc_id, regexp_replace(regexp_replace(lower(trim(regexp_replace(strip_accents(keyword), '[^\\x00-\\x7F]', '', 'g'))),
         '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS s FROM pairs)""")
def q_per_term_output(spark, sf_dir):
    """One output per search term, folder named by the term's slug."""
    path = scratch_path(spark, "per_term")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    pairs = J.match_pairs(d, kw_table(spark, sf_dir), "text", "term").select("keyword", "doc_id")
    K.write_by_slug(pairs, path, "keyword")
    return spark.read.parquet(path).select("keyword", "doc_id", "slug")


@query("label_export", with_ctes(NOTICES_SQL) + """
SELECT numeroControlePNCP AS pncp_id, objetoCompra AS Objeto, '' AS Relevante FROM notices ORDER BY ingest_seq LIMIT 100""")
def q_label_export(spark, sf_dir):
    """The first 100 notices for manual labelling (the export size is the feature)."""
    return K.export_for_labelling(notices(spark, sf_dir), "numeroControlePNCP", "objetoCompra", "ingest_seq", 100)


@query("batch_checkpoint", f"""WITH {SCORE_SQL}
SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 15 AS batch_id, serve_para_mim FROM scored""")
def q_batch_checkpoint(spark, sf_dir):
    """Results saved per batch; a second run skips finished batches;
    everything is read back in batch order."""
    path = scratch_path(spark, "batches")
    d = W.batches(table(spark, sf_dir, "documents").select("doc_id", "text"), 15, ["doc_id"])
    first = d.where(F.col("batch_id") % 2 == 0)     # run 1 stops half-way
    K.save_batch_results(RV.score(first, "text", doc_scorer()).select("doc_id", "serve_para_mim", "batch_id"), path)
    todo = K.pending_batches(d, K.finished_batches(spark, path))   # run 2 resumes
    K.save_batch_results(RV.score(todo, "text", doc_scorer()).select("doc_id", "serve_para_mim", "batch_id"), path)
    return K.load_results(spark, path).select("doc_id", F.col("batch_id").cast("bigint"), "serve_para_mim")
