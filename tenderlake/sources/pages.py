"""Landed API pages.

A landed page is one JSON document per line: either the bare API envelope
or a fetch record ``{"fonte", "pagina", "resposta": <envelope>}``.  All six
envelope shapes are accepted: ``{data:[...]}``, ``{items:[...]}``, a bare
list, ``{content:[...]}``, ``{dados:[...]}`` and
``{modalidades:{<name>:{dados:[...]}}}``.  Unparseable documents give no
rows.  Parsing uses VARIANT (one parse per page, any shape).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE_KEYS = ("data", "items", "content", "dados")


def _records(env: Column) -> Column:
    """array<variant> of records of an envelope, whatever its shape."""
    is_list = F.coalesce(F.schema_of_variant(env).startswith("ARRAY"), F.lit(False))
    cands = [F.when(is_list, F.try_variant_get(env, "$", "array<variant>"))]
    cands += [F.try_variant_get(env, f"$.{k}", "array<variant>") for k in ENVELOPE_KEYS]
    mods = F.try_variant_get(env, "$.modalidades", "map<string,variant>")
    per_mod = F.flatten(F.transform(F.map_values(mods), lambda m: F.coalesce(
        F.try_variant_get(m, "$.dados", "array<variant>"), F.array().cast("array<variant>"))))
    cands.append(per_mod)
    return F.coalesce(*cands)


def _once(c: Column) -> Column:
    """``c`` computed once per row: the optimiser does not copy it into what uses it."""
    return F.explode(F.array(c))


def parse_pages(df: DataFrame, value: str = "value", source: str | None = None) -> DataFrame:
    """S01 core: page documents -> one raw record per row with
    ``fonte, pagina, pos`` (0-based position inside the page) and ``raw``."""
    v = F.col("_doc")
    wrapped = F.try_variant_get(v, "$.resposta", "variant").isNotNull()
    env = F.when(wrapped, F.try_variant_get(v, "$.resposta", "variant")).otherwise(v)
    fonte = F.coalesce(F.try_variant_get(v, "$.fonte", "string"), F.lit(source))
    x = df.select(_once(F.try_parse_json(F.col(value))).alias("_doc")).select("_doc", _once(env).alias("_env"))
    env = F.col("_env")
    pagina = F.coalesce(F.try_variant_get(v, "$.pagina", "int"), F.try_variant_get(env, "$.numeroPagina", "int"))
    x = x.select(fonte.alias("fonte"), pagina.alias("pagina"), _records(env).alias("_r"))
    return x.select("fonte", "pagina", F.posexplode("_r").alias("pos", "_v")).select(
        "fonte", "pagina", F.col("pos").cast("bigint").alias("pos"), F.to_json("_v").alias("raw"))


def read_pages(spark: SparkSession, path: str, source: str | None = None, wholetext: bool = False) -> DataFrame:
    """Read landed page documents (one per line, or one per file with
    ``wholetext``) and explode them to records."""
    return parse_pages(spark.read.text(path, wholetext=wholetext), "value", source)


# ----------------------------------------------------------------- S02
def announced_pages(env: Column, page_size: int | None = None) -> Column:
    """Pages that an envelope announces, at least 1: the stated page count;
    without one, records over page size (``page_size`` where the envelope has
    none); without those, its own number plus the pages that remain."""
    def number(key: str) -> Column:
        text = F.try_variant_get(env, f"$.{key}", "string")
        return F.when(text.rlike(r"^\s*\d+\s*$"), F.trim(text).cast("long"))

    def positive(c: Column) -> Column:
        return F.when(c > 0, c)

    size = F.coalesce(positive(number("tamanhoPagina")), F.lit(page_size).cast("long"))
    counted = F.ceil(positive(number("totalRegistros")) / positive(size))
    reached = number("numeroPagina") + number("paginasRestantes")
    return F.greatest(F.coalesce(positive(number("totalPaginas")), counted, reached, F.lit(1)), F.lit(1)).cast("int")


def paged_source(spark: SparkSession, path: str, page_size: int | None = None) -> DataFrame:
    """Records ``modalidade, pagina, pos, raw`` of the pages landed under
    ``path/modalidade=<m>/pagina=<p>/`` (the HTTP fetcher of a live feed would
    write them), in any file system that Spark reads.  Fetch records, which say
    their ``pagina``, may also lie one per line under ``path/modalidade=<m>/``,
    so that files do not grow in number with pages.

    Per modality the first readable page tells how many pages to take; pages
    that cannot be parsed give no rows.  A path without pages is an error.
    """
    docs = spark.read.option("basePath", path).text(path)
    if "modalidade" not in docs.columns:
        raise FileNotFoundError(f"no pages (modalidade=) under {path}")
    doc, env = F.col("_doc"), F.col("env")
    number = F.col("pagina") if "pagina" in docs.columns else F.try_variant_get(doc, "$.pagina", "int")
    parsed = docs.select("*", _once(F.try_parse_json("value")).alias("_doc"))
    pages = parsed.select(F.col("modalidade").cast("string"), number.cast("int").alias("pagina"),
                          _once(F.coalesce(F.try_variant_get(doc, "$.resposta", "variant"), doc)).alias("env"))
    limits = (pages.where(env.isNotNull())
              .select("modalidade", "pagina", announced_pages(env, page_size).alias("n"))
              .groupBy(F.col("modalidade").alias("_m")).agg(F.min_by("n", "pagina").alias("_last")))
    wanted = pages.join(limits, F.col("modalidade") == F.col("_m")).where(F.col("pagina") <= F.col("_last"))
    return (wanted.select("modalidade", "pagina", F.posexplode(_records(env)).alias("pos", "_v"))
            .select("modalidade", "pagina", "pos", F.to_json("_v").alias("raw")))


# ----------------------------------------------------------------- S03
def take_until_end(pages: DataFrame, query: str, page: str, n_rows: str, page_size: int,
                   max_pages: int | None = None, remaining: str | None = None,
                   error: str | None = None) -> DataFrame:
    """Pages read by a client that stops at the first empty page, the
    first short page (kept), ``paginasRestantes = 0`` (kept), an error page
    (dropped) or ``max_pages``; later pages are never read."""
    n = F.col(n_rows)
    stop_keep = (n < page_size) & (n > 0)
    if remaining:
        stop_keep = stop_keep | ((F.col(remaining) == 0) & (n > 0))
    stop_drop = n == 0
    if error:
        stop_drop = stop_drop | F.col(error)
    # one row per query; a query with a third of all pages is not a group in one task
    last = pages.groupBy(F.col(query).alias("_q")).agg(
        F.least(F.coalesce(F.min(F.when(stop_keep, F.col(page))), F.lit(1 << 30)),
                F.coalesce(F.min(F.when(stop_drop, F.col(page))) - 1, F.lit(1 << 30)),
                F.lit(max_pages or 1 << 30)).alias("_last"))
    kept = pages.join(last, F.col(query).eqNullSafe(F.col("_q"))).where(F.col(page) <= F.col("_last"))
    return kept.drop("_q", "_last")
