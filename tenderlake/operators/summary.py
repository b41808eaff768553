"""Group summaries, metrics and sorts.

Every summary is a group-by with partial aggregation; nothing is collected
to the driver.  Money is summed as DECIMAL(18,2) so totals are exact and
independent of partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .dedupe import with_index


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------- A01/A17
def value_counts(df: DataFrame, col: str, name: str = "quantidade") -> DataFrame:
    """Rows per value, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(col))


def count_rows(df: DataFrame, name: str = "total") -> DataFrame:
    """Plain COUNT(*)."""
    return df.agg(F.count(F.lit(1)).alias(name))


# ----------------------------------------------------------------- A02-A05
def summary_modality(df: DataFrame, mid: str = "modalidade_id", mname: str = "modalidade_nome") -> DataFrame:
    """Count per (modality id, name) where both are present (name
    non-empty), ordered by id."""
    return (df.where(F.col(mid).isNotNull() & (F.coalesce(F.col(mname), F.lit("")) != ""))
              .groupBy(F.col(mid).alias("modalidadeId"), F.col(mname).alias("modalidadeNome"))
              .agg(F.count(F.lit(1)).alias("quantidade"))
              .orderBy("modalidadeId", "modalidadeNome"))


def summary_state(df: DataFrame, uf: str = "uf_sigla") -> DataFrame:
    """Count per state (non-empty), count desc then state asc."""
    return (df.where(F.coalesce(F.col(uf), F.lit("")) != "")
              .groupBy(F.col(uf).alias("uf")).agg(F.count(F.lit(1)).alias("quantidade"))
              .orderBy(F.desc("quantidade"), F.asc("uf")))


def summary_city(df: DataFrame, city: str = "municipio_nome", uf: str = "uf_sigla", n: int = 20) -> DataFrame:
    """Top-``n`` (municipality, state) by count, then names."""
    return (df.where((F.coalesce(F.col(city), F.lit("")) != "") & (F.coalesce(F.col(uf), F.lit("")) != ""))
              .groupBy(F.col(city).alias("municipio"), F.col(uf).alias("uf"))
              .agg(F.count(F.lit(1)).alias("quantidade"))
              .orderBy(F.desc("quantidade"), F.asc("municipio"), F.asc("uf")).limit(n))


def summary_category(df: DataFrame, cat: str = "categoria_objeto") -> DataFrame:
    """Count per category (missing -> 'outros'), count desc, name asc."""
    return (df.groupBy(F.coalesce(F.col(cat), F.lit("outros")).alias("categoria"))
              .agg(F.count(F.lit(1)).alias("quantidade"))
              .orderBy(F.desc("quantidade"), F.asc("categoria")))


# ----------------------------------------------------------------- A06
def general_stats(df: DataFrame, value: str = "valor_total_estimado", pub: str = "publicacao_pncp",
                  mid: str = "modalidade_id", mname: str = "modalidade_nome") -> DataFrame:
    """One row: rows, modalities (as A02 counts them), sum and mean of
    the non-null values (2 dp, 0.0 when none), first/last publication date,
    sorted list of modality ids."""
    v = F.col(value).cast("decimal(18,2)")
    has_mod = F.col(mid).isNotNull() & (F.coalesce(F.col(mname), F.lit("")) != "")
    pair = F.when(has_mod, F.struct(F.col(mid), F.col(mname)))
    p = F.when(F.col(pub) != "", F.col(pub))
    return df.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_distinct(pair).alias("total_modalidades"),
        F.coalesce(F.sum(v).cast("double"), F.lit(0.0)).alias("valor_total_estimado_somado"),
        F.coalesce(F.round(F.sum(v) / F.count(v), 2).cast("double"), F.lit(0.0)).alias("valor_total_estimado_medio"),
        F.min(p).alias("menor_data_publicacao"),
        F.max(p).alias("maior_data_publicacao"),
        F.array_join(F.sort_array(F.collect_set(F.when(has_mod, F.col(mid).cast("string")))), ",")
         .alias("modalidades"),
    )


# ----------------------------------------------------------------- A07
def group_by_modality(df: DataFrame, mid: str = "modalidade_id", mname: str = "modalidade_nome",
                      order=("encerramento_proposta", "publicacao_pncp", "objeto_compra"),
                      seq: str = "ingest_seq", per: int = 1000) -> DataFrame:
    """The notices of each modality name ('Sem modalidade' when missing),
    in display order (O02 order, then arrival), with the id of the first of
    them and their count; groups ordered by id (NULL id last, as 999999) then
    name.  A group's list comes in rows of at most ``per`` notices, ``parte`` 1,
    2, .. with ``dados``, so that no row holds a whole modality."""
    name = F.coalesce(F.when(F.col(mname) != "", F.col(mname)), F.lit("Sem modalidade"))
    rank = [F.coalesce(F.col(order[0]), F.lit("")), F.coalesce(F.col(order[1]), F.lit("")),
            F.lower(F.coalesce(F.col(order[2]), F.lit(""))), F.col(seq)]
    x = with_index(df.select(name.alias("modalidade"), F.struct(*df.columns).alias("_item"),
                             *[r.alias(f"_r{k}") for k, r in enumerate(rank)]),
                   [f"_r{k}" for k in range(len(rank))], "_i", partition_by=["modalidade"])
    g = (x.groupBy("modalidade")
          .agg(F.min_by(F.col("_item").getField(mid), "_i").alias("modalidadeId"), F.count(F.lit(1)).alias("quantidade"))
          .select(F.col("modalidade").alias("_m"), "modalidadeId", F.col("modalidadeId").cast("string").alias("codigo_modalidade"),
                  "quantidade", F.coalesce(F.col("modalidadeId"), F.lit(999999)).alias("_o"),
                  F.explode(F.sequence(F.lit(1), F.ceil(F.col("quantidade") / per))).alias("_p")))  # joined by row of the list: no task has a whole modality
    keys = ["_o", "modalidade", "parte"]
    rows = (x.withColumn("parte", F.floor((F.col("_i") - 1) / per) + 1)
             .join(g, (F.col("modalidade") == F.col("_m")) & (F.col("parte") == F.col("_p"))).repartitionByRange(*keys))
    return (rows.groupBy(*keys, "modalidadeId", "codigo_modalidade", "quantidade")
                .agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_item"))), lambda e: e["_item"]).alias("dados"))
                .orderBy(*keys)
                .select("modalidade", "modalidadeId", "codigo_modalidade", "quantidade", "parte", "dados"))


# ----------------------------------------------------------------- A08
def merge_summary(a: DataFrame, b: DataFrame, merged: DataFrame, key: str = "numeroControlePNCP",
                  origin: str = "_origem") -> DataFrame:
    """Totals per feed, keyed-unique, keyless, final, and counts per
    origin over keyed rows -- one pass over the tagged union, one row."""
    u = (a.select(F.lit("a").alias("_src"), F.lit(None).cast("string").alias("_k"),
                  F.lit(None).cast("string").alias("_o"))
         .unionByName(b.select(F.lit("b").alias("_src"), F.lit(None).cast("string").alias("_k"),
                               F.lit(None).cast("string").alias("_o")))
         .unionByName(merged.select(F.lit("m").alias("_src"), F.col(key).cast("string").alias("_k"),
                                    F.col(origin).cast("string").alias("_o"))))
    m = F.col("_src") == "m"
    k = m & F.col("_k").isNotNull() & (F.col("_k") != "")
    return u.agg(
        F.count_if(F.col("_src") == "a").alias("total_search"),
        F.count_if(F.col("_src") == "b").alias("total_consulta"),
        F.count_if(k).alias("unicos_com_chave"),
        F.count_if(m & ~F.coalesce(k, F.lit(False))).alias("sem_chave"),
        F.count_if(m).alias("total_final"),
        F.count_if(k & (F.col("_o") == "search")).alias("origem_search"),
        F.count_if(k & (F.col("_o") == "consulta")).alias("origem_consulta"),
        F.count_if(k & (F.col("_o") == "ambos")).alias("origem_ambos"),
    )


# ----------------------------------------------------------------- A09/A10
def keyword_counts(hits: DataFrame, kw: str = "keyword") -> DataFrame:
    """Hits per keyword, most first (ties by keyword)."""
    return hits.groupBy(kw).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(kw))


def keyword_totals(hits: DataFrame, kw: str = "keyword") -> DataFrame:
    """Total hits and distinct matched keywords (one row)."""
    return hits.agg(F.count(F.lit(1)).alias("total_matches"),
                    F.count_distinct(F.col(kw)).alias("unique_keywords"))


# ----------------------------------------------------------------- A11
def run_counters(df: DataFrame, status: str = "status", pred: str = "relevante",
                 total: int | Column | None = None) -> DataFrame:
    """Processed, relevant, errors, skipped, remaining, percent."""
    agg = df.agg(
        F.count_if(F.col(status).isin("ok", "erro")).alias("processados"),
        F.count_if((F.col(status) == "ok") & (F.col(pred) == 1)).alias("relevantes"),
        F.count_if(F.col(status) == "erro").alias("erros"),
        F.count_if(F.col(status) == "pulado").alias("pulados"),
        F.count(F.lit(1)).alias("total"),
    )
    return agg.select("*",
                      (F.col("total") - F.col("processados") - F.col("pulados")).alias("restantes"),
                      F.round(F.try_divide((F.col("processados") + F.col("pulados")) * 100.0,
                                           F.col("total")), 2).alias("percentual"))


# ----------------------------------------------------------------- A13-A15
def binary_metrics(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Accuracy, precision, recall, F1 of the positive class (0 when
    undefined)."""
    tp = F.sum(F.when((F.col(y) == 1) & (F.col(p) == 1), 1).otherwise(0))
    fp = F.sum(F.when((F.col(y) == 0) & (F.col(p) == 1), 1).otherwise(0))
    fn = F.sum(F.when((F.col(y) == 1) & (F.col(p) == 0), 1).otherwise(0))
    ok = F.sum(F.when(F.col(y) == F.col(p), 1).otherwise(0))
    n = F.count(F.lit(1))
    a = df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), ok.alias("ok"), n.alias("n"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return a.select(F.round(F.try_divide(F.col("ok").cast("double"), F.col("n")), 6).alias("accuracy"),
                    F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
                    F.round(f1, 6).alias("f1"))


def class_report(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Per-class precision/recall/F1/support plus macro and weighted
    averages, as rows (class label as text)."""
    stats = df.select(F.col(y).alias("_y"), F.col(p).alias("_p"))
    per = (stats.select(F.explode(F.array(
        F.struct(F.col("_y").alias("c"), F.lit(1).alias("is_y"), F.lit(0).alias("is_p"),
                 (F.col("_y") == F.col("_p")).cast("int").alias("hit")),
        F.struct(F.col("_p").alias("c"), F.lit(0).alias("is_y"), F.lit(1).alias("is_p"),
                 F.lit(0).alias("hit")))).alias("e"))
           .groupBy(F.col("e.c").alias("c"))
           .agg(F.sum("e.is_y").alias("support"), F.sum("e.is_p").alias("predicted"),
                F.sum("e.hit").alias("tp")))
    pr = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    rc = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * pr * rc, pr + rc), F.lit(0.0))
    rows = per.select(F.col("c").cast("string").alias("classe"), pr.alias("precision"),
                      rc.alias("recall"), f1.alias("f1"), F.col("support").cast("bigint").alias("support"))
    w = rows
    macro = w.agg(F.lit("macro avg").alias("classe"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                  F.sum("support").cast("bigint").alias("support"))
    weighted = w.agg(F.lit("weighted avg").alias("classe"),
                     (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                     (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                     (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
                     F.sum("support").cast("bigint").alias("support"))
    out = rows.unionByName(macro).unionByName(weighted)
    return out.select("classe", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


def confusion(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """2x2 confusion matrix: one row per true class, columns p0, p1."""
    return (df.groupBy(F.col(y).alias("y_true"))
              .agg(F.count_if(F.col(p) == 0).alias("pred_0"), F.count_if(F.col(p) == 1).alias("pred_1"))
              .orderBy("y_true"))


# ----------------------------------------------------------------- O01-O05
def sort_closing(df: DataFrame, closing="dataEncerramentoProposta", pub="dataPublicacaoPncp",
                 key="numeroControlePNCP") -> DataFrame:
    """(closing, publication, key) ascending, NULL as ''."""
    return df.orderBy(*[F.coalesce(F.col(c), F.lit("")) for c in (closing, pub, key)])


def sort_premium(df: DataFrame, closing="encerramento_proposta", pub="publicacao_pncp",
                 text="objeto_compra") -> DataFrame:
    """(closing, publication, lower(text)) ascending, NULL as ''."""
    return df.orderBy(F.coalesce(F.col(closing), F.lit("")), F.coalesce(F.col(pub), F.lit("")),
                      F.lower(F.coalesce(F.col(text), F.lit(""))))


def latest_n(df: DataFrame, order: str, n: int = 5, text: str = "objeto_compra", preview: int = 80,
             cols=()) -> DataFrame:
    """Newest ``n`` rows by ``order`` desc with a text preview."""
    return (df.orderBy(F.desc(order)).limit(n)
              .select(F.col(order), *[F.col(c) for c in cols],
                      F.substring(F.col(text), 1, preview).alias("preview")))


def topk_tokens(df: DataFrame, keep, toks: str, k: int = 8) -> DataFrame:
    """The ``k`` most frequent tokens of every record (ties: first
    occurrence), one row per rank: ``keep.., tok, n, rk``.  A record is one
    row, so its tokens are counted in the row and nothing is shuffled."""
    top = df.select(*keep, F.posexplode(X.top_tokens(F.col(toks), k)).alias("pos", "x"))
    return top.select(*keep, F.col("x.t").alias("tok"), F.col("x.n").cast("bigint").alias("n"), (F.col("pos") + 1).cast("bigint").alias("rk"))


def hash_order(key, seed: int = 42) -> Column:
    """Deterministic pseudo-random order key (md5 of key and seed)."""
    return F.md5(F.concat(_c(key).cast("string"), F.lit(str(seed))))


def hash_shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Deterministic shuffle (same order in every engine)."""
    return df.orderBy(hash_order(key, seed), F.col(key))
