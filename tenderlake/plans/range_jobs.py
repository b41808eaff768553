"""Date windows, adaptive range bisection and request predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as FL
from ..operators import ranges as RG
from ..tables import table
from . import query
from .adapters import NOTICES_SQL, notices, with_ctes

def date_bounds(df, col):
    """First and last day of a table, as text."""
    lo, hi = df.agg(F.min(F.to_date(col)).cast("string"), F.max(F.to_date(col)).cast("string")).first()
    return lo, hi


_EV_LO, _EV_HI = "(SELECT min(CAST(ts AS DATE)) FROM events)", "(SELECT max(CAST(ts AS DATE)) FROM events)"


@query("date_windows", f"""WITH b AS (SELECT {_EV_LO} AS lo, {_EV_HI} AS hi),
w AS (SELECT unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 7 DAY))::DATE AS inicio, hi FROM b)
SELECT w.inicio, least(w.inicio + 6, w.hi) AS fim, count(e.event_id) AS eventos
FROM w LEFT JOIN events e ON CAST(e.ts AS DATE) BETWEEN w.inicio AND least(w.inicio + 6, w.hi)
GROUP BY ALL""")
def q_date_windows(spark, sf_dir):
    """7-day windows over the event period (end inclusive) and the
    events each one holds (rows assigned by arithmetic, no range join)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    lo, hi = date_bounds(ev, "ts")
    w = RG.date_windows(spark, lo, hi, 7)
    e = RG.assign_windows(ev, "ts", lo, hi, 7)
    c = e.groupBy("inicio").agg(F.count(F.lit(1)).alias("eventos"))
    return w.join(c, "inicio", "left").select("inicio", "fim", F.coalesce("eventos", F.lit(0)).alias("eventos"))


_BISECT_SQL = """WITH RECURSIVE daily AS (SELECT {g_sel} CAST({d} AS DATE) AS dia, count(*) AS n FROM {src} GROUP BY ALL),
starts AS (SELECT DISTINCT {g_sel} {lo} AS lo, {hi} AS hi, 0 AS depth FROM daily),
r AS (
  SELECT * FROM starts
  UNION ALL
  SELECT {g_x} CASE WHEN s = 0 THEN x.lo ELSE x.mid + 1 END, CASE WHEN s = 0 THEN x.mid ELSE x.hi END, x.depth + 1
  FROM (SELECT r.*, r.lo + CAST(floor((r.hi - r.lo) / 2) AS INTEGER) AS mid,
          (SELECT coalesce(sum(n), 0) FROM daily WHERE {g_join} dia BETWEEN r.lo AND r.hi) AS cnt FROM r) x
  CROSS JOIN (VALUES (0), (1)) v(s)
  WHERE x.cnt >= {cap} AND x.depth < {md} AND x.hi > x.lo
),
c AS (SELECT r.*, CAST((SELECT coalesce(sum(n), 0) FROM daily WHERE {g_join} dia BETWEEN r.lo AND r.hi) AS BIGINT) AS n FROM r)
SELECT {g_sel} lo, hi, depth, n, n >= {cap} AS overflow FROM c WHERE NOT (n >= {cap} AND depth < {md} AND hi > lo)"""


@query("bisect_ranges", _BISECT_SQL.format(g_sel="", g_x="", g_join="", d="ts", src="events",
                                           lo=_EV_LO, hi=_EV_HI, cap=1000, md=6))
def q_bisect_ranges(spark, sf_dir):
    """Adaptive date bisection of the event period, cap 1000 rows."""
    ev = table(spark, sf_dir, "events")
    out = RG.bisect_ranges(RG.daily_counts(ev, "ts"), *date_bounds(ev, "ts"), 1000, 6)
    return out.select("lo", "hi", "depth", "n", "overflow")


_N_LO, _N_HI = (f"(SELECT {f}(CAST(dataPublicacaoPncp AS DATE)) FROM notices)" for f in ("min", "max"))

_STATE_SQL = (with_ctes(NOTICES_SQL) + _BISECT_SQL.replace("WITH RECURSIVE ", ", ").format(
    g_sel="uf_sigla,", g_x="x.uf_sigla,", g_join="daily.uf_sigla = r.uf_sigla AND",
    d="dataPublicacaoPncp", src="notices", lo=_N_LO, hi=_N_HI, cap=100, md=6)).replace("WITH ", "WITH RECURSIVE ", 1)


def _by_state(spark, sf_dir):
    return notices(spark, sf_dir).select("uf_sigla", "numeroControlePNCP", "dataPublicacaoPncp", "ingest_seq")


@query("collect_by_state", _STATE_SQL)
def q_collect_by_state(spark, sf_dir):
    """Per-state adaptive ranges over the publication dates, cap 100."""
    n = _by_state(spark, sf_dir)
    out = RG.state_ranges(n, "dataPublicacaoPncp", "uf_sigla", *date_bounds(n, "dataPublicacaoPncp"), 100, 6)
    return out.select("uf_sigla", "lo", "hi", "depth", "n", "overflow")


# every second notice is listed again by another state a day later
_TWICE_SQL = """twice AS (
  SELECT uf_sigla, numeroControlePNCP, CAST(dataPublicacaoPncp AS DATE) AS dia FROM notices
  UNION ALL SELECT 'ZZ', numeroControlePNCP, CAST(dataPublicacaoPncp AS DATE) + 1 FROM notices WHERE ingest_seq % 2 = 0)"""


@query("collect_by_state_rows", with_ctes(NOTICES_SQL, _TWICE_SQL) + """
SELECT numeroControlePNCP, uf_sigla, dia FROM twice WHERE numeroControlePNCP IS NULL
UNION ALL
SELECT numeroControlePNCP, arg_min(uf_sigla, (dia, uf_sigla)), min(dia) FROM twice
WHERE numeroControlePNCP IS NOT NULL GROUP BY numeroControlePNCP""")
def q_collect_by_state_rows(spark, sf_dir):
    """The notices that the ranges deliver, unique by key across states."""
    n = _by_state(spark, sf_dir).withColumn("dia", F.to_date("dataPublicacaoPncp"))
    again = n.where(F.col("ingest_seq") % 2 == 0).withColumn("uf_sigla", F.lit("ZZ")).withColumn("dia", F.date_add("dia", 1))
    both = n.unionByName(again).select("uf_sigla", "numeroControlePNCP", "dia")
    out = RG.collect_by_state(both, "dia", "numeroControlePNCP", "uf_sigla", *date_bounds(both, "dia"), 100, 6)
    return out.select("numeroControlePNCP", "uf_sigla", "dia")


@query("request_predicate", with_ctes(NOTICES_SQL) + """
SELECT ingest_seq, numeroControlePNCP FROM notices
WHERE replace(substr(dataPublicacaoPncp, 1, 10), '-', '') BETWEEN '19960101' AND '19961231'
  AND modalidadeId IN (1, 2) AND uf_sigla IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5')
  AND situacaoCompraNome IN ('O', 'P') AND contains(lower(objetoCompra), 'widget')""")
def q_request_predicate(spark, sf_dir):
    """F03 (publicacao mode): period, modalities, states, status and free text."""
    n = notices(spark, sf_dir)
    s = FL.select_notices(n, "publicacao", "19960101", "19961231", modality=[1, 2],
                          ufs=[f"NATION_{i}" for i in range(1, 6)], status=["O", "P"], q="widget")
    return s.select("ingest_seq", "numeroControlePNCP")


@query("request_open", with_ctes(NOTICES_SQL) + """
SELECT ingest_seq FROM notices
WHERE replace(substr(dataEncerramentoProposta, 1, 10), '-', '') >= '20010601' AND modalidadeId = 3""")
def q_request_open(spark, sf_dir):
    """F03 (proposta mode): still receiving proposals on the date, one modality."""
    n = notices(spark, sf_dir)
    return FL.select_notices(n, "proposta", fim="20010601", modality=3).select("ingest_seq")


@query("date_range", with_ctes(NOTICES_SQL) + """
SELECT ingest_seq FROM (SELECT ingest_seq, CASE WHEN ingest_seq % 13 = 0 THEN 'n/a' ELSE dataPublicacaoPncp END AS d FROM notices)
WHERE try_strptime(d, '%Y-%m-%dT%H:%M:%S') BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-06-30 00:00:00'""")
def q_date_range(spark, sf_dir):
    """coerced dates within [lo, hi] (hi = midnight); bad dates excluded."""
    n = notices(spark, sf_dir).select("ingest_seq", F.when(F.col("ingest_seq") % 13 == 0, F.lit("n/a"))
                                      .otherwise(F.col("dataPublicacaoPncp")).alias("d"))
    return FL.filter_dates(n, "d", "1996-01-01 00:00:00", "1996-06-30 00:00:00").select("ingest_seq")
