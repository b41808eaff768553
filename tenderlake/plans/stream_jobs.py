"""Streaming jobs: landed page files processed with ``availableNow`` triggers.

Files are landed by appends, one after another, below the shared checkpoint folder; each stream keeps its
checkpoint there too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import keyed
from ..streaming import ingest as ST
from ..tables import table
from . import query
from .label_jobs import SCORE_SQL, doc_scorer

LANDINGS = 3  # appends, one after another, that the days present are dealt over in order
PAGE_EVENTS = 500


def _land_event_pages(spark, sf_dir, path, again_days: int = 0):
    """Page documents of at most PAGE_EVENTS events (a page never spans two
    days), landed by ``LANDINGS`` appends in day order; the first
    ``again_days`` days are landed once more at the end."""
    e = table(spark, sf_dir, "events")
    rec = F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value"))
    day = F.to_date("ts")
    first, last = e.agg(F.min(day), F.max(day)).first()
    pages = (e.groupBy(day.alias("dia"), F.floor(F.col("event_id") / PAGE_EVENTS).alias("_pg"))
              .agg(F.array_sort(F.collect_list(F.struct("event_id", rec.alias("j")))).alias("_l")))
    doc = F.concat(F.lit('{"data":['), F.array_join(F.transform("_l", lambda x: x["j"]), ","),
                   F.lit('],"numeroPagina":'), F.date_format("dia", "yyyyMMdd"), F.lit("}"))
    place = F.floor(F.datediff("dia", F.lit(first)) * LANDINGS / ((last - first).days + 1))
    parts = [place == k for k in range(LANDINGS)]
    if again_days:
        parts.append(F.datediff("dia", F.lit(first)) < again_days)
    for part in parts:
        pages.where(part).select(doc.alias("value")).write.mode("append").text(path)


def _records(sdf):
    r = F.from_json("raw", "event_id long, user_id long")
    return sdf.select(r.alias("r")).select("r.event_id", "r.user_id")


def _await(q):
    q.awaitTermination()
    if q.exception():
        raise q.exception()


@query("stream_ingest", "SELECT event_id, user_id FROM events")
def q_stream_ingest(spark, sf_dir):
    """ST1: landed event pages -> records, incremental (availableNow)."""
    land, out, ck = (scratch_path(spark, n) for n in ("ev_land", "ev_out", "ev_ck"))
    _land_event_pages(spark, sf_dir, land)
    sdf = _records(ST.stream_pages(spark, land, "events"))
    _await(ST.run_to_sink(sdf, out, ck))
    return spark.read.parquet(out)


@query("stream_dedupe", "SELECT event_id FROM events")
def q_stream_dedupe(spark, sf_dir):
    """ST2: pages landed twice (days 1-5 re-sent) -> each id once."""
    land, out, ck = (scratch_path(spark, n) for n in ("dd_land", "dd_out", "dd_ck"))
    _land_event_pages(spark, sf_dir, land, again_days=5)
    sdf = ST.stream_dedupe(_records(ST.stream_pages(spark, land, "events")), "event_id")
    _await(ST.run_to_sink(sdf.select("event_id"), out, ck))
    return spark.read.parquet(out)


@query("stream_dedupe_bounded", """WITH d AS (SELECT min(CAST(ts AS DATE)) AS first FROM events)
SELECT event_id FROM events, d WHERE NOT (CAST(ts AS DATE) < first + 5 AND event_id % 10 = 0)""")
def q_stream_dedupe_bounded(spark, sf_dir):
    """ST2 with a watermark of ten days: the last landing brings days 1-5 again,
    with a tenth of their events that never came before, and the last five days
    again.  The old days are too late, new or not; the last days are repeats."""
    land, out, ck = (scratch_path(spark, n) for n in ("db_land", "db_out", "db_ck"))
    e = table(spark, sf_dir, "events")
    first, last = e.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    day, span = F.datediff(F.to_date("ts"), F.lit(first)), (last - first).days + 1
    held = (day < 5) & (F.col("event_id") % 10 == 0)
    landings = [e.where((F.floor(day * LANDINGS / span) == k) & ~held) for k in range(LANDINGS)]
    landings.append(e.where((day < 5) | (day >= span - 5)))
    for rows in landings:
        rows.select("event_id", "ts").write.mode("append").parquet(land)
        sdf = spark.readStream.schema("event_id long, ts timestamp").parquet(land)
        _await(ST.run_to_sink(ST.stream_dedupe(sdf, "event_id", ("ts", "10 days")).select("event_id"), out, ck))
    return spark.read.parquet(out)


@query("stream_upsert", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def q_stream_upsert(spark, sf_dir):
    """ST3: streaming insert-if-absent by user: the first event per user wins
    across micro-batches."""
    land, out, ck = (scratch_path(spark, n) for n in ("up_land", "up_out", "up_ck"))
    _land_event_pages(spark, sf_dir, land)
    sdf = _records(ST.stream_pages(spark, land, "events"))
    _await(ST.stream_upsert(sdf, out, "user_id", "event_id", ck, mode="insert"))
    return keyed.read(spark, out).select("user_id", "event_id")


@query("stream_latest", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def q_stream_latest(spark, sf_dir):
    """ST3: streaming latest-wins table by user."""
    land, out, ck = (scratch_path(spark, n) for n in ("lt_land", "lt_out", "lt_ck"))
    _land_event_pages(spark, sf_dir, land)
    sdf = _records(ST.stream_pages(spark, land, "events"))
    _await(ST.stream_upsert(sdf, out, "user_id", "event_id", ck, mode="latest"))
    return keyed.read(spark, out).select("user_id", "event_id")


def _classified(spark, sf_dir):
    """Run ST4 over landed document pages, the second landing after the first run; the output folder."""
    land, out, ck = (scratch_path(spark, n) for n in ("cl_land", "cl_out", "cl_ck"))
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    rec = F.to_json(F.struct("doc_id", "text"))
    pages = (d.groupBy(F.floor(F.col("doc_id") / 50).alias("pg"))   # pages of at most 50 documents
              .agg(F.array_sort(F.collect_list(F.struct("doc_id", rec.alias("j")))).alias("_l")))
    doc = F.concat(F.lit("["), F.array_join(F.transform("_l", lambda x: x["j"]), ","), F.lit("]"))
    pages = pages.select("pg", doc.alias("value"))
    pages.where(F.col("pg") % 2 == 0).select("value").write.text(land)

    def run():
        sdf = ST.stream_pages(spark, land, "documents").select(F.from_json("raw", "doc_id long, text string").alias("r")).select("r.*")
        _await(ST.stream_relevance(sdf, out, "doc_id", "text", doc_scorer(), ck))

    run()
    pages.select("value").write.mode("append").text(land)  # the even pages once more: no id is scored twice
    run()
    return out


@query("stream_classify", f"WITH {SCORE_SQL} SELECT doc_id, categoria FROM scored WHERE serve_para_mim")
def q_stream_classify(spark, sf_dir):
    """ST4: resumable classification over landed document pages."""
    return spark.read.parquet(_classified(spark, sf_dir)).select("doc_id", "categoria")


@query("stream_processed_log", f"WITH {SCORE_SQL} SELECT doc_id, 'ok' AS status FROM scored")
def q_stream_processed_log(spark, sf_dir):
    """ST4: the log of processed ids has every id once, relevant or not,
    though half of the pages were landed twice."""
    return spark.read.parquet(ST.processed_log(_classified(spark, sf_dir))).select("doc_id", "status")
