"""Wide notice rows: compiled code, one parse per record, narrow shuffles."""

from pyspark.sql import functions as F

from tenderlake.operators import dedupe as W
from tenderlake.operators import relevance as RV
from tenderlake.plans import REGISTRY, adapters as A, load_all, query
from tenderlake.session import HUGE_METHOD


def test_jobs_leave_methods_that_the_jvm_interprets_out(spark):
    load_all()
    seen = []

    @query("_limit_probe")
    def probe(session, sf_dir):
        seen.append(session.conf.get(HUGE_METHOD))
        return session.range(1)

    own = spark.conf.get(HUGE_METHOD)
    try:
        spark.conf.unset(HUGE_METHOD)
        REGISTRY["_limit_probe"][0](spark, "")
        spark.conf.set(HUGE_METHOD, "20000")  # the session's own limit stays
        REGISTRY["_limit_probe"][0](spark, "")
    finally:
        del REGISTRY["_limit_probe"]
        spark.conf.set(HUGE_METHOD, own)
    assert seen == ["8000", "20000"]


def test_dedupe_fallback_ships_only_the_kept_columns(spark):
    rows = [("a", 3, "k", "x" * 50), ("b", 1, "k", "y" * 50), ("c", 2, "", "z"), ("d", 4, None, "z"), ("c", 5, "", "z")]
    x = spark.createDataFrame(rows, "feed string, seq long, key string, raw string")
    whole = W.dedupe_fallback(x, ["key"], "seq")
    narrow = W.dedupe_fallback(x, ["key"], "seq", keep=["feed", "seq"])
    assert narrow.columns == ["feed", "seq", "_dedupe_key"]
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, whole.select(*narrow.columns).collect()))
    assert {r["seq"] for r in narrow.collect()} == {1, 2, 4}  # "" and NULL keys: the record itself, where they differ
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert "raw" not in plan[plan.index("min_by"):].split(")")[0]


def test_scored_rows_pass_through_as_they_came(spark):
    n = 2 * RV.SLICE_ROWS + 7
    ids = [None if i % 5 == 0 else 2 ** 53 + i for i in range(n)]
    rows = [(i, "catraca" if i is None else None if i % 3 == 0 else f"texto {i}", None if i is None else [i]) for i in ids]
    df = spark.createDataFrame(rows, "id long, t string, own array<long>").coalesce(1)
    found = RV.score(df, "t", RV.TermScorer(["catraca"], ["texto"]), batch_size=7)
    assert [tuple(r)[:3] for r in found.collect()] == rows
    assert [r["serve_para_mim"] for r in found.collect()] == [i is None for i in ids]


def test_feed_texts_are_made_in_a_projection(spark):
    d = "/root/testdata/sf0.001"
    f = A.feeds_raw(spark, d)
    plan = f._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("to_json" in line.lower() or "structstojson" in line.lower() for line in plan if "Generate explode" in line)
    for feed, own in (("search", A.search_raw), ("consulta", A.consulta_raw)):
        made = sorted(map(tuple, f.where(F.col("feed") == feed).select("ingest_seq", "raw").collect()))
        assert made and made == sorted(map(tuple, own(spark, d).collect()))
