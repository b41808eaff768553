"""Label-set, resumable-run, metric and model jobs over documents ⋈ labels
(and events for the probability rules)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as X
from ..operators import dedupe as W
from ..operators import filters as FL
from ..operators import merge as J
from ..operators import model as M
from ..operators import relevance as RV
from ..operators import summary as A
from ..session import scratch_path
from ..sources import files as SF
from ..tables import table
from . import query
from . import sqlfrag as S
from .text_jobs import DOC_NEG_TERMS, DOC_POS_TERMS


def labelled(spark, sf_dir):
    """labels ⋈ documents: doc_id, text, label (quality), lang, n_chars."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    return lab.join(d, "doc_id")


LAB_SQL = """lab AS (SELECT l.doc_id, d.text, l.quality AS label, d.lang, d.n_chars
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""


def label_text(spark, sf_dir):
    """Labels as typed in a spreadsheet: padded, doubled, split by a newline,
    out of range or missing (a derivation of every label row)."""
    lab = table(spark, sf_dir, "labels")
    q = F.col("quality").cast("string")
    k = F.col("doc_id") % 6
    t = (F.when(k == 0, F.concat(F.lit(" "), q, F.lit(" "))).when(k == 1, F.concat(q, q))
          .when(k == 2, F.concat(q, F.lit("\n"), q)).when(k == 3, F.lit("2"))
          .when(k == 4, F.lit(None).cast("string")).otherwise(q))
    return lab.select("doc_id", t.alias("label_txt"))


LABEL_TXT_SQL = """lt AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN ' ' || CAST(quality AS VARCHAR) || ' '
  WHEN 1 THEN CAST(quality AS VARCHAR) || CAST(quality AS VARCHAR)
  WHEN 2 THEN CAST(quality AS VARCHAR) || chr(10) || CAST(quality AS VARCHAR) WHEN 3 THEN '2'
  WHEN 4 THEN NULL ELSE CAST(quality AS VARCHAR) END AS label_txt FROM labels)"""


# ---------------------------------------------------------------- A01/F06/T18/P16/S05
@query("class_balance", "SELECT quality, count(*) AS quantidade FROM labels GROUP BY quality")
def q_class_balance(spark, sf_dir):
    """Class balance of the label set."""
    return A.value_counts(table(spark, sf_dir, "labels"), "quality")


@query("valid_labels", f"WITH {LABEL_TXT_SQL} SELECT doc_id, CAST(regexp_replace(label_txt, '\\s+', '', 'g') AS INTEGER) AS label "
       "FROM lt WHERE regexp_replace(label_txt, '\\s+', '', 'g') IN ('0', '1')")
def q_valid_labels(spark, sf_dir):
    """whitespace removed, only 0/1 kept."""
    return FL.valid_labels(label_text(spark, sf_dir), "label_txt", "label").select("doc_id", "label")


@query("parse_label", f"""WITH {LABEL_TXT_SQL} SELECT doc_id,
  CASE WHEN regexp_full_match(regexp_replace(label_txt, '\\s+', '', 'g'), '0+') THEN 0
       WHEN regexp_full_match(regexp_replace(label_txt, '\\s+', '', 'g'), '1+') THEN 1 END AS label FROM lt""")
def q_parse_label(spark, sf_dir):
    """T18: '0…0' -> 0, '1…1' -> 1, else NULL."""
    return label_text(spark, sf_dir).select("doc_id", X.parse_label("label_txt").alias("label"))


_EXPECTED = {"doc_id": "bigint", "texto": "string", "quality": "int", "confianca": "string", "toxic": "int"}


@query("ensure_columns", "SELECT doc_id, CAST(NULL AS VARCHAR) AS texto, quality, CAST(NULL AS VARCHAR) AS confianca, toxic FROM labels")
def q_ensure_columns(spark, sf_dir):
    """Expected columns in fixed order, missing ones NULL."""
    from ..operators.records import ensure_columns
    return ensure_columns(table(spark, sf_dir, "labels"), _EXPECTED)


@query("alias_columns", f"WITH {LAB_SQL} SELECT text, CAST(label AS VARCHAR) AS label FROM lab")
def q_alias_columns(spark, sf_dir):
    """First existing column among aliases, renamed to text/label."""
    lab = labelled(spark, sf_dir).withColumnRenamed("label", "Relevante").withColumnRenamed("text", "Objeto")
    return SF.canonical_labels(lab)


# ---------------------------------------------------------------- M03/M04/O05
@query("stratified_split", f"""WITH {LAB_SQL}, r AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) AS rk,
         count(*) OVER (PARTITION BY label) AS cnt FROM lab)
SELECT doc_id, label, rk <= ceil(cnt * 0.2) AS is_test FROM r""")
def q_stratified_split(spark, sf_dir):
    """Deterministic stratified 80/20 split."""
    return M.stratified_split(labelled(spark, sf_dir).select("doc_id", "label"), "label", "doc_id")


@query("hash_split", "SELECT doc_id, substr(md5(CAST(doc_id AS VARCHAR) || '42'), 1, 4) < '3333' AS is_test FROM documents")
def q_hash_split(spark, sf_dir):
    """Unstratified ~20 % split by md5."""
    return M.hash_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("hash_shuffle", """SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) AS ordem
FROM labels""")
def q_hash_shuffle(spark, sf_dir):
    """Deterministic shuffle (position in md5 order)."""
    lab = table(spark, sf_dir, "labels").select("doc_id").withColumn("_h", A.hash_order("doc_id", 42))
    return W.with_index(lab, ["_h", "doc_id"], "ordem").select("doc_id", "ordem")


# ---------------------------------------------------------------- J03/J04/U02/U04
@query("resume_anti", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_resume_anti(spark, sf_dir):
    """Documents not yet processed (anti-join with the id log)."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    return J.pending(d, table(spark, sf_dir, "labels"), "doc_id")


@query("done_semi", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def q_done_semi(spark, sf_dir):
    """Documents already processed (semi-join)."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    return J.already_done(d, table(spark, sf_dir, "labels"), "doc_id")


@query("todo_except", "SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels")
def q_todo_except(spark, sf_dir):
    """To-do = all - done."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    return d.exceptAll(table(spark, sf_dir, "labels").select("doc_id"))


@query("union_ids", "SELECT doc_id AS id FROM labels UNION SELECT doc_id FROM documents")
def q_union_ids(spark, sf_dir):
    """Processed ids ∪ new ids, distinct."""
    a = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    b = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return J.union_ids(a, b, "id")


# ---------------------------------------------------------------- A13-A15/F07
PRED_SQL = f"""{LAB_SQL}, pr AS (SELECT doc_id, label AS y, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS p FROM lab)"""


def predictions(spark, sf_dir):
    lab = labelled(spark, sf_dir)
    return lab.select("doc_id", F.col("label").alias("y"), (F.col("n_chars") >= 1000).cast("int").alias("p"))


@query("binary_metrics", f"""WITH {PRED_SQL}, c AS (
  SELECT sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN y = p THEN 1 ELSE 0 END) AS ok, count(*) AS n FROM pr),
m AS (SELECT ok / n AS acc, coalesce(tp / nullif(tp + fp, 0), 0.0) AS pr, coalesce(tp / nullif(tp + fn, 0), 0.0) AS rc FROM c)
SELECT round(acc, 6) AS accuracy, round(pr, 6) AS precision, round(rc, 6) AS recall,
       round(coalesce(2 * pr * rc / nullif(pr + rc, 0), 0.0), 6) AS f1 FROM m""")
def q_binary_metrics(spark, sf_dir):
    """Accuracy / precision / recall / F1."""
    return A.binary_metrics(predictions(spark, sf_dir), "y", "p")


@query("class_report", f"""WITH {PRED_SQL}, cls AS (SELECT y AS c FROM pr UNION SELECT p FROM pr),
per AS (SELECT c, (SELECT count(*) FROM pr WHERE y = c) AS support, (SELECT count(*) FROM pr WHERE p = c) AS predicted,
        (SELECT count(*) FROM pr WHERE p = c AND y = c) AS tp FROM cls),
r AS (SELECT CAST(c AS VARCHAR) AS classe, coalesce(tp / nullif(predicted, 0), 0.0) AS precision,
        coalesce(tp / nullif(support, 0), 0.0) AS recall, support FROM per),
r2 AS (SELECT classe, precision, recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1, support FROM r)
SELECT classe, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM r2
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM r2
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM r2""")
def q_class_report(spark, sf_dir):
    """Per-class report with macro and weighted averages."""
    return A.class_report(predictions(spark, sf_dir), "y", "p")


@query("confusion_matrix", f"""WITH {PRED_SQL}
SELECT y AS y_true, count(*) FILTER (WHERE p = 0) AS pred_0, count(*) FILTER (WHERE p = 1) AS pred_1 FROM pr GROUP BY y""")
def q_confusion_matrix(spark, sf_dir):
    """Confusion matrix."""
    return A.confusion(predictions(spark, sf_dir), "y", "p")


@query("relevant_only", f"WITH {PRED_SQL} SELECT doc_id, y FROM pr WHERE p = 1")
def q_relevant_only(spark, sf_dir):
    """keep predicted-relevant rows."""
    return FL.relevant(predictions(spark, sf_dir), "p").select("doc_id", "y")


# ---------------------------------------------------------------- R03-R05 (events / documents)
@query("threshold_decision", """WITH p AS (SELECT event_id, value / (SELECT max(value) FROM events) AS pr FROM events)
SELECT event_id, CASE WHEN pr >= 0.85 THEN 1 WHEN pr >= 0.40 THEN NULL ELSE 0 END AS classificacao_final,
  CASE WHEN pr >= 0.85 THEN 'relevante' WHEN pr >= 0.40 THEN 'revisar' ELSE 'nao_relevante' END AS status,
  round(1 - pr, 6) AS prob_nao_relevante, round(pr, 6) AS prob_relevante FROM p""")
def q_threshold_decision(spark, sf_dir):
    """Three-way threshold on a probability (value / max value)."""
    e = table(spark, sf_dir, "events").select("event_id", "value")
    mx = e.agg(F.max("value")).first()[0]  # one scalar
    p = F.col("value") / F.lit(mx)
    cls, st = RV.threshold_decision(p)
    return e.select("event_id", cls.alias("classificacao_final"), st.alias("status"),
                    F.round(1 - p, 6).alias("prob_nao_relevante"), F.round(p, 6).alias("prob_relevante"))


@query("review_gate", """WITH p AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS lab,
  value / (SELECT max(value) FROM events) AS conf FROM events)
SELECT event_id, CASE WHEN conf < 0.8 THEN 'validacao_humana' ELSE 'aprovado_pelo_modelo' END AS status,
  CASE WHEN conf < 0.8 THEN 'Confiança abaixo do limite mínimo de 0.80' END AS motivo,
  CASE WHEN lab = 1 THEN 'atende' ELSE 'nao_atende' END AS classificacao FROM p""")
def q_review_gate(spark, sf_dir):
    """Low-confidence results go to human validation."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    mx = e.agg(F.max("value")).first()[0]
    st, mo, cl = RV.review_gate((F.col("event_type") == "purchase").cast("int"), F.col("value") / F.lit(mx))
    return e.select("event_id", st.alias("status"), mo.alias("motivo"), cl.alias("classificacao"))


@query("hybrid_decision", f"""WITH h AS (
  SELECT doc_id, least(n_chars / 5000.0, 1.0) AS pr, {S.term_hits(S.squash_lower('text'), DOC_POS_TERMS)} AS p,
         {S.term_hits(S.squash_lower('text'), DOC_NEG_TERMS)} AS n FROM documents),
r AS (SELECT doc_id, pr, CASE WHEN len(n) > 0 AND len(p) = 0 THEN 'nao_relevante' WHEN len(p) > 0 AND len(n) = 0 THEN 'relevante'
       WHEN len(p) > 0 AND len(n) > 0 THEN 'revisar' ELSE 'sem_regra' END AS st FROM h)
SELECT doc_id,
  CASE WHEN st = 'relevante' THEN 1 WHEN st = 'nao_relevante' THEN 0 WHEN pr >= 0.85 THEN 1 WHEN pr >= 0.40 THEN NULL ELSE 0 END AS classificacao_final,
  CASE WHEN st = 'relevante' THEN 'relevante' WHEN st = 'nao_relevante' THEN 'nao_relevante' WHEN pr >= 0.85 THEN 'relevante'
       WHEN pr >= 0.40 THEN 'revisar' ELSE 'nao_relevante' END AS status_final,
  CASE WHEN st = 'relevante' THEN 'regra_forte_positiva' WHEN st = 'nao_relevante' THEN 'regra_forte_negativa'
       WHEN pr >= 0.85 THEN 'modelo_confiante' WHEN pr >= 0.40 THEN 'modelo_inseguro' ELSE 'modelo_confiante' END AS origem_decisao
FROM r""")
def q_hybrid_decision(spark, sf_dir):
    """Strong rule overrides the model probability."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    r = RV.rule_decision(d, "text", DOC_POS_TERMS, DOC_NEG_TERMS)
    p = F.least(F.col("n_chars") / F.lit(5000.0), F.lit(1.0))
    c, s, o = RV.hybrid_decision("status_regra", p)
    return r.select("doc_id", c.alias("classificacao_final"), s.alias("status_final"), o.alias("origem_decisao"))


# ---------------------------------------------------------------- R06-R08, J07, W03/W04, F08/F09, A11/A12
def doc_scorer():
    return RV.TermScorer(DOC_POS_TERMS, DOC_NEG_TERMS, category="licenca")


SCORE_SQL = f"""sc AS (
  SELECT doc_id, text, p, n, len(p) > 0 AND len(n) = 0 AS serve_para_mim FROM (
    SELECT doc_id, text, {S.term_hits(S.squash_lower('text'), DOC_POS_TERMS)} AS p,
           {S.term_hits(S.squash_lower('text'), DOC_NEG_TERMS)} AS n FROM documents)),
scored AS (
  SELECT doc_id, text, serve_para_mim,
    CASE WHEN serve_para_mim THEN 'licenca' ELSE 'fora_do_escopo' END AS categoria,
    CASE WHEN (len(p) > 0 OR len(n) > 0) AND NOT (len(p) > 0 AND len(n) > 0) THEN 'alta' ELSE 'baixa' END AS confianca,
    coalesce(nullif(array_to_string((CASE WHEN len(p) > 0 THEN p ELSE n END)[1:3], ', '), ''), 'sem termos') AS motivo
  FROM sc)"""


def scored_docs(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return RV.score(d, "text", doc_scorer(), batch_size=15)


@query("score_batches", f"WITH {SCORE_SQL} SELECT doc_id, serve_para_mim, categoria, confianca, motivo FROM scored")
def q_score_batches(spark, sf_dir):
    """Pluggable batch scorer over every document (mapInPandas)."""
    return scored_docs(spark, sf_dir).drop("text")


@query("attach_scores", f"WITH {SCORE_SQL} SELECT l.doc_id, l.quality, s.serve_para_mim FROM labels l JOIN scored s ON s.doc_id = l.doc_id")
def q_attach_scores(spark, sf_dir):
    """Scores joined back by row id (never by position)."""
    s = scored_docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), "serve_para_mim")
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), "quality")
    return J.attach_scores(lab, s, "row_id").select(F.col("row_id").alias("doc_id"), "quality", "serve_para_mim")


@query("relevance_job", f"""WITH {SCORE_SQL}
SELECT doc_id, categoria, motivo FROM scored
WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND serve_para_mim""")
def q_relevance_job(spark, sf_dir):
    """Pending (J03) -> score (R06) -> keep relevant -> insert-if-absent
    into the filtered table (here: the labelled-relevant ids)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = table(spark, sf_dir, "labels").select("doc_id")
    existing = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    new, _log = RV.run_relevance(d, done, "doc_id", "text", doc_scorer(), existing)
    return new


@query("relevance_log", f"""WITH {SCORE_SQL}
SELECT doc_id, 'ok' AS status FROM scored WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_relevance_log(spark, sf_dir):
    """The processed-id log of a run (every pending id, with status)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = table(spark, sf_dir, "labels").select("doc_id")
    _new, log = RV.run_relevance(d, done, "doc_id", "text", doc_scorer())
    return log


@query("run_counters", f"""WITH {SCORE_SQL}, st AS (
  SELECT CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'pulado' WHEN categoria = 'erro_classificacao' THEN 'erro' ELSE 'ok' END AS status,
         CASE WHEN serve_para_mim THEN 1 ELSE 0 END AS relevante FROM scored)
SELECT count(*) FILTER (WHERE status IN ('ok', 'erro')) AS processados,
  count(*) FILTER (WHERE status = 'ok' AND relevante = 1) AS relevantes, count(*) FILTER (WHERE status = 'erro') AS erros,
  count(*) FILTER (WHERE status = 'pulado') AS pulados, count(*) AS total,
  count(*) - count(*) FILTER (WHERE status IN ('ok', 'erro')) - count(*) FILTER (WHERE status = 'pulado') AS restantes,
  round(100.0 * (count(*) FILTER (WHERE status IN ('ok', 'erro')) + count(*) FILTER (WHERE status = 'pulado')) / count(*), 2) AS percentual
FROM st""")
def q_run_counters(spark, sf_dir):
    """Processed / relevant / errors / skipped / remaining / percent."""
    s = scored_docs(spark, sf_dir)
    done = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("_done"))
    x = s.join(done, "doc_id", "left").select(
        F.when(F.col("_done"), "pulado").when(F.col("categoria") == "erro_classificacao", "erro")
         .otherwise("ok").alias("status"),
        F.col("serve_para_mim").cast("int").alias("relevante"))
    return A.run_counters(x)


RAW_SQL = f"""{SCORE_SQL}, raw AS (
  SELECT doc_id, {S.squash('text')} AS texto, serve_para_mim, categoria, confianca,
    CASE WHEN doc_id % 13 = 0 THEN 'texto genérico' ELSE motivo END AS motivo FROM scored),
clean AS (
  SELECT doc_id, texto, CASE WHEN serve_para_mim THEN 1 ELSE 0 END AS label, categoria, confianca,
    lower(categoria) = 'ambiguo' OR lower(confianca) = 'baixa'
      OR {' OR '.join(f"contains(lower(motivo), {S.q(s)})" for s in fixed.AMBIGUITY_STEMS)} AS ambiguo
  FROM raw WHERE lower(texto) NOT IN ('', 'nan', 'none', 'null'))"""


def raw_results(spark, sf_dir):
    s = scored_docs(spark, sf_dir)
    return s.select("doc_id", X.squash("text").alias("texto"), "serve_para_mim", "categoria", "confianca",
                    F.when(F.col("doc_id") % 13 == 0, F.lit("texto genérico")).otherwise(F.col("motivo")).alias("motivo"))


def clean_results(spark, sf_dir, raw=None):
    r = FL.drop_null_text(raw if raw is not None else raw_results(spark, sf_dir), "texto")
    return r.select("doc_id", "texto", X.bool_label("serve_para_mim").alias("label"), "categoria", "confianca",
                    FL.is_ambiguous("categoria", "confianca", "motivo").alias("ambiguo"))


@query("ambiguous_rows", f"WITH {RAW_SQL} SELECT doc_id, ambiguo FROM clean")
def q_ambiguous_rows(spark, sf_dir):
    """ambiguity flag (category, low confidence, reason stems)."""
    return clean_results(spark, sf_dir).select("doc_id", "ambiguo")


@query("training_rows", f"WITH {RAW_SQL} SELECT doc_id, label FROM clean WHERE lower(confianca) <> 'baixa' AND NOT ambiguo AND label IN (0, 1)")
def q_training_rows(spark, sf_dir):
    """training rows (no low confidence, no ambiguity, label in {0,1})."""
    return FL.training_rows(clean_results(spark, sf_dir)).select("doc_id", "label")


@query("label_set", f"""WITH {RAW_SQL}, tr AS (SELECT * FROM clean WHERE lower(confianca) <> 'baixa' AND NOT ambiguo AND label IN (0, 1))
SELECT texto AS text, label FROM tr GROUP BY texto, label""")
def q_label_set(spark, sf_dir):
    """R08 (+W04): pseudo-label set: clean, label, flag, filter, pair dedupe."""
    return RV.build_label_set(raw_results(spark, sf_dir))


@query("run_summary", f"""WITH {RAW_SQL}, tr AS (SELECT * FROM clean WHERE lower(confianca) <> 'baixa' AND NOT ambiguo AND label IN (0, 1)),
fin AS (SELECT texto, label FROM tr GROUP BY texto, label)
SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM fin) AS final_rows,
  (SELECT count(*) FROM fin WHERE label = 1) AS final_pos, (SELECT count(*) FROM fin WHERE label = 0) AS final_neg,
  (SELECT count(*) FROM clean WHERE ambiguo) AS ambiguous_rows""")
def q_run_summary(spark, sf_dir):
    """Row counts and label distribution as one row."""
    raw = raw_results(spark, sf_dir).checkpoint()  # scored once for the three counts
    cl = clean_results(spark, sf_dir, raw)
    fin = W.dedupe_pairs(FL.training_rows(cl).select("texto", "label"), ("texto", "label"))
    u = (raw.select(F.lit("raw").alias("_s"), F.lit(None).cast("int").alias("label"), F.lit(False).alias("amb"))
         .unionByName(fin.select(F.lit("fin").alias("_s"), "label", F.lit(False).alias("amb")))
         .unionByName(cl.select(F.lit("clean").alias("_s"), F.lit(None).cast("int").alias("label"),
                                F.col("ambiguo").alias("amb"))))
    s = F.col("_s")
    return u.agg(F.count_if(s == "raw").alias("raw_rows"), F.count_if(s == "fin").alias("final_rows"),
                 F.count_if((s == "fin") & (F.col("label") == 1)).alias("final_pos"),
                 F.count_if((s == "fin") & (F.col("label") == 0)).alias("final_neg"),
                 F.count_if((s == "clean") & F.col("amb")).alias("ambiguous_rows"))


@query("dedupe_text", f"""SELECT doc_id, t AS texto FROM (SELECT doc_id, {S.squash_lower('text')} AS t FROM documents)
QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1""")
def q_dedupe_text(spark, sf_dir):
    """Exact dedupe on the normalised text, keep the first."""
    d = table(spark, sf_dir, "documents").select("doc_id", X.squash_lower("text").alias("texto"))
    return W.dedupe_text(d, "texto", "doc_id")


@query("dedupe_pairs", f"WITH {LAB_SQL} SELECT DISTINCT text, label FROM lab")
def q_dedupe_pairs(spark, sf_dir):
    """Pair dedupe."""
    return W.dedupe_pairs(labelled(spark, sf_dir).select("text", "label"), ("text", "label"))


@query("ntile_slices", """SELECT doc_id, ntile(4) OVER (ORDER BY doc_id) - 1 AS slice FROM documents""")
def q_ntile_slices(spark, sf_dir):
    """Four contiguous slices, the first total % 4 one row larger."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    return W.slices(d, 4, ["doc_id"]).select("doc_id", "slice")


@query("fixed_batches", """SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 15 AS batch_id FROM documents""")
def q_fixed_batches(spark, sf_dir):
    """Batches of 15 in id order."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    return W.batches(d, 15, ["doc_id"]).select("doc_id", "batch_id")


@query("running_progress", """SELECT event_id, row_number() OVER (ORDER BY event_id) AS done,
  round(row_number() OVER (ORDER BY event_id) * 100.0 / count(*) OVER (), 2) AS pct FROM events""")
def q_running_progress(spark, sf_dir):
    """Running count and percent done."""
    e = table(spark, sf_dir, "events").select("event_id")
    return W.progress(e, ["event_id"]).select("event_id", "done", "pct")


# ---------------------------------------------------------------- T19
def responses(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    q = F.col("quality").cast("string")
    k = F.col("doc_id") % 6
    body = (F.when(k == 0, F.concat(F.lit('```json\n{"relevante": '), q, F.lit(', "categoria": "cftv", "motivo": "ok"}\n```')))
             .when(k == 1, F.concat(F.lit('{"relevante": "'), q, F.lit('", "categoria": "xyz"}')))
             .when(k == 2, F.concat(F.lit('{"relevante": '), F.when(F.col("quality") == 1, "true").otherwise("false"), F.lit('}')))
             .when(k == 3, F.concat(F.lit('{"relevante": '), q, F.lit('.9, "motivo": "doc"}')))
             .when(k == 4, F.lit('{"relevante": null}'))
             .otherwise(F.lit("oops")))
    return lab.select("doc_id", body.alias("resposta"))


@query("parse_response", """WITH r AS (SELECT doc_id, quality, doc_id % 6 AS k FROM labels)
SELECT doc_id,
  CASE k WHEN 0 THEN quality WHEN 1 THEN quality WHEN 2 THEN quality WHEN 3 THEN quality ELSE 0 END AS relevante,
  CASE k WHEN 0 THEN 'cftv' END AS categoria,
  CASE k WHEN 0 THEN 'ok' WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN 'doc' ELSE NULL END AS motivo,
  k < 4 AS ok FROM r""")
def q_parse_response(spark, sf_dir):
    """Classifier responses (fenced, string, bool, float, null, junk)."""
    r = responses(spark, sf_dir)
    p = X.parse_response("resposta")
    return r.select("doc_id", p.relevante.alias("relevante"), p.categoria.alias("categoria"),
                    F.when(p.ok, p.motivo).alias("motivo"), p.ok.alias("ok"))


# ---------------------------------------------------------------- M06
@query("softmax_argmax", """WITH l AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, list_max(CAST(embedding AS DOUBLE[])) AS mx FROM embeddings),
m AS (SELECT vec_id, list_position(v, mx) - 1 AS label, list_transform(v, lambda x: exp(x - mx)) AS e FROM l)
SELECT vec_id, CAST(label AS INTEGER) AS label, round(1 / list_sum(e), 6) AS confidence,
  round(e[1] / list_sum(e), 6) AS p_first, round(e[len(e)] / list_sum(e), 6) AS p_last FROM m""")
def q_softmax_argmax(spark, sf_dir):
    """Softmax + arg-max over all embedding dimensions as logits."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("logits"))
    lab, conf, probs = M.softmax_argmax(F.col("logits"))
    return e.select("vec_id", lab.alias("label"), F.round(conf, 6).alias("confidence"),
                    F.round(F.element_at(probs, 1), 6).alias("p_first"), F.round(F.element_at(probs, -1), 6).alias("p_last"))


# ---------------------------------------------------------------- M01/M02/M05
TFIDF_SQL = f"""c AS (SELECT doc_id, {S.clean_text('text', fixed.CLEANER_STOPWORDS)} AS clean FROM documents),
t AS (SELECT doc_id, list_filter(string_split(clean, ' '), lambda x: length(x) >= 2) AS toks FROM c),
g AS (SELECT doc_id, unnest(toks) AS term FROM t
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])) FROM t),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL),
st AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term),
v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM st ORDER BY total DESC, term LIMIT 1000),
w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN v USING (term))"""


def clean_docs(spark, sf_dir):
    # the cleaned corpus feeds the vocabulary fit and the weights: clean once
    return table(spark, sf_dir, "documents").select("doc_id", X.clean_text("text").alias("clean")).checkpoint()


@query("tfidf_weights", f"""WITH {TFIDF_SQL}
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_tfidf_weights(spark, sf_dir):
    """TF-IDF weights (1-2-grams, top 1000, smooth idf, L2)."""
    d = clean_docs(spark, sf_dir)
    w = M.tfidf(d, "doc_id", "clean", M.fit_vocab(d, "doc_id", "clean", 1000))
    return w.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def _fit(spark, sf_dir):
    """Split the labelled documents, fit the vocabulary and the model on the
    training rows only."""
    d = clean_docs(spark, sf_dir)
    lab = labelled(spark, sf_dir).select("doc_id", "label")
    split = M.stratified_split(lab, "label", "doc_id").join(d, "doc_id").checkpoint()
    vocab = M.fit_vocab(split.where(~F.col("is_test")), "doc_id", "clean", 1000)
    # Materialise the featurised label set in the shared checkpoint folder:
    # the optimiser makes many passes, none of which should redo the text work.
    # A fixed layout (range partitions sorted by id, sized by AQE from the
    # data) makes the optimiser's tree aggregation -- and so the model --
    # the same on every run, and keeps per-iteration task counts small.
    data = (M.to_features(split, "clean", vocab).repartitionByRange("doc_id").sortWithinPartitions("doc_id").checkpoint())
    model = M.train_linear(data.where(~F.col("is_test")), "features", "label", max_iter=100)
    return model, vocab, data, d


@query("train_linear")
def q_train_linear(spark, sf_dir):
    """Linear hinge-loss classifier on TF-IDF; test-split predictions
    (rows-only: iterative optimiser, no SQL form)."""
    model, _vocab, data, _ = _fit(spark, sf_dir)
    test = data.where(F.col("is_test"))
    return model.transform(test).select("doc_id", "label", F.col("prediction").cast("int").alias("pred"))


@query("train_linear_margins", f"""WITH {LAB_SQL}
SELECT count(*) AS documentos, CAST(0 AS BIGINT) AS diferentes FROM lab""")
def q_train_linear_margins(spark, sf_dir):
    """The model's margins against sums of its coefficients over the
    weights of M01 (joined on the term): documents, and how many differ."""
    model, vocab, data, _ = _fit(spark, sf_dir)
    coef = spark.createDataFrame([(i, float(c)) for i, c in enumerate(model.coefficients)], "idx int, coef double")
    w = M.tfidf(data.select("doc_id", "clean"), "doc_id", "clean", vocab).join(F.broadcast(coef), "idx")
    own = w.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("coef")).alias("s"))
    said = model.transform(data).select("doc_id", vector_to_array("rawPrediction")[1].alias("m"))
    diff = F.abs(F.col("m") - F.coalesce("s", F.lit(0.0)) - F.lit(float(model.intercept))) > 1e-6
    return said.join(own, "doc_id", "left").agg(F.count("*").alias("documentos"), F.count_if(diff).alias("diferentes"))


def _saved(spark, model, vocab):
    path = scratch_path(spark, "model")
    M.save_model(model, vocab, path)
    return M.load_model(spark, path)


@query("score_table")
def q_score_table(spark, sf_dir):
    """Save model + vocabulary to shared storage, load them back and
    score every document; keep the predicted-relevant ones (rows-only)."""
    model, vocab, _, d = _fit(spark, sf_dir)
    s = M.score_table(d, *_saved(spark, model, vocab), "doc_id", "clean")
    return FL.relevant(s, "relevante_pred")


@query("score_table_reload", "SELECT count(*) AS documentos, CAST(0 AS BIGINT) AS diferentes FROM documents")
def q_score_table_reload(spark, sf_dir):
    """Documents, and how many get another prediction from the reloaded model."""
    model, vocab, _, d = _fit(spark, sf_dir)
    one = M.score_table(d, model, vocab, "doc_id", "clean", "a")
    two = M.score_table(d, *_saved(spark, model, vocab), "doc_id", "clean", "b")
    return one.join(two, "doc_id").agg(F.count("*").alias("documentos"), F.count_if(F.col("a") != F.col("b")).alias("diferentes"))
