"""Relevance decisions: rules, regex dictionaries, thresholds, scorers.

Rules and thresholds are native ``when`` chains.  The pluggable batch scorer
(R06) is the only Python on the data path: a
``mapInArrow`` that hands each task's rows to the scorer in micro-batches.
"""

from __future__ import annotations

from typing import Iterable, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import fixed, lexicon
from ..functions import text as X


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def term_hits(t: Column, terms, boundary: bool = False) -> Column:
    """Terms contained in ``t`` (dictionary order); ``boundary`` requires
    word boundaries instead of plain substrings."""
    return lexicon.found_terms(t, terms, lambda term: boundary)


# ----------------------------------------------------------------- R01
def rule_decision(df: DataFrame, text: str, pos=None, neg=None, boundary: bool = False) -> DataFrame:
    """Strong-term rule on the squashed lower-case text.

    only negatives -> 0 / nao_relevante; only positives -> 1 / relevante;
    both -> revisar (conflict); none -> sem_regra.
    """
    pos = fixed.STRONG_POSITIVE_TERMS if pos is None else pos
    neg = fixed.STRONG_NEGATIVE_TERMS if neg is None else neg
    t = X.squash_lower(_c(text))
    x = df.withColumn("_p", term_hits(t, pos, boundary)).withColumn("_n", term_hits(t, neg, boundary))
    p, n = F.size("_p") > 0, F.size("_n") > 0
    j = lambda a, k: F.array_join(F.slice(F.col(a), 1, k), ", ")
    return (x.withColumn("classe_regra", F.when(n & ~p, F.lit(0)).when(p & ~n, F.lit(1)).otherwise(F.lit(None).cast("int")))
             .withColumn("status_regra", F.when(n & ~p, "nao_relevante").when(p & ~n, "relevante")
                         .when(p & n, "revisar").otherwise("sem_regra"))
             .withColumn("motivo_regra", F.when(n & ~p, F.concat(F.lit("Termos negativos fortes encontrados: "), j("_n", 5)))
                         .when(p & ~n, F.concat(F.lit("Termos positivos fortes encontrados: "), j("_p", 5)))
                         .when(p & n, F.concat(F.lit("Conflito entre termos positivos ("), j("_p", 3),
                                               F.lit(") e negativos ("), j("_n", 3), F.lit(")")))
                         .otherwise(F.lit("Nenhuma regra forte acionada")))
             .drop("_p", "_n"))


# ----------------------------------------------------------------- R02
def regex_decision(df: DataFrame, text: str, pos=None, neg=None) -> DataFrame:
    """Named regex dictionaries on the squashed lower-case text; no hit
    or a conflict -> revisar."""
    pos = fixed.POSITIVE_PATTERNS if pos is None else pos
    neg = fixed.NEGATIVE_PATTERNS if neg is None else neg
    t = X.squash_lower(_c(text))
    x = df.withColumn("_p", X.regex_hits(t, pos)).withColumn("_n", X.regex_hits(t, neg))
    p, n = F.size("_p") > 0, F.size("_n") > 0
    j = lambda a, k: F.array_join(F.slice(F.col(a), 1, k), ", ")
    return (x.withColumn("classificacao_final", F.when(p & ~n, F.lit(1)).when(n & ~p, F.lit(0)).otherwise(F.lit(None).cast("int")))
             .withColumn("status_final", F.when(p & ~n, "relevante").when(n & ~p, "nao_relevante")
                         .otherwise("revisar"))
             .withColumn("termos_positivos_batidos", F.when(p, j("_p", 10)).otherwise(""))
             .withColumn("termos_negativos_batidos", F.when(n, j("_n", 10)).otherwise(""))
             .withColumn("motivo", F.when(p & ~n, F.concat(F.lit("Padrões positivos encontrados: "), j("_p", 5)))
                         .when(n & ~p, F.concat(F.lit("Padrões negativos encontrados: "), j("_n", 5)))
                         .when(p & n, F.lit("Conflito entre padrões positivos e negativos"))
                         .otherwise(F.lit("Nenhum padrão forte encontrado")))
             .drop("_p", "_n"))


# ----------------------------------------------------------------- R03-R05
def threshold_decision(p, hi: float = fixed.THRESHOLD_RELEVANT, lo: float = fixed.THRESHOLD_REVIEW):
    """(classificacao, status) from the relevant-class probability."""
    x = _c(p)
    cls = F.when(x >= hi, F.lit(1)).when(x >= lo, F.lit(None).cast("int")).otherwise(F.lit(0))
    st = F.when(x >= hi, F.lit("relevante")).when(x >= lo, F.lit("revisar")).otherwise(F.lit("nao_relevante"))
    return cls, st


def hybrid_decision(rule_status, p, hi: float = fixed.THRESHOLD_RELEVANT,
                    lo: float = fixed.THRESHOLD_REVIEW):
    """A strong rule overrides the model, else thresholds.  Returns
    (classificacao, status, origem)."""
    r, x = _c(rule_status), _c(p)
    cls = (F.when(r == "relevante", F.lit(1)).when(r == "nao_relevante", F.lit(0))
            .when(x >= hi, F.lit(1)).when(x >= lo, F.lit(None).cast("int")).otherwise(F.lit(0)))
    st = (F.when(r == "relevante", F.lit("relevante")).when(r == "nao_relevante", F.lit("nao_relevante"))
           .when(x >= hi, F.lit("relevante")).when(x >= lo, F.lit("revisar")).otherwise(F.lit("nao_relevante")))
    org = (F.when(r == "relevante", F.lit("regra_forte_positiva"))
            .when(r == "nao_relevante", F.lit("regra_forte_negativa"))
            .when(x >= hi, F.lit("modelo_confiante")).when(x >= lo, F.lit("modelo_inseguro"))
            .otherwise(F.lit("modelo_confiante")))
    return cls, st, org


def review_gate(label, conf, lim: float = fixed.REVIEW_CONFIDENCE):
    """(status, motivo, classificacao): confidence below ``lim`` ->
    human validation."""
    lab, c = _c(label), _c(conf).cast("double")
    low = c < lim
    status = F.when(low, F.lit("validacao_humana")).otherwise(F.lit("aprovado_pelo_modelo"))
    motivo = F.when(low, F.lit(f"Confiança abaixo do limite mínimo de {lim:.2f}"))
    cls = F.when(lab == 1, F.lit("atende")).otherwise(F.lit("nao_atende"))
    return status, motivo, cls


# ----------------------------------------------------------------- R06
SCORE_SCHEMA = T.StructType([
    T.StructField("serve_para_mim", T.BooleanType()),
    T.StructField("categoria", T.StringType()),
    T.StructField("confianca", T.StringType()),
    T.StructField("motivo", T.StringType()),
])
SLICE_ROWS = 600
FALLBACK = {"serve_para_mim": False, "categoria": "erro_classificacao", "confianca": "baixa",
            "motivo": "erro_classificacao"}


class Scorer(Protocol):
    """Batch scorer: one result dict per input text, same order."""

    def classify(self, texts: list[str]) -> list[dict]: ...


class TermScorer:
    """Rule scorer (no network): positive/negative terms on the lower-cased
    text, same decision as R01 -- usable wherever a model scorer is."""

    def __init__(self, pos=None, neg=None, category: str = "controle_acesso"):
        self.pos = [t.lower() for t in (fixed.STRONG_POSITIVE_TERMS if pos is None else pos)]
        self.neg = [t.lower() for t in (fixed.STRONG_NEGATIVE_TERMS if neg is None else neg)]
        self.category = category

    def classify(self, texts: list[str]) -> list[dict]:
        out = []
        for t in texts:
            s = " ".join(str(t or "").split()).lower()
            p = [k for k in self.pos if k in s]
            n = [k for k in self.neg if k in s]
            ok = bool(p) and not n
            out.append({"serve_para_mim": ok,
                        "categoria": self.category if ok else "fora_do_escopo",
                        "confianca": "alta" if (p or n) and not (p and n) else "baixa",
                        "motivo": ", ".join((p or n)[:3]) or "sem termos"})
        return out


_SCORERS = {"terms": TermScorer}


def get_scorer(name: str = "terms", **kw) -> Scorer:
    """Scorer registry (R06): build a scorer by name."""
    return _SCORERS[name](**kw)


def _score_batches(texts: list, scorer: Scorer, batch_size: int) -> list[dict]:
    out: list[dict] = []
    for i in range(0, len(texts), batch_size):
        chunk = texts[i:i + batch_size]
        try:
            res = scorer.classify(chunk)
            if not isinstance(res, list) or len(res) != len(chunk):
                raise ValueError("scorer returned a different number of results")
        except Exception:  # noqa: BLE001 - any scorer failure degrades per row
            res = [dict(FALLBACK) for _ in chunk]
        out.extend(res)
    return out


def score(df: DataFrame, text: str, scorer: Scorer | str = "terms", batch_size: int = 15,
          keep=None) -> DataFrame:
    """Score every row with a pluggable batch scorer.

    Runs as ``mapInArrow`` (one scorer per task); an Arrow batch is worked in
    slices of ``SLICE_ROWS`` rows or so, and only a slice's texts become Python
    objects, while its columns pass through as they came.  The
    scorer sees micro-batches of ``batch_size`` texts and must return one
    result per text -- otherwise (or on an exception) that micro-batch gets
    the fallback result (``False``, ``erro_classificacao``, ``baixa``).
    Results are attached to their own row inside the batch (never by
    position across batches).
    """
    sc = get_scorer(scorer) if isinstance(scorer, str) else scorer
    keep = list(df.columns) if keep is None else list(keep)
    in_schema = df.select(*keep).schema
    out_schema = T.StructType(list(in_schema.fields) + list(SCORE_SCHEMA.fields))

    step = batch_size * max(1, SLICE_ROWS // batch_size)  # whole micro-batches
    types = [(f.name, to_arrow_type(f.dataType)) for f in SCORE_SCHEMA.fields]

    def run(it: Iterable[pa.RecordBatch]):
        for batch in it:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                res = _score_batches(part.column(text).to_pylist(), sc, batch_size)
                made = [pa.array([r.get(n) for r in res], t, from_pandas=True) for n, t in types]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *(n for n, _ in types)])

    cols = list(dict.fromkeys(keep + [text]))
    src = df.select(*cols)
    if text not in keep:
        out_schema = T.StructType(list(src.schema.fields) + list(SCORE_SCHEMA.fields))
    return src.mapInArrow(run, out_schema)


# ----------------------------------------------------------------- R07
def run_relevance(df: DataFrame, done: DataFrame, key: str, text: str, scorer: Scorer | str = "terms",
                  existing: DataFrame | None = None, batch_size: int = 15):
    """Resumable relevance job.

    pending rows (J03 against the processed-id log) -> score (R06) -> the
    relevant ones inserted into the filtered table if absent (K01) -> every
    scored id logged with its status (``ok`` or ``erro``; errors are logged
    too and not retried, as in the reference).  Returns
    ``(new_filtered_rows, log_rows)``; callers append both.
    """
    from ..sources.sinks import insert_if_absent
    from .merge import pending
    todo = pending(df, done, key)
    # both outputs come from one materialised scoring: a scorer is never asked twice
    s = score(todo.select(key, text), text, scorer, batch_size).drop(text).checkpoint()
    rel = s.where("serve_para_mim").select(key, "categoria", "motivo")
    new = insert_if_absent(existing if existing is not None else rel.limit(0).select(key), rel, key, key)
    log = s.select(key, F.when(F.col("categoria") == FALLBACK["categoria"], F.lit("erro"))
                   .otherwise(F.lit("ok")).alias("status"))
    return new, log


# ----------------------------------------------------------------- R08
def build_label_set(raw: DataFrame, text: str = "texto", flag: str = "serve_para_mim",
                    category: str = "categoria", confidence: str = "confianca", reason: str = "motivo",
                    exclude_low: bool = True, exclude_ambiguous: bool = True,
                    check: bool = True) -> DataFrame:
    """Pseudo-label set from raw scorer results: text clean-up and
    null-text filter (F05), bool -> label (T18), ambiguity flag (F08),
    training-row filter (F09), (text, label) dedupe (W04).  With ``check``,
    an empty set or a single class raises (one small per-class count)."""
    from .dedupe import dedupe_pairs
    from .filters import drop_null_text, is_ambiguous, training_rows
    r = drop_null_text(raw, text, "text")
    r = r.select("text", X.bool_label(F.col(flag)).alias("label"), F.col(confidence).alias("confianca"),
                 is_ambiguous(category, confidence, reason).alias("ambiguo"))
    t = training_rows(r, "label", "confianca", "ambiguo", exclude_low, exclude_ambiguous)
    out = dedupe_pairs(t.select("text", "label"), ("text", "label"))
    if check:
        out = out.checkpoint()  # the check reads what is returned; the scorer runs once
        classes = [row[0] for row in out.select("label").distinct().collect()]  # 0 and 1 at most
        if not classes:
            raise ValueError("label set is empty")
        if len(classes) < 2:
            raise ValueError(f"label set has a single class: {classes}")
    return out
