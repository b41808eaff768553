"""Text model jobs (M01-M06): TF-IDF, splits, linear classifier, scoring.

TF-IDF weight = tf * (ln((1+n)/(1+df)) + 1), L2-normalised per document, over
the ``max_features`` most frequent 1-2-grams (ties: term ascending).  The
vocabulary is exact, but rare grams are never shuffled: see ``fit_vocab``.  The
classifier is Spark ML's ``LinearSVC`` (hinge loss) on those weights.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import counting as C
from ..functions import text as X
from .dedupe import with_index


# ----------------------------------------------------------------- M01
def words(text: str) -> Column:
    """Word tokens of >= 2 word characters, lower-cased."""
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"(?U)\b\w\w+\b"), 0)


def gram_array(text: str, ngrams=(1, 2)) -> Column:
    """``words`` as lo..hi-grams."""
    lo, hi = ngrams

    def all_sizes(t: Column) -> Column:
        def of(n: int) -> Column:
            shifted = F.arrays_zip(*[F.slice(t, i + 1, F.greatest(F.size(t) - (n - 1), F.lit(0))).alias(f"g{i}") for i in range(n)])
            return t if n == 1 else F.transform(shifted, lambda z: F.concat_ws(" ", *[z[f"g{i}"] for i in range(n)]))

        return F.concat(*[of(n) for n in range(lo, hi + 1)])

    return X.bound(words(text), all_sizes)


KEPT_TERMS, MOST_CANDIDATES = 20_000, 200_000


def _frequent(toks: DataFrame, ngrams, kept: int) -> DataFrame:
    """(term, n): the ``kept`` most frequent grams of each length in each slice
    of a task, with their counts there, and one row with a NULL term per slice,
    the most that any other gram counts there."""

    def run(batches):
        for part in C.token_slices(batches, "_t"):
            g, other = C.Grams(part.column("_t"), *ngrams), 0
            for size, (key, _) in g.levels.items():
                keys, n = C.groups(key)
                if keys.size > kept:
                    order = np.argpartition(-n, kept)
                    other = max(other, int(n[order[kept]]))
                    keys, n = keys[order[:kept]], n[order[:kept]]
                yield pa.RecordBatch.from_arrays([g.text(size, keys), pa.array(n, pa.int64())], names=["term", "n"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.array([other], pa.int64())], names=["term", "n"])

    return toks.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _exact(toks: DataFrame, terms: list[str], ngrams) -> DataFrame:
    """(term, total, df) of some terms; each slice of a task sends one sum per term."""
    split = [t.split(" ") for t in terms]

    def run(batches):
        total, df = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        for part in C.token_slices(batches, "_t"):
            _, place, n = C.Grams(part.column("_t"), *ngrams).counts(split)
            np.add.at(total, place, n)
            np.add.at(df, place, 1)
        own = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([terms[k] for k in own], pa.string()), pa.array(total[own]), pa.array(df[own])], names=["term", "total", "df"])

    return toks.mapInArrow(run, "term string, total long, df long").groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))


def fit_vocab(df: DataFrame, id_col: str, text: str, max_features: int = 1000, ngrams=(1, 2), kept: int = KEPT_TERMS) -> DataFrame:
    """M01 fit: (term, idx, idf) of the ``max_features`` most frequent terms, exactly.

    Tasks send their most frequent grams only, with a bound on all others.  Let
    E be the sum of the bounds: a gram's true count is at least the sum L of
    what was sent and at most L + E.  With T the ``max_features``-th largest L,
    every gram of the vocabulary has L >= T - E, so these candidates are
    counted exactly in a second pass.  Where E is over half of T the lists were
    too short, and four times as much is kept.  What is shuffled is
    independent of the number of rare grams.
    """
    toks = df.select(words(text).alias("_t"))
    while True:
        sums = _frequent(toks, ngrams, kept).checkpoint()
        bound = sums.where("term is null").agg(F.sum("n")).first()[0] or 0
        top = sums.where("term is not null").orderBy(F.desc("n"), F.asc("term")).limit(max_features)
        least = top.agg(F.min("n"), F.count(F.lit(1))).first()
        if not bound:  # everything was sent: the sums are exact
            candidates = top
            break
        if least[1] == max_features and 2 * bound <= least[0]:
            candidates = sums.where((F.col("term").isNotNull()) & (F.col("n") >= least[0] - bound))
            if candidates.count() <= MOST_CANDIDATES:
                break
        kept *= 4
    terms = [r["term"] for r in candidates.select("term").collect()]  # MOST_CANDIDATES (max_features where nothing was left out) at most
    best = _exact(toks, terms, ngrams).orderBy(F.desc("total"), F.asc("term")).limit(max_features)
    idf = F.log((F.lit(1.0) + df.count()) / (F.lit(1.0) + F.col("df"))) + 1.0
    return best.select("term", (F.row_number().over(Window.orderBy(F.asc("term"))) - 1).alias("idx"), idf.alias("idf")).checkpoint()


def tfidf(df: DataFrame, id_col: str, text: str, vocab: DataFrame, ngrams=(1, 2)) -> DataFrame:
    """(id, term, idx, weight) of a fitted vocabulary, a row per term of a
    text; counted and normalised inside the text's row, nothing is shuffled.

    The vocabulary has at most ``max_features`` rows, so it goes out with the tasks.
    """
    terms = [(r["term"], r["idx"], r["idf"]) for r in vocab.collect()]
    names = pa.array([t for t, _, _ in terms], pa.string())
    index, idf = np.array([i for _, i, _ in terms], np.int32), np.array([w for _, _, w in terms], np.float64)
    split = [t.split(" ") for t, _, _ in terms]

    def run(batches):
        for part in C.token_slices(batches, "_t"):
            row, place, n = C.Grams(part.column("_t"), *ngrams).counts(split)
            w = n * idf[place]
            norm = np.sqrt(np.bincount(row, weights=w * w, minlength=part.num_rows))
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), names.take(pa.array(place)), pa.array(index[place]), pa.array(w / norm[row])],
                                             names=[id_col, "term", "idx", "weight"])

    schema = T.StructType([df.schema[id_col], T.StructField("term", T.StringType()), T.StructField("idx", T.IntegerType()), T.StructField("weight", T.DoubleType())])
    return df.select(id_col, words(text).alias("_t")).mapInArrow(run, schema)


def to_features(df: DataFrame, text: str, vocab: DataFrame, col: str = "features", ngrams=(1, 2)) -> DataFrame:
    """``df`` with the weights of M01 as one sparse ML vector per row, no shuffle
    (all zero without a vocabulary term)."""
    rows = vocab.orderBy("idx").collect()  # max_features rows at most
    counts = CountVectorizerModel.from_vocabulary([r["term"] for r in rows], "_grams", "_tf")
    scale = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_tf", outputCol="_w")
    unit = Normalizer(p=2.0, inputCol="_w", outputCol=col)
    return unit.transform(scale.transform(counts.transform(df.withColumn("_grams", gram_array(text, ngrams))))).drop("_grams", "_tf", "_w")


# ----------------------------------------------------------------- M03/M04
def stratified_split(df: DataFrame, label: str, key: str, frac: float = 0.2, seed: int = 42,
                     name: str = "is_test") -> DataFrame:
    """Per class, the ``ceil(frac * n_class)`` rows with the smallest
    md5(key || seed) form the test split (deterministic, partition-free)."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    x = with_index(df.withColumn("_h", h), ["_h", key], "_rk", partition_by=[label])
    n = x.groupBy(label).agg(F.count(F.lit(1)).alias("_cnt"))
    return (x.join(F.broadcast(n), label)
             .withColumn(name, F.col("_rk") <= F.ceil(F.col("_cnt") * frac))
             .drop("_h", "_rk", "_cnt"))


def hash_split(df: DataFrame, key: str, seed: int = 42, name: str = "is_test") -> DataFrame:
    """Unstratified ~20 % test split: first 4 hex digits of
    md5(key || seed) below '3333'."""
    h = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), 1, 4)
    return df.withColumn(name, h < F.lit("3333"))


# ----------------------------------------------------------------- M02/M05
def train_linear(train: DataFrame, features: str = "features", label: str = "label",
                 max_iter: int = 100, balance: bool = True, reg: float = 1e-4, tol: float = 1e-4):
    """Hinge-loss linear classifier (at most ``max_iter`` optimiser
    iterations, stopping earlier at ``tol``); class weights inverse to class
    frequency when ``balance`` (the labelled sets are skewed)."""
    d = train
    est = LinearSVC(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg, tol=tol)
    if balance:
        counts = dict(train.groupBy(label).count().limit(3).collect())  # a binary label
        if len(counts) > 2:
            raise ValueError("the label has more than two values")
        share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, sum(counts.values()) / (2.0 * n))])
        d = train.withColumn("_w", F.try_element_at(share, F.col(label)))
        est = est.setWeightCol("_w")
    return est.fit(d.withColumn(label, F.col(label).cast("double")))


def save_model(model, vocab: DataFrame, path: str) -> None:
    """Model and its vocabulary under one folder (shared storage)."""
    model.write().overwrite().save(os.path.join(path, "model"))
    vocab.write.mode("overwrite").parquet(os.path.join(path, "vocab"))


def load_model(spark, path: str):
    return (LinearSVCModel.load(os.path.join(path, "model")),
            spark.read.parquet(os.path.join(path, "vocab")))


def score_table(df: DataFrame, model, vocab: DataFrame, id_col: str, text: str, pred: str = "relevante_pred") -> DataFrame:
    """Featurise with the fitted vocabulary and predict every row;
    rows without any vocabulary term get an all-zero vector."""
    feats = to_features(df.select(id_col, text), text, vocab)
    return model.transform(feats).select(id_col, F.col("prediction").cast("int").alias(pred))


# ----------------------------------------------------------------- M06
def softmax_argmax(logits: Column):
    """(label, confidence, probabilities) from a logits array."""
    mx = F.array_max(logits)
    ex = F.transform(logits, lambda x: F.exp(x - mx))
    tot = F.aggregate(ex, F.lit(0.0), lambda a, b: a + b)
    probs = F.transform(ex, lambda e: e / tot)
    label = (F.array_position(logits, mx) - 1).cast("int")
    return label, F.array_max(probs), probs
