"""Feed merges, joins and set operations.

Key-merges are aggregations, not windows: ``max_by`` / ``collect`` with a
partial (map-side) aggregate, so a hot key that holds a third of all rows
is combined per partition before it is shuffled and never lands in one task
as raw rows.  Keyless rows get a synthetic unique group key so they are
kept apart (and spread evenly).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X


def _group_key(key: str, seq: str) -> Column:
    return F.coalesce(F.col(key), F.concat(F.lit("#"), F.col(seq).cast("string")))


# ----------------------------------------------------------------- U01
def union_feeds(*dfs: DataFrame) -> DataFrame:
    """Union all by column name; missing columns become NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


# ----------------------------------------------------------------- J02
def merge_latest(df: DataFrame, key: str, ref: str, seq: str) -> DataFrame:
    """One row per key -- the version with the newest reference date
    (text compare, NULL as ''); ties keep the earliest arrival (``seq``).
    Keyless rows are all kept.  Whole record, no field fill."""
    cols = df.columns
    rank = F.struct(F.coalesce(F.col(ref), F.lit("")), -F.col(seq))
    g = (df.groupBy(_group_key(key, seq).alias("_g"))
           .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), rank).alias("_r")))
    return g.select("_r.*")


# ----------------------------------------------------------------- J01
def _empty(c: Column, dtype: T.DataType) -> Column:
    """Python-truthiness emptiness per type (NULL, '', [], struct of empties)."""
    if isinstance(dtype, T.StringType):
        return c.isNull() | (c == "")
    if isinstance(dtype, T.ArrayType):
        return c.isNull() | (F.size(c) == 0)
    if isinstance(dtype, T.StructType):
        e = c.isNull()
        allf = None
        for f in dtype.fields:
            k = _empty(c[f.name], f.dataType)
            allf = k if allf is None else (allf & k)
        return e | allf if allf is not None else e
    return c.isNull()


def merge_feeds(df: DataFrame, key: str, ref: str, seq: str, origin: str = "_origem",
                both: str = "ambos") -> DataFrame:
    """Two-feed merge with field fill.

    Versions of a key are ranked by (reference date desc, arrival asc); every
    field takes the first non-empty value in that order (struct fields one
    level deep), else the top version's own value; ``_origem`` becomes
    ``ambos`` when more than one feed contributed.  Keyless rows stay apart.

    Each field is its own ``max_by`` whose ordering is NULL for empty values
    (max_by skips NULL orderings), so the whole merge is one partial
    aggregate: no version list is ever collected, whatever the key's size.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    data_cols = [c for c in df.columns if c != seq]
    x = df.withColumn("_rk", F.struct(F.coalesce(F.col(ref), F.lit("")), -F.col(seq)))
    rank = F.col("_rk")
    top = F.col("_top")

    def filled(c: Column, dtype: T.DataType) -> Column:
        return F.max_by(c, F.when(~_empty(c, dtype), rank))

    # one aggregate for the top version, one per field for the first
    # non-empty value; the fill falls back to the top version's value
    aggs = [F.max_by(F.struct(*[F.col(c) for c in data_cols]), rank).alias("_top"),
            F.min(F.col(seq)).alias(seq), F.min(F.col(origin)).alias("_omin"), F.max(F.col(origin)).alias("_omax")]
    outs = []
    for c in data_cols:
        dt = types[c]
        if c == origin:
            outs.append(F.when(F.col("_omin") != F.col("_omax"), F.lit(both)).otherwise(top[c]).alias(c))
        elif isinstance(dt, T.StructType):
            for f in dt.fields:
                aggs.append(filled(F.col(c)[f.name], f.dataType).alias(f"_f_{c}_{f.name}"))
            outs.append(F.when(top[c].isNotNull() | F.col(f"_any_{c}"), F.struct(*[
                F.coalesce(F.col(f"_f_{c}_{f.name}"), top[c][f.name]).alias(f.name) for f in dt.fields])).alias(c))
            aggs.append(F.max(F.col(c).isNotNull()).alias(f"_any_{c}"))
        else:
            aggs.append(filled(F.col(c), dt).alias(f"_f_{c}"))
            outs.append(F.coalesce(F.col(f"_f_{c}"), top[c]).alias(c))
    g = x.groupBy(_group_key(key, seq).alias("_g")).agg(*aggs)
    return g.select(*outs, F.col(seq))


# ----------------------------------------------------------------- J03/J04/U04
def _done_keys(done: DataFrame, dk: str) -> DataFrame:
    d = done.select(F.col(dk).alias("_k")).where(F.col("_k").isNotNull())
    if dict(d.dtypes)["_k"] == "string":
        d = d.where(F.col("_k") != "")
    return d


def pending(df: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """Rows whose key is not in the processed set (``''`` or NULL
    keys are never treated as done).  Anti-join; Spark broadcasts the done
    set only when its measured size is under the threshold."""
    return df.join(_done_keys(done, done_key or key), df[key] == F.col("_k"), "left_anti")


def already_done(df: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """Rows whose key is in the processed set (semi-join)."""
    return df.join(_done_keys(done, done_key or key), df[key] == F.col("_k"), "left_semi")


# ----------------------------------------------------------------- U02/U03
def union_ids(a: DataFrame, b: DataFrame, col: str = "id") -> DataFrame:
    """Distinct union of two id sets."""
    return a.select(F.col(col)).union(b.select(F.col(col))).distinct()


def in_both(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys present in both feeds (NULL keys excluded)."""
    return keys_of_both(a.select(key, F.lit(0).alias("_f")).unionByName(b.select(key, F.lit(1).alias("_f"))), key, F.col("_f"))


def keys_of_both(rows: DataFrame, key: str, feed: Column) -> DataFrame:
    """U03 over one frame that holds both feeds: one aggregate."""
    return (rows.where(F.col(key).isNotNull()).groupBy(key).agg((F.min(feed) < F.max(feed)).alias("_both"))
            .where("_both").select(key))


# ----------------------------------------------------------------- J05
def enrich(df: DataFrame, lookup: DataFrame, own: str, key: str, lookup_key: str,
           looked: str) -> DataFrame:
    """Own array wins when non-empty, else the array looked up by key,
    else an empty array (left join).  Rows without a key stay out of the
    join, so they never meet in one partition."""
    lk = lookup.select(F.col(lookup_key).alias("_lk"), F.col(looked).alias("_looked")).where(F.col("_lk").isNotNull())
    keyed = df.where(F.col(key).isNotNull())
    keyless = df.where(F.col(key).isNull()).withColumn("_looked", F.lit(None).cast(lookup.schema[looked].dataType))
    j = keyed.join(lk, F.col(key) == F.col("_lk"), "left").drop("_lk").unionByName(keyless)
    et = dict(df.dtypes).get(own)
    empty = F.array().cast(et) if et else F.array()
    own_c = F.when(F.size(F.col(own)) > 0, F.col(own))
    return j.withColumn(own, F.coalesce(own_c, F.col("_looked"), empty)).drop("_looked")


# ----------------------------------------------------------------- J06
LEXICON_CHARS = 4_000_000


def match_pairs(df: DataFrame, kw: DataFrame, text: str, term: str = "term",
                boundary_short: bool = True, lexicon_chars: int = LEXICON_CHARS) -> DataFrame:
    """All (record, keyword) hits for a keyword *table* (T05 semantics).

    The terms are counted first.  Up to ``lexicon_chars`` characters (about
    32 bytes each) they are one automaton, sent to the tasks once: one pass over
    the records, no join and no shuffle for any number of terms.  A larger table
    is dealt by hash into automata of that size, with a pass over the records each.
    """
    terms = kw.select(F.col(term).alias("t")).where(F.length("t") > 0)
    chars = terms.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-chars // lexicon_chars)
    out = df.select("*", F.lit("").alias("keyword")).where(F.lit(False))
    for b in range(blocks):
        own = [r[0] for r in terms.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b).collect()]  # lexicon_chars characters, counted above
        hits = df.select("*", F.explode(X.matched_keywords(text, own, boundary_short)).alias("keyword"))
        out = hits if blocks == 1 else out.unionByName(hits)
    return out


# ----------------------------------------------------------------- J07
def attach_scores(df: DataFrame, scores: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Result *i* belongs to input *i* -- joined on an explicit row id,
    never positionally."""
    return df.join(scores, row_id, "inner")
