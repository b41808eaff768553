"""Operator 4 - chat formatting by prefix-target expansion (native).

Every assistant turn becomes an example of its own: all preceding turns are
context, the reply is the only trainable part.  Turns after the last assistant
turn (or of a conversation without one) come in one more row that trains
nothing, so that the output holds every turn.

A turn is ``<|turn|>role<|text|>text<|end|>`` and a line feed.  Inside role
and text ``&`` becomes ``&amp;``, every ``<`` becomes ``&#60;`` and the ``[``
of ``[INST]`` and ``[/INST]`` becomes ``&#91;``, so neither the marks of this
template nor ``</s>``, ``<s>``, ``<<SYS>>`` or ``[INST]`` of common ones
survive in a text; the reverse replacements restore it exactly.  The trainable
part is given as a code-point span of the formatted text.

A conversation is one row while it is formatted, which its longest example
needs anyway.  Defined cases: NULL text or role is empty; a row without
conv_id is a conversation of its own, so such rows share no group; turns are
ordered by turn (NULL last), then role, then text, and repeated rows stay;
an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
ESCAPES = (("&", "&amp;"), ("<", "&#60;"), ("[INST]", "&#91;INST]"), ("[/INST]", "&#91;/INST]"))


def escape(c: Column) -> Column:
    for plain, safe in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    for plain, safe in (("<", "&#60;"), ("[", "&#91;"), ("&", "&amp;")):
        c = F.replace(c, F.lit(safe), F.lit(plain))
    return c


def examples(turns: DataFrame) -> DataFrame:
    """(conv_key, conv_id, target, turns, formatted, loss_start, loss_chars) of (conv_id, turn, role, text).

    ``target`` is the place of the assistant turn (0 first) or NULL in the row
    without a target; ``loss_start`` counts code points from 0.
    """
    t = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    key = F.when(F.col("conv_id").isNull(), F.uuid()).otherwise(F.col("conv_id").cast("string"))
    conv = (t.groupBy(key.alias("conv_key"), "conv_id")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "text"))).alias("t"))
            .select("conv_key", "conv_id", F.transform("t", lambda x: x["role"] == "assistant").alias("own"),
                    F.transform("t", lambda x: F.concat(F.lit(TURN), escape(x["role"]), F.lit(TEXT))).alias("heads"),
                    F.transform("t", lambda x: escape(x["text"])).alias("texts")))
    last = F.size("own") - 1
    open_end = ~F.element_at("own", -1)
    rows = conv.select("*", F.posexplode("own").alias("pos", "is_own")).filter(F.col("is_own") | ((F.col("pos") == last) & open_end))
    upto = F.transform(F.slice(F.arrays_zip("heads", "texts"), 1, F.col("pos")), lambda x: F.concat(x["heads"], x["texts"], F.lit(END)))
    rows = rows.select("conv_key", "conv_id", "pos", "is_own", (F.col("pos") + 1).cast("long").alias("turns"),
                       F.concat(F.concat_ws("", upto), F.get("heads", "pos")).alias("context"), F.get("texts", "pos").alias("reply"))
    return rows.select("conv_key", "conv_id", F.when(F.col("is_own"), F.col("pos")).alias("target"), "turns",
                       F.concat("context", "reply", F.lit(END)).alias("formatted"),
                       F.length("context").cast("long").alias("loss_start"),
                       F.when(F.col("is_own"), F.length("reply")).otherwise(0).cast("long").alias("loss_chars"))


def parsed(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted text."""
    quoted = END.replace("|", "\\|")
    segments = F.slice(F.split(formatted, quoted), 1, F.greatest(F.size(F.split(formatted, quoted)) - 1, F.lit(0)))
    return F.transform(segments, lambda s: F.struct(
        unescape(F.substring_index(F.substring(s, F.lit(len(TURN) + 1), F.length(s)), TEXT, 1)).alias("role"),
        unescape(F.substring_index(s, TEXT, -1)).alias("text")))


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation, what its examples say when read back."""
    rows = rows.select("conv_key", "conv_id", "turns", "target", F.length("formatted").cast("long").alias("chars"),
                       "formatted", unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_chars"))).alias("loss"))
    per = rows.groupBy("conv_key", "conv_id").agg(
        F.max_by("formatted", "turns").alias("whole"), F.sum("chars").alias("formatted_chars"), F.count("target").alias("examples"),
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("target", "loss")))), lambda x: x["loss"])).alias("loss"))
    back = per.withColumn("back", parsed(F.col("whole")))
    said = F.concat_ws("", F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return back.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       "formatted_chars", "examples")


def query(spark, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    rows = [F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(said).alias("text"))
            for k, role in enumerate(("user", "assistant"))]
    more = spark.range(1).select(F.inline(F.array(*rows)))
    return digests(examples(turns.unionByName(more)))


SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
e AS (
  SELECT *, 24 + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&#60;'), '[INST]', '&#91;INST]'), '[/INST]', '&#91;/INST]'))
            + length(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&#60;'), '[INST]', '&#91;INST]'), '[/INST]', '&#91;/INST]')) AS chars
  FROM t),
c AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text ROWS UNBOUNDED PRECEDING) AS upto,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS FIRST, role DESC, text DESC) AS back
  FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR back = 1) AS BIGINT) AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS examples
FROM c GROUP BY conv_id
"""
