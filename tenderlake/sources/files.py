"""File sources: labelled CSV, keyword and id-log text files, date-partitioned
tables, flexible-schema notice tables (S04-S10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import display as D
from ..functions import text as X
from ..session import folder_names
from .records_csv import read_csv

TEXT_ALIASES = ["Objeto", "objeto", "objeto_compra", "texto", "text"]
LABEL_ALIASES = ["Relevante", "relevante", "label", "rotulo"]


# ----------------------------------------------------------------- S04
def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Labelled CSV (header, BOM, quoted multi-line text), any number of
    tasks per file; every column read as text -- labels are parsed later (T18/F06)."""
    return read_csv(spark, path)


# ----------------------------------------------------------------- S05
def resolve_column(df: DataFrame, candidates) -> str:
    """First existing column among ``candidates``; error when none."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of the columns {list(candidates)} exists in {df.columns}")


def canonical_labels(df: DataFrame, text_aliases=None, label_aliases=None) -> DataFrame:
    """Rename the resolved text/label columns to ``text``/``label``."""
    t = resolve_column(df, text_aliases or TEXT_ALIASES)
    lab = resolve_column(df, label_aliases or LABEL_ALIASES)
    return df.select(F.col(t).cast("string").alias("text"), F.col(lab).cast("string").alias("label"))


# ----------------------------------------------------------------- S06/S07
def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank trimmed lines, with their order (file line number is
    not kept by text sources, so the order is the first position seen)."""
    t = spark.read.text(path).select(X.strip(F.col("value")).alias("term"),
                                     F.monotonically_increasing_id().alias("ord"))
    return t.where(F.col("term") != "")


def read_id_log(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """Distinct trimmed non-blank ids of a progress log."""
    t = spark.read.text(path).select(X.strip(F.col("value")).alias(name))
    return t.where(F.col(name) != "").distinct()


# ----------------------------------------------------------------- S08
def read_date_or_latest(spark: SparkSession, path: str, date: str | None, col: str = "data") -> DataFrame:
    """The partition of ``date`` when present, else the newest one.

    The partition list is the folder listing of the table; the returned read
    is pruned to one partition.
    """
    days = sorted(n.split("=", 1)[1] for n in folder_names(spark, path) if n.startswith(f"{col}="))
    if not days:
        raise FileNotFoundError(f"no partitions under {path}")
    df = spark.read.parquet(path)
    chosen = date if date in days else days[-1]
    return df.where(F.col(col) == F.lit(chosen).cast(df.schema[col].dataType))


# ----------------------------------------------------------------- S09
def scan(df: DataFrame, cols, order=None, limit: int | None = None) -> DataFrame:
    """Projection + order + optional limit (0/None = no limit)."""
    out = df.select(*cols)
    if order:
        out = out.orderBy(*order)
    return out.limit(limit) if limit else out


# ----------------------------------------------------------------- S10
FLEX_FIELDS = {
    "pncp_id": (["pncp_id", "numero_controle_pncp"], ["numeroControlePNCP", "numero_controle_pncp"]),
    "orgao_nome": (["orgao_nome"], ["orgaoEntidade.razaoSocial", "orgaoEntidade.razaosocial", "orgao_nome"]),
    "uf_sigla": (["uf_sigla"], ["unidadeOrgao.ufSigla", "uf"]),
    "objeto_compra": (["objeto_compra"], ["objetoCompra", "objeto_compra", "description"]),
}


def read_notices(df: DataFrame, json_col: str = "dados_json") -> DataFrame:
    """Five non-NULL text fields whatever the table shape: flat columns
    when present, else JSON paths with alias fallbacks (first truthy);
    NULL -> '' and a missing JSON -> '{}'."""
    cols = set(df.columns)
    has_json = json_col in cols
    x = df.withColumn("_v", F.try_parse_json(F.col(json_col))) if has_json else df  # one parse for all paths
    out = []
    for name, (flat, paths) in FLEX_FIELDS.items():
        parts = [F.col(c).cast("string") for c in flat if c in cols]
        if has_json:
            parts += [F.try_variant_get("_v", "$." + p, "string") for p in paths]
        out.append(D.first_truthy(*parts, default="").alias(name) if parts else F.lit("").alias(name))
    j = F.coalesce(F.col(json_col), F.lit("{}")) if has_json else F.lit("{}")
    return x.select(*out, j.alias("dados_json"))
