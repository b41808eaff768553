"""Row filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as X


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keyword_predicate(text, any_=None, all_=None) -> Column | None:
    """F01 predicate: lower-case substring test; blank terms ignored."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    anys = [k.strip().lower() for k in (any_ or []) if k and k.strip()]
    alls = [k.strip().lower() for k in (all_ or []) if k and k.strip()]
    cond = None
    if anys:
        a = None
        for k in anys:
            a = t.contains(k) if a is None else (a | t.contains(k))
        cond = a
    for k in alls:
        cond = t.contains(k) if cond is None else (cond & t.contains(k))
    return cond


def filter_keywords(df: DataFrame, col: str, any_=None, all_=None) -> DataFrame:
    """keep rows whose text contains any of ``any_`` and all of ``all_``;
    no (non-blank) terms -> pass-through."""
    cond = keyword_predicate(col, any_, all_)
    return df if cond is None else df.where(cond)


def filter_keywords_folded(df: DataFrame, col: str, terms=None, extras=None) -> DataFrame:
    """accent-insensitive any-filter over terms + extras (both sides
    folded to ASCII, whitespace collapsed)."""
    allt = [t for t in list(terms or []) + list(extras or []) if t and t.strip()]
    if not allt:
        return df
    t = X.fold_squash(F.col(col))
    folded = _fold_terms(allt)
    cond = None
    for k in folded:
        if not k:
            continue
        cond = t.contains(k) if cond is None else (cond | t.contains(k))
    return df if cond is None else df.where(cond)


def _fold_terms(terms):
    import unicodedata
    out = []
    for t in terms:
        s = unicodedata.normalize("NFKD", t.lower().strip()).encode("ascii", "ignore").decode("ascii")
        out.append(" ".join(s.split()))
    return out


def select_notices(df: DataFrame, mode: str = "publicacao", ini: str | None = None,
                   fim: str | None = None, modality=None, ufs=None, status=None,
                   doc_types=None, q: str | None = None, *, pub="dataPublicacaoPncp",
                   closing="dataEncerramentoProposta", mod="modalidadeId", uf="uf_sigla",
                   st="situacaoCompraNome", dtype=None, text="objetoCompra") -> DataFrame:
    """request predicate as pushed-down filters.

    ``publicacao``: publication date (YYYYMMDD bounds, inclusive) and
    modality; ``proposta``: closing date on or after ``fim`` (still open on
    that date), optional modality.  Plus status, document types, UF list and
    a free-text ``q`` (case-insensitive substring).
    """
    def day(c):
        return F.regexp_replace(F.substring(F.col(c), 1, 10), "-", "")
    out = df
    if mode == "publicacao":
        if ini:
            out = out.where(day(pub) >= F.lit(str(ini)))
        if fim:
            out = out.where(day(pub) <= F.lit(str(fim)))
    elif mode == "proposta":
        if fim:
            out = out.where(day(closing) >= F.lit(str(fim)))
    else:
        raise ValueError(f"unknown mode {mode}")
    if modality is not None:
        mods = modality if isinstance(modality, (list, tuple)) else [modality]
        out = out.where(F.col(mod).isin(list(mods)))
    if ufs:
        out = out.where(F.col(uf).isin(list(ufs)))
    if status:
        sts = status if isinstance(status, (list, tuple)) else [status]
        out = out.where(F.col(st).isin(list(sts)))
    if doc_types and dtype:
        out = out.where(F.col(dtype).isin(list(doc_types)))
    if q:
        out = out.where(F.lower(F.col(text)).contains(q.lower()))
    return out


def filter_dates(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """coerced timestamp within [lo, hi] (inclusive; ``hi`` is a
    midnight); unparseable dates are excluded."""
    c = F.col(col)
    ts = c if dict(df.dtypes).get(col, "string").startswith("timestamp") else \
        F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in
                     ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")])
    return df.where(ts.between(F.to_timestamp(F.lit(lo)), F.to_timestamp(F.lit(hi))))


NULL_TEXTS = ["", "nan", "none", "null"]


def drop_null_text(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """whitespace-collapsed text; drop blank / nan / none / null."""
    o = out or col
    x = df.withColumn(o, X.squash(F.col(col)))
    return x.where(~F.lower(F.col(o)).isin(NULL_TEXTS))


def valid_labels(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """whitespace removed; only '0'/'1' kept, cast to int."""
    o = out or col
    s = F.regexp_replace(F.col(col).cast("string"), r"(?U)\s+", "")
    return df.withColumn(o, s).where(F.col(o).isin("0", "1")).withColumn(o, F.col(o).cast("int"))


def relevant(df: DataFrame, col: str = "pred") -> DataFrame:
    """keep predicted-relevant rows."""
    return df.where(F.col(col) == 1)


def is_ambiguous(cat, conf, reason, stems=None) -> Column:
    """category 'ambiguo', confidence 'baixa', or a reason that contains
    one of the ambiguity stems (all lower-cased)."""
    st = fixed.AMBIGUITY_STEMS if stems is None else stems
    r = F.lower(F.coalesce(_c(reason).cast("string"), F.lit("")))
    hit = None
    for s in st:
        k = r.contains(s)
        hit = k if hit is None else (hit | k)
    return ((F.lower(F.coalesce(_c(cat).cast("string"), F.lit(""))) == "ambiguo")
            | (F.lower(F.coalesce(_c(conf).cast("string"), F.lit(""))) == "baixa")
            | hit)


def training_rows(df: DataFrame, label: str = "label", conf: str = "confianca",
                  amb: str = "ambiguo", exclude_low: bool = True,
                  exclude_ambiguous: bool = True) -> DataFrame:
    """optional exclusion of low-confidence / ambiguous rows; label in {0,1}."""
    out = df
    if exclude_low:
        out = out.where(F.lower(F.coalesce(F.col(conf), F.lit(""))) != "baixa")
    if exclude_ambiguous:
        out = out.where(~F.col(amb))
    return out.where(F.col(label).isin(0, 1))
