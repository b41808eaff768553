"""Display and value helpers (T11-T17, F10, J08, P02, P03, P09) as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import strip, title_case

_c = lambda c: F.col(c) if isinstance(c, str) else c

ISO_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd")


def _blank(x: Column) -> Column:
    """NULL or, after strip, '', 'None' or 'null'."""
    s = strip(x)
    return x.isNull() | s.isin("", "None", "null")


# ------------------------------------------------------------ values (P02/3/9)
def safe_double(c) -> Column:
    """NULL, '' or unparseable -> NULL (ANSI-safe)."""
    return _c(c).cast("string").try_cast("double")


def first_truthy(*cols, default=None) -> Column:
    """P02 for text values: first one that is not NULL and not ''."""
    parts = [F.when(_c(c) != "", _c(c)) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def _truthy_or_null(x: Column, dtype: str) -> Column:
    if dtype == "string":
        return F.when(x != "", x)
    if dtype in ("int", "bigint", "double", "float", "smallint", "tinyint") or dtype.startswith("decimal"):
        return F.when(x != 0, x)
    if dtype == "boolean":
        return F.when(x, x)
    if dtype.startswith("array") or dtype.startswith("map"):
        return F.when(F.size(x) > 0, x)
    return x


def truthy_coalesce(df, cols, default=None) -> Column:
    """P02 with the per-type truthiness taken from ``df``'s schema."""
    types = dict(df.dtypes)
    parts = []
    for c in cols:
        if isinstance(c, str):
            parts.append(_truthy_or_null(F.col(c), types.get(c, "string")))
        else:
            parts.append(F.when(c.cast("string") != "", c))
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def safe_path(json_col, *keys, default: str = "") -> Column:
    """Nested JSON getter; missing, 'none'/'null'/blank -> default; stripped."""
    path = "$" + "".join(f".{k}" for k in keys)
    v = F.get_json_object(_c(json_col), path)
    s = strip(v)
    return F.when(v.isNull() | F.lower(s).isin("none", "null", ""), F.lit(default)).otherwise(s)


# ---------------------------------------------------------------- links
def valid_link(c) -> Column:
    """stripped URL when it starts with http (any case), else NULL."""
    s = strip(_c(c))
    bad = s.isNull() | F.lower(s).isin("none", "null", "", "banco de dados", "n/a") | \
        ~F.lower(s).startswith("http")
    return F.when(~bad, s)


def parse_control(c) -> Column:
    """Control number -> struct(cnpj, seq without leading zeros, ano);
    prefix match of ``{digits}-1-{digits}/{digits}``, else NULL."""
    s = strip(_c(c))
    ok = s.rlike(fixed.CONTROL_RE)
    seq = F.regexp_replace(F.regexp_extract(s, fixed.CONTROL_RE, 2), r"^0+(?=\d)", "")
    return F.when(ok, F.struct(
        F.regexp_extract(s, fixed.CONTROL_RE, 1).alias("cnpj"),
        seq.alias("seq"),
        F.regexp_extract(s, fixed.CONTROL_RE, 3).alias("ano")))


def portal_link(c) -> Column:
    """Public notice URL from the control number; NULL when unparseable."""
    p = parse_control(c)
    return F.when(p.isNotNull(), F.concat(F.lit(fixed.PORTAL_BASE), p.cnpj, F.lit("/"), p.ano,
                                          F.lit("/"), p.seq))


def absolute_url(c, base: str = fixed.SITE_BASE) -> Column:
    """Relative item URL -> absolute; blank -> NULL."""
    x = _c(c)
    return (F.when(x.isNull() | (x == ""), F.lit(None).cast("string"))
             .when(x.startswith("http://") | x.startswith("https://"), x)
             .otherwise(F.concat(F.lit(base), x)))


# ---------------------------------------------------------------- dates
def _parse_iso(s: Column):
    return [F.try_to_timestamp(s, F.lit(f)) for f in ISO_FORMATS]


def fmt_date(c, style: str = "report") -> Column:
    """ISO text -> 'dd/MM/yyyy HH:mm' (report) or 'dd/MM/yyyy - HH:mm:ss'
    (listing) when it has a time part, 'dd/MM/yyyy' for a bare date;
    blank -> 'Não informado' (report) / '—' (listing); unparseable -> unchanged."""
    x = _c(c)
    if style == "report":
        s = strip(x)
        t1, t2, t3 = _parse_iso(s)
        timed = F.coalesce(t1, t2)
        has_t = x.contains("T")
        out = (F.when(_blank(x), F.lit(fixed.NOT_INFORMED))
                .when(timed.isNotNull(), F.date_format(timed, "dd/MM/yyyy HH:mm"))
                .when(t3.isNotNull() & has_t, F.date_format(t3, "dd/MM/yyyy HH:mm"))
                .when(t3.isNotNull(), F.date_format(t3, "dd/MM/yyyy"))
                .otherwise(x))
        return out
    t1, t2, t3 = _parse_iso(x)
    anyt = F.coalesce(t1, t2, t3)
    return (F.when(x.isNull() | (x == ""), F.lit(fixed.DASH))
             .when(anyt.isNotNull() & x.contains("T"), F.date_format(anyt, "dd/MM/yyyy - HH:mm:ss"))
             .when(anyt.isNotNull(), F.date_format(anyt, "dd/MM/yyyy"))
             .otherwise(x))


def deadline_days(c, today) -> Column:
    """Whole days from ``today`` (a date literal/Column) to the closing date."""
    s = strip(_c(c))
    t = F.coalesce(*_parse_iso(s))
    td = F.to_date(F.lit(today)) if isinstance(today, str) else today
    return F.datediff(F.to_date(t), td)


def deadline_status(c, today) -> Column:
    """Closing date vs ``today`` -> wording; blank/unparseable -> ''."""
    d = deadline_days(c, today)
    return (F.when(d.isNull(), F.lit(""))
             .when(d >= 3, F.concat(F.lit("Vence em "), d.cast("string"), F.lit(" dias")))
             .when(d == 2, F.lit("Vence depois de amanhã"))
             .when(d == 1, F.lit("Vence amanhã"))
             .when(d == 0, F.lit("Vence hoje"))
             .when(d == -1, F.lit("Venceu ontem"))
             .when(d == -2, F.lit("Venceu antes de ontem"))
             .otherwise(F.concat(F.lit("Vencido há "), F.abs(d).cast("string"), F.lit(" dias"))))


# ---------------------------------------------------------------- numbers
def fmt_brl(c) -> Column:
    """T14: 'R$ 1.234.567,50'; blank -> 'Não informado'; non-numeric -> unchanged."""
    x = _c(c).cast("string")
    v = strip(x).try_cast("double")
    num = F.translate(F.format_number(v, 2), ",.", ".,")
    return (F.when(_blank(x), F.lit(fixed.NOT_INFORMED))
             .when(v.isNotNull() & ~F.isnan(v), F.concat(F.lit("R$ "), num))
             .otherwise(x))


def fmt_cnpj(c) -> Column:
    """14 digits -> '00.000.000/0000-00'; blank -> 'Não informado'; else unchanged."""
    x = _c(c)
    d = F.regexp_replace(x, r"\D", "")
    f = F.regexp_replace(d, r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$", "$1.$2.$3/$4-$5")
    return (F.when(x.isNull() | (x == ""), F.lit(fixed.NOT_INFORMED))
             .when(F.length(d) == 14, f)
             .otherwise(x))


# ---------------------------------------------------------------- names
def category_name(c, names: dict | None = None) -> Column:
    """Slug -> display name; unknown -> Python-style title case; blank -> '—'."""
    m = fixed.CATEGORY_NAMES if names is None else names
    x = _c(c)
    lut = F.create_map(*[F.lit(t) for kv in m.items() for t in kv])
    return (F.when(x.isNull() | (x == ""), F.lit(fixed.DASH))
             .otherwise(F.coalesce(F.element_at(lut, F.lower(x)), title_case(x))))


# ---------------------------------------------------------------- files
def sanitize_name(c) -> Column:
    """Characters invalid in file names -> '_', then stripped."""
    return strip(F.regexp_replace(_c(c), r'[\\/:*?"<>|]', "_"))


def ext_for_content_type(c) -> Column:
    ct = strip(F.substring_index(F.lower(_c(c)), ";", 1))
    lut = F.create_map(*[F.lit(t) for kv in fixed.CONTENT_TYPE_EXT.items() for t in kv])
    return F.coalesce(F.element_at(lut, ct), F.lit(".bin"))


def name_from_disposition(c) -> Column:
    """File name from a Content-Disposition header, sanitized; else NULL."""
    m = F.regexp_extract(_c(c), fixed.DISPOSITION_RE, 1)
    n = F.regexp_replace(strip(m), r"""^["']+|["']+$""", "")
    return F.when(n != "", sanitize_name(n))
