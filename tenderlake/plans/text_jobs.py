"""Text, keyword and relevance-rule jobs over ``documents`` (whole texts).

The operators' defaults are the procurement dictionaries; these jobs pass
dictionaries written for the documents' own vocabulary (license lines,
mail addresses, the four languages) so that every rule actually fires on
the driver data.  Both sides (Spark, SQL) use the same parameters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import display as D
from ..functions import fixed
from ..functions import text as X
from ..operators import filters as FL
from ..operators import merge as J
from ..operators import relevance as RV
from ..operators import summary as A
from ..operators.records import top_keywords_inline
from ..tables import table
from . import query
from . import sqlfrag as S

# Query parameters for the documents domain.
DOC_KEYWORDS = ["license", "apache", "tionou", "ment", "schein", "para", "und", "ción", "über", "of",
                "le", "reti"]
DOC_POS_TERMS = ["mit license", "apache license", "licensed under", "released under"]
DOC_NEG_TERMS = ["general public license", "cc by-nc", "example.com"]
DOC_POS_PATTERNS = {
    "mit_license": ("flex", "mit license"),
    "apache_license": ("re", r"\bapache" + fixed.SEP + r"license\b"),
    "released_under": ("flex", "released under"),
    "version_2": ("re", r"\bversion" + fixed.SEP + r"2(?:\.0)?\b"),
}
DOC_NEG_PATTERNS = {
    "gpl": ("flex", "general public license"),
    "cc_by_nc": ("re", r"\bcc" + fixed.SEP + r"by" + fixed.SEP + r"nc\b"),
    "mail": ("re", r"\bmail[0-9]*\b"),
}
DOC_CATEGORIES = [
    ("licenca", ["license", "licensed"]),
    ("contato", ["@", "mail"]),
    ("ingles", [" the "]),
    ("frances", [" le ", " les "]),
    ("alemao", [" der ", " und "]),
    ("espanhol", [" el ", " los "]),
]
FOLD_TERMS, FOLD_EXTRAS = ["Über", "Acción"], ["Ñandú"]


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def kw_table(spark, sf_dir):
    """Keyword dimension as a table (one row per term, with its order)."""
    return spark.createDataFrame([(i, k) for i, k in enumerate(DOC_KEYWORDS)], "ord int, term string")


# ---------------------------------------------------------------- T01-T04
@query("clean_text", f"SELECT doc_id, {S.clean_text('text', fixed.CLEANER_STOPWORDS)} AS clean FROM documents")
def q_clean_text(spark, sf_dir):
    """ML cleaner over every document."""
    return docs(spark, sf_dir).select("doc_id", X.clean_text("text").alias("clean"))


@query("squash_text", f"SELECT doc_id, {S.squash_lower('text')} AS squashed FROM documents")
def q_squash_text(spark, sf_dir):
    """Whitespace collapse + trim + lower."""
    return docs(spark, sf_dir).select("doc_id", X.squash_lower("text").alias("squashed"))


@query("fold_text", f"SELECT doc_id, {S.fold('text')} AS folded FROM documents")
def q_fold_text(spark, sf_dir):
    """Accent fold to ASCII."""
    return docs(spark, sf_dir).select("doc_id", X.fold("text").alias("folded"))


@query("tokens", f"""SELECT doc_id, array_to_string(toks, ' ') AS toks, CAST(len(toks) AS BIGINT) AS n_tokens
FROM (SELECT doc_id, {S.tokens('text', fixed.TOKEN_STOPWORDS)} AS toks FROM documents)""")
def q_tokens(spark, sf_dir):
    """Folded tokens, len > 2, stop-words removed."""
    t = docs(spark, sf_dir).select("doc_id", X.tokens("text").alias("t"))
    return t.select("doc_id", F.array_join("t", " ").alias("toks"), F.size("t").cast("bigint").alias("n_tokens"))


# ---------------------------------------------------------------- T05/J06/A09/A10
@query("matched_keywords", f"""SELECT doc_id, array_to_string({S.matched_keywords('text', DOC_KEYWORDS)}, '|') AS matched
FROM documents""")
def q_matched_keywords(spark, sf_dir):
    """Matched keywords in dimension order (short terms word-bounded)."""
    d = docs(spark, sf_dir)
    return d.select("doc_id", F.array_join(X.matched_keywords("text", DOC_KEYWORDS), "|").alias("matched"))


_PAIRS_SQL = f"""pairs AS (
  SELECT doc_id, unnest({S.matched_keywords('text', DOC_KEYWORDS)}) AS keyword FROM documents
)"""


@query("keyword_theta", f"WITH {_PAIRS_SQL} SELECT doc_id, keyword FROM pairs")
def q_keyword_theta(spark, sf_dir):
    """All (document, keyword) hits from a keyword table."""
    d = docs(spark, sf_dir).select("doc_id", "text")
    return J.match_pairs(d, kw_table(spark, sf_dir), "text", "term").select("doc_id", "keyword")


@query("keyword_counts", f"""WITH {_PAIRS_SQL}
SELECT keyword, count(*) AS count FROM pairs GROUP BY keyword""")
def q_keyword_counts(spark, sf_dir):
    """Hits per keyword, most first."""
    d = docs(spark, sf_dir).select("doc_id", "text")
    return A.keyword_counts(J.match_pairs(d, kw_table(spark, sf_dir), "text", "term"))


@query("keyword_totals", f"""WITH {_PAIRS_SQL}
SELECT count(*) AS total_matches, count(DISTINCT keyword) AS unique_keywords FROM pairs""")
def q_keyword_totals(spark, sf_dir):
    """Total hits and distinct matched keywords."""
    d = docs(spark, sf_dir).select("doc_id", "text")
    return A.keyword_totals(J.match_pairs(d, kw_table(spark, sf_dir), "text", "term"))


@query("keyword_samples", f"""SELECT doc_id, matched FROM (
  SELECT doc_id, array_to_string({S.matched_keywords('text', DOC_KEYWORDS)}, '|') AS matched FROM documents)
WHERE matched <> '' ORDER BY doc_id LIMIT 20""")
def q_keyword_samples(spark, sf_dir):
    """A10: first 20 matching documents with their matched terms (top-k report)."""
    d = docs(spark, sf_dir).select("doc_id", F.array_join(X.matched_keywords("text", DOC_KEYWORDS), "|")
                                   .alias("matched"))
    return d.where(F.col("matched") != "").orderBy("doc_id").limit(20)


# ---------------------------------------------------------------- T06/T07
@query("flex_phrase", f"""SELECT doc_id,
  regexp_matches({S.squash_lower('text')}, {S.q(S.re2('(?iU)' + X.flex_pattern('licensed under')))}) AS licensed_under,
  regexp_matches({S.squash_lower('text')}, {S.q(S.re2('(?iU)' + X.flex_pattern('general public')))}) AS general_public
FROM documents""")
def q_flex_phrase(spark, sf_dir):
    """Phrase patterns tolerant to space / hyphen / underscore / slash."""
    t = X.squash_lower("text")
    return docs(spark, sf_dir).select(
        "doc_id", t.rlike("(?iU)" + X.flex_pattern("licensed under")).alias("licensed_under"),
        t.rlike("(?iU)" + X.flex_pattern("general public")).alias("general_public"))


@query("regex_dictionary", f"""SELECT doc_id,
  array_to_string({S.regex_hits(S.squash_lower('text'), DOC_POS_PATTERNS)}, ', ') AS positivos,
  array_to_string({S.regex_hits(S.squash_lower('text'), DOC_NEG_PATTERNS)}, ', ') AS negativos
FROM documents""")
def q_regex_dictionary(spark, sf_dir):
    """Names of the dictionary patterns found, in dictionary order."""
    t = X.squash_lower("text")
    return docs(spark, sf_dir).select(
        "doc_id", F.array_join(X.regex_hits(t, DOC_POS_PATTERNS), ", ").alias("positivos"),
        F.array_join(X.regex_hits(t, DOC_NEG_PATTERNS), ", ").alias("negativos"))


# ---------------------------------------------------------------- T08/O04
@query("top_keywords", f"""WITH t AS (
  SELECT doc_id, {S.tokens('text', fixed.TOKEN_STOPWORDS)} AS toks FROM documents
), e AS (
  SELECT doc_id, unnest(toks) AS tok, unnest(range(CAST(len(toks) AS BIGINT))) AS pos FROM t
), c AS (
  SELECT doc_id, tok, count(*) AS n, min(pos) AS first FROM e GROUP BY doc_id, tok
), r AS (
  SELECT doc_id, tok, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS rk FROM c
  QUALIFY rk <= 8
)
SELECT d.doc_id, coalesce(string_agg(tok, ',' ORDER BY rk), '') AS palavras_chave
FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id""")
def q_top_keywords(spark, sf_dir):
    """Top-8 folded tokens per document (count desc, first seen)."""
    return docs(spark, sf_dir).select("doc_id", F.array_join(top_keywords_inline(X.tokens("text")), ",").alias("palavras_chave"))


# ---------------------------------------------------------------- T09/T10/J08
@query("categorize", f"SELECT doc_id, {S.categorize('text', DOC_CATEGORIES, 'outros')} AS categoria FROM documents")
def q_categorize(spark, sf_dir):
    """First category of an ordered dictionary, else 'outros'."""
    return docs(spark, sf_dir).select("doc_id", X.categorize("text", DOC_CATEGORIES).alias("categoria"))


@query("summary_category", f"""SELECT categoria, count(*) AS quantidade FROM (
  SELECT {S.categorize('text', DOC_CATEGORIES, 'outros')} AS categoria FROM documents) GROUP BY categoria""")
def q_summary_category(spark, sf_dir):
    """Documents per category."""
    c = docs(spark, sf_dir).select(X.categorize("text", DOC_CATEGORIES).alias("categoria_objeto"))
    return A.summary_category(c)


@query("slugify", rf"""SELECT doc_id, CASE WHEN s = '' THEN 'termo' ELSE s END AS slug FROM (
  SELECT doc_id, regexp_replace(regexp_replace(lower(trim(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g'))),
         '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS s FROM documents)""")
def q_slugify(spark, sf_dir):
    """File-name slug of the whole text."""
    return docs(spark, sf_dir).select("doc_id", X.slug("text").alias("slug"))


_CAT_NAMES = {"licenca": "Licença de uso", "contato": "Contato"}


@query("category_lookup", f"""SELECT doc_id, CASE c WHEN 'licenca' THEN 'Licença de uso' WHEN 'contato' THEN 'Contato'
  ELSE upper(substr(c, 1, 1)) || lower(substr(c, 2)) END AS categoria_nome FROM (
  SELECT doc_id, {S.categorize('text', DOC_CATEGORIES, 'outros')} AS c FROM documents)""")
def q_category_lookup(spark, sf_dir):
    """Category slug -> display name (map, else title case)."""
    c = docs(spark, sf_dir).select("doc_id", X.categorize("text", DOC_CATEGORIES).alias("c"))
    return c.select("doc_id", D.category_name("c", _CAT_NAMES).alias("categoria_nome"))


# ---------------------------------------------------------------- F01/F02/F05
@query("keyword_any_all", """SELECT doc_id, lang FROM documents
WHERE (contains(lower(text), 'license') OR contains(lower(text), 'apache')) AND contains(lower(text), 'the')""")
def q_keyword_any_all(spark, sf_dir):
    """any of [license, apache] and all of [the]; blank terms ignored."""
    d = docs(spark, sf_dir)
    return FL.filter_keywords(d, "text", any_=["license", "apache", " "], all_=["the", ""]).select("doc_id", "lang")


@query("keyword_folded", f"""SELECT doc_id FROM documents
WHERE contains({S.squash(S.fold('text'))}, 'uber') OR contains({S.squash(S.fold('text'))}, 'accion')
   OR contains({S.squash(S.fold('text'))}, 'nandu')""")
def q_keyword_folded(spark, sf_dir):
    """accent-insensitive any-filter (terms + extras)."""
    d = docs(spark, sf_dir)
    return FL.filter_keywords_folded(d, "text", FOLD_TERMS, FOLD_EXTRAS).select("doc_id")


@query("null_text", rf"""SELECT conv_id, turn, t AS text FROM (
  SELECT conv_id, turn, {S.squash('text')} AS t FROM conversations) WHERE lower(t) NOT IN ('', 'nan', 'none', 'null')""")
def q_null_text(spark, sf_dir):
    """drop blank / nan / none / null texts after whitespace collapse."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return FL.drop_null_text(c, "text")


# ---------------------------------------------------------------- R01/R02/A18
@query("rule_decision", f"""WITH h AS (
  SELECT doc_id, {S.term_hits(S.squash_lower('text'), DOC_POS_TERMS)} AS p,
         {S.term_hits(S.squash_lower('text'), DOC_NEG_TERMS)} AS n FROM documents
)
SELECT doc_id,
  CASE WHEN len(n) > 0 AND len(p) = 0 THEN 0 WHEN len(p) > 0 AND len(n) = 0 THEN 1 END AS classe_regra,
  CASE WHEN len(n) > 0 AND len(p) = 0 THEN 'nao_relevante' WHEN len(p) > 0 AND len(n) = 0 THEN 'relevante'
       WHEN len(p) > 0 AND len(n) > 0 THEN 'revisar' ELSE 'sem_regra' END AS status_regra,
  CASE WHEN len(n) > 0 AND len(p) = 0 THEN 'Termos negativos fortes encontrados: ' || array_to_string(n[1:5], ', ')
       WHEN len(p) > 0 AND len(n) = 0 THEN 'Termos positivos fortes encontrados: ' || array_to_string(p[1:5], ', ')
       WHEN len(p) > 0 AND len(n) > 0 THEN 'Conflito entre termos positivos (' || array_to_string(p[1:3], ', ')
            || ') e negativos (' || array_to_string(n[1:3], ', ') || ')'
       ELSE 'Nenhuma regra forte acionada' END AS motivo_regra
FROM h""")
def q_rule_decision(spark, sf_dir):
    """R01 (+A18 reason strings): strong-term rule."""
    d = docs(spark, sf_dir).select("doc_id", "text")
    return RV.rule_decision(d, "text", DOC_POS_TERMS, DOC_NEG_TERMS).drop("text")


@query("regex_decision", f"""WITH h AS (
  SELECT doc_id, {S.regex_hits(S.squash_lower('text'), DOC_POS_PATTERNS)} AS p,
         {S.regex_hits(S.squash_lower('text'), DOC_NEG_PATTERNS)} AS n FROM documents
)
SELECT doc_id,
  CASE WHEN len(p) > 0 AND len(n) = 0 THEN 1 WHEN len(n) > 0 AND len(p) = 0 THEN 0 END AS classificacao_final,
  CASE WHEN len(p) > 0 AND len(n) = 0 THEN 'relevante' WHEN len(n) > 0 AND len(p) = 0 THEN 'nao_relevante'
       ELSE 'revisar' END AS status_final,
  CASE WHEN len(p) > 0 THEN array_to_string(p[1:10], ', ') ELSE '' END AS termos_positivos_batidos,
  CASE WHEN len(n) > 0 THEN array_to_string(n[1:10], ', ') ELSE '' END AS termos_negativos_batidos,
  CASE WHEN len(p) > 0 AND len(n) = 0 THEN 'Padrões positivos encontrados: ' || array_to_string(p[1:5], ', ')
       WHEN len(n) > 0 AND len(p) = 0 THEN 'Padrões negativos encontrados: ' || array_to_string(n[1:5], ', ')
       WHEN len(p) > 0 AND len(n) > 0 THEN 'Conflito entre padrões positivos e negativos'
       ELSE 'Nenhum padrão forte encontrado' END AS motivo
FROM h""")
def q_regex_decision(spark, sf_dir):
    """Regex-dictionary decision."""
    d = docs(spark, sf_dir).select("doc_id", "text")
    return RV.regex_decision(d, "text", DOC_POS_PATTERNS, DOC_NEG_PATTERNS).drop("text")


@query("reason_text", f"""SELECT doc_id, 'Padrões positivos encontrados: ' || array_to_string(p[1:1], ', ') AS motivo_curto,
  array_to_string(p[1:10], ', ') AS todos FROM (
  SELECT doc_id, {S.regex_hits(S.squash_lower('text'), DOC_POS_PATTERNS)} AS p FROM documents) WHERE len(p) > 0""")
def q_reason_text(spark, sf_dir):
    """The first n matched names joined into a message."""
    d = docs(spark, sf_dir).select("doc_id", X.regex_hits(X.squash_lower("text"), DOC_POS_PATTERNS).alias("p"))
    return d.where(F.size("p") > 0).select(
        "doc_id", X.reason_text("p", 1, "Padrões positivos encontrados: ").alias("motivo_curto"),
        X.reason_text("p", 10).alias("todos"))


@query("topk_tokens", f"""WITH t AS (
  SELECT conv_id, turn, {S.tokens('text', fixed.TOKEN_STOPWORDS)} AS toks FROM conversations
), e AS (
  SELECT conv_id, turn, unnest(toks) AS tok, unnest(range(CAST(len(toks) AS BIGINT))) AS pos FROM t
), c AS (
  SELECT conv_id, turn, tok, count(*) AS n, min(pos) AS first FROM e GROUP BY ALL
)
SELECT conv_id, turn, tok, CAST(n AS BIGINT) AS n,
       row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC, first) AS rk FROM c
QUALIFY rk <= 3""")
def q_topk_tokens(spark, sf_dir):
    """The 3 most frequent tokens of every conversation turn (count
    desc, first occurrence asc), one row per (turn, rank)."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", X.tokens("text").alias("toks"))
    return A.topk_tokens(c, ["conv_id", "turn"], "toks", 3)
