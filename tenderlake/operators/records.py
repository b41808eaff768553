"""Record projection and normalisation.

All operators take and return DataFrames; JSON is parsed once per row with
``from_json`` and a narrow schema (Catalyst prunes unused fields), never
re-parsed per field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import display as D
from ..functions import text as X


# ----------------------------------------------------------------- P01
def json_fields(df: DataFrame, raw: str, fields: dict[str, str], keep=None) -> DataFrame:
    """Generated columns from JSON paths (``$.a.b``); missing -> NULL.

    Paths are case-sensitive.  All fields come out as strings, like
    generated TEXT columns; callers cast.
    """
    keep = list(df.columns) if keep is None else list(keep)
    # maps keep keys apart by case and values as they are written: one parse of
    # the record, and one of each object that a path goes through
    x, maps = df.withColumn("_m", F.from_json(F.col(raw), "map<string,string>")), {"$": "_m"}

    def value(path: str) -> Column:
        parent, _, key = path.rpartition(".")
        return F.try_element_at(F.col(maps[parent]), F.lit(key))

    for path in sorted({p.rpartition(".")[0] for p in fields.values()}):
        steps = path.split(".")
        for n in range(2, len(steps) + 1):
            at = ".".join(steps[:n])
            if at not in maps:
                x = x.withColumn(f"_m{len(maps)}", F.from_json(value(at), "map<string,string>"))
                maps[at] = f"_m{len(maps)}"
    return x.select(*keep, *[value(p).alias(n) for n, p in fields.items()])


def json_struct(df: DataFrame, raw: str, schema: T.StructType | str, alias: str = "r") -> DataFrame:
    """Parse the raw JSON once into a struct column (narrow schema)."""
    return df.withColumn(alias, F.from_json(F.col(raw), schema))


# ----------------------------------------------------------------- P04-P06
# The common notice, column by column (structs dotted), with the
# JSON paths it comes from in the search feed, in the consulta feed and in rows
# that are premium records already.  "a|b" takes the first that is set; an
# empty path is always NULL.
COMMON_FIELDS = (
    ("numeroControlePNCP", "numero_controle_pncp|numeroControlePNCP", "numeroControlePNCP", "numeroControlePNCP|numero_controle_pncp|raw.numero_controle_pncp"),
    ("objetoCompra", "description|objetoCompra", "objetoCompra", "objeto_compra"),
    ("titulo", "title|titulo", "tipoInstrumentoConvocatorioNome", "tipo_instrumento_convocatorio_nome"),
    ("anoCompra", "ano|anoCompra", "anoCompra", "ano_compra"),
    ("sequencialCompra", "numero_sequencial|sequencialCompra", "sequencialCompra", "sequencial_compra"),
    ("numeroCompra", "numero", "numeroCompra", "numero_compra"),
    ("processo", "", "processo", "processo"),
    ("modalidadeId", "modalidade_licitacao_id|modalidadeId", "modalidadeId", "modalidade_id"),
    ("modalidadeNome", "modalidade_licitacao_nome|modalidadeNome", "modalidadeNome", "modalidade_nome"),
    ("tipoInstrumentoConvocatorioCodigo", "tipo_id|tipoInstrumentoConvocatorioCodigo", "tipoInstrumentoConvocatorioCodigo", "tipo_instrumento_convocatorio_codigo"),
    ("tipoInstrumentoConvocatorioNome", "tipo_nome|tipoInstrumentoConvocatorioNome", "tipoInstrumentoConvocatorioNome", "tipo_instrumento_convocatorio_nome"),
    ("situacaoCompraId", "situacao_id|situacaoCompraId", "situacaoCompraId", "situacao_compra_id"),
    ("situacaoCompraNome", "situacao_nome|situacaoCompraNome", "situacaoCompraNome", "situacao_compra_nome"),
    ("orgaoEntidade.cnpj", "orgao_cnpj", "orgaoEntidade.cnpj", "orgao_entidade.cnpj"),
    ("orgaoEntidade.razaoSocial", "orgao_nome", "orgaoEntidade.razaoSocial", "orgao_entidade.razao_social"),
    ("orgaoEntidade.poderId", "poder_id", "orgaoEntidade.poderId", "orgao_entidade.poder_id"),
    ("orgaoEntidade.esferaId", "esfera_id", "orgaoEntidade.esferaId", "orgao_entidade.esfera_id"),
    ("unidadeOrgao.codigoUnidade", "unidade_codigo", "unidadeOrgao.codigoUnidade", "unidade_orgao.codigo_unidade"),
    ("unidadeOrgao.nomeUnidade", "unidade_nome", "unidadeOrgao.nomeUnidade", "unidade_orgao.nome_unidade"),
    ("unidadeOrgao.municipioNome", "municipio_nome", "unidadeOrgao.municipioNome", "unidade_orgao.municipio_nome"),
    ("unidadeOrgao.ufSigla", "uf", "unidadeOrgao.ufSigla", "unidade_orgao.uf_sigla"),
    ("unidadeOrgao.ufNome", "", "unidadeOrgao.ufNome", ""),
    ("unidadeOrgao.codigoIbge", "", "unidadeOrgao.codigoIbge", ""),
    ("dataPublicacaoPncp", "data_publicacao_pncp|dataPublicacaoPncp", "dataPublicacaoPncp", "datas.publicacao_pncp"),
    ("dataAtualizacaoGlobal", "data_atualizacao_pncp|dataAtualizacaoPncp", "dataAtualizacaoGlobal|dataAtualizacao", "datas.atualizacao_global|datas.atualizacao"),
    ("dataAberturaProposta", "data_inicio_vigencia", "dataAberturaProposta", "datas.abertura_proposta"),
    ("dataEncerramentoProposta", "data_fim_vigencia", "dataEncerramentoProposta", "datas.encerramento_proposta"),
    ("valorTotalEstimado", "valor_global", "valorTotalEstimado", "valor_total_estimado"),
    ("valorTotalHomologado", "", "valorTotalHomologado", "valor_total_homologado"),
    ("modoDisputaId", "", "modoDisputaId", "modo_disputa_id"),
    ("modoDisputaNome", "", "modoDisputaNome", "modo_disputa_nome"),
    ("linkSistemaOrigem", "item_url|itemUrl", "linkSistemaOrigem", "links.sistema_origem"),
    ("linkProcessoEletronico", "", "linkProcessoEletronico", "links.processo_eletronico"),
    ("fontesOrcamentarias", "fonte_orcamentaria", "fontesOrcamentarias", "fontes_orcamentarias"),
    ("usuarioNome", "", "usuarioNome", "usuario_nome"),
)
ARRAYS = {"fonte_orcamentaria", "fontesOrcamentarias", "fontes_orcamentarias"}  # elements stay JSON text
MONEY = {"valorTotalEstimado", "valorTotalHomologado"}
# a consulta row with one of these keys has the feed's own shape, any other is a premium record
CONSULTA_KEYS = ("orgaoEntidade", "unidadeOrgao", "dataAberturaProposta")

# The flat notice of the search feed (P05), column by JSON key.
SEARCH_FLAT_FIELDS = (
    ("objetoCompra", "description"), ("titulo", "title"), ("id", "id"), ("numeroControlePNCP", "numero_controle_pncp"),
    ("anoCompra", "ano"), ("sequencialCompra", "numero_sequencial"), ("numero", "numero"), ("documentType", "document_type"),
    ("tipoId", "tipo_id"), ("tipoNome", "tipo_nome"), ("modalidadeLicitacaoId", "modalidade_licitacao_id"),
    ("modalidadeLicitacaoNome", "modalidade_licitacao_nome"), ("situacaoId", "situacao_id"), ("situacaoNome", "situacao_nome"),
    ("orgaoId", "orgao_id"), ("orgaoCnpj", "orgao_cnpj"), ("orgaoNome", "orgao_nome"), ("unidadeId", "unidade_id"),
    ("unidadeCodigo", "unidade_codigo"), ("unidadeNome", "unidade_nome"), ("esferaId", "esfera_id"), ("esferaNome", "esfera_nome"),
    ("poderId", "poder_id"), ("poderNome", "poder_nome"), ("municipioId", "municipio_id"), ("municipioNome", "municipio_nome"),
    ("uf", "uf"), ("dataPublicacaoPncp", "data_publicacao_pncp"), ("dataAtualizacaoPncp", "data_atualizacao_pncp"),
    ("dataInicioVigencia", "data_inicio_vigencia"), ("dataFimVigencia", "data_fim_vigencia"), ("dataAssinatura", "data_assinatura"),
    ("cancelado", "cancelado"), ("temResultado", "tem_resultado"), ("valorGlobal", "valor_global"),
    ("fonteOrcamentaria", "fonte_orcamentaria"), ("fonteOrcamentariaId", "fonte_orcamentaria_id"),
    ("fonteOrcamentariaNome", "fonte_orcamentaria_nome"), ("itemUrl", "item_url"), ("urlPncp", "item_url"), ("createdAt", "createdAt"),
)


def paths_schema(paths) -> T.StructType:
    """Narrow schema of dotted JSON paths: every leaf is text, ``ARRAYS`` are arrays of text."""
    tree: dict = {}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node.setdefault(leaf, {})

    def struct(node: dict) -> T.StructType:
        return T.StructType([T.StructField(k, struct(v) if v else T.ArrayType(T.StringType()) if k in ARRAYS else T.StringType())
                             for k, v in node.items()])

    return struct(tree)


def _paths(*specs: str) -> list[str]:
    return [p for spec in specs for p in spec.split("|") if p]


def _picked(spec: str, column: str) -> Column:
    """First set value of ``spec`` in the parsed record ``r``."""
    if column == "fontesOrcamentarias":
        return F.coalesce(*[F.col(f"r.{p}") for p in _paths(spec)], F.array().cast("array<string>"))
    value = D.first_truthy(*[F.col(f"r.{p}") for p in _paths(spec)]) if spec else F.lit(None).cast("string")
    return D.safe_double(value) if column in MONEY else value


def _common(choose) -> list[Column]:
    """The common notice's columns from ``choose(column, search, consulta, premium)``."""
    out: dict[str, object] = {}
    for column, *specs in COMMON_FIELDS:
        name, _, member = column.partition(".")
        if member:
            out.setdefault(name, []).append(choose(column, *specs).alias(member))
        else:
            out[name] = choose(column, *specs).alias(name)
    return [F.struct(*c).alias(name) if isinstance(c, list) else c for name, c in out.items()]


def _from_search(column: str, search: str, *_) -> Column:
    value = _picked(search, column)
    return D.absolute_url(value) if column == "linkSistemaOrigem" else value


def _from_consulta(column: str, _search: str, consulta: str, premium: str) -> Column:
    return F.when(F.col("_own"), _picked(consulta, column)).otherwise(_picked(premium, column))


COMMON_COLUMNS = [*dict.fromkeys(c.partition(".")[0] for c, *_ in COMMON_FIELDS), "_origem"]
SEARCH_SCHEMA = paths_schema([*_paths(*[s for _, s, _, _ in COMMON_FIELDS]), *[k for _, k in SEARCH_FLAT_FIELDS]])
CONSULTA_SCHEMA = paths_schema(_paths(*[c for _, _, c, _ in COMMON_FIELDS]))
CONSULTA_OR_PREMIUM_SCHEMA = paths_schema(_paths(*[s for _, _, *both in COMMON_FIELDS for s in both]))


def _parsed(df: DataFrame, raw: str, schema: T.StructType) -> DataFrame:
    keep = [c for c in df.columns if c != raw]
    own = F.arrays_overlap(F.json_object_keys(F.col(raw)), F.array(*map(F.lit, CONSULTA_KEYS)))
    return df.select(*keep, F.from_json(F.col(raw), schema).alias("r"), F.coalesce(own, F.lit(False)).alias("_own"))


def normalize_search(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Search-feed JSON -> common notice: snake_case names first, the
    camelCase spelling as fallback (first truthy), organisation and unit as
    structs, relative item URL made absolute, ``_origem = 'search'``."""
    x = _parsed(df, raw, SEARCH_SCHEMA)
    return x.select(*[c for c in df.columns if c != raw], *_common(_from_search), F.lit("search").alias("_origem"))


def normalize_consulta(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Consulta-feed JSON, or premium records (told apart row by row) ->
    common notice (``_origem = 'consulta'``)."""
    x = _parsed(df, raw, CONSULTA_OR_PREMIUM_SCHEMA)
    return x.select(*[c for c in df.columns if c != raw], *_common(_from_consulta), F.lit("consulta").alias("_origem"))


def normalize_feeds(df: DataFrame, raw: str = "raw", feed: str = "feed") -> DataFrame:
    """P04 + P06 in ONE pass over a mixed bronze table: a single parse with
    the union of both feed schemas, each output column picked per row by the
    record's feed.  Same result as ``normalize_search`` ∪ ``normalize_consulta``
    without scanning (and parsing) the bronze rows twice."""
    x = _parsed(df, raw, paths_schema(_paths(*[s for _, *specs in COMMON_FIELDS for s in specs])))

    def either(column, *specs):
        return F.when(F.col(feed) == "search", _from_search(column, *specs)).otherwise(_from_consulta(column, *specs))

    return x.select(*[c for c in df.columns if c != raw], *_common(either),
                    F.when(F.col(feed) == "search", "search").otherwise("consulta").alias("_origem"))


def reference_date(prefix: str = "") -> Column:
    """J01 reference date: update, else publication, else closing, else ''."""
    return D.first_truthy(F.col(prefix + "dataAtualizacaoGlobal"), F.col(prefix + "dataPublicacaoPncp"),
                          F.col(prefix + "dataEncerramentoProposta"), default="")


def normalize_search_flat(df: DataFrame, raw: str = "raw", term: str | None = None) -> DataFrame:
    """Search-feed JSON -> the flat notice of ``SEARCH_FLAT_FIELDS``
    (optionally tagged with the search term); ``urlPncp`` is absolute."""
    typed = {"cancelado": lambda c: c.try_cast("boolean"), "temResultado": lambda c: c.try_cast("boolean"),
             "valorGlobal": D.safe_double, "urlPncp": D.absolute_url}
    keep = [c for c in df.columns if c != raw]
    x = df.select(*keep, F.from_json(F.col(raw), paths_schema([k for _, k in SEARCH_FLAT_FIELDS])).alias("r"))
    tag = [F.lit(term).alias("termo_busca")] if term is not None else []
    return x.select(*keep, *[typed.get(c, lambda v: v)(F.col(f"r.{k}")).alias(c) for c, k in SEARCH_FLAT_FIELDS], *tag)


# ----------------------------------------------------------------- P08
def prune_empty(c: Column, dtype: T.DataType) -> Column:
    """P08 helper: NULL-out empties bottom-up: '', NaN/Inf, empty arrays,
    structs whose fields are all empty; arrays lose their empty elements."""
    if isinstance(dtype, T.StringType):
        return F.when(c != "", c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
    if isinstance(dtype, T.ArrayType):
        inner = F.transform(c, lambda e: prune_empty(e, dtype.elementType))
        kept = F.filter(inner, lambda e: e.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(dtype, T.StructType):
        fields = [prune_empty(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        any_set = None
        for f in dtype.fields:
            k = prune_empty(c[f.name], f.dataType).isNotNull()
            any_set = k if any_set is None else (any_set | k)
        return F.when(any_set, F.struct(*fields)) if any_set is not None else F.lit(None)
    return c


def to_pruned_json(df: DataFrame, cols=None, alias: str = "json", keep=()) -> DataFrame:
    """One JSON text per row with empty fields removed recursively."""
    cols = list(df.columns) if cols is None else list(cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    st = T.StructType([T.StructField(c, types[c]) for c in cols])
    pruned = prune_empty(F.struct(*[F.col(c) for c in cols]), st)
    return df.select(*keep, F.coalesce(F.to_json(pruned), F.lit("{}")).alias(alias))


# ----------------------------------------------------------------- P10
def object_text(df: DataFrame, raw: str | None = "raw", column: str | None = "objeto_compra") -> Column:
    """P10: the object text: own column, else JSON ``objetoCompra`` /
    ``objeto_compra`` / ``Objeto`` / ``objeto``, else ''."""
    parts = []
    if column and column in df.columns:
        parts.append(F.col(column))
    if raw and raw in df.columns:
        names = ("objetoCompra", "objeto_compra", "Objeto", "objeto")
        parsed = F.from_json(F.col(raw), "map<string,string>")
        parts += [F.try_element_at(parsed, F.lit(k)) for k in names]
    return D.first_truthy(*parts, default="")


# ----------------------------------------------------------------- P12/P16
def select_existing(df: DataFrame, cols) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in cols if c in have])


def ensure_columns(df: DataFrame, cols: dict) -> DataFrame:
    """All expected columns in fixed order; missing ones added as NULL."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None).cast(t)).alias(c)
                       for c, t in cols.items()])


# ----------------------------------------------------------------- K07
def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> dotted top-level columns (arrays kept)."""
    out = []

    def walk(prefix, path, dtype):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(prefix + [f.name], path + [f.name], f.dataType)
        else:
            c = F.col("`" + path[0] + "`")
            for p in path[1:]:
                c = c[p]
            out.append(c.alias(sep.join(prefix)))

    for f in df.schema.fields:
        walk([f.name], [f.name], f.dataType)
    return df.select(*out)


# ----------------------------------------------------------------- P13-P15
ATTACHMENT_SCHEMA = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in [
    "sequencialDocumento", "titulo", "nome", "tipo", "tipoDocumentoNome", "tipoDocumentoDescricao",
    "data", "dataPublicacaoPncp", "link", "url", "uri"]]))

ITEM_SCHEMA = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in [
    "sequencialItem", "sequencial", "descricao", "descricaoItem", "descricaoObjeto", "quantidade",
    "qtde", "unidade", "unidadeMedida", "valorUnitario", "valor_unitario", "valor", "valorTotal",
    "valor_total"]]))


def explode_attachments(df: DataFrame, raw: str = "raw", key: str = "pncp_id") -> DataFrame:
    """``Arquivos`` (else ``arquivos``) array -> one row per attachment,
    with title/type/date/link fallbacks; records without attachments give 0
    rows."""
    arr = F.coalesce(F.from_json(F.get_json_object(F.col(raw), "$.Arquivos"), ATTACHMENT_SCHEMA),
                     F.from_json(F.get_json_object(F.col(raw), "$.arquivos"), ATTACHMENT_SCHEMA))
    x = df.select(F.col(key), F.posexplode(arr).alias("pos", "a"))
    a = lambda n: F.col("a." + n)
    return x.select(
        F.col(key), (F.col("pos") + 1).cast("bigint").alias("posicao"),
        D.first_truthy(a("titulo"), a("nome")).alias("titulo"),
        D.first_truthy(a("tipo"), a("tipoDocumentoNome"), a("tipoDocumentoDescricao")).alias("tipo"),
        D.first_truthy(a("data"), a("dataPublicacaoPncp")).alias("data"),
        D.first_truthy(a("link"), a("url"), a("uri")).alias("link"),
    )


def attachment_listing(att: DataFrame, key: str = "pncp_id") -> DataFrame:
    """Listing rows: sequence (own or 1-based position), title <= 39
    chars, formatted date, type <= 27 chars, link url -> uri -> link, '—'."""
    a = lambda n: F.col("a." + n)
    seq = F.coalesce(F.when(a("sequencialDocumento").cast("string").isin("", "0") == F.lit(False),
                            a("sequencialDocumento")), F.col("pos").cast("string"))
    return att.select(
        F.col(key),
        seq.alias("seq"),
        F.substring(D.first_truthy(a("titulo"), default="—"), 1, 39).alias("titulo"),
        D.fmt_date(D.first_truthy(a("dataPublicacaoPncp"), a("data"), default=""), "listing").alias("data"),
        F.substring(D.first_truthy(a("tipoDocumentoNome"), a("tipoDocumentoDescricao"), a("tipo"),
                                   default="—"), 1, 27).alias("tipo"),
        D.first_truthy(a("url"), a("uri"), a("link"), default="").alias("link"),
    )


def explode_items(df: DataFrame, raw: str = "raw", key: str = "pncp_id") -> DataFrame:
    """``Itens`` array -> display rows: sequence, description, quantity,
    unit, unit price and total (BRL), with field fallbacks and '—'."""
    arr = F.from_json(F.get_json_object(F.col(raw), "$.Itens"), ITEM_SCHEMA)
    x = df.select(F.col(key), F.posexplode_outer(arr).alias("pos", "i"))
    i = lambda n: F.col("i." + n)
    dash = "—"
    return x.where(F.col("i").isNotNull()).select(
        F.col(key),
        D.first_truthy(i("sequencialItem"), i("sequencial"), (F.col("pos") + 1).cast("string")).alias("seq"),
        D.first_truthy(i("descricao"), i("descricaoItem"), i("descricaoObjeto"), default=dash).alias("descricao"),
        D.first_truthy(i("quantidade"), i("qtde"), default=dash).alias("quantidade"),
        D.first_truthy(i("unidade"), i("unidadeMedida"), default=dash).alias("unidade"),
        F.coalesce(D.fmt_brl(D.first_truthy(i("valorUnitario"), i("valor_unitario"), i("valor"))),
                   F.lit(dash)).alias("valor_unitario"),
        F.coalesce(D.fmt_brl(D.first_truthy(i("valorTotal"), i("valor_total"))), F.lit(dash)).alias("valor_total"),
    )


# ----------------------------------------------------------------- P07
def top_keywords_inline(toks: Column, k: int = 8) -> Column:
    """The ``k`` most frequent tokens of a record, ties by first occurrence."""
    return F.transform(X.top_tokens(toks, k), lambda x: x["t"])


# The premium record (P07), column or group member by consulta
# path, with the type where it is not text.
PREMIUM_FIELDS = (
    ("objeto_compra", "objetoCompra", ""), ("numero_controle_pncp", "numeroControlePNCP", ""),
    ("valor_total_estimado", "valorTotalEstimado", "double"), ("valor_total_homologado", "valorTotalHomologado", "double"),
    ("informacao_complementar", "informacaoComplementar", ""), ("id", "numeroControlePNCP", ""),
    ("categoria_objeto", "objetoCompra", "category"), ("palavras_chave", "objetoCompra", "keywords"),
    ("ano_compra", "anoCompra", "int"), ("sequencial_compra", "sequencialCompra", "long"), ("numero_compra", "numeroCompra", ""),
    ("processo", "processo", ""), ("modalidade_id", "modalidadeId", "int"), ("modalidade_nome", "modalidadeNome", ""),
    ("modo_disputa_id", "modoDisputaId", "int"), ("modo_disputa_nome", "modoDisputaNome", ""),
    ("tipo_instrumento_convocatorio_codigo", "tipoInstrumentoConvocatorioCodigo", "int"),
    ("tipo_instrumento_convocatorio_nome", "tipoInstrumentoConvocatorioNome", ""),
    ("situacao_compra_id", "situacaoCompraId", ""), ("situacao_compra_nome", "situacaoCompraNome", ""), ("srp", "srp", "boolean"),
    ("datas.publicacao_pncp", "dataPublicacaoPncp", ""), ("datas.abertura_proposta", "dataAberturaProposta", ""),
    ("datas.encerramento_proposta", "dataEncerramentoProposta", ""), ("datas.atualizacao", "dataAtualizacao", ""),
    ("datas.atualizacao_global", "dataAtualizacaoGlobal", ""), ("datas.inclusao", "dataInclusao", ""),
    ("orgao_entidade.cnpj", "orgaoEntidade.cnpj", ""), ("orgao_entidade.razao_social", "orgaoEntidade.razaoSocial", ""),
    ("orgao_entidade.poder_id", "orgaoEntidade.poderId", ""), ("orgao_entidade.esfera_id", "orgaoEntidade.esferaId", ""),
    ("unidade_orgao.uf_nome", "unidadeOrgao.ufNome", ""), ("unidade_orgao.uf_sigla", "unidadeOrgao.ufSigla", ""),
    ("unidade_orgao.municipio_nome", "unidadeOrgao.municipioNome", ""), ("unidade_orgao.nome_unidade", "unidadeOrgao.nomeUnidade", ""),
    ("unidade_orgao.codigo_ibge", "unidadeOrgao.codigoIbge", ""), ("unidade_orgao.codigo_unidade", "unidadeOrgao.codigoUnidade", ""),
    ("amparo_legal.codigo", "amparoLegal.codigo", ""), ("amparo_legal.nome", "amparoLegal.nome", ""),
    ("amparo_legal.descricao", "amparoLegal.descricao", ""), ("links.sistema_origem", "linkSistemaOrigem", ""),
    ("links.processo_eletronico", "linkProcessoEletronico", ""), ("justificativa_presencial", "justificativaPresencial", ""),
    ("usuario_nome", "usuarioNome", ""), ("fontes_orcamentarias", "fontesOrcamentarias", ""),
)


def normalize_premium(df: DataFrame, raw: str = "raw", categories=None) -> DataFrame:
    """Consulta JSON -> premium record: snake_case, nested groups (datas,
    orgao_entidade, unidade_orgao, amparo_legal, links), object category
    (T09), top-8 keywords (T08), safe floats (P09)."""
    keep = [c for c in df.columns if c != raw]
    x = df.select(*keep, F.from_json(F.col(raw), paths_schema([p for _, p, _ in PREMIUM_FIELDS])).alias("r"))
    made = {"category": lambda c: X.categorize(F.coalesce(c, F.lit("")), categories),
            "keywords": lambda c: top_keywords_inline(X.tokens(F.coalesce(c, F.lit("")))), "double": D.safe_double}
    out: dict[str, object] = {}
    for column, path, kind in PREMIUM_FIELDS:
        name, _, member = column.partition(".")
        c = F.col(f"r.{path}")
        c = made[kind](c) if kind in made else c.try_cast(kind) if kind else c
        if member:
            out.setdefault(name, []).append(c.alias(member))
        else:
            out[name] = c.alias(name)
    return x.select(*keep, *[F.struct(*c).alias(n) if isinstance(c, list) else c for n, c in out.items()])


def premium_flat(p: DataFrame) -> DataFrame:
    """Premium record with the nested groups lifted to top-level columns."""
    groups = ("datas", "orgao_entidade", "unidade_orgao")
    return p.select("*", *[f"{g}.*" for g in groups]).drop(*groups)


# ----------------------------------------------------------------- P11
REPORT_SCHEMA = T.StructType([
    *[T.StructField(n, T.StringType()) for n in [
        "numeroControlePNCP", "anoCompra", "sequencialCompra", "numeroCompra", "processo", "objetoCompra",
        "modalidadeNome", "modoDisputaNome", "situacaoCompraNome", "tipoInstrumentoConvocatorioNome",
        "valorTotalEstimado", "valorTotalHomologado", "dataAberturaProposta", "dataEncerramentoProposta",
        "dataPublicacaoPncp", "dataAtualizacao", "dataInclusao", "linkSistemaOrigem",
        "linkProcessoEletronico", "usuarioNome"]],
    T.StructField("orgaoEntidade", T.StructType([T.StructField(n, T.StringType()) for n in ["cnpj", "razaoSocial"]])),
    T.StructField("unidadeOrgao", T.StructType([T.StructField(n, T.StringType()) for n in
                                                ["ufSigla", "ufNome", "municipioNome", "nomeUnidade"]])),
    T.StructField("amparoLegal", T.StructType([T.StructField("nome", T.StringType())])),
    # only the sizes are needed: one small field per element keeps the parse cheap
    T.StructField("Arquivos", T.ArrayType(T.StructType([T.StructField("sequencialDocumento", T.StringType())]))),
    T.StructField("Itens", T.ArrayType(T.StructType([T.StructField("sequencialItem", T.StringType())]))),
])


def _safe_str(v: Column, default: str = "") -> Column:
    """P03 on an already parsed value: NULL / 'none' / 'null' / blank -> default; stripped."""
    s = X.strip(v)
    return F.when(v.isNull() | F.lower(s).isin("none", "null", ""), F.lit(default)).otherwise(s)


def report_rows(df: DataFrame, json_col: str = "dados_json", today: str | None = None) -> DataFrame:
    """Report-ready rows from a filtered table.

    The JSON is parsed once (narrow schema).  Field precedence follows the
    report code: JSON first for most fields; the table column first for
    ``pncp_id``, ``uf_sigla`` and ``objeto_compra``.  Attachments/items: the
    record's own arrays (their sizes here; P13/P15 explode them).  Display
    forms use T12-T16.
    """
    cols = set(df.columns)
    col = lambda n: F.col(n) if n in cols else F.lit(None).cast("string")
    x = df.withColumn("_j", F.from_json(F.col(json_col), REPORT_SCHEMA))
    s = lambda *k: _safe_str(F.col("_j." + ".".join(k)))
    t = D.first_truthy
    orgao = t(s("orgaoEntidade", "razaoSocial"), col("orgao_nome"), s("unidadeOrgao", "nomeUnidade"), default="")
    numero = t(s("numeroControlePNCP"), col("pncp_id"), col("numero_controle_pncp"), default="")
    out = x.select(
        t(col("pncp_id"), col("numero_controle_pncp"), s("numeroControlePNCP")).alias("pncp_id"),
        numero.alias("numero_controle"),
        s("anoCompra").alias("ano_compra"), s("sequencialCompra").alias("sequencial_compra"),
        s("numeroCompra").alias("numero_compra"), s("processo").alias("processo"),
        orgao.alias("orgao_nome"), s("orgaoEntidade", "cnpj").alias("cnpj"),
        t(col("uf_sigla"), s("unidadeOrgao", "ufSigla"), default="").alias("uf_sigla"),
        s("unidadeOrgao", "ufNome").alias("uf_nome"), s("unidadeOrgao", "municipioNome").alias("municipio"),
        s("unidadeOrgao", "nomeUnidade").alias("unidade"),
        t(col("objeto_compra"), s("objetoCompra"), default="").alias("objeto_compra"),
        s("modalidadeNome").alias("modalidade"), s("modoDisputaNome").alias("modo_disputa"),
        t(s("situacaoCompraNome"), col("situacao_nome"), default="").alias("situacao"),
        s("tipoInstrumentoConvocatorioNome").alias("instrumento"),
        t(s("valorTotalEstimado"), col("valor_estimado"), default="").alias("valor_estimado"),
        s("valorTotalHomologado").alias("valor_homologado"),
        s("dataAberturaProposta").alias("data_abertura"),
        s("dataEncerramentoProposta").alias("data_encerramento"),
        s("dataPublicacaoPncp").alias("data_publicacao"),
        s("dataAtualizacao").alias("data_atualizacao"), s("dataInclusao").alias("data_inclusao"),
        D.valid_link(s("linkSistemaOrigem")).alias("link_sistema"),
        D.valid_link(s("linkProcessoEletronico")).alias("link_processo"),
        D.portal_link(t(s("numeroControlePNCP"), col("pncp_id"))).alias("link_pncp"),
        s("amparoLegal", "nome").alias("amparo_legal"), s("usuarioNome").alias("usuario"),
        F.coalesce(F.when(col("categoria") != "", col("categoria")), F.lit("")).alias("categoria"),
        F.coalesce(F.when(col("motivo") != "", col("motivo")), F.lit("")).alias("motivo"),
        F.coalesce(F.size(F.col("_j.Arquivos")), F.lit(0)).cast("bigint").alias("n_arquivos"),
        F.coalesce(F.size(F.col("_j.Itens")), F.lit(0)).cast("bigint").alias("n_itens"),
    )
    out = (out.withColumn("valor_estimado_fmt", D.fmt_brl("valor_estimado"))
              .withColumn("data_encerramento_fmt", D.fmt_date("data_encerramento"))
              .withColumn("cnpj_fmt", D.fmt_cnpj("cnpj")))
    if today:
        out = out.withColumn("prazo", D.deadline_status("data_encerramento", today))
    return out
