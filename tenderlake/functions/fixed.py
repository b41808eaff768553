"""FIXED VALUES.

Word lists, term lists, regular-expression dictionaries and label maps whose
exact contents decide results.  They are data, listed plainly and in their
natural order; operators take them as parameters, these are the defaults.
"""

# ---------------------------------------------------------------- fixed values
# Fallback stop-words of the ML text cleaner (used when no language list is
# available).
CLEANER_STOPWORDS = ["a", "o", "e", "de", "para", "com", "um", "uma"]

# Stop-words of the folded tokeniser used for keyword extraction.
TOKEN_STOPWORDS = [
    "a", "o", "e", "de", "da", "do", "das", "dos", "para", "por", "com",
    "sem", "em", "na", "no", "nas", "nos", "um", "uma", "uns", "umas",
    "ao", "aos", "à", "às", "que", "se", "sob", "sobre", "entre", "ou",
    "como", "ser", "será", "sendo", "visando", "atender", "necessidades",
    "necessidade", "destinados", "destinadas", "destinado", "destinada",
    "conforme", "termo", "referencia", "edital", "anexo", "anexos",
    "prestacao", "servicos", "servico", "contratacao", "empresa",
    "aquisição", "aquisicao", "objeto", "municipio", "municipal",
]

# Ordered category dictionary: the first category with a term contained in
# the folded text wins, else "outros".
CATEGORIES = [
    ("tecnologia", [
        "software", "sistema", "informatica", "internet", "rede", "computador",
        "notebook", "scanner", "licenca", "antivirus", "camera", "videomonitoramento",
        "monitoramento", "equipamentos de informatica", "fibra optica"]),
    ("engenharia_obras", [
        "obra", "construcao", "reforma", "pavimentacao", "drenagem", "engenharia",
        "reservatorio", "ubs", "unidade basica", "canalizacao", "adutora"]),
    ("saude", [
        "saude", "hospital", "medico", "medicos", "consulta", "cirurgia", "exames",
        "mamografia", "ambulancia", "pacientes", "piscina", "psiquiatria"]),
    ("educacao", [
        "escola", "creche", "merenda", "educacao", "alunos", "unidades escolares"]),
    ("alimentacao", [
        "alimentos", "generos alimenticios", "panificados", "refeicoes", "marmitex",
        "peixes", "cestas basicas", "ovos de pascoa", "buffet"]),
    ("veiculos_logistica", [
        "veiculo", "veiculos", "frota", "transporte", "caminhao", "van",
        "moto niveladora", "seguro veicular", "caçambas", "cacambas"]),
    ("manutencao_materiais", [
        "material", "materiais", "eletrico", "eletricos", "madeira", "mobilia",
        "suprimentos", "insumos", "quimicos", "uniforme", "vestuario"]),
    ("servicos_gerais", [
        "prestacao de servicos", "servicos", "assessoria", "consultoria",
        "publicidade", "comunicacao", "pesquisa", "limpeza", "manutencao"]),
]
DEFAULT_CATEGORY = "outros"

# Keyword dimension (one term per line of the keyword file, in file order).
ACCESS_KEYWORDS = [
    "software de controle de acesso", "software de segurança", "software de monitoramento",
    "software para controle de portaria", "software para registro de frequência",
    "software de gestão", "relógio de ponto", "cartão de ponto", "controle de ponto",
    "reconhecimento facial", "registrador eletrônico de ponto biométrico",
    "gerenciamento eletrônico de frequência", "controle de frequência",
    "registrador de ponto facial", "sistema com aplicativo facial",
    "controle de frequência facial", "controle de faces", "equipamento com biometria de face",
    "identificador facial", "bastão de ronda", "relógio protocolador", "relógio cartográfico",
    "bobina térmica para relógio de ponto", "papel termosensível para relógio de ponto",
    "controlador de acesso", "fechadura facial", "fechadura biométrica",
    "fechadura eletrônica facial", "fechadura eletromagnética", "controladora de acesso facial",
    "hid", "hickvision", "detector de metais", "porta giratória", "portal detector metal",
    "porta automática", "motor de portão", "catracas faciais", "catraca balcão",
    "catraca mecânica", "catracas eletrônicas", "catraca pedestal bidirecional", "catraca pne",
    "controle de acesso", "controle de acesso facial", "cancela automática",
    "cancela eletrônica", "leitores faciais", "torniquete",
    "conjunto controle acesso área restrita", "idface", "botoeira", "veja o datsheet",
]

# Strong rule terms (substring match on the squashed lower-case text).
STRONG_POSITIVE_TERMS = [
    "controle de acesso", "controle de acesso facial", "catraca", "catracas",
    "leitor facial", "leitores faciais", "reconhecimento facial", "biometria facial",
    "biometria de face", "relógio de ponto", "controle de ponto", "registro de frequência",
    "controle de frequência", "registrador eletrônico de ponto", "rep", "rep-c", "rep-p",
    "idface", "hid", "fechadura biométrica", "fechadura eletromagnética",
    "cancela eletrônica", "cancela automática", "torniquete", "botoeira",
    "porta giratória", "detector de metais", "software gerenciador de controle de acesso",
]
STRONG_NEGATIVE_TERMS = [
    "medicamentos", "cadeiras escolares", "merenda escolar", "gêneros alimentícios",
    "material de limpeza", "combustível", "combustíveis", "frota", "rastreamento veicular",
    "gps", "telemetria", "uniforme", "livros didáticos", "software de multas",
    "prontuário eletrônico", "erp hospitalar", "buffet", "academia ao ar livre",
    "estação solda", "solda",
]

# Flexible separator between the words of a phrase pattern.
SEP = r"[\s\-_/]*"

# Named regular-expression dictionaries (case-insensitive search on the
# squashed lower-case text).  Phrases written "a b c" in FLEX_PHRASES are
# compiled by ``flex_pattern``: escaped words joined by SEP, word-bounded.
POSITIVE_PATTERNS = {
    "software_controle_acesso": ("flex", "software de controle de acesso"),
    "software_seguranca": ("re", r"\bsoftware" + SEP + r"de" + SEP + r"seguran[cç]a\b"),
    "software_monitoramento": ("flex", "software de monitoramento"),
    "software_portaria": ("flex", "software para controle de portaria"),
    "software_registro_frequencia": ("re", r"\bsoftware" + SEP + r"para" + SEP + r"registro" + SEP + r"de" + SEP + r"frequ[eê]ncia\b"),
    "software_gestao": ("re", r"\bsoftware" + SEP + r"de" + SEP + r"gest[aã]o\b"),
    "relogio_ponto": ("re", r"\brel[oó]gio" + SEP + r"de" + SEP + r"ponto\b"),
    "cartao_ponto": ("re", r"\bcart[aã]o" + SEP + r"de" + SEP + r"ponto\b"),
    "controle_ponto": ("flex", "controle de ponto"),
    "reconhecimento_facial": ("flex", "reconhecimento facial"),
    "registrador_eletronico_ponto_biometrico": ("re", r"\bregistrador" + SEP + r"eletr[oô]nico" + SEP + r"de" + SEP + r"ponto" + SEP + r"biom[eé]trico\b"),
    "gerenciamento_eletronico_frequencia": ("re", r"\bgerenciamento" + SEP + r"eletr[oô]nico" + SEP + r"de" + SEP + r"frequ[eê]ncia\b"),
    "controle_frequencia": ("re", r"\bcontrole" + SEP + r"de" + SEP + r"frequ[eê]ncia\b"),
    "registrador_ponto_facial": ("re", r"\bregistrador" + SEP + r"de" + SEP + r"ponto" + SEP + r"facial\b"),
    "sistema_aplicativo_facial": ("re", r"\bsistema" + SEP + r"com" + SEP + r"aplicativo" + SEP + r"facial\b"),
    "controle_frequencia_facial": ("re", r"\bcontrole" + SEP + r"de" + SEP + r"frequ[eê]ncia" + SEP + r"facial\b"),
    "controle_faces": ("flex", "controle de faces"),
    "biometria_face": ("re", r"\bequipamento" + SEP + r"com" + SEP + r"biometria" + SEP + r"de" + SEP + r"face\b"),
    "identificador_facial": ("flex", "identificador facial"),
    "bastao_ronda": ("re", r"\bbast[aã]o" + SEP + r"de" + SEP + r"ronda\b"),
    "relogio_protocolador": ("re", r"\brel[oó]gio" + SEP + r"protocolador\b"),
    "relogio_cartografico": ("re", r"\brel[oó]gio" + SEP + r"cartogr[aá]fico\b"),
    "bobina_termica_relogio_ponto": ("re", r"\bbobina" + SEP + r"t[eé]rmica" + SEP + r"para" + SEP + r"rel[oó]gio" + SEP + r"de" + SEP + r"ponto\b"),
    "papel_termosensivel_relogio_ponto": ("re", r"\bpapel" + SEP + r"termosens[ií]vel" + SEP + r"para" + SEP + r"rel[oó]gio" + SEP + r"de" + SEP + r"ponto\b"),
    "controlador_acesso": ("flex", "controlador de acesso"),
    "fechadura_facial": ("flex", "fechadura facial"),
    "fechadura_biometrica": ("re", r"\bfechadura" + SEP + r"biom[eé]trica\b"),
    "fechadura_eletronica_facial": ("re", r"\bfechadura" + SEP + r"eletr[oô]nica" + SEP + r"facial\b"),
    "fechadura_eletromagnetica": ("re", r"\bfechadura" + SEP + r"eletromagn[eé]tica\b"),
    "controladora_acesso_facial": ("re", r"\bcontroladora" + SEP + r"de" + SEP + r"acesso" + SEP + r"facial\b"),
    "hid": ("re", r"\bhid\b"),
    "hikvision": ("re", r"\bh[ií]?kvision\b"),
    "detector_metais": ("flex", "detector de metais"),
    "porta_giratoria": ("re", r"\bporta" + SEP + r"girat[oó]ria\b"),
    "portal_detector_metal": ("re", r"\bportal" + SEP + r"detector" + SEP + r"metal\b"),
    "porta_automatica": ("re", r"\bporta" + SEP + r"autom[aá]tica\b"),
    "motor_portao": ("re", r"\bmotor" + SEP + r"de" + SEP + r"port[aã]o\b"),
    "catraca_facial": ("re", r"\bcatraca(?:s)?" + SEP + r"facial(?:is)?\b"),
    "catraca_balcao": ("re", r"\bcatraca(?:s)?" + SEP + r"balc[aã]o\b"),
    "catraca_mecanica": ("re", r"\bcatraca(?:s)?" + SEP + r"mec[aâ]nica(?:s)?\b"),
    "catraca_eletronica": ("re", r"\bcatraca(?:s)?" + SEP + r"eletr[oô]nica(?:s)?\b"),
    "catraca_pedestal_bidirecional": ("re", r"\bcatraca(?:s)?" + SEP + r"pedestal" + SEP + r"bidirecional\b"),
    "catraca_pne": ("re", r"\bcatraca(?:s)?" + SEP + r"pne\b"),
    "controle_acesso": ("flex", "controle de acesso"),
    "controle_acesso_facial": ("re", r"\bcontrole" + SEP + r"de" + SEP + r"acesso" + SEP + r"facial\b"),
    "cancela_automatica": ("re", r"\bcancela(?:s)?" + SEP + r"autom[aá]tica(?:s)?\b"),
    "cancela_eletronica": ("re", r"\bcancela(?:s)?" + SEP + r"eletr[oô]nica(?:s)?\b"),
    "leitor_facial": ("re", r"\bleitor(?:es)?" + SEP + r"facial(?:is)?\b"),
    "torniquete": ("re", r"\btorniquete(?:s)?\b"),
    "conjunto_controle_area_restrita": ("re", r"\bconjunto" + SEP + r"controle" + SEP + r"acesso" + SEP + r"[aá]rea" + SEP + r"restrita\b"),
    "idface": ("re", r"\bidface\b"),
    "botoeira": ("re", r"\bbotoeira(?:s)?\b"),
}
NEGATIVE_PATTERNS = {
    "medicamentos": ("re", r"\bmedicamento(?:s)?\b"),
    "cadeiras_escolares": ("re", r"\bcadeira(?:s)?" + SEP + r"escolar(?:es)?\b"),
    "merenda_escolar": ("flex", "merenda escolar"),
    "generos_alimenticios": ("re", r"\bg[eê]neros?" + SEP + r"aliment[ií]cios?\b"),
    "material_limpeza": ("flex", "material de limpeza"),
    "combustiveis": ("re", r"\bcombust[ií]vel(?:eis|es)?\b"),
    "frota": ("re", r"\bfrota(?:s)?\b"),
    "rastreamento_veicular": ("re", r"\brastreamento" + SEP + r"veicular\b"),
    "gps": ("re", r"\bgps\b"),
    "telemetria": ("re", r"\btelemetria\b"),
    "uniforme": ("re", r"\buniforme(?:s)?\b"),
    "livros_didaticos": ("re", r"\blivro(?:s)?" + SEP + r"did[aá]tico(?:s)?\b"),
    "software_multas": ("re", r"\bsoftware" + SEP + r"de" + SEP + r"multa(?:s)?\b"),
    "prontuario_eletronico": ("re", r"\bprontu[aá]rio" + SEP + r"eletr[oô]nico\b"),
    "erp_hospitalar": ("re", r"\berp" + SEP + r"hospitalar\b"),
    "buffet": ("re", r"\bbuffet\b"),
    "estacao_solda": ("re", r"\besta[cç][aã]o" + SEP + r"de" + SEP + r"solda\b"),
    "solda": ("re", r"\bsolda\b"),
}

# Stems that mark a scorer's reason text as ambiguous.
AMBIGUITY_STEMS = [
    "ambígu", "ambigu", "dúvida", "duvida", "incerto", "incerta",
    "depende", "não está claro", "nao esta claro", "genérico", "generico",
]

# Closed set of scorer categories.
SCORER_CATEGORIES = ["cracha", "ponto_eletronico", "controle_acesso", "cftv"]

# Display names of category slugs (others are title-cased; blank -> "—").
CATEGORY_NAMES = {
    "cracha": "Crachá / Identificação",
    "ponto_eletronico": "Ponto Eletrônico",
    "controle_acesso": "Controle de Acesso",
    "cftv": "CFTV / Câmeras",
}

# Display constants.
NOT_INFORMED = "Não informado"
DASH = "—"
PORTAL_BASE = "https://pncp.gov.br/editais/"
SITE_BASE = "https://pncp.gov.br"

# Control number, and the file name of a Content-Disposition header.
CONTROL_RE = r"^(\d+)-1-(\d+)/(\d+)"
DISPOSITION_RE = r"""(?i)filename\*?=["']?(?:UTF-8'')?([^"';\r\n]+)"""

# Content type -> file extension (others: ".bin").
CONTENT_TYPE_EXT = {
    "application/pdf": ".pdf",
    "application/msword": ".doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "application/vnd.ms-excel": ".xls",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx",
    "application/zip": ".zip",
    "text/plain": ".txt",
    "text/html": ".html",
    "image/jpeg": ".jpg",
    "image/png": ".png",
}

# Decision thresholds.
THRESHOLD_RELEVANT = 0.85
THRESHOLD_REVIEW = 0.40
REVIEW_CONFIDENCE = 0.8
# ------------------------------------------------------------ end fixed values
