"""Words, labels, patterns and limits that results depend on."""

# Function words that mark a language, in order of precedence of the languages.
STOPWORDS = {
    "pt": "de que não uma com para como dos das por mais são também está pelo pela seu sua você então após é à às saúde doença".split(),
    "es": "de que no una con para como los las por más son también está este esta su sus usted entonces después el la salud".split(),
    "en": "the of and that with for from this are was which have has not their been between health disease study results objective methods".split(),
    "fr": "de que ne une avec pour comme les des par plus sont aussi est cette leur vous alors après à santé maladie résultats".split(),
    "it": "di che non una con per come gli dei delle più sono anche è questa loro dopo alla salute malattia risultati obiettivo".split(),
}
# Fixed value: letters of a token, in lower case.
TOKEN = "[a-záàâãéêíóôõúüçñèìòùäöß]+"
# Limits of page routing, document types, gates and excerpts.
NATIVE_CHARS_PER_PAGE = 100
ARTICLE_MAX_PAGES, MANUAL_MIN_PAGES = 15, 10
OCR_MIN_CONF, OCR_MIN_WORDS = 75.0, 15
GARBAGE_MAX, STOPWORD_MIN, MIN_TOKENS, CONF_MIN, EMPTY_PAGES_ERROR = 0.15, 2.0, 40, 60.0, 0.2
OVERLAP_MIN, MIN_BASE_WORDS, MIN_WORD_LEN, LANG_MIN_TOKENS, EXPLOSION_CHARS, EXPLOSION_MAX_BASE = 0.30, 5, 4, 40, 3000, 10
EDGE_LINES, MIN_PAGES, REPEAT_RATIO = 3, 3, 0.4
MAX_CHARS, BLOCK_CHARS = 42000, 40000
PIPELINE_VERSION = "3"
# Headings (group 1 of each pattern), written without word-boundary signs.
IMRAD = "RESUMO|ABSTRACT|RESUMEN|M[ÉE]TODOS?|METHODS?|RESULTADOS?|RESULTS?|CONCLUS[ÕO]ES?|CONCLUSIONS?"
KEYWORDS = r"Palavras[- ]chave|Keywords?|Palabras\s+clave|Descritores"
CONTENTS = "SUM[ÁA]RIO|[ÍI]NDICE|TABLE OF CONTENTS|PREF[ÁA]CIO|APRESENTA[ÇC][ÃA]O"
STRUCTURE = {
    "sumario": "SUM[ÁA]RIO|[ÍI]NDICE|TABLE OF CONTENTS|CONTENTS",
    "apresentacao": "APRESENTA[ÇC][ÃA]O|PREF[ÁA]CIO|PRESENTACI[ÓO]N|PREFACE|FOREWORD|PR[ÓO]LOGO",
    "introducao": r"INTRODU[ÇC][ÃA]O|INTRODUCCI[ÓO]N|INTRODUCTION|1\.?\s+INTRODU",
    "conclusao": r"CONCLUS[ÕO]ES?|CONCLUSIONES?|CONCLUSIONS?|CONSIDERA[ÇC][ÕO]ES\s+FINAIS",
    "abstract": "RESUMO|ABSTRACT|RESUMEN|R[ÉE]SUM[ÉE]",
}
# Abstract headings and their languages, keyword marks, starts of a body, tails to cut.
ABSTRACT_HEADERS = {"RESUMO": "pt", "ABSTRACT": "en", "RESUMEN": "es", "RÉSUMÉ": "fr", "RESUME": "fr", "RIASSUNTO": "it", "ZUSAMMENFASSUNG": "de"}
ABSTRACT_KEYWORDS = r"Palavras[- ]chave|Palabras[- ]llave|Keywords?|Palabras\s+clave|Mots[- ]cl[ée]s|Descritores|Descriptors"
ABSTRACT_BODY = r"Introdu[cç][aã]o|Introduction|Introducci[oó]n|1\.?\s+Introdu|Background"
ABSTRACT_TAILS = (
    r"\bCom\.\s*Ci[eê]ncias\s+Sa[uú]de\b",
    r"\bRev\.?\s*[A-Z][a-z]+\.?\s*\d{4}",
    r"\bTelefone\b",
    r"\bE[- ]?mail\b",
    r"\bEndere[cç]o\b",
    r"\bPalabras[- ]llave\b",
)
ABSTRACT_MIN, ABSTRACT_MAX, BODY_AFTER = 40, 2500, 200
# Fixed value: characters that a legible transcript consists of.
LEGIBLE = r"A-Za-zÀ-ÖØ-öø-ÿĀ-ž0-9\s.,;:¡!¿?()\[\]{}<>\"'´`’‘“”«»\-–—_/\\%&@#*+=§°ºª·•€$£~^|"
# Phrases of a refusal or of talk to the user, in order.
REFUSALS = (
    "no puedo generar",
    "no puedo ayudar",
    "não posso gerar",
    "não posso",
    "i cannot",
    "i can't",
    "as an ai",
    "i'm sorry",
    "lo siento, pero",
    "desculpe, mas",
    "¿cómo puedo ayudar",
    "como posso ajudar",
    "sua pergunta",
    "su pregunta",
    "your question",
)
# Phrases by which a vision model describes instead of transcribing, in order.
CHATTER = (
    "a imagem mostra",
    "a imagem contém",
    "la imagen muestra",
    "esta imagen contiene",
    "the image shows",
    "the image contains",
    "this image depicts",
    "não posso",
    "no puedo",
    "i cannot",
    "i can't",
    "i'm sorry",
    "lo siento",
    "desculpe",
    "as an ai",
    "?como puedo ayudar",
    "como posso ajudar",
)
# Of the phrases above, those that count as words of their own only: other words end ("was an AI") or begin ("as an aide") with them.
WHOLE_PHRASES = ("as an ai",)
PACK_LANGS = {"por": "pt", "spa": "es", "eng": "en", "fra": "fr", "ita": "it"}
# Section keys of each template, and which may be empty.
TEMPLATES = {
    "A": "titulo autores tipo_estudio objetivo metodos resultados conclusiones palabras_clave".split(),
    "B": "titulo tipo_documento entidad objeto_alcance estructura sintesis publico terminos".split(),
    "C": "titulo tipo_documento entidad publico resumen_ejecutivo puntos_clave terminos".split(),
}
OPTIONAL_KEYS = ("autores", "palabras_clave")
TEMPLATE_OF = {"articulo": "A", "manual": "B", "divulgacion": "C"}
# Section labels, by key in pt, es and en.
LABELS = {
    "titulo": ("Título", "Título", "Title"),
    "autores": ("Autores / Filiação", "Autores / Filiación", "Authors / Affiliation"),
    "tipo_estudio": ("Tipo de estudo", "Tipo de estudio", "Study type"),
    "objetivo": ("Objetivo", "Objetivo", "Objective"),
    "metodos": ("Métodos", "Métodos", "Methods"),
    "resultados": ("Resultados", "Resultados", "Results"),
    "conclusiones": ("Conclusões", "Conclusiones", "Conclusions"),
    "palabras_clave": ("Palavras-chave", "Palabras clave", "Keywords"),
    "tipo_documento": ("Tipo de documento", "Tipo de documento", "Document type"),
    "entidad": ("Entidade(s) emissora(s)", "Entidad(es) emisora(s)", "Issuing entity(ies)"),
    "objeto_alcance": ("Objeto e alcance", "Objeto y alcance", "Scope"),
    "estructura": ("Estrutura", "Estructura", "Structure"),
    "sintesis": ("Síntese por seção", "Síntesis por sección", "Section synthesis"),
    "publico": ("Público-alvo", "Público objetivo", "Target audience"),
    "resumen_ejecutivo": ("Resumo executivo", "Resumen ejecutivo", "Executive summary"),
    "puntos_clave": ("Pontos-chave", "Puntos clave", "Key points"),
    "terminos": ("Termos técnicos / entidades", "Términos técnicos / entidades", "Technical terms / entities"),
}
LABEL_LANGS = ("pt", "es", "en")
DEDUP_KEYS = ("publico", "terminos")
SUMMARY_KEY = {"A": "objetivo", "B": "objeto_alcance", "C": "resumen_ejecutivo"}
TERMS_KEY = {"A": "palabras_clave", "B": "terminos", "C": "terminos"}
# Model instructions by language.
INSTRUCTIONS = {
    "pt": (
        "Você é um sistema automático de catalogação. Resuma o texto entre aspas triplas (material de saúde pública já publicado). "
        "NÃO se dirija ao usuário, NÃO recuse. Responda SOMENTE em português, preenchendo EXATAMENTE estes campos Markdown '##', sem texto extra:"
    ),
    "es": (
        "Eres un sistema automático de catalogación. Resume el texto entre comillas triples (material de salud pública ya publicado). "
        "NO te dirijas al usuario, NO te niegues. Responde SOLO en español, rellenando EXACTAMENTE estos campos Markdown '##', sin texto extra:"
    ),
    "en": (
        "You are an automatic cataloguing system. Summarize the text between triple quotes (published public-health material). "
        "Do NOT address the user, do NOT refuse. Answer ONLY in English, filling EXACTLY these Markdown '##' fields, with no extra text:"
    ),
}
LILACS_TYPE = {"articulo": "S", "manual": "M", "divulgacion": "M"}
LOC_LANG = {"es": "spa", "pt": "por", "en": "eng", "fr": "fre"}
# Limits of page images, in pixels of the full page, gray levels and degrees.
INK_BELOW, MASK_SCALE, LEAST_RUN = 200, 0.25, 8
GUTTER, COLUMN_WIDTH, BLOCK_GAP, REGION_HEIGHT, BOX_MARGIN = 40, 30, 25, 20, 6
SKEW_STEP, SKEW_FINE, SKEW_APPLIED = 0.5, 0.25, 0.5
NON_TEXT_MARKER = "[región no textual: posible figura/tabla]"
NON_TEXT_WORDS, NON_TEXT_CONF, NON_TEXT_INK = 5, 40.0, 0.05
# Required tools, values of an idle throttling flag, metadata versions.
HARD_TOOLS = ("pdftotext", "pdfinfo", "pdftoppm")
NOT_THROTTLED = ("0", "0x0000000000000000", "n/a", "not active")
META_VERSION = "1.0"
CONTRACT_VERSION = "1.0"
# Model services, their default models, key variables and addresses.
DEFAULT_MODELS = {
    "ollama": "qwen2.5:7b",
    "openrouter": "qwen/qwen-2.5-7b-instruct",
    "openai": "gpt-4o-mini",
    "anthropic": "claude-haiku-4-5",
}
KEY_VARIABLES = {"openai": "OPENAI_API_KEY", "openrouter": "OPENROUTER_API_KEY", "anthropic": "ANTHROPIC_API_KEY"}
CHAT_URLS = {"openai": "https://api.openai.com/v1", "openrouter": "https://openrouter.ai/api/v1"}
MESSAGES_URL, MESSAGES_VERSION, MESSAGES_TOKENS = "https://api.anthropic.com/v1/messages", "2023-06-01", 4096
LOCAL_URL, LOCAL_CONTEXT, TEMPERATURE = "http://localhost:11434", 16384, 0.2
# Vision model and its instructions by language pack.
DEFAULT_VISION = "qwen3-vl:8b-instruct"
VISION_PROMPTS = {
    "por": "Transcreva EXATAMENTE o texto desta imagem, palavra por palavra, em português. Não resuma, não invente.",
    "spa": "Transcribe EXACTAMENTE el texto de esta imagen, palabra por palabra, en español. No resumas, no inventes.",
    "eng": "Transcribe the text in this image verbatim, word for word. Do not summarize, do not invent.",
}
# Notes on exported drafts.
LILACS_NOTE = (
    "Borrador para revisión humana. Los descriptores son CANDIDATOS y deben validarse con el vocabulario DeCS/MeSH. "
    "El tipo de documento LILACS es aproximado."
)
BIB_NOTE = (
    "Borrador para revisión humana. Campos mapeados desde la metadata embebida del PDF y/o el resumen generado (ver sources); "
    "no validados contra autoridades (VIAF/DeCS/MeSH)."
)
