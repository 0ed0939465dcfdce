"""Fixed values of the domain: word lists, weights, caps, enums, patterns.

Everything in this module is a fixed value: results depend on these exact
entries, so they are stated here once and passed to operators as defaults.
"""

# --- text -----------------------------------------------------------------
# Separator class: white space (the Unicode set, not only ASCII), brackets,
# punctuation and typographic quotes. Written as the inside of a regex class.
SEPARATOR_CLASS = (
    r"\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
    r"/\\|()\[\]{},;:.!?\"'\-_\u201c\u201d\u2018\u2019"
)
CURRENCY_TOKENS = (("$", "usd"), ("£", "gbp"), ("€", "eur"))
NEGATION_CUES = ("no", "sin", "not", "without")
NEGATION_BEFORE = 8
NEGATION_AFTER = 2

# --- scoring --------------------------------------------------------------
TIER_WEIGHTS = {3: 4.0, 2: 2.5, 1: 1.0}
PHRASE_TIER_WEIGHTS = {3: 2.0, 2: 1.2, 1: 0.6}
FIELD_WEIGHTS = {"title": 1.5, "description": 1.0}
BUCKET_PREFIXES = {
    "direct_fx": "cat_fx_",
    "intl_footprint": "cat_intl_",
    "business_model": "cat_biz_",
    "tech_proxy": "cat_proxy_",
}
DEFAULT_BUCKET = "tech_proxy"
BUCKET_CAPS = {
    "direct_fx": 7.0,
    "intl_footprint": 3.0,
    "business_model": 2.5,
    "tech_proxy": 1.5,
}
CORE_THRESHOLD = 2.0
SYNERGY_INTL = 1.0
SYNERGY_BIZ = 0.8
SYNERGY_MAX = 1.8
SYNERGY_MIN_BUCKET = 1.0
NO_CORE_CAP = 5.0
MIN_SCORE = 0.0
MAX_SCORE = 10.0
STRONG_THRESHOLD = 6

# --- reposts --------------------------------------------------------------
SIMILARITY_THRESHOLD = 0.9

# --- listings -------------------------------------------------------------
LISTING_MAX_PAGES = 10
LISTING_MAX_OFFERS = 500
JOBS_PER_TENANT = 200
# Size caps a caller may pass to the mappers and detectors. They default to
# off: whole descriptions and whole pages are processed.

# --- companies, sheet -----------------------------------------------------
ATS_PROVIDERS = ("lever", "greenhouse")
MARKETPLACE_DOMAIN_MARK = "infojobs."
RESOLUTIONS = (
    "PENDING",
    "IN_PROGRESS",
    "HIGH_INTEREST",
    "ALREADY_REVOLUT",
    "ACCEPTED",
    "REJECTED",
)
RESOLVED = ("ALREADY_REVOLUT", "ACCEPTED", "REJECTED")
DEFAULT_RESOLUTION = "PENDING"
MODEL_FEEDBACK = ("OK", "FP", "FN")
SHEET_HEADERS = (
    "ID Empresa",
    "Empresa",
    "Resolución",
    "Score máx.",
    "Ofertas fuertes",
    "Ofertas únicas",
    "Actividad publicaciones",
    "URL Oferta Top",
    "Categoría top",
    "Última señal fuerte",
    "Feedback Modelo",
    "Notas Modelo",
)
NO_NAME = "(no name)"
APPEND_BATCH = 100
UPDATE_BATCH = 50
FEEDBACK_ZONE = "Europe/Madrid"
FEEDBACK_HOURS = (3, 6)
QUERY_KEY_HEX = 12

# --- hiring-platform discovery ---------------------------------------------
ATS_HOSTS = (
    "jobs.lever.co",
    "api.lever.co",
    "boards.greenhouse.io",
    "job-boards.greenhouse.io",
    "boards-api.greenhouse.io",
)
CAREER_PATHS = (
    "/careers",
    "/jobs",
    "/join-us",
    "/work-with-us",
    "/careers/jobs",
    "/jobs/",
    "/empleo",
    "/trabaja-con-nosotros",
    "/job-opportunities",
    "/job-openings",
)
ATS_PATTERNS = (
    ("lever", r"(?i)https?://jobs\.lever\.co/([a-zA-Z0-9_-]+)"),
    ("lever", r"(?i)https?://api\.lever\.co/v0/postings/([a-zA-Z0-9_-]+)"),
    ("greenhouse", r"(?i)https?://boards\.greenhouse\.io/([a-zA-Z0-9_-]+)"),
    ("greenhouse", r"(?i)https?://job-boards\.greenhouse\.io/([a-zA-Z0-9_-]+)"),
    ("greenhouse", r"(?i)https?://boards-api\.greenhouse\.io/v1/boards/([a-zA-Z0-9_-]+)"),
)
CAREER_KEYWORDS = (
    "careers",
    "career",
    "jobs",
    "join",
    "join-us",
    "work-with-us",
    "empleo",
    "trabaja",
    "trabaja-con",
    "vacantes",
    "oportunidades",
    "job-openings",
    "opportunities",
)
CAREER_IGNORED_EXTENSIONS = (
    ".pdf", ".jpg", ".jpeg", ".png", ".gif", ".svg", ".zip", ".tar", ".gz",
    ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx",
)

# --- company directories ----------------------------------------------------
DIRECTORY_IGNORED_EXTENSIONS = (".pdf", ".jpg", ".jpeg", ".png", ".zip", ".gif")
DIRECTORY_EXCLUDED_DOMAINS = (
    "linkedin.com",
    "twitter.com",
    "facebook.com",
    "instagram.com",
    "youtube.com",
    "github.com",
    "startupshub.catalonia.com",
)

# --- directories -------------------------------------------------------------
# source, host, card, title and detail path of the known company directories
DIRECTORY_RULES = (
    ("catalonia", "startupshub.catalonia.com", r"(?is)<li[^>]*class=\"[^\"]*\bitem\b[^\"]*\"[^>]*>(.*?)</li>", r"(?is)<h3[^>]*>(.*?)</h3>", r"^/startup/[^/]+/[^/]+/\d+/?$"),
    ("madrimasd", "startups.madrimasd.org", r"(?is)<li[^>]*class=\"[^\"]*\belement-list\b[^\"]*\"[^>]*>(.*?)</li>", r"(?is)<h3[^>]*>(.*?)</h3>",
     r"^/emprendedores/emprendedores-casos-exito/[^/]+/?$"),
    ("lanzadera", "lanzadera.es", r"(?is)<article[^>]*class=\"[^\"]*\bstartup-slide\b[^\"]*\"[^>]*>(.*?)</article>", r"(?is)<h3[^>]*>(.*?)</h3>", r"^/proyecto/[^/]+/?$"),
)
