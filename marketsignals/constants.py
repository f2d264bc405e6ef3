"""Fixed values.

Everything below must equal the behaviour being reproduced (labels, word
lists, message texts, defaults).  They are kept verbatim, in their natural
order, in one place.  Nothing here is derived; change them only together
with the expected outputs in tests/.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES — enumerations of a price signal
# ---------------------------------------------------------------------------

RISE = "podwyzka"
CUT = "obnizka"
PERCENT = "procent"

# The twelve keys a model response must carry (plus optional extracted_on
# and the not_relevant flag that is removed before building the record).
SIGNAL_KEYS = [
    "material", "material_detail", "change_type", "amount", "unit", "currency",
    "region", "effective_date", "announcement_date", "source_company",
    "confidence", "summary_pl",
]
OPTIONAL_KEYS = ["extracted_on"]
FLAG_KEY = "not_relevant"

# ---------------------------------------------------------------------------
# FIXED VALUES — acquisition
# ---------------------------------------------------------------------------
SOURCE_REGISTRY = [
    ("PR Newswire - Paper & Packaging",
     "https://www.prnewswire.com/rss/heavy-industry-manufacturing-latest-news/paper-forest-products-containers-list.rss"),
]
FEED_MAX_ITEMS = 5
LISTING_MAX_ITEMS = 15
LISTING_HREF_SUBSTRING = "/news-releases/"
LISTING_MIN_TITLE_CHARS = 15
LISTING_BASE_URL = "https://www.prnewswire.com"
SHORT_SUMMARY_CHARS = 200
REMOVED_ELEMENTS = ["script", "style", "nav", "footer", "header"]

PRICE_KEYWORDS = [
    "price", "pricing", "increase", "raise", "cost", "surcharge",
    "cena", "podwyżk", "wzrost cen",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — extraction, usage accounting
# ---------------------------------------------------------------------------
DEFAULT_MODEL = "openai/gpt-4o-mini"
PROCESS_AUTOMATIC = "ekstrakcja_automatyczna"
PROCESS_MANUAL = "ekstrakcja_reczna"

USAGE_DISPLAY_NAMES = {
    "process": "proces",
    "model": "model",
    "wywolania": "wywołania",
    "suma_wejsciowych": "wejściowe",
    "suma_wyjsciowych": "wyjściowe",
    "suma_myslenia": "myślenie",
    "suma_calkowita": "razem",
}
USAGE_KIND_LABELS = {
    "suma_wejsciowych": "wejściowe",
    "suma_wyjsciowych": "wyjściowe",
    "suma_myslenia": "myślenie",
}
USAGE_LOG_LIMIT = 100

# ---------------------------------------------------------------------------
# FIXED VALUES — alerts, margin, dashboard
# ---------------------------------------------------------------------------
ALERT_THRESHOLD_PCT = 3.0
ALERT_CHANNELS = ["slack", "email"]

MSG_RISE = "🔺 podwyżka"
MSG_CUT = "🔻 obniżka"
MSG_NO_AMOUNT = "brak danych o kwocie"
MSG_NOT_GIVEN = "nie podano"
MSG_UNKNOWN = "nieznane"
MSG_CHANGE = "Zmiana: "
MSG_REGION = "Region: "
MSG_EFFECTIVE = "Wejście w życie: "
MSG_SOURCE = "Źródło: "
MSG_SUMMARY = "Podsumowanie: "
MSG_MARGIN = "Wpływ na marżę: "

MATERIAL_COST_SHARE = [
    ("celuloza", 55),
    ("tektura", 40),
    ("papier", 45),
    ("PE", 60),
    ("PP", 60),
    ("PET", 60),
]
DASHBOARD_COST_SHARE = 50
MARGIN_NO_DATA = ("Brak wystarczających danych do przeliczenia wpływu na marżę "
                  "(potrzebna zmiana w %, nie w EUR/t bez znajomości bazowej ceny).")
MARGIN_TEMPLATE = ("Przy udziale surowca {share}% w koszcie wytworzenia: "
                   "{direction} o ok. {impact:.1f} p.p. marży, jeśli cena "
                   "sprzedaży nie zostanie skorygowana.")
MARGIN_UP = "wzrost kosztu"
MARGIN_DOWN = "spadek kosztu"

ALL_MATERIALS = "Wszystkie"
HISTORY_COLUMNS = [
    "announcement_date", "material", "material_detail", "change_type", "amount",
    "unit", "region", "source_company", "confidence", "summary_pl",
]

QUOTE_WINDOW_DAYS = 5
