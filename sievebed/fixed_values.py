"""Formats, patterns and names that must equal the source systems' for right results."""

from __future__ import annotations

# Fixed values -- column-name replacements, applied in this order, before lowercasing.
NAME_REPLACEMENTS = (
    ("Í", "i"),
    ("Ô", "o"),
    (" / ", "_"),
    (" (", "_"),
    (")", ""),
    ("/", "_"),
    (" ", "_"),
    (".", "_"),
    ("-", "_"),
)

# Fixed values -- separator of flattened names, key and payload field of a raw document.
NAME_SEPARATOR = "-"
DOCUMENT_KEY = "ticker"
DOCUMENT_DATA = "data"
DATA_PREFIX = "data-"

# Fixed values -- marker of an unknown id, marker of a page in place of a payload.
MISSING_ID = -1
HTML_MARKER = "<html"

# Fixed values -- id patterns of a key page, header of the key listing.
TICKER_ID_PATTERN = r"refreshComponent\('rating-component'.*?'id':\s(\d+)"
COMPANY_ID_PATTERN = r"/api/balancos/receitaliquida/chart/(\d+)/"
LISTING_HEADER = "Código"

# Fixed values -- rank page: scope of the text, grades, labels.
RANK_SCOPE_TAG = "p"
RANK_SCOPE_CLASS = "rank_view"
GRADES = ("A", "B", "C", "D", "E", "F")
GRADE_LABELS = ("value", "growth", "momentum", "vgm")
INDUSTRY_LABEL = "Industry: "

# Fixed values -- long form of the price and profit table.
YEAR_COLUMN = "year"
YEAR_MEASURES = ("net_profit", "quotation")

# Fixed values -- header of the snapshot history file -> column of the rank table.
HISTORY_COLUMNS = (
    ("Symbol", "ticker"),
    ("ZacksRank", "rank"),
    ("ValueScore", "value_score"),
    ("GrowthScore", "growth_score"),
    ("MomentumScore", "momentum_score"),
    ("VGMScore", "vgm_score"),
    ("Industry", "industry"),
    ("reference_date", "reference_date"),
)

# Fixed values -- column of the rank table -> header of the tab-separated export (spelling as published).
EXPORT_COLUMNS = (
    ("ticker", "symbol"),
    ("rank", "zacks"),
    ("value_score", "value"),
    ("growth_score", "growth"),
    ("momentum_score", "momtum"),
    ("vgm_score", "vgm"),
    ("industry", "industry"),
    ("reference_date", "date"),
)
EXPORT_NULL = "None"

# Fixed values -- texts the pandas CSV reader takes as "not a number" (documented defaults of 1.5).
NOT_A_VALUE = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

# Fixed values -- HTML elements that never have an end tag (HTML standard, void elements).
VOID_ELEMENTS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track",
    "wbr",
)

# Fixed values -- the seven datasets: folder, endpoint, id column, URL suffix, cleaning.
DATASETS = (
    ("ticker_prices", "api/cotacoes/acao/chart", "ticker", "3650/true/real", "default"),
    ("net_income", "api/balancos/receitaliquida/chart/", "company_id", "3650/0", "default"),
    ("assets_liabilities", "api/balancos/ativospassivos/chart", "company_id", "/3650", "default"),
    ("dividends", "api/dividendos/chart/", "ticker", "/3650/ano", "default"),
    ("dividend_yield", "api/dividend-yield/chart/", "ticker", "/3650/ano", "default"),
    ("historic_kpis", "api/historico-indicadores/", "ticker_id", "/10", "kpi"),
    ("prices_profit", "api/cotacao-lucro/", "ticker", "adjusted/", "price_profit"),
)

# Fixed values -- tries of a callback, datasets run at once.
CALLBACK_TRIES = 5
DATASETS_AT_ONCE = 4

# Fixed values -- option names of the warehouse connector: data set, table, bucket for the load.
WAREHOUSE_OPTIONS = ("dataset", "table", "temporaryGcsBucket")
