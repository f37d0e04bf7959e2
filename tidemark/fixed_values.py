"""Fixed values.

Results depend on every entry here being exactly as written: literals that
appear in output rows, character sets, word lists, patterns and limits.
Nothing in this module is logic.
"""

# --- text classes ---------------------------------------------------------
# Dashes that may become "-" in codes and in names.
COMMON_HYPHENS = "-­‐‑‒–—―⁃−－"
# Long-vowel marks: a dash inside a code, a letter inside a name.
LONG_VOWEL_MARKS = "ーｰ"
# First characters that make a number negative.
MINUS_SIGNS = "-−－‐‑–—―▲△"
# Shop remarks that are not part of a card name.
STORE_MEMO_WORDS = [
    "高い方", "安い方", "高いほう", "安いほう", "高値", "安値",
    "要確認", "在庫僅少", "自店",
]

# --- trend classes and limits ---------------------------------------------
DOWN, UP, FLAT, UNDECIDED = "下落", "上昇", "横ばい", "判定不可"
TREND_MARKS = {DOWN: "▼下落", UP: "▲上昇", FLAT: "→横ばい"}
TREND_MARK_DEFAULT = "?判定不可"
TREND_URGENCY = {DOWN: 0, UNDECIDED: 1, FLAT: 2, UP: 3}
TREND_URGENCY_DEFAULT = 9
DOWN_D3 = -0.8
DOWN_STREAK = -2
UP_D3 = 1.5
UP_STREAK = 3
MIN_VALID_DAYS = 10
BUFFER_MULTIPLIER = 2.0

# --- imputation bases -------------------------------------------------------
BASIS_COUNT, BASIS_REPEAT, BASIS_NONE = "trade_count", "price_repeat", "none"

# --- conditions -----------------------------------------------------------
CONDITION_UNKNOWN = "不明"
CONDITION_HINTS = [
    ("psa10", ["psa10", "psa_10", "graded", "鑑定"]),
    ("キズあり", ["damaged", "kizu", "played", "キズ"]),
    ("美品", ["mint", "bihin", "clean", "美品", "normal"]),
]
CHART_PRICE_COLUMNS = [("美品", "price_01"), ("キズあり", "price_02"), ("PSA10", "price_03")]
INDEX_LABELS = {"normal": "bihin", "graded": "psa10"}

# --- listing status -------------------------------------------------------
STATUS_OPEN, STATUS_CLOSED = "募集中", "受付終了"

# --- notes ------------------------------------------------------------------
NOTE_DUPLICATE_CODE = "品番重複（要確認）"
NOTE_NO_HIT = "検索ヒットなし"
MEMO_NOT_FOUND = "マスタに見つかりません（手でcard_id/urlを入れてください）"
MEMO_CANDIDATES = ("候補", "件から先頭を採用（要確認）")
IMPUTED_MARK = "★補完"

# --- JSON field names that count as date, price and trade count -----------
DATE_KEYS = ["date", "day", "d", "x", "label", "tradeDate", "trade_date", "createdAt", "time"]
PRICE_KEYS = ["price", "value", "y", "avg", "average", "averagePrice", "median", "amount", "yen"]
COUNT_KEYS = [
    "tradeCount", "trade_count", "count", "dealCount", "deal_count",
    "volume", "num", "n", "transactions", "取引件数",
]

# --- link and number patterns ---------------------------------------------
PRODUCT_URL_PATTERNS = [
    r"/trading-cards/\d+",
    r"/products/\d+",
    r"/trading-cards/[a-z0-9\-]+/\d+",
]
#: Where result pages may show a product link, best first: part of the class of an element around it (or none), part of its href (or none).
PRODUCT_LINK_SELECTORS = [
    ("", "/trading-cards/"),
    ("", "/products/"),
    ("searchResult", ""),
    ("product", ""),
]
CARD_LINK_TESTS = [r"/card/", r"/cards/"]
CARD_LIST_CLASS = "cardList"
PRODUCT_NUMBER_CLASSES = {
    "最安価格": [("class", "lowestPrice"), ("class", "lowest-price"), ("class", "minPrice"),
             ("data-testid", "lowest")],
    "出品枚数": [("class", "askCount"), ("class", "listingCount"), ("class", "stockCount"),
             ("data-testid", "listing")],
    "直近取引価格": [("class", "lastSoldPrice"), ("class", "latestPrice"), ("class", "recentPrice"),
               ("data-testid", "last-sold")],
}
PRODUCT_NUMBER_PATTERNS = {
    "最安価格": [
        r"最安値?[^0-9¥￥]{0,20}[¥￥]?\s*([0-9][0-9,]*)",
        r"最低価格[^0-9¥￥]{0,20}[¥￥]?\s*([0-9][0-9,]*)",
        r"購入[^0-9¥￥]{0,10}[¥￥]\s*([0-9][0-9,]*)",
    ],
    "出品枚数": [
        r"([0-9][0-9,]*)\s*(?:点|枚|件)\s*の?出品",
        r"出品[数枚点件][^0-9]{0,10}([0-9][0-9,]*)",
        r"在庫[^0-9]{0,10}([0-9][0-9,]*)",
    ],
    "直近取引価格": [
        r"直近[^0-9¥￥]{0,20}[¥￥]?\s*([0-9][0-9,]*)",
        r"最終取引価格[^0-9¥￥]{0,20}[¥￥]?\s*([0-9][0-9,]*)",
        r"直近の?取引価格[^0-9¥￥]{0,20}[¥￥]?\s*([0-9][0-9,]*)",
    ],
}

# --- patterns of dates, codes and embedded JSON ------------------------------
FULL_DATE_PATTERN = r"([0-9]{4})\s*[-/.年]\s*([0-9]{1,2})\s*[-/.月]\s*([0-9]{1,2})"
DAY_OF_YEAR_PATTERN = r"([0-9]{1,2})\s*[-/.月]\s*([0-9]{1,2})"
CODE_PATTERN = r"\b(\d{1,3}\s*/\s*\d{1,3}[A-Za-z\-]*)\b"
JSON_SCRIPT_PATTERN = (
    r'<script[^>]*(?:id="__NEXT_DATA__"|type="application/(?:json|ld\+json)")[^>]*>(.*?)</script>')
JSON_PUSH_PATTERN = r'self\.__next_f\.push\(\s*\[\s*\d+\s*,\s*("(?:[^"\\]|\\.)*+")\s*\]\s*\)'

# --- windows in days / rows -------------------------------------------------
DAILY_DAYS = 30
BACKFILL_DAYS = 3650
SHOW_DAYS = 20
TRAIL_DAYS = 7
SERIES_PER_PAGE = 3
REPORT_HITS = 5
WORST_FALLS = 15

# --- time zone of every stamp ---------------------------------------------
ZONE = "Asia/Tokyo"
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
