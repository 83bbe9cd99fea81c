"""Published names, formats and limits that results must match.

They are plain data. Every operator takes them as parameters with these as the
defaults, so another market needs no code change.
"""

# --- raw trade payload -------------------------------------------------------
RAW_TRADE_ID = "a"
TRADE_REQUIRED = ("e", "E", "s", "a", "p", "q", "T")
TICK_COLUMNS = ("symbol", "price", "quantity", "event_time")
TOPIC = "crypto-trades"
TICK_FILE_NAME_FORMAT = "dd-HH-mm"

# --- raw rates ---------------------------------------------------------------
RATE_FILE_GLOB = "nbp_rate_???_*.json"
RATE_FILE_DATE_PATTERN = r"_([0-9]{8})\.json$"
RATE_FILE_DATE_FORMAT = "yyyyMMdd"

# --- analytics ---------------------------------------------------------------
BAR_BUCKET = "1 hour"
BAR_PERCENTILE = 0.95
CORRELATION_FRAME_ROWS = 63
CORRELATION_MIN_PAIRS = 2
VOLATILITY_FRAME_ROWS = 21
CORRELATION_BASE = "BTCUSDT"
CORRELATION_QUOTE = "USD"
CORRELATION_COLUMN = "corr_btc_usdpln_63d"

# --- serving table -----------------------------------------------------------
SERVING_TABLE = "finance:facts_daily"
SALT_BUCKETS = 10
ROW_KEY_DATE_FORMAT = "yyyyMMdd"
# (family, qualifier, fact column, only for this symbol)
SERVED_CELLS = (
    ("metrics", "ret_1d", "ret_1d", None),
    ("price", "avg", "close", None),
    ("volume", "sum", "volume_sum", None),
    ("volume", "count", "trade_count_sum", None),
    ("correlation", "btc_usdpln_63d", CORRELATION_COLUMN, CORRELATION_BASE),
)

# --- quality limits ----------------------------------------------------------
MAX_ABS_RETURN = 10.0
MAX_ABS_CORRELATION = 1.0000001
