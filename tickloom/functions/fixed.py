"""Texts, marks and patterns that must be exactly these for results to match."""

# --- domain values ---------------------------------------------------------------------------

SPIKE_UP, SPIKE_DOWN = "SPIKE_UP", "SPIKE_DOWN"
UPTREND, DOWNTREND = "UPTREND", "DOWNTREND"
GOLD_GAP = "GOLD_GAP"

HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"

OK, WARN, DEAD = "OK", "WARN", "DEAD"

FALLBACK_SOURCE = "fallback"
PAYLOAD_SOURCES = {"USD/EGP": "fxapi", "XAU/USD": "gold_api"}
PAGE_SYMBOL, PAGE_SOURCE = "XAU/EGP_LOCAL", "gold-price-live"

# --- marks in messages -----------------------------------------------------------------------

TYPE_MARKS = {
    "SPIKE_UP": "📈",
    "SPIKE_DOWN": "📉",
    "UPTREND": "🚀",
    "DOWNTREND": "⬇️",
    "GOLD_GAP": "🔔",
}
UNKNOWN_TYPE_MARK = "⚠️"

SEVERITY_MARKS = {"HIGH": "🔴", "MEDIUM": "🟡", "LOW": "🟢"}

STATUS_MARKS = {"OK": "✅", "WARN": "⚠️", "DEAD": "🔴"}

# --- names of checks -------------------------------------------------------------------------

FEED_CHECK_PREFIX = "feed:"
LAG_CHECK = "pipeline:lag"
LAG_CHECK_PREFIX = "pipeline:"

# --- price row of a quote page ---------------------------------------------------------------

PAGE_TABLE_CLASS = "local-cur"
PAGE_LABEL_PARTS = ("1 جرام", "21")
PAGE_NUMBER = r"[\d,]+"

# --- state keys ------------------------------------------------------------------------------

LAST_PRICE_SUFFIX = "__last_price"
PRICE_HISTORY_SUFFIX = "__price_history"
ALERT_TIME_SUFFIX = "__alert_time"
GAP_TIME_KEY = "GAP__last_alert_time"
GAP_AMOUNT_KEY = "GAP__last_gap_amount"
