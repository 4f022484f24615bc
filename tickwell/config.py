"""Fixed values of the data contract.

Everything in the "fixed values" block must equal the behaviour being
reproduced (flag names, thresholds, holiday dates, index codes); do not
tune them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Index codes carried by the index table.
INDEX_MAIN = "VNINDEX"
INDEX_MEMBERS = "VN30"

# Data-quality flags, in the order the rules are tried.
FLAG_INVALID_CLOSE = "invalid_close_price"
FLAG_HIGH_LT_LOW = "high_less_than_low"
FLAG_INVALID_OHLC = "invalid_ohlc"
FLAG_NEGATIVE_VOLUME = "negative_volume"
FLAG_PRICE_GAP = "abnormal_price_gap"
FLAG_OK = "ok"

# Price-gap rule: a move above 15 % on a day the main index moved under 3 %.
GAP_THRESHOLD = 0.15
INDEX_CALM_THRESHOLD = 0.03

# Flags that keep a bar valid.
PRICE_ACCEPTED_FLAGS = (FLAG_OK, FLAG_PRICE_GAP)
INDEX_ACCEPTED_FLAGS = (FLAG_OK,)

# Placeholder exchange of the stock dimension.
DEFAULT_EXCHANGE = "HOSE"

# Indicator periods.
MA_SHORT = 50
MA_LONG = 200
BB_PERIOD = 20
BB_WIDTH = 2.0
EMA_FAST = 12
EMA_SLOW = 26
MACD_SIGNAL = 9
RSI_PERIOD = 14

# Fixed (month, day) holidays used by the trading-day count.
FIXED_HOLIDAYS = ((1, 1), (4, 30), (5, 1), (9, 2), (9, 3))

# Coverage gate: skip a load when at least 80 % of the expected bars exist.
COVERAGE_RATIO = 0.8

# Dashboard extract parameters.
LOOKBACK_DAYS = 200
LATEST_DATES = 2
TOP_MOVERS = 10
PRICE_UNIT_CUTOFF = 500.0      # above: raw units, divide by 1000
PRICE_UNIT_DIVISOR = 1000.0
INDEX_UNIT_CUTOFF = 5000.0     # above: scaled by 100, divide by 100
INDEX_UNIT_DIVISOR = 100.0

# RSI chart lines.
RSI_OVERBOUGHT = 70.0
RSI_OVERSOLD = 30.0

# Drift report: warm-up rows skipped, floors below which percent error is 0.
DRIFT_SKIP_ROWS = 250
DRIFT_FLOOR_RSI = 0.1
DRIFT_FLOOR_OTHER = 0.01
MACD_TOLERANCE_PCT = 0.1
MACD_MIN_ROWS = 35

# Default constituent list, used when no list is supplied.
DEFAULT_MEMBERS = (
    "ACB", "BID", "BSR", "CTG", "FPT", "GAS", "GVR", "HDB", "HPG", "LPB",
    "MBB", "MSN", "MWG", "PLX", "SAB", "SHB", "SSB", "SSI", "STB", "TCB",
    "TPB", "VCB", "VHM", "VIB", "VIC", "VJC", "VNM", "VPB", "VPL", "VRE",
)

# Bronze contract columns.
LANDING_COLUMNS = ("time", "open", "high", "low", "close", "volume")
BAR_COLUMNS = ("code", "date", "open", "high", "low", "close", "volume", "source")
SOURCE_PREFIX = "vnstock"
