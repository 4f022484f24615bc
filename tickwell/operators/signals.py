"""Chart signals read from the indicator fact (documented reading rules).

Crosses compare the sign of a difference with the previous row of the same
symbol (one window, partitioned by symbol, bounded by its trading days).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .windows import by_symbol


# Differences are compared at 1e-9 resolution (prices carry at most 4
# decimals), so an exact tie counts as zero whatever the summation order.
RESOLUTION = 9


def _settled(diff: Column) -> Column:
    return F.round(diff, RESOLUTION)


def _cross(diff: Column, up: str, down: str) -> Column:
    diff = _settled(diff)
    prev = F.lag(diff).over(by_symbol())
    return (F.when((prev <= 0) & (diff > 0), F.lit(up))
             .when((prev >= 0) & (diff < 0), F.lit(down)))


def ma_cross(short: str = "ma50", long: str = "ma200") -> Column:
    """S1: 'golden' when the short average crosses above the long one,
    'death' when it crosses below."""
    return _cross(F.col(short) - F.col(long), "golden", "death")


def rsi_zone(rsi: str = "rsi_14") -> Column:
    """S2: 'overbought' above 70, 'oversold' below 30, else 'neutral'."""
    r = F.col(rsi)
    return (F.when(r > C.RSI_OVERBOUGHT, F.lit("overbought"))
             .when(r < C.RSI_OVERSOLD, F.lit("oversold"))
             .when(r.isNotNull(), F.lit("neutral")))


def macd_cross(hist: str = "macd_histogram") -> Column:
    """S3: 'bullish' when the MACD line crosses above its signal (histogram
    turns positive), 'bearish' when it crosses below."""
    return _cross(F.col(hist), "bullish", "bearish")


def band_touch(close: str = "close_price", upper: str = "bb_upper", lower: str = "bb_lower") -> Column:
    """S4: 'upper' when the close reaches the upper band, 'lower' when it
    reaches the lower band."""
    c = F.col(close)
    return (F.when(_settled(c - F.col(upper)) >= 0, F.lit("upper"))
             .when(_settled(c - F.col(lower)) <= 0, F.lit("lower")))


def signals(ind: DataFrame) -> DataFrame:
    return ind.select("symbol", "trade_date", ma_cross().alias("ma_cross"), rsi_zone().alias("rsi_zone"),
                      macd_cross().alias("macd_cross"), band_touch().alias("band_touch"))
