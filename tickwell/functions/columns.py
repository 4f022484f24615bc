"""Column-expression builders. Each returns a native ``Column``; nothing
here runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(num, den) -> Column:
    """``num / den`` when ``den > 0``, else null. ANSI mode raises on a zero
    divisor, so every division in the engine goes through a guard."""
    den = col(den)
    return F.when(den > 0, col(num) / den)


def abs_change_rate(cur, prev) -> Column:
    """|cur - prev| / prev for a positive prev, else null."""
    return guarded_ratio(F.abs(col(cur) - col(prev)), prev)


def _ohlc_rules(open_, high, low, close, volume):
    return (F.when(close <= 0, C.FLAG_INVALID_CLOSE)
            .when(high < low, C.FLAG_HIGH_LT_LOW)
            .when((open_ <= 0) | (high <= 0) | (low <= 0), C.FLAG_INVALID_OHLC)
            .when(volume < 0, C.FLAG_NEGATIVE_VOLUME))


def index_dq_flag(open_="open_price", high="high_price", low="low_price",
                  close="close_price", volume="volume") -> Column:
    """Ordered rules for index bars; the first that holds wins. A null
    comparison never fires, so a bar with null prices is 'ok'."""
    return _ohlc_rules(col(open_), col(high), col(low), col(close), col(volume)).otherwise(C.FLAG_OK)


def price_dq_flag(open_="open_price", high="high_price", low="low_price",
                  close="close_price", volume="volume", prev_close="prev_close_price",
                  index_change="index_change_rate") -> Column:
    """Index rules plus the price-gap rule: a move above 15 % against the raw
    previous close on a day the main index moved under 3 % (a missing index
    day counts as 0)."""
    gap = abs_change_rate(close, prev_close) > F.lit(C.GAP_THRESHOLD)
    calm = F.coalesce(col(index_change), F.lit(0.0)) < F.lit(C.INDEX_CALM_THRESHOLD)
    return (_ohlc_rules(col(open_), col(high), col(low), col(close), col(volume))
            .when(gap & calm, C.FLAG_PRICE_GAP)
            .otherwise(C.FLAG_OK))


def is_valid(flag="dq_flag", accepted=C.PRICE_ACCEPTED_FLAGS) -> Column:
    return col(flag).isin(*accepted)


def normalize_price(c) -> Column:
    """Prices above 500 are in raw units: divide by 1000. Null stays null."""
    c = col(c)
    return F.when(c > C.PRICE_UNIT_CUTOFF, c / C.PRICE_UNIT_DIVISOR).otherwise(c)


def normalize_index(c) -> Column:
    """Index levels above 5000 are scaled by 100: divide by 100."""
    c = col(c)
    return F.when(c > C.INDEX_UNIT_CUTOFF, c / C.INDEX_UNIT_DIVISOR).otherwise(c)


def pct_error(ref, val, floor: float = 1e-10) -> Column:
    """Percent error |ref - val| / |ref| * 100; 0 when |ref| is under the
    floor; null when either side is null."""
    ref, val = col(ref), col(val)
    return (F.when(ref.isNull() | val.isNull(), F.lit(None).cast("double"))
            .when(F.abs(ref) < floor, F.lit(0.0))
            .otherwise(F.abs(ref - val) / F.abs(ref) * 100.0))


def tag_source(provider_source) -> Column:
    """Source tag ``<prefix>_<source>``."""
    return F.concat_ws("_", F.lit(C.SOURCE_PREFIX), col(provider_source))


def rounded(c, places: int = 6) -> Column:
    return F.round(col(c), places)
