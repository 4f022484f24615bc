"""Per-symbol row-frame windows.

All windows here share one specification, partition by symbol and order by
trade date, so Catalyst plans them as one exchange and one sort. A symbol
group holds at most one row per trading day (the (symbol, trade_date) key
is unique), so a group's size is bounded by the calendar span, never by the
number of symbols or the total data volume.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_symbol(key: str = "symbol", order: str = "trade_date"):
    return Window.partitionBy(key).orderBy(order)


def trailing(rows: int, key: str = "symbol", order: str = "trade_date"):
    """Frame of the current row and the ``rows - 1`` rows before it."""
    return by_symbol(key, order).rowsBetween(-(rows - 1), Window.currentRow)


def with_gain_loss(df: DataFrame, value: str = "close_price") -> DataFrame:
    """Day change against the previous row, gain = max(change, 0),
    loss = |min(change, 0)|, both 0 on the first row and after a null."""
    change = F.coalesce(F.col(value) - F.lag(value).over(by_symbol()), F.lit(0.0))
    return (df.withColumn("gain", F.greatest(change, F.lit(0.0)))
              .withColumn("loss", F.abs(F.least(change, F.lit(0.0)))))


# Running sums for the moving averages are kept in this decimal type. Prices
# are stored with 4 decimal places (bronze NUMERIC(18,4)), so a price cast
# here is exact and so is every running sum: a frame sum is the exact
# difference of two running sums, with no cancellation.
EXACT_SUM = T.DecimalType(38, 10)


def with_sma(df: DataFrame, periods: dict[str, int], value: str = "close_price", rn: str = "row_num",
             key: str = "symbol", order: str = "trade_date") -> DataFrame:
    """W5 / W6 for several periods at once: mean of the non-null values
    among the last ``period`` rows, null before row ``period``.

    A sliding row frame is re-aggregated for every row (``period`` updates
    per row); here each mean is the difference of two exact running sums
    read ``period`` rows apart with ``lag``: O(1) per row whatever the
    period."""
    return moving(df, [Averages(periods, value, rn)], key, order)


def sma_col(period: int, value: str = "close_price", rn: str = "row_num") -> Column:
    """W5 / W6 as one column over a sliding frame (re-aggregated per row;
    ``with_sma`` is the O(1) form used by the indicator fact)."""
    return F.when(F.col(rn) >= period, F.avg(value).over(trailing(period)))


# Bands: prices (4 decimal places) and their squares (8) are exact in these
# types, and so are their running sums and ``n * sum(x^2) - sum(x)^2`` of a
# frame, which is n^2 times the variance. A flat frame has exactly 0.
_PRICE, _SUM, _SQUARES = T.DecimalType(18, 4), T.DecimalType(28, 4), T.DecimalType(37, 8)
_FRAME_SUM, _FRAME_SQUARES, _FRAME_ROWS = T.DecimalType(18, 4), T.DecimalType(33, 8), T.DecimalType(3, 0)


def bollinger_frame(df: DataFrame, period: int = 20, width: float = 2.0, value: str = "close_price",
                    rn: str = "row_num", upper: str = "bb_upper", lower: str = "bb_lower",
                    key: str = "symbol", order: str = "trade_date") -> DataFrame:
    """Mean plus and minus ``width`` population deviations of the
    non-null values among the last ``period`` rows (at most 999), null before
    row ``period``.

    As in ``with_sma`` a frame's sums are differences of two exact running
    sums: O(1) a row, no sliding frame. Values count to 4 decimal places, as
    prices have; a frame whose values sum to 10^14 or more has no bands."""
    return moving(df, [Bands(period, width, value, rn, upper, lower)], key, order)


def moving(df: DataFrame, kinds, key: str = "symbol", order: str = "trade_date", running: dict[str, Column] | None = None) -> DataFrame:
    """Averages and bands together: one window operator has all running sums
    (and the ``running`` aggregates, which stay as columns), a second one all
    that is read some rows back."""
    w = by_symbol(key, order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumns({n: c for k in kinds for n, c in k.sums(run).items()} | {n: c.over(run) for n, c in (running or {}).items()})
    out = out.withColumns({n: c for k in kinds for n, c in k.frames(w).items()})
    for k in kinds:
        out = k.results(out)
    return out


@dataclass(frozen=True)
class Averages:
    """W5 / W6 in ``moving``."""
    periods: dict[str, int]
    value: str = "close_price"
    rn: str = "row_num"

    def sums(self, run) -> dict[str, Column]:
        return {"_cs": F.coalesce(F.sum(F.col(self.value).cast(EXACT_SUM)).over(run), F.lit(0).cast(EXACT_SUM)), "_cn": F.count(self.value).over(run)}

    def frames(self, w) -> dict[str, Column]:
        return {f"_{c}_{name}": F.col(f"_c{c}") - F.coalesce(F.lag(f"_c{c}", p).over(w), zero)
                for name, p in self.periods.items() for c, zero in (("s", F.lit(0).cast(EXACT_SUM)), ("n", F.lit(0)))}

    def results(self, df: DataFrame) -> DataFrame:
        n = lambda name: F.col(f"_n_{name}")
        out = df.withColumns({name: F.when((F.col(self.rn) >= p) & (n(name) > 0), F.col(f"_s_{name}").cast("double") / n(name))
                              for name, p in self.periods.items()})
        return out.drop("_cs", "_cn", *[f"_{c}_{name}" for name in self.periods for c in "sn"])


@dataclass(frozen=True)
class Bands:
    """W7 / W8 in ``moving``."""
    period: int = 20
    width: float = 2.0
    value: str = "close_price"
    rn: str = "row_num"
    upper: str = "bb_upper"
    lower: str = "bb_lower"

    def sums(self, run) -> dict[str, Column]:
        x = F.col(self.value).cast(_PRICE)
        return {"_bs": F.coalesce(F.sum(x).over(run).cast(_SUM), F.lit(0).cast(_SUM)),
                "_bq": F.coalesce(F.sum(x * x).over(run).cast(_SQUARES), F.lit(0).cast(_SQUARES)),
                "_bn": F.count(self.value).over(run)}

    def frames(self, w) -> dict[str, Column]:
        since = lambda c, zero: F.col(c) - F.coalesce(F.lag(c, self.period).over(w), zero)
        return {"_fs": since("_bs", F.lit(0).cast(_SUM)).try_cast(_FRAME_SUM),
                "_fq": since("_bq", F.lit(0).cast(_SQUARES)).try_cast(_FRAME_SQUARES),
                "_fn": since("_bn", F.lit(0))}

    def results(self, df: DataFrame) -> DataFrame:
        n = F.col("_fn").cast("double")
        spread = F.col("_fn").cast(_FRAME_ROWS) * F.col("_fq") - F.col("_fs") * F.col("_fs")
        ready = (F.col(self.rn) >= self.period) & (F.col("_fn") > 0)
        out = df.withColumns({"_bb_mid": F.when(ready, F.col("_fs").cast("double") / n),
                              "_bb_sd": F.when(ready, F.sqrt(spread.cast("double")) / n)})
        return (out.withColumn(self.upper, F.col("_bb_mid") + F.lit(self.width) * F.col("_bb_sd"))
                   .withColumn(self.lower, F.col("_bb_mid") - F.lit(self.width) * F.col("_bb_sd"))
                   .drop("_bs", "_bq", "_bn", "_fs", "_fq", "_fn", "_bb_mid", "_bb_sd"))
