"""Technical indicators on the price fact: SMA, Bollinger, EMA, MACD, RSI.

The recursive indicators (EMA, Wilder averages) are evaluated with the
block scan in ``scan.py``; their seeds are row-frame windows read at the
seed row, so no seed table is aggregated and joined back. All windows
partition by symbol (directly or by (symbol, block)), so the whole indicator
fact is computed on the price fact's single hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .scan import ScanSpec, linear_scan, safe_block
from .windows import Averages, Bands, by_symbol, moving


def _seed(value: str, key: str, order: str, first_row: Column | None = None) -> Column:
    """Mean of ``value`` from the key's first row (or from the first row
    where ``first_row`` holds) to the current row. Read at the seed row it
    is the seed mean; a running frame is updated in O(1) per row, where a
    sliding frame would be re-aggregated row by row."""
    w = by_symbol(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _mean(value, first_row).over(w)


def _mean(value: str, first_row: Column | None = None) -> Column:
    return F.avg(F.col(value) if first_row is None else F.when(first_row, F.col(value)))


def ema_alpha(period: int) -> float:
    return 2.0 / (period + 1.0)


def ema_spec(period: int, value: str, name: str, key: str = "symbol", rn: str = "row_num",
             order: str = "trade_date", seed: Column | None = None) -> ScanSpec:
    """R1 input: 0 before the seed row, the mean of rows 1..period at row
    ``period`` (nulls skipped, as a mean does), ``alpha * x`` after.
    ``seed``: that running mean, where the frame has it."""
    alpha = ema_alpha(period)
    r = F.col(rn)
    b = (F.when(r < period, F.lit(0.0))
          .when(r == period, _seed(value, key, order) if seed is None else seed)
          .otherwise(F.lit(alpha) * F.col(value)))
    return ScanSpec(name, 1.0 - alpha, b)


def wilder_specs(period: int, key: str = "symbol", rn: str = "row_num",
                 order: str = "trade_date", seeds: dict[str, Column] | None = None) -> list[ScanSpec]:
    """R2 inputs: seeds are the means of gain and loss over rows
    2..period+1, read at row period+1; then ``x / period`` with decay
    ``(period - 1) / period``."""
    start = period + 1
    r = F.col(rn)
    specs = []
    for v in ("gain", "loss"):
        b = (F.when(r < start, F.lit(0.0))
              .when(r == start, _seed(v, key, order, r >= 2) if seeds is None else seeds[v])
              .otherwise(F.col(v) / F.lit(float(period))))
        specs.append(ScanSpec(f"avg_{v}", (period - 1.0) / period, b))
    return specs


def ema(df: DataFrame, period: int, value_col: str, key: str = "symbol", rn: str = "row_num",
        order: str = "trade_date", block: int | None = None) -> DataFrame:
    """EMA over ``value_col``; rows from the seed row on. The value column
    must be named explicitly."""
    name = f"ema_{period}"
    out = linear_scan(df, [ema_spec(period, value_col, name, key, rn, order)], key, rn, block)
    return out.filter(F.col(rn) >= period)


def rsi_col(avg_gain="avg_gain", avg_loss="avg_loss") -> Column:
    """Null when both averages are 0, 100 when only the loss is 0, else
    100 - 100 / (1 + gain / loss) rounded half-up to 4 places."""
    g, l = F.col(avg_gain), F.col(avg_loss)
    return (F.when((l == 0) & (g == 0), F.lit(None).cast("double"))
             .when(l == 0, F.lit(100.0))
             .otherwise(F.round(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / l), 4)))


def wilder(fact: DataFrame, period: int = C.RSI_PERIOD, block: int | None = None) -> DataFrame:
    """R2: Wilder averages of gain and loss from row period+1 on."""
    return (linear_scan(fact, wilder_specs(period), "symbol", "row_num", block)
            .filter(F.col("row_num") >= period + 1))


def rsi(fact: DataFrame, period: int = C.RSI_PERIOD, block: int | None = None) -> DataFrame:
    return wilder(fact, period, block).select("symbol", "trade_date", rsi_col().alias(f"rsi_{period}"))


# What the recursions need of all rows before, in the order of their specs.
CARRIED = ("ema_12", "ema_26", "avg_gain", "avg_loss", "macd_signal")


def _carried(spec: ScanSpec, rows: DataFrame, state: str) -> ScanSpec:
    """A recursion that goes on from a stored state, in a frame that has one:
    rows with ``_pos`` 0 are the last ones stored, whose value is given
    (``_state``); rows before it (-1) are there for the windows only, are
    dropped before a scan or add nothing; all others, and keys without a
    state, are as usual."""
    if "_pos" not in rows.columns:
        return spec
    b = F.when(F.col("_pos") < 0, F.lit(0.0)).when(F.col("_pos") == 0, F.col(f"_state.{state}")).otherwise(spec.b)
    return ScanSpec(spec.name, spec.a, b)


def _core(fact: DataFrame, block: int | None) -> DataFrame:
    """EMA fast, EMA slow and both Wilder averages in one scan; the frame has
    the running means (``_means``) they start from."""
    specs = [ema_spec(C.EMA_FAST, "close_price", "ema_12", seed=F.col("_mean_close")),
             ema_spec(C.EMA_SLOW, "close_price", "ema_26", seed=F.col("_mean_close")),
             *wilder_specs(C.RSI_PERIOD, seeds={v: F.col(f"_mean_{v}") for v in ("gain", "loss")})]
    specs = [_carried(x, fact, state) for x, state in zip(specs, CARRIED, strict=False)]
    return linear_scan(fact, specs, "symbol", "row_num", block, keep_blocks=True)


def common_block() -> int:
    """One block size that is safe for every recurrence here, so that both
    scans share their blocks and one sort."""
    decays = [1.0 - ema_alpha(p) for p in (C.EMA_FAST, C.EMA_SLOW, C.MACD_SIGNAL)] + [(C.RSI_PERIOD - 1.0) / C.RSI_PERIOD]
    return min(safe_block(a) for a in decays)


# The MACD line exists on rows EMA_SLOW.. while both EMAs are not null. An
# EMA that turns null stays null, so these rows are contiguous from row
# EMA_SLOW and the line's own row number (W9) is ``row_num - LINE_OFFSET``.
LINE_OFFSET = C.EMA_SLOW - 1


def _has_line() -> Column:
    return (F.col("row_num") >= C.EMA_SLOW) & F.col("ema_12").isNotNull() & F.col("ema_26").isNotNull()


def _with_macd(core: DataFrame, block: int | None) -> DataFrame:
    """R5 + R6 as columns of the same rows: the line where it exists, and
    the signal (EMA9 over the line's own row numbers) from a second scan.
    Rows before the line contribute 0 to the scan; a row after the line has
    ended has a null line, which nulls the signal from there on."""
    rows = (core.withColumn("ema_12", F.when(F.col("row_num") >= C.EMA_FAST, F.col("ema_12")))
                .withColumn("ema_26", F.when(F.col("row_num") >= C.EMA_SLOW, F.col("ema_26")))
                .withColumn("macd_line", F.when(_has_line(), F.col("ema_12") - F.col("ema_26")))
                .withColumn("_line_rn", F.col("row_num") - F.lit(LINE_OFFSET)))
    # The line's first rows have no null or it has ended: their mean is put
    # into the scan row by row, each so that it decays to its share.
    r, x = F.col("_line_rn"), F.col("macd_line")
    spec = ema_spec(C.MACD_SIGNAL, "macd_line", "_sig", rn="_line_rn", seed=x / C.MACD_SIGNAL)
    start = x / C.MACD_SIGNAL * F.pow(F.lit(spec.a), r - C.MACD_SIGNAL)
    spec = ScanSpec(spec.name, spec.a, F.when((r >= 1) & (r < C.MACD_SIGNAL), start).otherwise(spec.b))
    out = linear_scan(rows, [_carried(spec, rows, CARRIED[-1])], "symbol", "row_num", block)
    ready = (F.col("_line_rn") >= C.MACD_SIGNAL) & F.col("macd_line").isNotNull()
    return out.withColumn("macd_signal", F.when(ready, F.col("_sig"))).drop("_sig", "_line_rn")


def macd_line(wide: DataFrame) -> DataFrame:
    """R5 + W9: EMA12 - EMA26 on rows where both exist and are not null,
    numbered over those rows."""
    return wide.filter(F.col("macd_line").isNotNull()).select(
        "symbol", "trade_date", (F.col("row_num") - F.lit(LINE_OFFSET)).alias("row_num"), "macd_line")


def macd_signal(wide: DataFrame) -> DataFrame:
    """EMA9 of the MACD line over the line's own row numbers."""
    return wide.filter(F.col("macd_signal").isNotNull()).select("symbol", "trade_date", "macd_signal")


def _means() -> dict[str, Column]:
    return {"_mean_close": _mean("close_price"), **{f"_mean_{v}": _mean(v, F.col("row_num") >= 2) for v in ("gain", "loss")}}


class Indicators:
    """All indicators of one price fact as one wide per-row frame.

    Every step (two block scans, the seed windows, SMA and Bollinger
    windows) is partitioned by symbol or by (symbol, block), so the frame
    is planned with a single exchange (hash by symbol) and no join between
    indicator tables. The intermediate tables (EMA12, EMA26, RSI, MACD line
    and signal) are projections of the wide frame."""

    def __init__(self, fact: DataFrame, block: int | None = None, materialize=None, keep=()):
        """``materialize`` (optional) cuts the lineage of the wide frame,
        which every projection below reuses. ``keep`` names columns of the
        fact that the wide frame has too. In a frame that goes on from
        stored states the rows that serve the windows alone (``_pos`` -1)
        end with those."""
        carried = [c for c in ("_pos", "_state") if c in fact.columns]
        block = block or common_block()
        # The averages, bands and scan seeds share one window specification
        # (symbol, trade_date): two window operators, one for all running
        # sums and one for what is read some rows back.
        base = moving(fact.select("symbol", "trade_date", "row_num", "close_price", "gain", "loss", *carried, *keep),
                      [Averages({"ma50": C.MA_SHORT, "ma200": C.MA_LONG}), Bands(C.BB_PERIOD, C.BB_WIDTH)], running=_means())
        if carried:
            # what a scan would read of them is 0, as it is of rows that are not there
            base = base.filter(F.col("_pos").isNull() | (F.col("_pos") >= 0))
        wide = _with_macd(_core(base, block), block)
        wide = wide.select(
            "symbol", "trade_date", "row_num", "close_price", "ema_12", "ema_26",
            "ma50", "ma200", "bb_upper", "bb_lower",
            F.when(F.col("row_num") >= C.RSI_PERIOD + 1, rsi_col()).alias("rsi_14"),
            "macd_line", "macd_signal",
            (F.col("macd_line") - F.col("macd_signal")).alias("macd_histogram"),
            "gain", "loss", "avg_gain", "avg_loss", *keep)
        self.wide = materialize(wide) if materialize is not None else wide
        self.tables = projections(self.wide)
        self.line, self.signal = self.tables["int_macd_line"], self.tables["int_macd_signal"]

    def ema12(self) -> DataFrame:
        return self.tables["int_ema12"]

    def ema26(self) -> DataFrame:
        return self.tables["int_ema26"]

    def rsi14(self) -> DataFrame:
        return self.tables["int_rsi14"]

    def fact(self) -> DataFrame:
        """R7 + J4: one row per price-fact row (warm-up rows keep nulls, as
        the left joins of the indicator tables give)."""
        return self.tables["fact_stock_indicators"]


def projections(wide: DataFrame) -> dict[str, DataFrame]:
    """The indicator tables as projections of the wide frame's rows."""
    from_row = lambda n: wide.filter(F.col("row_num") >= n)
    return {
        "fact_stock_indicators": wide.select("symbol", "trade_date", "close_price", "ma50", "ma200", "bb_upper", "bb_lower",
                                             "rsi_14", "macd_line", "macd_signal", "macd_histogram"),
        "int_ema12": from_row(C.EMA_FAST).select("symbol", "trade_date", "ema_12"),
        "int_ema26": from_row(C.EMA_SLOW).select("symbol", "trade_date", "ema_26"),
        "int_rsi14": from_row(C.RSI_PERIOD + 1).select("symbol", "trade_date", "rsi_14"),
        "int_macd_line": macd_line(wide), "int_macd_signal": macd_signal(wide)}


def fact_stock_indicators(fact: DataFrame, block: int | None = None, materialize=None) -> DataFrame:
    return Indicators(fact, block, materialize).fact()
