"""Comparison of two indicator tables: drift report and MACD acceptance.

Both join the two tables on (symbol, trade_date) and aggregate per symbol;
a table and the same table built from changed prices, from another source or
by another version can be held against each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import pct_error

_FLOORS = {"rsi_14": C.DRIFT_FLOOR_RSI}
_DRIFT_COLS = ("rsi_14", "macd_line", "macd_signal", "ma50", "ma200", "bb_upper", "bb_lower")


def drift_report(ours: DataFrame, ref: DataFrame, fact: DataFrame | None = None, skip: int = C.DRIFT_SKIP_ROWS) -> DataFrame:
    """V9: per symbol and indicator, after the first ``skip`` rows: max
    absolute error and mean percent error (0 where the reference is under its
    floor: 0.1 for RSI, 0.01 otherwise; the MACD floors are on |ref|). The
    row numbers are the price fact's, or those of ``ours`` without one."""
    r = ref.select("symbol", "trade_date", *[F.col(c).alias(f"ref_{c}") for c in _DRIFT_COLS])
    if fact is not None:
        ours = ours.drop("row_num").join(fact.select("symbol", "trade_date", "row_num"), ["symbol", "trade_date"], "inner")
    # Two whole indicator tables: neither is sent to every task, however well its files compress.
    j = ours.filter(F.col("row_num") > skip).join(r.hint("merge"), ["symbol", "trade_date"], "inner")
    aggs = []
    for c in _DRIFT_COLS:
        err = F.abs(F.col(c) - F.col(f"ref_{c}"))
        refv = F.abs(F.col(f"ref_{c}")) if c.startswith("macd") else F.col(f"ref_{c}")
        pe = F.when(refv > _FLOORS.get(c, C.DRIFT_FLOOR_OTHER), err / refv * 100.0).otherwise(F.lit(0.0))
        aggs += [F.max(err).alias(f"{c}__max"), F.avg(pe).alias(f"{c}__mape")]
    g = j.groupBy("symbol").agg(F.count(F.lit(1)).cast("bigint").alias("rows"), *aggs)
    stack = ", ".join(f"'{c}', `{c}__max`, `{c}__mape`" for c in _DRIFT_COLS)
    return g.selectExpr("symbol", "rows", f"stack({len(_DRIFT_COLS)}, {stack}) AS (indicator, max_abs_err, mape)")


def macd_acceptance(ours: DataFrame, ref: DataFrame, fact: DataFrame, tol: float = C.MACD_TOLERANCE_PCT,
                    min_rows: int = C.MACD_MIN_ROWS) -> DataFrame:
    """Per symbol with at least ``min_rows`` price rows, the max percent
    error of the MACD line and signal (0 below |ref| < 1e-10) and whether
    both stay under ``tol``."""
    n = fact.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows)
    r = ref.select("symbol", "trade_date", F.col("macd_line").alias("ref_line"),
                   F.col("macd_signal").alias("ref_signal"))
    j = ours.join(r, ["symbol", "trade_date"], "inner").join(n, "symbol", "left_semi")
    g = j.groupBy("symbol").agg(
        F.count_if(F.col("macd_line").isNotNull() & F.col("ref_line").isNotNull()).cast("bigint").alias("line_rows"),
        F.count_if(F.col("macd_signal").isNotNull() & F.col("ref_signal").isNotNull()).cast("bigint").alias("signal_rows"),
        F.coalesce(F.max(pct_error("ref_line", "macd_line")), F.lit(0.0)).alias("max_line_err"),
        F.coalesce(F.max(pct_error("ref_signal", "macd_signal")), F.lit(0.0)).alias("max_signal_err"))
    return g.filter(F.col("line_rows") > 0).withColumn(
        "passed", (F.col("max_line_err") < tol) & (F.col("max_signal_err") < tol))
