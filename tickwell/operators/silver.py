"""Silver layer: typed, flagged and gap-corrected bars.

Partitioning: the only exchange is the hash partitioning by symbol needed by
the previous-close window. The main index series (one row per trading day)
is joined by broadcast: its size is bounded by the calendar, not by the
number of symbols or bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import abs_change_rate, index_dq_flag, is_valid, price_dq_flag

_PRICE_COLS = ("open_price", "high_price", "low_price", "close_price")


def cast_bars(bronze: DataFrame, key: str) -> DataFrame:
    """Rename and cast bronze bars (decimal prices to double, volume to
    bigint). ``ingested_at`` is carried when the input has it."""
    cols = [F.col("code").alias(key), F.col("date").cast("date").alias("trade_date"),
            F.col("open").cast("double").alias("open_price"),
            F.col("high").cast("double").alias("high_price"),
            F.col("low").cast("double").alias("low_price"),
            F.col("close").cast("double").alias("close_price"),
            F.col("volume").cast("bigint").alias("volume"),
            F.col("source")]
    if "ingested_at" in bronze.columns:
        cols.append(F.col("ingested_at"))
    return bronze.select(*cols)


def index_series(bronze_index: DataFrame, code: str = C.INDEX_MAIN) -> DataFrame:
    """One index code from raw bronze (no validity check)."""
    return bronze_index.filter(F.col("code") == code)


def index_change_rate(bronze_index: DataFrame, code: str = C.INDEX_MAIN) -> DataFrame:
    """|close - previous close| / previous close of one index, 0 on the
    first day or when the previous close is not positive. The frame holds one
    code, so partitioning by code is one small task bounded by the calendar."""
    ix = index_series(bronze_index, code).select(
        "code", F.col("date").cast("date").alias("trade_date"),
        F.col("close").cast("double").alias("index_close"))
    w = Window.partitionBy("code").orderBy("trade_date")
    prev = F.lag("index_close").over(w)
    return ix.select("trade_date",
                     F.coalesce(abs_change_rate("index_close", prev), F.lit(0.0)).alias("index_change_rate"))


def with_prev_close(df: DataFrame, key: str = "symbol", value: str = "close_price",
                    out: str = "prev_close_price") -> DataFrame:
    """Previous value per key by date on the series as given."""
    w = Window.partitionBy(key).orderBy("trade_date")
    return df.withColumn(out, F.lag(value).over(w))


def with_index_change(prices: DataFrame, index_change: DataFrame) -> DataFrame:
    """Left join the daily index change by date (broadcast: one row per
    calendar day)."""
    return prices.join(F.broadcast(index_change), "trade_date", "left")


def correct_gaps(df: DataFrame) -> DataFrame:
    """P5: on a flagged gap the OHLC become the previous raw close and the
    volume 0."""
    gap = F.col("dq_flag") == C.FLAG_PRICE_GAP
    out = df
    for c in _PRICE_COLS:
        out = out.withColumn(c, F.when(gap, F.col("prev_close_price")).otherwise(F.col(c)))
    return out.withColumn("volume", F.when(gap, F.lit(0).cast("bigint")).otherwise(F.col("volume")))


def silver_prices(bronze_prices: DataFrame, bronze_index: DataFrame, audit: bool = True) -> DataFrame:
    """Silver prices: cast, raw previous close, flags, correction, validity.

    With ``audit`` the load timestamp ``loaded_at`` is added (and
    ``ingested_at`` kept when present)."""
    prices = with_prev_close(cast_bars(bronze_prices, "symbol"))
    flagged = (with_index_change(prices, index_change_rate(bronze_index))
               .withColumn("dq_flag", price_dq_flag()))
    out = correct_gaps(flagged).withColumn("is_valid", is_valid("dq_flag", C.PRICE_ACCEPTED_FLAGS))
    cols = ["symbol", "trade_date", *_PRICE_COLS, "volume", "source", "dq_flag", "is_valid"]
    if audit:
        out = out.withColumn("loaded_at", F.current_timestamp())
        cols.append("loaded_at")
        if "ingested_at" in out.columns:
            cols.append("ingested_at")
    return out.select(*cols)


def silver_index(bronze_index: DataFrame, audit: bool = True) -> DataFrame:
    """Silver index: cast, flags (no gap rule), validity = 'ok'."""
    out = (cast_bars(bronze_index, "index_code")
           .withColumn("dq_flag", index_dq_flag())
           .withColumn("is_valid", is_valid("dq_flag", C.INDEX_ACCEPTED_FLAGS)))
    cols = ["index_code", "trade_date", *_PRICE_COLS, "volume", "source", "dq_flag", "is_valid"]
    if audit:
        out = out.withColumn("loaded_at", F.current_timestamp())
        cols.append("loaded_at")
        if "ingested_at" in out.columns:
            cols.append("ingested_at")
    return out.select(*cols)


def valid_only(df: DataFrame) -> DataFrame:
    """P6."""
    return df.filter(F.col("is_valid"))


def dq_flag_counts(silver: DataFrame) -> DataFrame:
    """Rows per quality flag."""
    return silver.groupBy("dq_flag").agg(F.count(F.lit(1)).alias("rows"))
