"""Gold layer: price fact, market breadth, stock dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .silver import valid_only
from .windows import by_symbol, with_gain_loss


def fact_stock_price(silver: DataFrame, audit: bool = True) -> DataFrame:
    """Valid silver rows with a per-symbol row number over valid rows only,
    and gain / loss against the previous valid (corrected) close."""
    cols = ["symbol", "trade_date", "open_price", "high_price", "low_price", "close_price",
            "volume", "source"]
    base = valid_only(silver)
    if audit and "loaded_at" in silver.columns:
        base = base.select(*cols, F.col("loaded_at").alias("silver_loaded_at"))
    else:
        base = base.select(*cols)
    out = with_gain_loss(base.withColumn("row_num", F.row_number().over(by_symbol()).cast("bigint")))
    keep = ["symbol", "trade_date", "row_num", "open_price", "high_price", "low_price",
            "close_price", "volume", "source"]
    if audit and "silver_loaded_at" in out.columns:
        out = out.withColumn("gold_loaded_at", F.current_timestamp())
        keep += ["silver_loaded_at", "gold_loaded_at"]
    return out.select(*keep, "gain", "loss")


def skip_first(fact: DataFrame) -> DataFrame:
    """Drop each symbol's first row (it has no previous close)."""
    return fact.filter(F.col("row_num") > 1)


def market_breadth(fact: DataFrame) -> DataFrame:
    """A1: per date, gainers / losers / unchanged against the previous
    close, total volume and symbol count. Grouping by date is combined
    map-side, so a busy date never concentrates raw rows in one task."""
    return (skip_first(fact).groupBy("trade_date").agg(
        F.count_if(F.col("gain") > 0).cast("bigint").alias("gainers"),
        F.count_if(F.col("loss") > 0).cast("bigint").alias("losers"),
        F.count_if((F.col("gain") == 0) & (F.col("loss") == 0)).cast("bigint").alias("unchanged"),
        F.count("symbol").cast("bigint").alias("total_symbols"),
        F.sum("volume").cast("bigint").alias("total_volume")))


def index_close(silver_index: DataFrame, code: str, out: str) -> DataFrame:
    return (silver_index.filter((F.col("index_code") == code) & F.col("is_valid"))
            .select("trade_date", F.col("close_price").alias(out)))


def with_indices(breadth: DataFrame, silver_index: DataFrame) -> DataFrame:
    """Inner joins to both index closes by date (one row per day each,
    broadcast); a day lacking either index is dropped."""
    main = index_close(silver_index, C.INDEX_MAIN, "vnindex_close")
    members = index_close(silver_index, C.INDEX_MEMBERS, "vn30_close")
    return (breadth.join(F.broadcast(main), "trade_date", "inner")
                   .join(F.broadcast(members), "trade_date", "inner"))


def fact_market_summary(fact: DataFrame, silver_index: DataFrame) -> DataFrame:
    return with_indices(market_breadth(fact), silver_index).select(
        "trade_date", "gainers", "losers", "unchanged", "total_symbols", "total_volume",
        "vnindex_close", "vn30_close")


def distinct_sources(silver: DataFrame) -> DataFrame:
    """A2: distinct (symbol, source) over valid rows."""
    return valid_only(silver).select("symbol", F.col("source").alias("data_source")).distinct()


def flag_members(df: DataFrame, components: DataFrame, key: str = "symbol",
                 out: str = "is_vn30") -> DataFrame:
    """Boolean membership by a left join against the distinct constituent
    codes. Their number grows with the listing, so there is no broadcast
    hint: the planner broadcasts the list when its size is under the
    broadcast threshold and AQE re-plans from the real size."""
    members = components.select(F.col("code").alias("_member")).distinct()
    return (df.join(members, F.col(key) == F.col("_member"), "left")
              .withColumn(out, F.col("_member").isNotNull()).drop("_member"))


def dim_stock(silver: DataFrame, components: DataFrame) -> DataFrame:
    """A3: one row per symbol with the largest source name as ``exchange``."""
    grouped = (distinct_sources(silver).groupBy("symbol")
               .agg(F.max("data_source").alias("exchange"))
               .withColumn("default_exchange", F.lit(C.DEFAULT_EXCHANGE)))
    return flag_members(grouped, components).select("symbol", "exchange", "default_exchange", "is_vn30")
