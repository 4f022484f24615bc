"""Bronze tables derived from the driver's ``lineitem`` table.

Supplier = symbol, ship date shifted into 2020..2026 = trading day, line items
= ticks. Prices stay integer cents until the final cast so that averages do
not depend on summation order. Faults are injected by order key so every
quality rule fires. The derivation is the one given in FIXTURES.md; the
DuckDB oracles use the same definition in SQL.

Open and close are the first and last tick of the day under a total order;
they are computed with ``min_by`` / ``max_by`` inside one aggregate, so the
tick table is combined map-side and never sorted per (symbol, day).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture definition.
DAY_SHIFT = 9131
MEMBER_MOD, MEMBER_CUT = 10, 3          # l_suppkey % 10 < 3 -> constituent
OPEN_NEG_MOD = 211
HIGH_BAD_MOD = 223
CLOSE_ZERO_MOD = 199
CLOSE_JUMP_MOD = 97
CLOSE_NULL_MOD = 1009
VOLUME_NEG_MOD = 227
SOURCE_B_MOD = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dec(cents_expr, divisor: int):
    # A divisor of 10000: the quotient as a whole number of its last places, exact and without a decimal division.
    places = (cents_expr * F.lit(10000 // divisor)).cast("decimal(18,0)")
    return (places * F.lit(Decimal("0.0001"))).cast("decimal(18,4)")


def _code():
    return F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("code")


def ticks(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        _code(),
        "l_suppkey",
        F.date_add(F.col("l_shipdate").cast("date"), DAY_SHIFT).alias("date"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
        ((F.lit(20) + F.col("l_suppkey") % 80)
         * F.round(F.lit(100) + F.lit(100) * F.col("l_discount") - F.lit(100) * F.col("l_tax")).cast("bigint")
         ).alias("cents"),
    )


def bars(lineitem: DataFrame) -> DataFrame:
    """One row per (code, date) in integer cents: o, h, l, c, v, k."""
    # The code follows from the supplier: rows are sorted and dealt by the
    # number, and the text is made once a bar.
    t = ticks(lineitem)
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return (t.groupBy("l_suppkey", "date")
            .agg(F.min_by("cents", order).alias("o"),
                 F.max("cents").alias("h"),
                 F.min("cents").alias("l"),
                 F.max_by("cents", order).alias("c"),
                 F.sum("l_quantity").cast("bigint").alias("v"),
                 F.max("l_orderkey").alias("k"))
            .select(_code(), "*"))


def bronze_prices_from_bars(b: DataFrame) -> DataFrame:
    k = F.col("k")
    return b.select(
        "code", "date",
        _dec(F.when(k % OPEN_NEG_MOD == 0, -F.col("o")).otherwise(F.col("o")), 100).alias("open"),
        _dec(F.when(k % HIGH_BAD_MOD == 0, F.col("l") - 100).otherwise(F.col("h")), 100).alias("high"),
        _dec(F.col("l"), 100).alias("low"),
        _dec(F.when(k % CLOSE_ZERO_MOD == 0, F.lit(0))
             .when(k % CLOSE_JUMP_MOD == 0, F.col("c") * 140)
             .when(k % CLOSE_NULL_MOD == 0, F.lit(None))
             .otherwise(F.col("c") * 100), 10000).alias("close"),
        F.when(k % VOLUME_NEG_MOD == 0, -F.col("v")).otherwise(F.col("v")).alias("volume"),
        F.when(k % SOURCE_B_MOD == 0, F.lit("feed_b")).otherwise(F.lit("feed_a")).alias("source"),
    )


def _index_rows(b: DataFrame, code: str, scale: int) -> DataFrame:
    # Grouping by date: at most one row per calendar day, combined map-side.
    return (b.groupBy("date")
            .agg(F.floor(F.avg("o")).alias("o"), F.max("h").alias("h"), F.min("l").alias("l"),
                 F.floor(F.avg("c")).alias("c"), F.sum("v").cast("bigint").alias("volume"))
            .select(F.lit(code).alias("code"), "date",
                    _dec(F.col("o"), scale).alias("open"), _dec(F.col("h"), scale).alias("high"),
                    _dec(F.col("l"), scale).alias("low"), _dec(F.col("c"), scale).alias("close"),
                    "volume", F.lit("feed_a").alias("source")))


def bronze_index_from_bars(b: DataFrame) -> DataFrame:
    members = b.filter(F.col("l_suppkey") % MEMBER_MOD < MEMBER_CUT)
    return _index_rows(b, "VNINDEX", 10).unionByName(_index_rows(members, "VN30", 5))


def components_from_bars(b: DataFrame) -> DataFrame:
    return b.filter(F.col("l_suppkey") % MEMBER_MOD < MEMBER_CUT).select("code").distinct()


class Bronze:
    """The three bronze inputs derived from one ``lineitem`` read.

    ``materialize`` (optional) stores the aggregated bars once: prices, index
    and constituents all derive from them, so the tick aggregation then runs
    once instead of once per branch (as stored bronze tables do in the
    rebuild)."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize=None):
        self.spark = spark
        self.sf_dir = sf_dir
        li = read_table(spark, sf_dir, "lineitem")
        self.bars = bars(li) if materialize is None else materialize(bars(li))
        self.prices = bronze_prices_from_bars(self.bars)
        self.index = bronze_index_from_bars(self.bars)
        self.components = components_from_bars(self.bars)


def load(spark: SparkSession, sf_dir: str, materialize=None) -> Bronze:
    return Bronze(spark, sf_dir, materialize)


def upsert_batches(bronze_prices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batch 1 = all bars (sequence 1); batch 2 = bars with volume % 7 = 0,
    close + 1, sequence 2."""
    b1 = bronze_prices.withColumn("seq", F.lit(1))
    b2 = (bronze_prices.filter(F.col("volume") % 7 == 0)
          .withColumn("close", (F.col("close") + F.lit(1)).cast("decimal(18,4)"))
          .withColumn("seq", F.lit(2)))
    return b1, b2
