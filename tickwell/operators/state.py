"""What a symbol's next bars need of all bars before: its state.

The moving averages and bands read the last 200 rows, the recursions (EMA, Wilder averages, MACD signal) their last value,
the gap rule the last raw close. One row per symbol holds these, so a new day is computed from the state and the day's bars
alone. A symbol with 200 rows or fewer has all of them in its state and is computed from its first row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from . import gold, silver
from .indicators import CARRIED, Indicators
from .windows import by_symbol

TAIL_ROWS = C.MA_LONG
_TAIL = ("row_num", "trade_date", "close_price", "gain", "loss")


def last_bars(prices: DataFrame) -> DataFrame:
    """(symbol, raw_date, raw_close): each symbol's last bar as loaded. Combined map-side."""
    return prices.groupBy(F.col("code").alias("symbol")).agg(F.max(F.col("date").cast("date")).alias("raw_date"), F.max_by("close", "date").alias("raw_close"))


def symbol_state(wide: DataFrame, bars: DataFrame) -> DataFrame:
    """One row per symbol of ``bars``: last raw bar, last rows (``tail``, at most 200, by row number) and last recursion values.
    A symbol without a valid row has no tail."""
    last = F.max("row_num").over(Window.partitionBy("symbol"))
    rows = wide.withColumn("_last", last).filter(F.col("row_num") > F.col("_last") - TAIL_ROWS)
    tails = rows.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct(*_TAIL))).alias("tail"), _values().alias("state"))
    return bars.join(tails, "symbol", "left").select("symbol", "raw_date", "raw_close", "tail", "state")


def _values():
    return F.struct(*[F.max_by(c, "row_num").alias(c) for c in CARRIED])


def next_state(state: DataFrame, bars: DataFrame, rows: DataFrame) -> DataFrame:
    """States after new ``bars``, all later than their symbol's last one: a symbol's new valid ``rows`` (of the wide frame) are
    put to the end of its tail. One whose new bars are all invalid keeps its tail and recursion values. Stored tails are cut
    as they lie and are not dealt row by row."""
    added = rows.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct(*_TAIL))).alias("_added"), _values().alias("_values"))
    last = last_bars(bars).select("symbol", F.col("raw_date").alias("_date"), F.col("raw_close").alias("_close"))
    touched = last.join(added, "symbol", "left")
    listed = touched.join(state.select("symbol"), "symbol", "left_anti")
    both = F.when(F.col("tail").isNull(), F.col("_added")).otherwise(F.concat("tail", "_added"))
    cut = F.slice(both, F.greatest(F.size(both) - TAIL_ROWS + 1, F.lit(1)), TAIL_ROWS)
    mine = state.join(touched, "symbol", "left").select(
        "symbol", F.coalesce("_date", "raw_date").alias("raw_date"), F.when(F.col("_date").isNull(), F.col("raw_close")).otherwise(F.col("_close")).alias("raw_close"),
        F.when(F.col("_added").isNull(), F.col("tail")).otherwise(cut).alias("tail"), F.coalesce("_values", "state").alias("state"))
    new = listed.select("symbol", F.col("_date").alias("raw_date"), F.col("_close").alias("raw_close"),
                        F.slice("_added", F.greatest(F.size("_added") - TAIL_ROWS + 1, F.lit(1)), TAIL_ROWS).alias("tail"), F.col("_values").alias("state"))
    return mine.unionByName(new)


def last_after(bars: DataFrame, state: DataFrame) -> DataFrame:
    """``last_bars`` of the symbols of ``bars`` once these have replaced or followed their stored ones."""
    last = last_bars(bars).select("symbol", F.col("raw_date").alias("_date"), F.col("raw_close").alias("_close"))
    both = last.join(state.select("symbol", "raw_date", "raw_close"), "symbol", "left")
    newer = F.col("raw_date").isNull() | (F.col("_date") >= F.col("raw_date"))
    return both.select("symbol", F.when(newer, F.col("_date")).otherwise(F.col("raw_date")).alias("raw_date"),
                       F.when(newer, F.col("_close")).otherwise(F.col("raw_close")).alias("raw_close"))


def with_last_bars(bars: DataFrame, state: DataFrame) -> DataFrame:
    """New bars and, for the gap rule, the last stored bar of each of their symbols (its date and raw close alone)."""
    kinds = dict(bars.dtypes)
    given = {"code": F.col("symbol"), "date": F.col("raw_date"), "close": F.col("raw_close")}
    mine = state.join(bars.select(F.col("code").alias("symbol")).distinct(), "symbol", "left_semi")
    return bars.unionByName(mine.select(*[given.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in bars.columns]))


def new_silver(bars: DataFrame, state: DataFrame, index: DataFrame) -> DataFrame:
    """Silver rows of bars that are later than their symbol's last stored one."""
    rows = silver.silver_prices(with_last_bars(bars, state), index)
    before = state.select("symbol", "raw_date")
    return rows.join(before, "symbol", "left").filter(F.col("raw_date").isNull() | (F.col("trade_date") > F.col("raw_date"))).drop("raw_date")


def continued_fact(new: DataFrame, state: DataFrame) -> DataFrame:
    """Price-fact rows of new silver rows (``is_new``) after the stored tails of their symbols, numbered on, with gain and
    loss; ``_pos`` and ``_state`` tell the recursions where to go on (``indicators._carried``)."""
    rows = gold.valid_only(new).withColumnRenamed("loaded_at", "silver_loaded_at")
    cols = ["symbol", "trade_date", "open_price", "high_price", "low_price", "close_price", "volume", "source", "silver_loaded_at"]
    rows = rows.select(*cols, F.lit(True).alias("is_new"))
    mine = state.join(rows.select("symbol").distinct(), "symbol", "left_semi").select("symbol", "state", F.size("tail").alias("_n"), F.posexplode("tail"))
    goes_on = F.col("col.row_num") - F.col("pos") > 1  # rows before the tail exist
    tails = mine.select(
        "symbol", *[F.col(f"col.{c}").alias({"gain": "_gain", "loss": "_loss", "row_num": "_row"}.get(c, c)) for c in _TAIL], F.lit(False).alias("is_new"),
        F.when(goes_on, F.when(F.col("pos") == F.col("_n") - 1, 0).otherwise(-1)).alias("_pos"), F.col("state").alias("_state"))
    both = rows.unionByName(tails, allowMissingColumns=True)
    w = by_symbol()
    number = F.coalesce(F.max("_row").over(Window.partitionBy("symbol")), F.lit(0)) + F.count_if(F.col("is_new")).over(w)
    both = gold.with_gain_loss(both.withColumn("row_num", F.when(F.col("is_new"), number).otherwise(F.col("_row")).cast("bigint")))
    both = both.withColumns({c: F.when(F.col("is_new"), F.col(c)).otherwise(F.col(f"_{c}")) for c in ("gain", "loss")})
    return both.withColumn("gold_loaded_at", F.current_timestamp()).drop("_row", "_gain", "_loss")


# Of a price fact's columns those that the wide frame lacks.
_FACT_ONLY = ("open_price", "high_price", "low_price", "volume", "source", "silver_loaded_at", "gold_loaded_at")


def wide_fact(fact: DataFrame) -> DataFrame:
    """The wide frame with all columns of the price fact."""
    return Indicators(fact, keep=_FACT_ONLY).wide


def new_wide(new: DataFrame, state: DataFrame) -> DataFrame:
    """``wide_fact`` of new silver rows, computed on from the states: the new rows alone."""
    return Indicators(continued_fact(new, state), keep=(*_FACT_ONLY, "is_new")).wide.filter("is_new").drop("is_new")
