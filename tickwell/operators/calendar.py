"""Calendar, trading-day counts, coverage gate and symbol universe.

A calendar has one row per day, so it is bounded by the span it covers
(about 365 rows per year) and is broadcast wherever it is joined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C


def _day_rows(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end)).alias("date")


def calendar_frame(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Date parts and the trading-day flag for a frame with a ``date`` column.
    Trading day = Monday..Friday and not in ``holidays`` (if given)."""
    d = F.col("date")
    out = days.select(
        d, F.dayofmonth(d).alias("day"), F.date_format(d, "EEEE").alias("day_of_week"),
        F.month(d).alias("month"), F.quarter(d).alias("quarter"), F.year(d).alias("year"))
    weekday = F.weekday(d) < 5
    if holidays is None:
        return out.withColumn("is_trading_day", weekday)
    # A caller's table may cover more than these days: cut to them, it is as bounded as they are.
    h = holidays.select(F.col("date").alias("_h")).join(days.select(d.alias("_h")), "_h", "left_semi").distinct()
    return (out.join(F.broadcast(h), d == F.col("_h"), "left")
               .withColumn("is_trading_day", weekday & F.col("_h").isNull()).drop("_h"))


def dim_date(spark: SparkSession, start, end, holidays: DataFrame | None = None) -> DataFrame:
    """One row per day in [start, end]. The day sequence is
    generated by ``spark.range`` (distributed), not on the driver."""
    s, e = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    n = (e - s).days + 1
    days = spark.range(n).select(F.date_add(F.lit(s), F.col("id").cast("int")).alias("date"))
    return calendar_frame(days, holidays)


def fixed_holidays(days: DataFrame) -> DataFrame:
    """Holiday table from the fixed (month, day) list, for the days given."""
    d = F.col("date")
    cond = F.lit(False)
    for m, dd in C.FIXED_HOLIDAYS:
        cond = cond | ((F.month(d) == m) & (F.dayofmonth(d) == dd))
    return days.filter(cond).select("date")


def data_years_calendar(dates: DataFrame, date_col: str = "date", holidays: str | None = "fixed") -> DataFrame:
    """Calendar over whole calendar years spanned by the data (Jan 1 of the
    first year to Dec 31 of the last). Lazy: the bounds are one aggregate
    row and the days are exploded from it (bounded by the span)."""
    bounds = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = bounds.select(_day_rows(F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
                                   F.make_date(F.year("hi"), F.lit(12), F.lit(31))))
    hol = fixed_holidays(days) if holidays == "fixed" else None
    return calendar_frame(days, hol)


def is_fixed_trading_day(d: Column) -> Column:
    """C3 rule: weekday and not one of the fixed holidays."""
    hol = F.lit(False)
    for m, dd in C.FIXED_HOLIDAYS:
        hol = hol | ((F.month(d) == m) & (F.dayofmonth(d) == dd))
    return (F.weekday(d) < 5) & ~hol


def trading_day_index(cal: DataFrame) -> DataFrame:
    """Running count of trading days per date (calendar-sized, one task)."""
    w = Window.partitionBy(F.lit(0)).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cal.select("date", F.sum(F.col("is_trading_day").cast("int")).over(w).alias("td"))


def count_trading_days(ranges: DataFrame, cal: DataFrame, start: str = "start", end: str = "end",
                       out: str = "trading_days") -> DataFrame:
    """Trading days in [start, end] per row of ``ranges`` as
    td(end) - td(start) + [start is a trading day], with two broadcast
    equi-joins against the calendar index (no range join)."""
    idx = trading_day_index(cal).join(cal.select("date", "is_trading_day"), "date")
    a = idx.select(F.col("date").alias("_sd"), F.col("td").alias("_std"), F.col("is_trading_day").alias("_st"))
    b = idx.select(F.col("date").alias("_ed"), F.col("td").alias("_etd"))
    j = (ranges.join(F.broadcast(a), F.col(start) == F.col("_sd"), "left")
               .join(F.broadcast(b), F.col(end) == F.col("_ed"), "left"))
    n = F.col("_etd") - F.col("_std") + F.col("_st").cast("int")
    return j.withColumn(out, F.greatest(n, F.lit(0)).cast("bigint")).drop("_sd", "_std", "_st", "_ed", "_etd")


def trading_days_per_symbol(bars: DataFrame, cal: DataFrame) -> DataFrame:
    """Per symbol: first and last bar date, bars held, trading days spanned."""
    spans = bars.groupBy("code").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                                     F.count(F.lit(1)).cast("bigint").alias("bars"))
    return count_trading_days(spans, cal, "first_date", "last_date").withColumnRenamed("code", "symbol")


def coverage(bars: DataFrame, members: DataFrame, cal: DataFrame, force: bool = False) -> DataFrame:
    """C4 + A6 per calendar year: existing member bars in the year against
    expected = members x trading days; a load is skipped when existing >=
    floor(0.8 * expected) and expected > 0, unless forced."""
    m = members.select(F.col("code")).distinct()
    n_members = m.agg(F.count(F.lit(1)).cast("bigint")).scalar()
    years = (cal.groupBy("year").agg(F.min("date").alias("start"), F.max("date").alias("end")))
    years = count_trading_days(years, cal, "start", "end")
    # The member list grows with the listing, not the calendar: no hint; the
    # planner broadcasts it when its size is under the broadcast threshold.
    existing = (bars.join(m, "code", "left_semi")
                .groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).cast("bigint").alias("existing_rows")))
    out = (years.withColumn("symbols", n_members)
           .join(existing, "year", "left")
           .withColumn("existing_rows", F.coalesce("existing_rows", F.lit(0).cast("bigint")))
           .withColumn("expected_rows", F.col("symbols") * F.col("trading_days"))
           .withColumn("threshold", F.floor(F.col("expected_rows") * F.lit(C.COVERAGE_RATIO)).cast("bigint")))
    skip = (F.col("expected_rows") > 0) & (F.col("existing_rows") >= F.col("threshold")) & F.lit(not force)
    return out.withColumn("needs_load", ~skip).select(
        "year", "start", "end", "symbols", "trading_days", "expected_rows", "existing_rows", "threshold", "needs_load")


def count_bars(bars: DataFrame, symbols: DataFrame, start, end) -> DataFrame:
    """How many bars of ``symbols`` (a frame with ``code``) lie between
    start and end, both inclusive: one row, ``existing_rows``. The range
    prunes a partitioned table; the symbols stay a semi join."""
    from ..sources.bronze import select_range
    return select_range(bars, symbols, start, end).agg(F.count(F.lit(1)).cast("bigint").alias("existing_rows"))


def needs_backfill(bars: DataFrame, symbols: DataFrame, start, end, force: bool = False) -> DataFrame:
    """C4: one row saying whether [start, end] must be loaded for
    ``symbols``: not when at least floor(0.8 * symbols * trading days) bars
    are there and any are expected, unless forced."""
    spark = bars.sparkSession
    span = dim_date(spark, start, end)
    wanted = symbols.select("code").distinct()
    days = span.filter(is_fixed_trading_day(F.col("date"))).agg(F.count(F.lit(1)).cast("bigint")).scalar()
    n = wanted.agg(F.count(F.lit(1)).cast("bigint")).scalar()
    out = (count_bars(bars, wanted, start, end)
           .withColumn("symbols", n).withColumn("trading_days", days)
           .withColumn("expected_rows", F.col("symbols") * F.col("trading_days"))
           .withColumn("threshold", F.floor(F.col("expected_rows") * F.lit(C.COVERAGE_RATIO)).cast("bigint")))
    skip = (F.col("expected_rows") > 0) & (F.col("existing_rows") >= F.col("threshold")) & F.lit(not force)
    return out.select("symbols", "trading_days", "expected_rows", "existing_rows", "threshold", (~skip).alias("needs_load"))


def listed_stocks(listing: DataFrame, type_: str = "STOCK", exchange: str = "HSX") -> DataFrame:
    """P13."""
    return listing.filter((F.col("type") == type_) & (F.col("exchange") == exchange)).select("symbol")


def universe_others(all_symbols: DataFrame, members: DataFrame) -> DataFrame:
    """Symbols that are not constituents (anti join)."""
    return (all_symbols.select(F.col("symbol")).distinct()
            .join(members.select(F.col("code").alias("symbol")).distinct(), "symbol", "left_anti"))


def resolve_universe(all_symbols: DataFrame, members: DataFrame, mode: str | None,
                     spark: SparkSession | None = None) -> DataFrame:
    """C5: 'vn30' -> constituents, 'others' -> the rest, 'all' -> every
    symbol, otherwise the default constituent list."""
    if mode == "vn30":
        return members.select(F.col("code").alias("symbol")).distinct()
    if mode == "others":
        return universe_others(all_symbols, members)
    if mode == "all":
        return all_symbols.select("symbol").distinct()
    spark = spark or all_symbols.sparkSession
    return spark.createDataFrame([(s,) for s in C.DEFAULT_MEMBERS], "symbol string")
