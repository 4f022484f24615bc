"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the bronze derivation in
``sources/fixtures.py``) and runs over all of them. Column names and types
match the oracle SQL in ``oracles.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import gold, indicators, silver
from ..session import checkpoint_root
from ..sources import fixtures
from .materialize import checkpointed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


#: Bars of one task where rows are dealt by symbol: shuffled bytes say little of them, as bars compress to some 20 bytes each.
TASK_BARS = 250_000


def symbol_tasks(bars: DataFrame) -> int:
    """Tasks for rows dealt by symbol: more with the stored ``bars`` (counted from the files' footers), so that what one
    task sorts doesn't grow with them."""
    return max(bars.sparkSession.sparkContext.defaultParallelism, -(-bars.count() // TASK_BARS))


class Layers:
    """Lazily built silver and gold frames over one bronze derivation."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        # The tick aggregation feeds prices, index and constituents: store the
        # bars once (the rebuild reads stored bronze tables the same way).
        self.bronze = fixtures.load(spark, sf_dir, checkpointed)
        dealt = self.bronze.prices.repartition(symbol_tasks(self.bronze.bars), "code")
        self.silver_prices = silver.silver_prices(dealt, self.bronze.index, audit=False)
        self.silver_index = silver.silver_index(self.bronze.index, audit=False)
        self.fact = gold.fact_stock_price(self.silver_prices, audit=False)

    def indicators(self, block: int | None = None, reused: bool = True) -> indicators.Indicators:
        # Bronze -> silver -> fact -> indicators share one hash partitioning by
        # symbol (one exchange). When a query reads the wide indicator frame
        # more than once (``reused``), its lineage is cut once.
        return indicators.Indicators(self.fact, block, checkpointed if reused else None)


@query("silver_prices")
def q_silver_prices(spark, sf_dir):
    return Layers(spark, sf_dir).silver_prices


@query("silver_index")
def q_silver_index(spark, sf_dir):
    return Layers(spark, sf_dir).silver_index


@query("dq_flag_counts")
def q_dq_flag_counts(spark, sf_dir):
    return silver.dq_flag_counts(Layers(spark, sf_dir).silver_prices)


@query("fact_stock_price")
def q_fact_stock_price(spark, sf_dir):
    f = Layers(spark, sf_dir).fact
    return f.select("symbol", "trade_date", "row_num", "open_price", "high_price", "low_price",
                    "close_price", "volume", "source", r6("gain"), r6("loss"))


@query("fact_market_summary")
def q_fact_market_summary(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return gold.fact_market_summary(L.fact, L.silver_index)


@query("dim_stock")
def q_dim_stock(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return gold.dim_stock(L.silver_prices, L.bronze.components)


@query("sma")
def q_sma(spark, sf_dir):
    from ..operators.windows import with_sma
    f = with_sma(Layers(spark, sf_dir).fact, {"ma50": 50, "ma200": 200})
    return f.select("symbol", "trade_date", r6("ma50"), r6("ma200"))


@query("bollinger")
def q_bollinger(spark, sf_dir):
    from ..operators.windows import bollinger_frame
    f = bollinger_frame(Layers(spark, sf_dir).fact, 20, 2.0)
    return f.select("symbol", "trade_date", r6("bb_upper"), r6("bb_lower"))


@query("ema12")
def q_ema12(spark, sf_dir):
    return Layers(spark, sf_dir).indicators(reused=False).ema12().select("symbol", "trade_date", r6("ema_12"))


@query("ema26")
def q_ema26(spark, sf_dir):
    return Layers(spark, sf_dir).indicators(reused=False).ema26().select("symbol", "trade_date", r6("ema_26"))


@query("macd_line")
def q_macd_line(spark, sf_dir):
    return Layers(spark, sf_dir).indicators(reused=False).line.select("symbol", "trade_date", "row_num", r6("macd_line"))


@query("macd_signal")
def q_macd_signal(spark, sf_dir):
    return Layers(spark, sf_dir).indicators(reused=False).signal.select("symbol", "trade_date", r6("macd_signal"))


@query("rsi14")
def q_rsi14(spark, sf_dir):
    return Layers(spark, sf_dir).indicators(reused=False).rsi14()


@query("fact_stock_indicators")
def q_fact_stock_indicators(spark, sf_dir):
    ind = Layers(spark, sf_dir).indicators(reused=False).fact()
    return ind.select("symbol", "trade_date", "close_price", r6("ma50"), r6("ma200"), r6("bb_upper"),
                      r6("bb_lower"), "rsi_14", r6("macd_line"), r6("macd_signal"), r6("macd_histogram"))



# --- bronze maintenance --------------------------------------------------------

def _as_double_bars(df):
    return df.select("code", "date", *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
                     "volume", "source")


@query("upsert_bronze")
def q_upsert_bronze(spark, sf_dir):
    from ..sources import bronze as B
    b1, b2 = fixtures.upsert_batches(fixtures.load(spark, sf_dir).prices)
    return _as_double_bars(B.upsert_bronze(b1.drop("seq"), b2, ("code", "date"), "seq"))


@query("dedup_last")
def q_dedup_last(spark, sf_dir):
    from ..sources import bronze as B
    t = fixtures.ticks(fixtures.read_table(spark, sf_dir, "lineitem")).select(
        "code", "date", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "cents")
    d = B.dedup_last(t, ["code", "date"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"])
    return d.select("code", "date", "l_orderkey", "l_linenumber", "cents")


@query("audit_bars")
def q_audit_bars(spark, sf_dir):
    from ..sources import bronze as B
    return B.audit_bars(fixtures.load(spark, sf_dir).prices)


@query("universe_others")
def q_universe_others(spark, sf_dir):
    from ..operators import calendar as K
    b = fixtures.load(spark, sf_dir, checkpointed)
    return K.universe_others(b.prices.select(F.col("code").alias("symbol")), b.components)


# --- calendar and coverage ------------------------------------------------------

def _calendar(b):
    from ..operators import calendar as K
    return K.data_years_calendar(b.prices, "date")


@query("dim_date")
def q_dim_date(spark, sf_dir):
    return _calendar(fixtures.load(spark, sf_dir))


@query("trading_days")
def q_trading_days(spark, sf_dir):
    from ..operators import calendar as K
    b = fixtures.load(spark, sf_dir)
    return K.trading_days_per_symbol(b.prices, _calendar(b)).select(
        "symbol", "first_date", "last_date", "bars", "trading_days")


@query("coverage")
def q_coverage(spark, sf_dir):
    from ..operators import calendar as K
    b = fixtures.load(spark, sf_dir, checkpointed)
    return K.coverage(b.prices, b.components, _calendar(b))


# --- quality ----------------------------------------------------------------------

@query("quality_report")
def q_quality_report(spark, sf_dir):
    from ..operators import quality as Q
    return Q.report(_gates_of(*_gate_tables(spark, sf_dir)))


def _gate_tables(spark, sf_dir):
    """The tables that gates read, each stored once, as the rebuild stores them."""
    L = Layers(spark, sf_dir)
    sp = checkpointed(L.silver_prices, "silver")
    tasks = symbol_tasks(L.bronze.bars)
    fact = checkpointed(gold.fact_stock_price(sp.repartition(tasks, "symbol"), audit=False), "fact")
    ind = checkpointed(indicators.Indicators(fact.repartition(tasks, "symbol")).fact(), "indicators")
    summary = checkpointed(gold.fact_market_summary(fact, L.silver_index), "summary")
    return sp, checkpointed(L.silver_index, "index"), ind, summary, checkpointed(gold.dim_stock(sp, L.bronze.components), "dim")


def _gates_of(sp, si, ind, summary, dim):
    from ..operators import quality as Q
    return Q.silver_gates(sp, si) + Q.gold_gates(ind, summary, dim)


@query("quality_failures")
def q_quality_failures(spark, sf_dir):
    """Every gate over tables with injected faults: duplicate and null keys,
    and values that break each expression."""
    from ..operators import quality as Q
    sp, si, ind, summary, dim = _gate_tables(spark, sf_dir)
    day = F.dayofmonth("trade_date")
    sp = sp.unionByName(sp.filter("volume % 5 = 0")).withColumns({
        "symbol": F.when(F.col("volume") % 11 != 0, F.col("symbol")), "trade_date": F.when(F.col("volume") % 13 != 0, F.col("trade_date"))})
    si = si.unionByName(si.filter(F.col("volume") % 7 == 0)).withColumns({
        "index_code": F.when(F.col("volume") % 17 != 0, F.col("index_code")), "trade_date": F.when(F.col("volume") % 19 != 0, F.col("trade_date"))})
    ind = ind.withColumns({"rsi_14": F.when(day == 3, F.col("rsi_14") + 60).otherwise(F.col("rsi_14")),
                           "ma200": F.when(day == 4, -F.col("ma200")).otherwise(F.col("ma200")),
                           "bb_upper": F.when(day == 5, F.col("bb_lower") - 1).otherwise(F.col("bb_upper"))})
    summary = summary.withColumn("gainers", F.when(day == 6, F.col("gainers") + 1).otherwise(F.col("gainers")))
    dim = dim.unionByName(dim.filter("is_vn30")).withColumn("symbol", F.when(~F.col("symbol").endswith("7"), F.col("symbol")))
    return Q.report(_gates_of(sp, si, ind, summary, dim))


# --- dashboard extracts and measures ------------------------------------------------

class Marts(Layers):
    """Gold marts the extracts read. The price fact, the summary, the
    dimension and the price extract are stored once each, when first used,
    and every reader takes the stored table."""

    @cached_property
    def stored_fact(self):
        return checkpointed(self.fact, "fact")

    @cached_property
    def summary(self):
        return checkpointed(gold.fact_market_summary(self.stored_fact, self.silver_index), "summary")

    @cached_property
    def dim(self):
        # The fact's rows are silver's valid ones, with their sources.
        return checkpointed(gold.dim_stock(self.stored_fact.withColumn("is_valid", F.lit(True)), self.bronze.components), "dim")

    @cached_property
    def extract(self):
        from ..operators import dashboard as D
        return checkpointed(D.with_pct_change(D.price_extract(self.stored_fact, self.dim)), "extract")

    @cached_property
    def series(self):
        from ..operators import dashboard as D
        fact = self.stored_fact.repartition(symbol_tasks(self.bronze.bars), "symbol")
        ind = indicators.Indicators(fact).fact()
        return D.indicator_extract(ind, self.dim, latest=D.max_date(self.stored_fact).scalar())


@query("latest_market")
def q_latest_market(spark, sf_dir):
    from ..operators import dashboard as D
    L = Layers(spark, sf_dir)
    return D.latest_market(gold.fact_market_summary(L.fact, L.silver_index)).select(
        "trade_date", "gainers", "losers", "unchanged", "total_symbols", "total_volume",
        r6("vnindex_close"), r6("vn30_close"))


@query("market_history")
def q_market_history(spark, sf_dir):
    from ..operators import dashboard as D
    h = D.market_history(Marts(spark, sf_dir).summary)
    return h.select("trade_date", r6("vnindex_close"), r6("vn30_close"), "total_volume", "gainers", "losers",
                    "unchanged")


@query("price_extract")
def q_price_extract(spark, sf_dir):
    return Marts(spark, sf_dir).extract.select("symbol", "trade_date", "close_price", "volume", "is_vn30")


@query("top_movers")
def q_top_movers(spark, sf_dir):
    from ..operators import dashboard as D
    m = Marts(spark, sf_dir)
    t = D.top_movers(m.extract, m.summary)
    return t.select("symbol", "trade_date", r6("close_price"), r6("prev_close"), "pct_change", "is_vn30", "volume")


@query("indicator_extract")
def q_indicator_extract(spark, sf_dir):
    x = Marts(spark, sf_dir).series
    return x.select("symbol", "trade_date", *[r6(c) for c in ("close_price", "ma50", "ma200", "bb_upper",
                                                               "bb_lower")],
                    "rsi_14", *[r6(c) for c in ("macd_line", "macd_signal", "macd_histogram")], "is_vn30")


@query("vn30_breadth")
def q_vn30_breadth(spark, sf_dir):
    from ..operators import dashboard as D
    return D.member_breadth(Marts(spark, sf_dir).extract)


@query("vn30_kpis")
def q_vn30_kpis(spark, sf_dir):
    from ..operators import dashboard as D
    m = Marts(spark, sf_dir)
    k = D.member_kpis(m.extract, m.summary)
    return k.select("trade_date", "gainers", "losers", "unchanged", "total_volume", r6("index_close"))


@query("measure_percent_change")
def q_measure_percent_change(spark, sf_dir):
    from ..operators import dashboard as D
    m = Marts(spark, sf_dir)
    return D.measure_percent_change(m.stored_fact, _calendar(m.bronze)).select(
        "symbol", "trade_date", r6("percent_change"))


@query("measure_latest_breadth")
def q_measure_latest_breadth(spark, sf_dir):
    from ..operators import dashboard as D
    m = Marts(spark, sf_dir)
    return D.measure_latest_breadth(m.stored_fact, _calendar(m.bronze))


@query("measure_trend")
def q_measure_trend(spark, sf_dir):
    from ..operators import dashboard as D
    return D.measure_trend(Layers(spark, sf_dir).fact)


@query("star_quarterly_trend")
def q_star_quarterly_trend(spark, sf_dir):
    from ..operators import dashboard as D
    m = Marts(spark, sf_dir)
    return D.measure_trend_sliced(D.star(m.fact, m.dim, _calendar(m.bronze)))


@query("signals")
def q_signals(spark, sf_dir):
    from ..operators import signals as SG
    return SG.signals(Layers(spark, sf_dir).indicators(reused=False).fact())


# --- verification -------------------------------------------------------------

def nudged(fact):
    """The price fact of another feed: every 37th close of the symbols with
    an even number is 0.01 higher, and gain and loss follow."""
    from ..operators.windows import with_gain_loss
    even = F.substring("symbol", 2, 10).cast("bigint") % 2 == 0
    close = F.when(even & (F.col("row_num") % 37 == 0), F.col("close_price") + 0.01).otherwise(F.col("close_price"))
    return with_gain_loss(fact.drop("gain", "loss").withColumn("close_price", close))


def _two_feeds(spark, sf_dir):
    L = Layers(spark, sf_dir)
    fact = checkpointed(L.fact, "fact")
    dealt = fact.repartition(symbol_tasks(L.bronze.bars), "symbol")
    # Each side is read once, by the join that holds them against each other.
    return indicators.Indicators(dealt).wide, indicators.Indicators(nudged(dealt)).wide, fact


@query("drift_report")
def q_drift_report(spark, sf_dir):
    from ..operators import verify as V
    ours, other, _ = _two_feeds(spark, sf_dir)
    rep = V.drift_report(ours, other)
    return rep.select("symbol", "indicator", "rows", r6("max_abs_err"), r6("mape"))


@query("macd_acceptance")
def q_macd_acceptance(spark, sf_dir):
    """Errors as a number from 1 to 10 (three decimals) and a power of ten: a reference near 0 makes them any size."""
    from ..operators import verify as V
    acc = V.macd_acceptance(*_two_feeds(spark, sf_dir))
    power = lambda c: F.when(F.col(c) > 0, F.floor(F.log10(c))).otherwise(F.lit(0)).cast("bigint")
    shown = lambda c: F.round(F.col(c) / F.pow(F.lit(10.0), power(c)), 3).alias(c)
    return acc.select("symbol", "line_rows", "signal_rows", shown("max_line_err"), power("max_line_err").alias("line_err_power"),
                      shown("max_signal_err"), power("max_signal_err").alias("signal_err_power"), "passed")


# --- payload ----------------------------------------------------

@query("dashboard_payload")
def q_dashboard_payload(spark, sf_dir):
    """The payload's JSON, read back as typed rows."""
    from ..operators import dashboard as D
    m = Marts(spark, sf_dir)
    return D.payload_rows(D.dashboard_payload(m.summary, m.extract, checkpointed(m.series, "series")))


# --- bronze: landing, storage, bounded loads -------------------------------------

@query("landing_normalise")
def q_landing_normalise(spark, sf_dir):
    """IO2, IO3, IO5, F12: two providers' landing frames (text dates, some of
    them none; double prices) to bars, their union and its audit columns."""
    from ..sources import bronze as B
    bars = fixtures.load(spark, sf_dir).prices
    frames = []
    for feed in ("feed_a", "feed_b"):
        mine = bars.filter(F.col("source") == feed)
        time = F.when(F.col("volume") % 17 == 0, F.lit("no date")).otherwise(F.date_format("date", "yyyy-MM-dd"))
        land = mine.select("code", time.alias("time"), *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")], "volume")
        frames.append(B.normalise_bars(land, source=feed.upper()))
    return _as_double_bars(B.union_bars(frames)).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("upsert_roundtrip")
def q_upsert_roundtrip(spark, sf_dir):
    """IO7, IO9, IO10, IO1: batch 1 is written by month, batch 2 (shuffled
    duplicates and no sequence among it) is upserted, the table read back."""
    from ..sources import bronze as B
    root = f"{checkpoint_root(spark)}/tables/upsert-{uuid.uuid4().hex}"
    b1, b2 = fixtures.upsert_batches(fixtures.load(spark, sf_dir, checkpointed).prices)
    stamp = lambda df, t: df.drop("seq").withColumn("ingested_at", F.lit(t).cast("timestamp"))
    older = stamp(b2, "2027-01-02").withColumn("close", (F.col("close") + 5).cast("decimal(18,4)"))
    B.upsert_into(spark, stamp(b1, "2027-01-01"), f"{root}/bronze_prices", f"{root}/staging", grain=B.YEAR_MONTH)
    B.upsert_into(spark, stamp(b2, "2027-01-03").unionByName(older), f"{root}/bronze_prices", f"{root}/staging")
    return _as_double_bars(B.read_bronze(spark, root, "bronze_prices"))


@query("range_load")
def q_range_load(spark, sf_dir):
    """IO1, IO13, P10: constituents' bars of 2023-02-10..2024-05-20 from the
    stored, partitioned table."""
    from ..sources import bronze as B
    root = f"{checkpoint_root(spark)}/tables/range-{uuid.uuid4().hex}"
    b = fixtures.load(spark, sf_dir, checkpointed)
    B.write_partitioned(b.prices, f"{root}/bronze_prices")
    return _as_double_bars(B.select_range(B.read_bronze(spark, root, "bronze_prices"), b.components, "2023-02-10", "2024-05-20"))


@query("components_replace")
def q_components_replace(spark, sf_dir):
    """IO8: the stored list replaced twice, the second time by nothing."""
    from ..sources import bronze as B
    path = f"{checkpoint_root(spark)}/tables/components-{uuid.uuid4().hex}"
    b = fixtures.load(spark, sf_dir, checkpointed)
    B.replace_components(spark, b.prices.select("code").filter(F.col("volume") % 2 == 0), path)
    B.replace_components(spark, b.prices.join(b.components, "code", "left_semi").select("code"), path)
    B.replace_components(spark, b.components.filter("code is null"), path)
    return B.read_stored(spark, path).select("code")


@query("needs_backfill")
def q_needs_backfill(spark, sf_dir):
    """A6, C4 over symbols and a range: a covered month, a month past the
    data, the same forced."""
    from ..operators import calendar as K
    b = fixtures.load(spark, sf_dir, checkpointed)
    every = b.prices.select("code").distinct()
    asks = [("members 2022-03", b.components, "2022-03-01", "2022-03-31", False), ("members 2030-01", b.components, "2030-01-01", "2030-01-31", False),
            ("all 2023", every, "2023-01-01", "2023-12-31", False), ("all 2023 forced", every, "2023-01-01", "2023-12-31", True),
            ("one day", b.components, "2024-04-30", "2024-04-30", False)]
    rows = [K.needs_backfill(b.prices, who, start, end, force).select(F.lit(name).alias("ask"), "*") for name, who, start, end, force in asks]
    return reduce(lambda x, y: x.unionByName(y), rows)


@query("dim_date_span")
def q_dim_date_span(spark, sf_dir):
    """The calendar of the data's first to last day, no holidays."""
    from ..operators import calendar as K
    span = fixtures.load(spark, sf_dir).prices.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    return K.dim_date(spark, span["lo"], span["hi"])


@query("universe")
def q_universe(spark, sf_dir):
    """The listed stocks (a listing derived from the bars) and the
    universe of every mode."""
    from ..operators import calendar as K
    b = fixtures.load(spark, sf_dir, checkpointed)
    codes = b.prices.select("code").distinct()
    number = F.substring("code", 2, 10).cast("bigint")
    listing = codes.select(F.col("code").alias("symbol"), F.when(number % 7 == 0, "ETF").otherwise("STOCK").alias("type"),
                           F.when(number % 5 == 0, "HNX").otherwise("HSX").alias("exchange"))
    listed = K.listed_stocks(listing)
    modes = [K.resolve_universe(listed, b.components, m).select(F.lit(str(m)).alias("mode"), "symbol") for m in ("vn30", "others", "all", None)]
    return reduce(lambda x, y: x.unionByName(y), modes)


# --- dashboard: units, slicers, members -------------------------------------------

@query("unit_normalisation")
def q_unit_normalisation(spark, sf_dir):
    """Closes of even symbols in raw units (x 1000) and index
    levels x 100, brought back by the cutoffs."""
    from ..functions.columns import normalize_index, normalize_price
    L = Layers(spark, sf_dir)
    even = F.substring("symbol", 2, 10).cast("bigint") % 2 == 0
    raw = F.when(even, F.col("close_price") * 1000).otherwise(F.col("close_price"))
    px = L.fact.select(F.col("symbol").alias("name"), "trade_date", raw.alias("raw"))
    ix = L.silver_index.select(F.col("index_code").alias("name"), "trade_date", (F.col("close_price") * 100).alias("raw"))
    return (px.withColumn("value", normalize_price("raw")).unionByName(ix.withColumn("value", normalize_index("raw")))
            .select("name", "trade_date", r6("raw"), r6("value")))


@query("top_movers_members")
def q_top_movers_members(spark, sf_dir):
    from ..operators import dashboard as D
    m = Marts(spark, sf_dir)
    t = D.top_movers(m.extract, m.summary, members_only=True)
    return t.select("symbol", "trade_date", r6("close_price"), r6("prev_close"), "pct_change", "is_vn30", "volume")


@query("measures_sliced")
def q_measures_sliced(spark, sf_dir):
    """M6 on M4 and M5: the trend of constituents in a date range, of the
    others, of one day and of one symbol."""
    from ..operators import dashboard as D
    m = Marts(spark, sf_dir)
    slices = {"members 2022": dict(members=True, start="2022-01-01", end="2022-12-31"), "others from 2025": dict(members=False, start="2025-01-01"),
              "one day": dict(start="2023-06-01", end="2023-06-01"), "one symbol": dict(symbol="S3")}
    rows = [D.measure_trend(D.slice_prices(m.stored_fact, m.dim, **kw)).select(F.lit(name).alias("slice"), "*") for name, kw in slices.items()]
    return reduce(lambda x, y: x.unionByName(y), rows)


# --- stored tables and runs, read back ---------------------------------------------

def _scratch_root(spark, name):
    return f"{checkpoint_root(spark)}/tables/{name}-{uuid.uuid4().hex}"


@query("stored_fact")
def q_stored_fact(spark, sf_dir):
    """IO9, IO10: the price fact as a stored daily table, by year and in buckets by symbol."""
    from . import store as S
    fact = gold.fact_stock_price(checkpointed(Layers(spark, sf_dir).silver_prices, "silver"), audit=False)
    entry = S.write_daily(fact, f"{_scratch_root(spark, 'fact')}/fact_stock_price", "first", S.bucket_count(spark))
    return S.open_daily(spark, entry).select("symbol", "trade_date", "row_num", "open_price", "high_price", "low_price", "close_price", "volume", "source", r6("gain"), r6("loss"))


@query("dim_date_csv")
def q_dim_date_csv(spark, sf_dir):
    """IO12: the calendar's CSV file."""
    from ..sources import bronze as B
    path, cal = _scratch_root(spark, "dim-date"), _calendar(fixtures.load(spark, sf_dir))
    B.write_csv(cal.orderBy("date"), path)
    return spark.read.option("header", True).schema(cal.schema).csv(path)


@query("ordered_sink")
def q_ordered_sink(spark, sf_dir):
    """T5: silver closes written in order of day and symbol; each row with the place where it lies in the files by name."""
    from ..sources import bronze as B
    path = _scratch_root(spark, "ordered")
    rows = checkpointed(Layers(spark, sf_dir).silver_prices.select("symbol", "trade_date", "close_price"), "silver")
    B.write_ordered(rows, path, ["trade_date", "symbol"], fmt="parquet")
    lie = spark.read.parquet(path).select("symbol", "trade_date", "close_price", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    # a row for each file
    sizes = lie.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    return lie.join(before, "file").select("symbol", "trade_date", "close_price", (F.col("before") + F.col("row")).alias("position"))


@query("warehouse_run")
def q_warehouse_run(spark, sf_dir):
    """Q5: the whole run (upsert, layers with their gates, extracts, publication); the stored market summary."""
    from . import warehouse as W
    root, b = _scratch_root(spark, "warehouse"), fixtures.load(spark, sf_dir, checkpointed)
    W.run_pipeline(spark, b.prices, b.index, b.components, f"{root}/bronze_prices", root)
    return W.open_table(spark, root, "fact_market_summary")


@query("daily_run")
def q_daily_run(spark, sf_dir):
    """Q5, R1..R7, W5..W8 in proportion to the day: bars up to 2026-06-01 (some of them wrong) and a full build, a day run
    with the next month, and one with the rest and the right bars; the stored indicators."""
    from . import daily
    from . import warehouse as W
    root, b = _scratch_root(spark, "daily"), fixtures.load(spark, sf_dir, checkpointed)
    index = checkpointed(b.index, "index")
    to = lambda df, lo, hi: df.filter(F.col("date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
    wrong = (F.col("code") == "S3") & (F.col("date") >= F.lit("2026-01-01").cast("date")) & (F.col("volume") % 5 == 0)
    first = to(b.prices, "1900-01-01", "2026-05-31")
    first = first.withColumn("close", F.when(wrong, F.col("close") + 1).otherwise(F.col("close")).cast("decimal(18,4)"))
    right = to(b.prices.filter(wrong), "1900-01-01", "2026-05-31").unionByName(to(b.prices, "2026-07-01", "9999-12-31"))
    for batch, upto in ((first, "2026-05-31"), (to(b.prices, "2026-06-01", "2026-06-30"), "2026-06-30"), (right, "9999-12-31")):
        daily.run_daily(spark, batch, to(index, "1900-01-01", upto), b.components, f"{root}/bronze_prices", root)
    ind = W.open_table(spark, root, "fact_stock_indicators")
    return ind.select("symbol", "trade_date", "close_price", r6("ma50"), r6("ma200"), r6("bb_upper"), r6("bb_lower"), "rsi_14",
                      r6("macd_line"), r6("macd_signal"), r6("macd_histogram"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
