"""Dashboard extracts (D1..D8), report measures (M1..M6), top-k (T1..T5)
and the JSON payload (IO11).

"Latest" dates are scalar subqueries (one value each), never joined rows.
Extract windows (previous close inside the extract) partition by symbol,
bounded by the extract's date span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import guarded_ratio, normalize_index, normalize_price


def max_date(df: DataFrame, date: str = "trade_date", out: str = "max_date") -> DataFrame:
    """One-row frame with the latest date."""
    return df.agg(F.max(date).alias(out))


def from_date(df: DataFrame, low: Column, date: str = "trade_date") -> DataFrame:
    """Rows on or after ``low``; on a table partitioned by year the implied
    bound on the year prunes the scan."""
    out = df.filter(F.col(date) >= low)
    return out.filter(F.col("year") >= F.year(low)) if "year" in df.columns else out


def since_max(df: DataFrame, days: int, date: str = "trade_date", latest: Column | None = None) -> DataFrame:
    """J10 + F11: rows within ``days`` of the frame's own latest date (an
    uncorrelated scalar subquery; ``latest`` gives it where a cheaper table
    holds the same dates)."""
    latest = max_date(df, date).scalar() if latest is None else latest
    return from_date(df, F.date_sub(latest, days), date)


def latest_row(df: DataFrame, date: str = "trade_date") -> DataFrame:
    """The row with the latest date."""
    return df.orderBy(F.col(date).desc()).limit(1)


def latest_dates(df: DataFrame, n: int = C.LATEST_DATES, date: str = "trade_date") -> DataFrame:
    """The ``n`` latest distinct dates."""
    return df.select(date).distinct().orderBy(F.col(date).desc()).limit(n)


def latest_market(summary: DataFrame) -> DataFrame:
    """Latest market-summary row with index levels normalised."""
    return latest_row(summary).select(
        "trade_date", "gainers", "losers", "unchanged", "total_symbols", "total_volume",
        normalize_index("vnindex_close").alias("vnindex_close"),
        normalize_index("vn30_close").alias("vn30_close"))


def market_history(summary: DataFrame, days: int = C.LOOKBACK_DAYS) -> DataFrame:
    """The last ``days`` days of the market summary, indices normalised."""
    return since_max(summary, days).select(
        "trade_date", normalize_index("vnindex_close").alias("vnindex_close"),
        normalize_index("vn30_close").alias("vn30_close"),
        "total_volume", "gainers", "losers", "unchanged")


def with_member_flag(df: DataFrame, dim: DataFrame) -> DataFrame:
    """``is_vn30`` from the stock dimension, false when absent. The
    dimension has one row per symbol, which grows with the listing: no
    broadcast hint; the planner broadcasts it under the broadcast threshold
    (a stored dimension has an exact size) and AQE re-plans at runtime."""
    d = dim.select(F.col("symbol").alias("_s"), F.col("is_vn30").alias("_m"))
    return (df.join(d, F.col("symbol") == F.col("_s"), "left")
              .withColumn("is_vn30", F.coalesce(F.col("_m"), F.lit(False))).drop("_s", "_m"))


def price_extract(fact: DataFrame, dim: DataFrame, days: int = C.LOOKBACK_DAYS,
                  n_latest: int = C.LATEST_DATES, dates: list | None = None) -> DataFrame:
    """D3: constituents over the last ``days`` days, plus every symbol on the
    ``n_latest`` latest distinct dates (J9). The dates are bounded before the
    join with the dimension. ``dates``: these latest dates, where they are
    known already (``store.latest_dates`` reads the last year for them)."""
    if dates:
        cut, recent = F.date_sub(F.lit(max(dates)), days), F.lit(min(dates))
    else:
        cut = F.date_sub(max_date(fact).scalar(), days)
        recent = latest_dates(fact, n_latest).agg(F.min("trade_date")).scalar()  # the dates from here on are the latest
    kept = from_date(fact, F.least(cut, recent)).select("symbol", "trade_date", "close_price", "volume")
    keep = (F.col("is_vn30") & (F.col("trade_date") >= cut)) | (F.col("trade_date") >= recent)
    return with_member_flag(kept, dim).filter(keep).select("symbol", "trade_date", "close_price", "volume", "is_vn30")


def with_pct_change(extract: DataFrame) -> DataFrame:
    """Normalised close (P11), previous normalised close inside the
    extract, percent change rounded half-even to 2 places. An extract that
    has them already is returned as it is."""
    if "pct_change" in extract.columns:
        return extract
    w = Window.partitionBy("symbol").orderBy("trade_date")
    cn = normalize_price("close_price")
    return (extract.withColumn("close_normalized", cn)
            .withColumn("prev_close", F.lag("close_normalized").over(w))
            .withColumn("pct_change",
                        F.bround(guarded_ratio(F.col("close_normalized") - F.col("prev_close"),
                                               "prev_close") * 100.0, 2)))


def movers(extract: DataFrame, summary: DataFrame) -> DataFrame:
    """D4 (all rows): the extract's rows on the latest market-summary date,
    with null change shown as 0.0 and null volume as 0. ``rank_change`` keeps
    the raw change for ordering (nulls last)."""
    x = with_pct_change(extract).filter(F.col("trade_date") == max_date(summary).scalar())
    return x.select("symbol", "trade_date", F.col("close_normalized").alias("close_price"), "prev_close",
                    F.coalesce("pct_change", F.lit(0.0)).alias("pct_change"),
                    F.col("pct_change").alias("rank_change"), "is_vn30",
                    F.coalesce("volume", F.lit(0).cast("bigint")).alias("volume"))


def top_n(df: DataFrame, measure: str, n: int = C.TOP_MOVERS, tie: str = "symbol") -> DataFrame:
    """Top ``n`` by a measure, descending, nulls last, ties by
    symbol (the limit is the feature: a top-k report)."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(tie).asc()).limit(n)


def top_movers(extract: DataFrame, summary: DataFrame, n: int = C.TOP_MOVERS,
               members_only: bool = False) -> DataFrame:
    m = movers(extract, summary)
    if members_only:
        m = m.filter("is_vn30")
    return top_n(m, "rank_change", n).drop("rank_change")


def indicator_extract(ind: DataFrame, dim: DataFrame, days: int = C.LOOKBACK_DAYS,
                      latest: Column | None = None) -> DataFrame:
    """Indicators over the last ``days`` days, prices normalised.
    ``latest``: the latest date, as a scalar from the price fact, which has
    the same dates."""
    x = with_member_flag(since_max(ind, days, latest=latest), dim)
    cols = [normalize_price(c).alias(c) if c in ("close_price", "ma50", "ma200", "bb_upper", "bb_lower")
            else F.col(c) for c in ("symbol", "trade_date", "close_price", "ma50", "ma200", "bb_upper",
                                    "bb_lower", "rsi_14", "macd_line", "macd_signal", "macd_histogram",
                                    "is_vn30")]
    return x.select(*cols)


def member_breadth(extract: DataFrame) -> DataFrame:
    """Per date over constituents of the extract, counts of
    positive / negative / zero change (a null change is in no bucket), and
    volume (0 when all null)."""
    x = with_pct_change(extract).filter("is_vn30")
    return x.groupBy("trade_date").agg(
        F.coalesce(F.sum("volume"), F.lit(0)).cast("bigint").alias("total_volume"),
        F.count_if(F.col("pct_change") > 0).cast("bigint").alias("gainers"),
        F.count_if(F.col("pct_change") < 0).cast("bigint").alias("losers"),
        F.count_if(F.col("pct_change") == 0).cast("bigint").alias("unchanged"))


def member_kpis(extract: DataFrame, summary: DataFrame) -> DataFrame:
    """Constituent KPIs on the latest date from the movers list (a null
    change shown as 0.0 counts as flat) and the constituent index level."""
    m = movers(extract, summary).filter("is_vn30")
    k = m.agg(F.count_if(F.col("pct_change") > 0).cast("bigint").alias("gainers"),
              F.count_if(F.col("pct_change") < 0).cast("bigint").alias("losers"),
              F.count_if(F.col("pct_change") == 0).cast("bigint").alias("unchanged"),
              F.coalesce(F.sum("volume"), F.lit(0)).cast("bigint").alias("total_volume"))
    lm = latest_market(summary).select(F.struct("trade_date", "vn30_close").alias("m")).scalar()
    return (k.withColumn("_m", lm)
            .select(F.col("_m.trade_date").alias("trade_date"), "gainers", "losers", "unchanged", "total_volume",
                    F.col("_m.vn30_close").alias("index_close")))


# --- report measures --------------------------------------------------------

def _latest_trading_dates(prices: DataFrame, cal: DataFrame) -> DataFrame:
    """Latest calendar trading day that has price rows, and the calendar
    trading day before it (one row)."""
    tdays = cal.filter("is_trading_day").select(F.col("date").alias("d"))
    have = prices.select(F.col("trade_date").alias("d")).distinct()
    latest = tdays.join(have, "d", "left_semi").agg(F.max("d").alias("latest_date"))
    prev = tdays.filter(F.col("d") < latest.scalar()).agg(F.max("d").alias("prev_date"))
    return latest.select("latest_date", prev.scalar().alias("prev_date"))


def slice_prices(prices: DataFrame, dim: DataFrame | None = None, members: bool | None = None,
                 start=None, end=None, symbol: str | None = None) -> DataFrame:
    """M6: optional slicers (constituents, date range, one symbol)."""
    out = prices
    if members is not None and dim is not None:
        out = with_member_flag(out, dim).filter(F.col("is_vn30") == F.lit(members)).drop("is_vn30")
    if start is not None:
        out = out.filter(F.col("trade_date") >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(F.col("trade_date") <= F.lit(end).cast("date"))
    if symbol is not None:
        out = out.filter(F.col("symbol") == symbol)
    return out


def star(fact: DataFrame, dim: DataFrame, cal: DataFrame, date: str = "trade_date") -> DataFrame:
    """A fact with its dimensions for slicing: the stock dimension by
    symbol (``exchange``, ``is_vn30``, false when absent) and the calendar by
    date (day name, month, quarter, year, trading-day flag). The calendar has
    one row per day (broadcast); the stock dimension goes through the
    planner's size check (see ``with_member_flag``)."""
    d = dim.select(F.col("symbol").alias("_s"), "exchange", F.col("is_vn30").alias("_m"))
    c = cal.select(F.col("date").alias("_d"), "day_of_week", "month", "quarter", "year", "is_trading_day")
    return (fact.join(d, F.col("symbol") == F.col("_s"), "left")
                .join(F.broadcast(c), F.col(date) == F.col("_d"), "left")
                .withColumn("is_vn30", F.coalesce(F.col("_m"), F.lit(False)))
                .drop("_s", "_m", "_d"))


def measure_trend_sliced(starred: DataFrame, by=("year", "quarter", "is_vn30")) -> DataFrame:
    """M4 + M5 under M6 slicers taken from the star (by default per
    calendar quarter and constituent flag)."""
    return starred.groupBy(*by).agg(*_breadth_cols(), F.count(F.lit(1)).cast("bigint").alias("bars"))


def measure_percent_change(prices: DataFrame, cal: DataFrame) -> DataFrame:
    """M1 per symbol: (close on the latest trading day - close on the
    previous trading day) / previous close; blank (no row) when the previous
    close is missing or zero."""
    dates = _latest_trading_dates(prices, cal)
    latest, prev = dates.select("latest_date").scalar(), dates.select("prev_date").scalar()
    two = from_date(prices, prev).filter((F.col("trade_date") == latest) | (F.col("trade_date") == prev))
    g = two.groupBy("symbol").agg(
        F.sum(F.when(F.col("trade_date") == latest, F.col("close_price"))).alias("close_latest"),
        F.sum(F.when(F.col("trade_date") == prev, F.col("close_price"))).alias("close_prev")).withColumn("latest_date", latest)
    pct = F.when(F.col("close_prev") != 0,
                 (F.coalesce(F.col("close_latest"), F.lit(0.0)) - F.col("close_prev")) / F.col("close_prev"))
    return (g.withColumn("percent_change", pct).filter(F.col("percent_change").isNotNull())
            .select("symbol", F.col("latest_date").alias("trade_date"), "percent_change"))


def _breadth_cols() -> list[Column]:
    c, o = F.col("close_price"), F.col("open_price")
    return [F.count_if(c > o).cast("bigint").alias("gainers"),
            F.count_if(c < o).cast("bigint").alias("losers"),
            F.count_if(c == o).cast("bigint").alias("unchanged"),
            F.sum("volume").cast("bigint").alias("total_volume")]


def measure_latest_breadth(prices: DataFrame, cal: DataFrame) -> DataFrame:
    """M2 + M3: on the latest trading day, rows closing above / below / at
    the open, and total volume."""
    latest = _latest_trading_dates(prices, cal).select("latest_date").scalar()
    day = from_date(prices, latest).filter(F.col("trade_date") == latest)
    return day.groupBy("trade_date").agg(*_breadth_cols())


def measure_trend(prices: DataFrame) -> DataFrame:
    """M4 + M5 per date: close against open counts and volume."""
    return prices.groupBy("trade_date").agg(*_breadth_cols())


# --- payload (IO11) -----------------------------------------------------------

def _field(name: str):
    return lambda r: r[name]


def _sorted_values(key: str, value: str) -> Column:
    """Values of ``value`` ordered by ``key`` (sort of (key, value) pairs)."""
    return F.transform(F.sort_array(F.collect_list(F.struct(key, value))), _field(value))


def _iso_dates(c: str) -> Column:
    return F.transform(F.sort_array(F.collect_list(c)), lambda d: F.date_format(d, "yyyy-MM-dd"))


def series_by_symbol(df: DataFrame, cols) -> DataFrame:
    """Per symbol, parallel arrays ordered by date (dates as
    yyyy-MM-dd). One group is one symbol's extract (bounded by the look-back)."""
    cols = list(cols)
    g = df.groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct("trade_date", *cols))).alias("_rows"),
        F.first("is_vn30").alias("is_vn30") if "is_vn30" in df.columns else F.lit(False).alias("is_vn30"))
    arrays = [F.transform("_rows", lambda r: F.date_format(r["trade_date"], "yyyy-MM-dd")).alias("trade_date")]
    arrays += [F.transform("_rows", _field(c)).alias(c) for c in cols]
    return g.select("symbol", *arrays, "is_vn30")


def dashboard_payload(summary: DataFrame, extract: DataFrame, ind_extract: DataFrame,
                      n_top: int = C.TOP_MOVERS) -> DataFrame:
    """IO11 as JSON lines: (section, key, json) rows, so no single row or
    task carries the whole document. One row each for the latest market
    row, the market history and the constituent history (arrays bounded by
    the look-back) and the top movers (bounded by ``n_top``); one row per
    symbol for the movers of the latest date, the symbol list and the
    indicator series. Anything that grows with the listing is split by
    symbol."""
    def one(section: str, frame: DataFrame, key: Column | None = None) -> DataFrame:
        body = F.to_json(F.struct(*[F.col(c) for c in frame.columns]))
        return frame.select(F.lit(section).alias("section"),
                            (key if key is not None else F.lit(section)).alias("key"), body.alias("json"))

    lm = latest_market(summary).withColumn("trade_date", F.date_format("trade_date", "yyyy-MM-dd"))
    hist = market_history(summary)
    hist_arr = hist.agg(_iso_dates("trade_date").alias("trade_date"),
                        *[_sorted_values("trade_date", c).alias(c)
                          for c in ("vnindex_close", "vn30_close", "total_volume", "gainers", "losers",
                                    "unchanged")])
    vb = member_breadth(extract)
    vb_arr = vb.agg(_iso_dates("trade_date").alias("trade_date"),
                    *[_sorted_values("trade_date", c).alias(c)
                      for c in ("total_volume", "gainers", "losers", "unchanged")])
    mv = movers(extract, summary)
    item = ("symbol", "close_price", "prev_close", "pct_change", "is_vn30", "volume")
    top = top_n(mv, "rank_change", n_top).select(
        F.struct(F.col("rank_change").alias("_k"), F.col("symbol").alias("_s"),
                 F.struct(*item).alias("item")).alias("r"))
    # Ten rows at most: order them inside one array (change descending, nulls
    # last, then symbol).
    top_arr = top.agg(F.transform(
        F.array_sort(F.collect_list("r"), lambda a, b: F.when(a["_k"].isNull() & b["_k"].isNull(), F.lit(0))
                     .when(a["_k"].isNull(), F.lit(1)).when(b["_k"].isNull(), F.lit(-1))
                     .when(a["_k"] > b["_k"], F.lit(-1)).when(a["_k"] < b["_k"], F.lit(1))
                     .when(a["_s"] < b["_s"], F.lit(-1)).when(a["_s"] > b["_s"], F.lit(1))
                     .otherwise(F.lit(0))),
        lambda r: r["item"]).alias("items"))
    syms = ind_extract.groupBy("symbol").agg(F.max("is_vn30").alias("is_vn30"))
    per_symbol = series_by_symbol(ind_extract, ["close_price", "ma50", "ma200", "bb_upper", "bb_lower", "rsi_14",
                                                "macd_line", "macd_signal", "macd_histogram"])
    return (one("latest_market", lm)
            .unionByName(one("market_history", hist_arr))
            .unionByName(one("vn30_history", vb_arr))
            .unionByName(one("top_movers", top_arr))
            .unionByName(one("movers", mv.select(*item), F.col("symbol")))
            .unionByName(one("symbols", syms, F.col("symbol")))
            .unionByName(one("indicators_by_symbol", per_symbol, F.col("symbol"))))


def payload_rows(payload: DataFrame) -> DataFrame:
    """The payload's JSON read back as typed rows: section, key, field,
    position in its array (-1 outside arrays), number and text. Dates and symbols are
    texts; a null in an array keeps its position."""
    def flat(sections: list[str], kind: str, fields) -> DataFrame:
        return payload.filter(F.col("section").isin(sections)).select("section", "key", F.from_json("json", kind).alias("j")).select("section", "key", *fields)

    arrays = flat(["market_history", "vn30_history"], "map<string, array<string>>", [F.explode("j").alias("field", "v")])
    arrays = arrays.select("section", "key", "field", F.posexplode("v").alias("pos", "text"))
    series = payload.filter("section = 'indicators_by_symbol'").select(
        "section", "key", F.from_json("json", "trade_date array<string>, close_price array<string>, ma50 array<string>, ma200 array<string>, "
                                      "bb_upper array<string>, bb_lower array<string>, rsi_14 array<string>, macd_line array<string>, "
                                      "macd_signal array<string>, macd_histogram array<string>").alias("j"))
    names = ("trade_date", "close_price", "ma50", "ma200", "bb_upper", "bb_lower", "rsi_14", "macd_line", "macd_signal", "macd_histogram")
    series = series.select("section", "key", F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(f"j.{n}") for n in names]))).alias("field", "v"))
    series = series.select("section", "key", "field", F.posexplode("v").alias("pos", "text"))
    items = flat(["top_movers"], "items array<map<string, string>>", [F.posexplode("j.items").alias("pos", "item")])
    items = items.select("section", "key", "pos", F.explode("item").alias("field", "text")).select("section", "key", "field", "pos", "text")
    single = flat(["latest_market", "movers", "symbols"], "map<string, string>", [F.explode("j").alias("field", "text")])
    single = single.select("section", "key", "field", F.lit(-1).alias("pos"), "text")
    rows = arrays.unionByName(series).unionByName(items).unionByName(single)
    number = F.col("text").try_cast("double")
    return rows.select("section", "key", "field", F.col("pos").cast("bigint").alias("pos"), F.round(number, 6).alias("number"),
                       F.when(number.isNull(), F.col("text")).alias("text"))
