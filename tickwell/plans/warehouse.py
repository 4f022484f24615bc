"""Q5: the full rebuild, layer by layer, stopped by the first failing gate.

bronze key gates -> silver tables -> silver gates -> price fact, indicators,
market summary, stock dimension -> gold gates -> calendar CSV and dashboard
payload (JSON lines).

A run writes into a folder of its own under ``<root>/_builds``. When all
gates have passed and all is written, one publication names its tables, so
readers (``open_table``) see all layers of one run: a failing gate, or a run
that stops anywhere, leaves the last good state. Every table is written once
and the next step reads it back, so a lost executor costs at most the stage
it was running. The daily tables lie by year and in buckets by symbol
(``store.py``): from the bronze scan to the indicators rows are dealt by
symbol once, and gates over them add no exchange. Each layer's gates run
once.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import calendar as K
from ..operators import dashboard as D
from ..operators import gold, quality, silver
from ..operators.indicators import Indicators
from ..operators.state import last_bars, symbol_state
from ..sources import bronze as B
from . import store as S


@dataclass
class BuildReport:
    root: str
    build: str
    buckets: int
    tables: dict[str, str] = field(default_factory=dict)
    gates: dict[str, list] = field(default_factory=dict)
    entries: dict[str, dict] = field(default_factory=dict)

    @property
    def load(self) -> str:
        return self.build.rsplit("/", 1)[-1]


INTERMEDIATE = ("int_ema12", "int_ema26", "int_rsi14", "int_macd_line", "int_macd_signal")
#: Tables that are written at the same time.
WRITERS = 4
DAILY = ("silver_prices", "fact_stock_price", "fact_stock_indicators", "wide", *INTERMEDIATE)


def new_report(spark: SparkSession, root: str) -> BuildReport:
    return BuildReport(root, f"{root}/_builds/{uuid.uuid4().hex}", S.bucket_count(spark))


def write_entry(report: BuildReport, name: str, df: DataFrame) -> DataFrame:
    """Writes a table of the running build and reads it back."""
    path = f"{report.build}/{name}"
    if name in DAILY:
        report.entries[name] = S.write_daily(df, path, report.load, report.buckets)
    else:
        B.write_table(df, path)
        report.entries[name] = {"path": path}
    report.tables[name] = path
    return S.open_entry(df.sparkSession, report.entries[name])


def build_silver(spark: SparkSession, prices: DataFrame, index: DataFrame, report: BuildReport):
    report.gates["bronze"] = quality.enforce(quality.bronze_gates(prices, index))
    # dealt once, into the buckets: the windows of silver and all later steps keep that
    dealt = prices.repartition(report.buckets, "code")
    sp = write_entry(report, "silver_prices", silver.silver_prices(dealt, index))
    si = write_entry(report, "silver_index", silver.silver_index(index))
    report.gates["silver"] = quality.enforce(quality.silver_gates(sp, si))
    return sp, si


def build_gold(spark: SparkSession, sp: DataFrame, si: DataFrame, components: DataFrame, report: BuildReport):
    with S.bucketed_scans(spark):
        fact = write_entry(report, "fact_stock_price", gold.fact_stock_price(sp))
        # The wide frame is stored once; the six indicator tables are projections of it, which don't wait for each other.
        ind = Indicators(fact, materialize=lambda wide: write_entry(report, "wide", wide))
        frames = {**ind.tables, "fact_market_summary": gold.fact_market_summary(fact, si), "dim_stock": gold.dim_stock(sp, components)}
        with ThreadPoolExecutor(WRITERS) as pool:
            done = dict(zip(frames, pool.map(lambda x: write_entry(report, *x), frames.items()), strict=True))
    indicators, summary, dim = (done[n] for n in ("fact_stock_indicators", "fact_market_summary", "dim_stock"))
    report.gates["gold"] = quality.enforce(quality.gold_gates(indicators, summary, dim))
    return fact, indicators, summary, dim


def build_extracts(spark: SparkSession, prices: DataFrame, fact: DataFrame, indicators: DataFrame,
                   summary: DataFrame, dim: DataFrame, report: BuildReport) -> None:
    cal = K.data_years_calendar(prices, "date")
    outputs = {n: f"{report.build}/{n}" for n in ("dim_date_csv", "dashboard_payload")}
    B.write_csv(cal.orderBy("date"), outputs["dim_date_csv"])
    dates = S.latest_dates(spark, report.entries["fact_stock_price"], C.LATEST_DATES)  # the last year has them
    latest = F.lit(dates[0]) if dates else None
    extract = write_entry(report, "extract", D.with_pct_change(D.price_extract(fact, dim, dates=dates)))
    series = write_entry(report, "indicator_extract", D.indicator_extract(indicators, dim, latest=latest))
    payload = D.dashboard_payload(summary, extract, series)
    B.write_ordered(payload, outputs["dashboard_payload"], ["section", "key"])
    for name, path in outputs.items():
        report.tables[name], report.entries[name] = path, {"path": path}


TEMPORARY = ("wide", "extract", "indicator_extract")


def finish(spark: SparkSession, report: BuildReport, store: S.Store, info: dict | None = None, keep: dict | None = None) -> BuildReport:
    """Publishes the build's tables (and those of ``keep`` that it didn't
    write) and drops its temporary ones."""
    for name in TEMPORARY:
        if report.entries.pop(name, None):
            B.delete_path(spark, report.tables.pop(name))
    store.publish({**(keep or {}), **report.entries}, {"build": report.load, **(info or {})})
    return report


def build_warehouse(spark: SparkSession, prices: DataFrame, index: DataFrame, components: DataFrame,
                    root: str, extracts: bool = True, state: bool = False, info: dict | None = None) -> BuildReport:
    """Run the whole rebuild; raises ``QualityError`` at the first failing
    layer (silver gates stop the gold build), and ``published.Conflict``
    where another run has published since this one started. With ``state``
    the rows from which the daily run goes on are stored too; ``info`` is
    kept with the publication."""
    store, report = S.Store(spark, root), new_report(spark, root)
    sp, si = build_silver(spark, prices, index, report)
    fact, indicators, summary, dim = build_gold(spark, sp, si, components, report)
    if state:
        wide = S.open_entry(spark, report.entries["wide"])
        write_entry(report, "symbol_state", symbol_state(wide, last_bars(prices)))
    if extracts:
        build_extracts(spark, prices, fact, indicators, summary, dim, report)
    return finish(spark, report, store, info)


def open_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table of the warehouse as last published."""
    return S.Store(spark, root).table(name)


def run_pipeline(spark: SparkSession, batch: DataFrame, index: DataFrame, components: DataFrame, bronze_path: str,
                 root: str, members_only: bool = False, extracts: bool = True) -> BuildReport:
    """The daily run: upsert the day's bars into the stored bronze prices
    (with ``members_only`` the constituents' bars alone), then rebuild from
    what is stored."""
    if members_only:
        batch = batch.join(components.select("code").distinct(), "code", "left_semi")
    B.upsert_into(spark, batch, bronze_path, f"{root}/_staging")
    return build_warehouse(spark, B.read_stored(spark, bronze_path), index, components, root, extracts)
