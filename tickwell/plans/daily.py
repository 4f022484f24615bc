"""The daily run in proportion to the day.

The day's bars are upserted into bronze, and only what they touch is computed: bars later than their symbol's last stored
one from the symbol's state (``operators/state.py``), symbols with a corrected older bar from all their bars. New rows are
added to the daily tables as folders of their own; a correction rewrites the years from the corrected day on, in which the
other symbols' rows only pass an anti join. Summary rows are computed again from the batch's first day on. One publication
then names the old and new folders, as after a rebuild.

Gates run on the years that change (uniqueness) and on the new rows (expressions); the rest is as proven by the run that
wrote it. The run is a full rebuild instead where there is no state, where bronze holds an upsert that the published tables
have not seen (a run ended between the two), or where the index changed on a day that prices were already computed for,
since the gap rule of every symbol reads it.

Each run adds a folder a year with at most one file for each bucket; a full rebuild, as once a week, puts them together.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, quality, silver
from ..operators import state as ST
from ..operators.indicators import projections
from ..sources import bronze as B
from ..sources import published as P
from . import store as S
from . import warehouse as W


def _index_changed_from(index: DataFrame, stored: DataFrame) -> DataFrame:
    """The first day whose index rows differ from the stored ones; the tables have a few rows a day."""
    cols = [c for c in stored.columns if c not in ("loaded_at", "ingested_at")]
    fresh, old = silver.silver_index(index).select(*cols), stored.select(*cols)
    return fresh.exceptAll(old).unionByName(old.exceptAll(fresh)).agg(F.min("trade_date").alias("day"))


def run_daily(spark: SparkSession, batch: DataFrame, index: DataFrame, components: DataFrame, bronze_path: str, root: str,
              members_only: bool = False, extracts: bool = False) -> W.BuildReport:
    """Upserts the day's bars (with ``members_only`` the constituents' alone) and brings the warehouse to that state."""
    store, report = S.Store(spark, root), W.new_report(spark, root)
    if members_only:
        batch = batch.join(components.select("code").distinct(), "code", "left_semi")
    seen = P.latest(spark, bronze_path)[0]
    in_step = "symbol_state" in store.tables and store.info.get("bronze") == seen
    if in_step:  # else only the upsert reads the batch, once
        batch.write.parquet(f"{report.build}/batch")
        batch = spark.read.schema(batch.schema).parquet(f"{report.build}/batch")
    B.upsert_into(spark, batch, bronze_path, f"{root}/_staging")
    info = {"bronze": P.latest(spark, bronze_path)[0]}
    prices = B.read_stored(spark, bronze_path)

    def rebuilt() -> W.BuildReport:
        B.delete_path(spark, report.build)
        return W.build_warehouse(spark, prices, index, components, root, extracts, state=True, info=info)

    if not in_step:
        return rebuilt()
    state = store.table("symbol_state")
    first_index = _index_changed_from(index, store.table("silver_index")).first()["day"]
    bars = B.dedup_last(batch, ["code", "date"], B.batch_order(batch.columns))
    ages = bars.groupBy(F.col("code").alias("symbol")).agg(F.min("date").alias("first")).join(state.select("symbol", "raw_date"), "symbol", "left")
    days = ages.agg(F.min("first").alias("first"), F.min(F.when(F.col("first") <= F.col("raw_date"), F.col("first"))).alias("corrected")).first()
    last = state.agg(F.max("raw_date").alias("day")).first()["day"]
    if first_index is not None and last is not None and first_index <= last:
        return rebuilt()
    if days["first"] is None and first_index is None:
        return _unchanged(spark, store, report, info)

    # symbols whose stored rows change: computed from all their bars
    redone = W.write_entry(report, "redone", ages.filter(F.col("first") <= F.col("raw_date")).select("symbol"))
    since_year = days["corrected"].year if days["corrected"] else None
    columns = [c for c in prices.columns if c not in B.YEAR_MONTH]
    wanted = prices.select(*columns).join(redone, F.col("code") == F.col("symbol"), "left_semi")
    if since_year is not None:
        again = W.write_entry(report, "again_silver", silver.silver_prices(wanted, index))
        again_wide = W.write_entry(report, "again_wide", ST.wide_fact(gold.fact_stock_price(again)))

    # the others: from their states, whose stored rows only the windows read
    kinds = prices.schema
    of = lambda how: bars.join(redone, F.col("code") == F.col("symbol"), how).select(
        *[(F.col(c) if c in bars.columns else F.lit(None)).cast(kinds[c].dataType).alias(c) for c in columns])
    ahead = of("left_anti")
    new = W.write_entry(report, "new_silver", ST.new_silver(ahead, state, index))
    new_wide = W.write_entry(report, "new_wide", ST.new_wide(new, state))
    if since_year is None:
        again, again_wide = new.filter("false"), new_wide.filter("false")

    # the price fact's columns are the wide frame's too; a table takes its own of them
    fresh = {"silver_prices": (new, again), "fact_stock_price": (new_wide, again_wide)}
    fresh |= {n: (a, projections(again_wide)[n]) for n, a in projections(new_wide).items()}
    with S.bucketed_scans(spark), ThreadPoolExecutor(W.WRITERS) as pool:  # the tables don't wait for each other
        list(pool.map(lambda x: _change(report, store, x[0], *x[1], redone, since_year), fresh.items()))
    after = {n: S.open_daily(spark, report.entries[n]) for n in fresh}

    si = W.write_entry(report, "silver_index", silver.silver_index(index))
    day = min(d for d in (days["first"], first_index) if d is not None)
    year = F.col("year") >= day.year
    recent = gold.fact_market_summary(after["fact_stock_price"].filter(year & (F.col("trade_date") >= F.lit(day))), si)
    summary = W.write_entry(report, "fact_market_summary", store.table("fact_market_summary").filter(F.col("trade_date") < F.lit(day)).unionByName(recent))
    known = store.table("dim_stock").join(redone, "symbol", "left_anti").select("symbol", F.col("exchange").alias("source"), F.lit(True).alias("is_valid"))
    sources = reduce(lambda a, b: a.unionByName(b), [known, *[x.select("symbol", "source", "is_valid") for x in (new, again)]])
    dim = W.write_entry(report, "dim_stock", gold.dim_stock(sources, components))

    states = ST.next_state(state.join(redone, "symbol", "left_anti"), ahead, new_wide)
    if since_year is not None:
        states = states.unionByName(ST.symbol_state(again_wide, ST.last_after(of("left_semi"), state)))
    W.write_entry(report, "symbol_state", states)

    changed = sorted({y for y, load, _ in report.entries["silver_prices"]["parts"] if load == report.load})
    report.gates["silver"] = quality.enforce(quality.silver_gates(after["silver_prices"].filter(F.col("year").isin(changed)), si))
    report.gates["gold"] = quality.enforce(quality.gold_gates(projections(new_wide.unionByName(again_wide))["fact_stock_indicators"], summary, dim))
    if extracts:
        W.build_extracts(spark, prices, after["fact_stock_price"], after["fact_stock_indicators"], summary, dim, report)
    for name in ("redone", "again_silver", "again_wide", "new_silver", "new_wide"):
        if report.entries.pop(name, None):
            B.delete_path(spark, report.tables.pop(name))
    B.delete_path(spark, f"{report.build}/batch")
    return W.finish(spark, report, store, info, keep=store.tables)


def _unchanged(spark: SparkSession, store: S.Store, report: W.BuildReport, info: dict) -> W.BuildReport:
    B.delete_path(spark, report.build)
    store.publish(store.tables, {**store.info, **info})
    return report


def _change(report: W.BuildReport, store: S.Store, name: str, added: DataFrame, replaced: DataFrame, redone: DataFrame, since_year: int | None) -> None:
    """Adds rows to a daily table; with ``since_year`` the symbols of ``redone`` get theirs of ``replaced`` from that year on.
    The others' stored rows stay in their buckets: only added and replaced rows are dealt."""
    old = store.tables[name]
    columns = [c.strip("`") for c in _names(old["columns"])]
    rows, parts = added.select(*columns), old["parts"]
    if since_year is not None:
        theirs = replaced.filter(F.year("trade_date") >= since_year).select(*columns)
        stored = S.open_daily(added.sparkSession, old).filter(F.col("year") >= since_year).select(*columns, "year")
        rows = _beside(stored, redone, rows.unionByName(theirs), old["buckets"])
        parts = [p for p in parts if p[0] < since_year]
    path = f"{report.build}/{name}"
    entry = S.write_daily(rows, path, report.load, old["buckets"])
    report.tables[name] = path
    report.entries[name] = {**old, "parts": parts + entry["parts"]}


def _beside(stored: DataFrame, redone: DataFrame, fresh: DataFrame, buckets: int) -> DataFrame:
    """Stored rows but those of ``redone``, where they lie, and ``fresh`` rows dealt into the same buckets. Both have their year
    before they meet: a column put on after the union hides from the planner that it is hash-partitioned."""
    return stored.join(redone, S.KEY, "left_anti").unionByName(B.with_grain(fresh, date=S.DATE).repartition(buckets, S.KEY))


def _names(columns: str) -> list[str]:
    return [c.split(" ")[0] for c in columns.split(", ")]
