"""Q5: the layered rebuild writes every table and stops at the first
failing layer."""

import json
import os

import pytest

from tickwell.operators.quality import QualityError
from pyspark.sql import functions as F

from tickwell.operators import dashboard as D
from tickwell.operators import gold, silver
from tickwell.operators import quality
from tickwell.operators.indicators import Indicators
from tickwell.plans import store as S
from tickwell.plans import warehouse as W
from tickwell.plans.store import Store
from tickwell.plans.warehouse import build_warehouse, open_table, run_pipeline
from tickwell.sources import bronze as B
from tickwell.sources import fixtures

from conftest import SF_SMOKE

GOLD = ("fact_stock_price", "int_ema12", "int_ema26", "int_rsi14", "int_macd_line", "int_macd_signal",
        "fact_stock_indicators", "fact_market_summary", "dim_stock")


def test_full_rebuild(spark, scratch):
    b = fixtures.load(spark, SF_SMOKE)
    rep = build_warehouse(spark, b.prices, b.index, b.components, f"{scratch}/wh")
    for name in ("silver_prices", "silver_index", *GOLD, "dim_date_csv", "dashboard_payload"):
        assert os.path.isdir(rep.tables[name]), name
    assert all(g["failures"] == 0 for layer in ("silver", "gold") for g in rep.gates[layer])
    ind = spark.read.parquet(rep.tables["fact_stock_indicators"])
    assert ind.count() == spark.read.parquet(rep.tables["fact_stock_price"]).count()
    sections = {r["section"] for r in spark.read.json(rep.tables["dashboard_payload"]).collect()}
    assert {"latest_market", "market_history", "top_movers", "indicators_by_symbol"} <= sections
    first = spark.read.json(rep.tables["dashboard_payload"]).filter("section = 'market_history'").first()
    assert json.loads(first["json"])["trade_date"]
    cal = spark.read.option("header", True).csv(rep.tables["dim_date_csv"])
    assert set(cal.columns) == {"date", "day", "day_of_week", "month", "quarter", "year", "is_trading_day"}


def test_failing_silver_gate_keeps_the_last_good_layer(spark, scratch):
    b = fixtures.load(spark, SF_SMOKE)
    dup = b.prices.unionByName(b.prices.limit(1))
    with pytest.raises(QualityError) as e:
        build_warehouse(spark, dup, b.index, b.components, f"{scratch}/wh")
    assert e.value.failures == {"silver_prices.unique_combination(symbol, trade_date)": 1}
    assert Store(spark, f"{scratch}/wh").tables == {}
    build_warehouse(spark, b.prices, b.index, b.components, f"{scratch}/wh", extracts=False)
    good = open_table(spark, f"{scratch}/wh", "silver_prices").count()
    with pytest.raises(QualityError):
        build_warehouse(spark, dup, b.index, b.components, f"{scratch}/wh", extracts=False)
    assert open_table(spark, f"{scratch}/wh", "silver_prices").count() == good > 0


def test_null_keys_are_stopped_before_any_window(spark, scratch):
    b = fixtures.load(spark, SF_SMOKE)
    bad = b.prices.withColumn("code", F.when(F.col("volume") % 7 != 0, F.col("code")))
    with pytest.raises(QualityError) as e:
        build_warehouse(spark, bad, b.index, b.components, f"{scratch}/wh")
    assert list(e.value.failures) == ["bronze_prices.not_null(code)"]
    assert Store(spark, f"{scratch}/wh").tables == {}


def test_members_only_run_and_pruned_extract(spark, scratch):
    b = fixtures.load(spark, SF_SMOKE)
    rep = run_pipeline(spark, b.prices, b.index, b.components, f"{scratch}/bronze", f"{scratch}/wh", members_only=True, extracts=False)
    members = {r["code"] for r in b.components.collect()}
    fact = spark.read.parquet(rep.tables["fact_stock_price"])
    assert {r["symbol"] for r in fact.select("symbol").distinct().collect()} == members
    full = run_pipeline(spark, b.prices, b.index, b.components, f"{scratch}/bronze", f"{scratch}/wh", extracts=False)
    assert spark.read.parquet(full.tables["fact_stock_price"]).count() == b_fact_rows(spark, b)
    plan = D.since_max(fact, 200)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def b_fact_rows(spark, b):
    return gold.fact_stock_price(silver.silver_prices(b.prices, b.index)).count()


@pytest.fixture()
def small(spark):
    """Few partitions, so few buckets and files."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


STOPS = [("write_entry", n) for n in (1, 3, 6)] + [("quality.enforce", 3), ("build_extracts", 1), ("published.publish", 1)]


def test_a_run_that_stops_anywhere_leaves_all_layers_of_one_run(spark, scratch, monkeypatch, small):
    """Two feeds with different closes: layers of both would not fit together."""
    b = fixtures.load(spark, SF_SMOKE)
    root, names = f"{scratch}/wh", ("silver_prices", "fact_stock_price", "fact_stock_indicators", "int_ema12")
    few = b.prices.filter("code in ('S1', 'S2', 'S3')").persist()
    build_warehouse(spark, few, b.index, b.components, root)
    total = lambda name: open_table(spark, root, name).agg(F.sum("close_price" if "ema" not in name else "ema_12")).first()[0]
    first = {n: total(n) for n in names}
    other = few.withColumn("close", (F.col("close") + 1).cast("decimal(18,4)"))
    for step, call in STOPS:
        module, name = {"quality.enforce": (quality, "enforce"), "published.publish": (S.P, "publish")}.get(step, (W, step))
        real, calls = getattr(module, name), []

        def stops(*a, **k):
            calls.append(1)
            if len(calls) == call:
                raise RuntimeError("stopped")
            return real(*a, **k)

        with monkeypatch.context() as m:
            m.setattr(module, name, stops)
            with pytest.raises(RuntimeError, match="stopped"):
                build_warehouse(spark, other, b.index, b.components, root)
        assert {n: total(n) for n in names} == first, step
    rep = build_warehouse(spark, other, b.index, b.components, root, extracts=False)
    second = {n: total(n) for n in names}
    assert all(second[n] > first[n] for n in names)
    assert Store(spark, root).info["build"] == rep.load
    few.unpersist()


def test_of_two_builds_the_second_to_finish_is_refused(spark, scratch, small):
    b = fixtures.load(spark, SF_SMOKE)
    few = b.prices.filter("code = 'S1'")
    early = Store(spark, f"{scratch}/wh")
    build_warehouse(spark, few, b.index, b.components, f"{scratch}/wh", extracts=False)
    with pytest.raises(S.P.Conflict):
        early.publish({}, {})
    assert open_table(spark, f"{scratch}/wh", "dim_stock").count() == 1


def test_stored_layout_needs_no_exchange_and_few_files(spark, scratch):
    b = fixtures.load(spark, SF_SMOKE)
    rep = build_warehouse(spark, b.prices, b.index, b.components, f"{scratch}/wh", extracts=False)
    fact = open_table(spark, f"{scratch}/wh", "fact_stock_price")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(Indicators(fact).fact()) and "Bucketed: true" in plan(Indicators(fact).fact())
    silver_ = open_table(spark, f"{scratch}/wh", "silver_prices")
    assert plan(quality.unique(silver_, ["symbol", "trade_date"], "silver", "x").frame).count("Exchange") == 1  # of one row a task
    assert "Exchange" not in plan(gold.fact_stock_price(silver_))
    both = silver_.select("symbol", "trade_date").join(fact.select("symbol", "trade_date", "row_num"), ["symbol", "trade_date"])
    assert "Exchange" not in plan(both.hint("merge"))
    for name in W.DAILY:
        if name in rep.tables:
            for year in os.listdir(rep.tables[name]):
                if year.startswith("year="):
                    assert len([f for f in os.listdir(f"{rep.tables[name]}/{year}") if f.endswith(".parquet")]) <= rep.buckets


def test_old_builds_go_but_for_the_one_before(spark, scratch, small):
    b = fixtures.load(spark, SF_SMOKE)
    few, root = b.prices.filter("code = 'S1'"), f"{scratch}/wh"
    for _ in range(4):
        build_warehouse(spark, few, b.index, b.components, root, extracts=False)
    full = [d for d in os.listdir(f"{root}/_builds") if any(f.endswith(".parquet") for _, _, fs in os.walk(f"{root}/_builds/{d}") for f in fs)]
    assert len(full) == 2


def rows_read(df):
    """Rows that the scan of a plain filter gave, after partitions, buckets, row groups and pages were passed over."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_one_symbol_is_read_without_the_others(spark, scratch, monkeypatch):
    monkeypatch.setattr(B, "PAGE_ROWS", 20)
    days, symbols = 60, 400
    bars = spark.range(days * symbols).select(
        F.concat(F.lit("S"), (F.col("id") % symbols).cast("string")).alias("code"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / symbols).cast("int")).alias("date"),
        *[F.lit(10 + i).cast("decimal(18,4)").alias(c) for i, c in enumerate(("open", "high", "low", "close"))], F.col("id").alias("volume"), F.lit("feed").alias("source"))
    B.write_partitioned(bars, f"{scratch}/plain/bronze_prices")
    B.upsert_into(spark, bars.filter("volume % 2 = 0"), f"{scratch}/bronze_prices", f"{scratch}/stage")
    B.upsert_into(spark, bars.filter("volume % 2 = 1"), f"{scratch}/bronze_prices", f"{scratch}/stage")
    for root in (f"{scratch}/plain", scratch):
        one = B.select_range(B.read_bronze(spark, root, "bronze_prices"), ["S77"])
        assert one.count() == days and rows_read(one) < 0.02 * days * symbols
    fact = bars.select(F.col("code").alias("symbol"), F.col("date").alias("trade_date"), F.col("close").cast("double").alias("close_price"))
    entry = S.write_daily(fact, f"{scratch}/fact", "first", 4)
    one = D.slice_prices(S.open_daily(spark, entry), symbol="S77")
    assert one.count() == days and rows_read(one) < 0.02 * days * symbols


def test_latest_dates_read_the_last_years_alone(spark, scratch, monkeypatch):
    rows = [("S1", f"{y}-0{m}-03", float(m)) for y in (2021, 2022, 2023, 2024) for m in (1, 2, 3)]
    fact = spark.createDataFrame(rows, "symbol string, d string, close_price double").select("symbol", F.col("d").cast("date").alias("trade_date"), "close_price")
    entry = S.write_daily(fact, f"{scratch}/fact", "first", 2)
    # a last year whose rows have all become invalid: its folder holds none
    S.write_daily(fact.filter("false"), f"{scratch}/none", "second", 2)
    entry["parts"].append([2025, "second", f"{scratch}/none"])
    read, real = [], S.open_daily
    monkeypatch.setattr(S, "open_daily", lambda s, e: read.append({p[0] for p in e["parts"]}) or real(s, e))
    assert [str(x) for x in S.latest_dates(spark, entry)] == ["2024-03-03"]
    assert read == [{2025}, {2024}]
    read.clear()
    assert [str(x) for x in S.latest_dates(spark, entry, 4)] == ["2024-03-03", "2024-02-03", "2024-01-03", "2023-03-03"]
    assert read == [{2025}, {2024}, {2023}]
    assert S.latest_dates(spark, {**entry, "parts": []}) == []
