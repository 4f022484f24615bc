"""The daily run: equal to a full rebuild after every kind of day, in proportion to the day."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickwell.plans import daily
from tickwell.plans import store as S
from tickwell.plans import warehouse as W
from tickwell.plans.store import Store
from tickwell.sources import bronze as B
from tickwell.sources import fixtures

from conftest import SF_SMOKE

TABLES = ("silver_prices", "silver_index", "fact_stock_price", "fact_stock_indicators", "fact_market_summary", "dim_stock",
          "int_ema12", "int_ema26", "int_rsi14", "int_macd_line", "int_macd_signal")


@pytest.fixture()
def small(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows(spark, root, name):
    df = W.open_table(spark, root, name)
    cols = [c for c in sorted(df.columns) if c not in ("loaded_at", "silver_loaded_at", "gold_loaded_at", "year")]
    near = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.select(*cols).dtypes]
    return sorted(map(tuple, df.select(*near).collect()), key=str)


def test_days_equal_the_full_rebuild(spark, scratch, small):
    b = fixtures.load(spark, SF_SMOKE)
    prices = b.prices.persist()
    index = b.index.persist()
    cut = prices.agg(F.percentile(F.unix_date("date"), 0.9).alias("d")).first()["d"]
    cut = dt.date(1970, 1, 1) + dt.timedelta(days=int(cut))
    listed_late = F.col("code") == "S3"
    late = prices.filter(listed_late & (F.col("date") >= F.lit(cut)))
    base = prices.filter(~listed_late & (F.col("date") < F.lit(cut)))
    before = lambda df, day: df.filter(F.col("date") < F.lit(day))
    bronze, root = f"{scratch}/bronze", f"{scratch}/wh"
    daily.run_daily(spark, base, before(index, cut), b.components, bronze, root)
    first = Store(spark, root)
    assert {"symbol_state", *TABLES} <= set(first.tables)
    fact_folders = {p[2] for p in first.tables["fact_stock_price"]["parts"]}

    one, two, far = cut + dt.timedelta(days=25), cut + dt.timedelta(days=60), dt.date(2100, 1, 1)
    up = lambda df, by: df.withColumn("close", (F.col("close") + by).cast("decimal(18,4)"))
    span = lambda lo, hi: F.col("date").between(F.lit(lo), F.lit(hi - dt.timedelta(days=1)))
    days = [
        ("days alone", prices.filter(~listed_late & span(cut, one)), one),
        ("corrected old bars and a symbol listed since", up(base.filter("code = 'S5' and volume % 3 = 0"), 1).unionByName(late.filter(F.col("date") < F.lit(two)))
         .unionByName(prices.filter(~listed_late & span(one, two))), two),
        ("the rest, with a symbol's last bar again", prices.filter((F.col("date") >= F.lit(two))).unionByName(up(prices.filter((F.col("code") == "S7") & span(one, two)), 2)), far),
    ]
    for what, batch, upto in days:
        rep = daily.run_daily(spark, batch, before(index, upto), b.components, bronze, root)
        W.build_warehouse(spark, B.read_stored(spark, bronze), before(index, upto), b.components, f"{scratch}/full", extracts=False)
        for name in TABLES:
            assert rows(spark, root, name) == rows(spark, f"{scratch}/full", name), (what, name)
        assert any(load == rep.load for _, load, _ in Store(spark, root).tables["fact_stock_price"]["parts"])
        if what == "days alone":  # no stored folder is replaced, and what is added holds the new rows alone
            parts = Store(spark, root).tables["fact_stock_price"]["parts"]
            assert fact_folders < {p[2] for p in parts}
            added = [f"{p[2]}/{f}" for p in parts if p[1] == rep.load for f in os.listdir(p[2]) if f.endswith(".parquet")]
            assert 0 < spark.read.parquet(*added).count() <= batch.count()
    prices.unpersist()
    index.unpersist()


def test_fallbacks_to_a_full_rebuild(spark, scratch, small, monkeypatch):
    b = fixtures.load(spark, SF_SMOKE)
    bronze, root = f"{scratch}/bronze", f"{scratch}/wh"
    few = b.prices.filter("code in ('S1', 'S2')").persist()
    last = few.agg(F.max("date")).first()[0]
    early, day = few.filter(F.col("date") < F.lit(last)), few.filter(F.col("date") == F.lit(last))
    index = b.index.filter(F.col("date") < F.lit(last))
    daily.run_daily(spark, early, index, b.components, bronze, root)
    rebuilds = []
    real = W.build_warehouse
    monkeypatch.setattr(W, "build_warehouse", lambda *a, **k: rebuilds.append(1) or real(*a, **k))
    daily.run_daily(spark, early.limit(0), index, b.components, bronze, root)
    assert not rebuilds and Store(spark, root).number == 2
    # a run that ended after its upsert: the next one sees that bronze is ahead
    with monkeypatch.context() as m:
        m.setattr(daily, "_index_changed_from", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            daily.run_daily(spark, day, b.index, b.components, bronze, root)
    assert W.open_table(spark, root, "silver_prices").filter(F.col("trade_date") == F.lit(last)).count() == 0
    daily.run_daily(spark, day, b.index, b.components, bronze, root)
    assert len(rebuilds) == 1
    assert W.open_table(spark, root, "silver_prices").count() == few.count()
    # an index day that prices were computed for
    moved = b.index.withColumn("close", F.when(F.col("date") == F.lit(last), F.col("close") + 1).otherwise(F.col("close")).cast("decimal(18,4)"))
    daily.run_daily(spark, day, moved, b.components, bronze, root)
    assert len(rebuilds) == 2
    few.unpersist()


def test_a_day_without_a_valid_bar_keeps_the_state(spark, scratch, small):
    """S2's new bar is invalid: its next day goes on from the rows before. S9 is listed with invalid bars alone."""
    day = lambda i: dt.date(2023, 1, 2) + dt.timedelta(days=i)
    kind = "code string, date date, open decimal(18,4), high decimal(18,4), low decimal(18,4), close decimal(18,4), volume bigint, source string"
    bar = lambda code, i, volume=10, up=0: (code, day(i), *[Decimal(100 + i % 7 + up)] * 4, volume, "feed")
    table = lambda rows: spark.createDataFrame(rows, kind)
    index = table([bar(c, i) for c in ("VNINDEX", "VN30") for i in range(266)])
    members, bronze, root = table([bar("S1", 0)]).select("code"), f"{scratch}/bronze", f"{scratch}/wh"
    old = {"S1": 260, "S2": 250, "S3": 40}
    batches = [[bar(c, i) for c, n in old.items() for i in range(260 - n, 260)],
               [bar("S1", 260), bar("S2", 260, -1), bar("S3", 260, -1), bar("S9", 260, -1)],
               # S1's older bar again, in the middle of what is stored
               [bar("S1", 250, up=1), bar("S2", 261, up=1), bar("S3", 261), bar("S9", 261)]]
    for batch in batches:
        daily.run_daily(spark, table(batch), index, members, bronze, root)
        state = {r["symbol"]: r for r in Store(spark, root).table("symbol_state").collect()}
        assert all(len(r["tail"] or ()) <= 200 for r in state.values())
    W.build_warehouse(spark, B.read_stored(spark, bronze), index, members, f"{scratch}/full", extracts=False, state=True)
    for name in TABLES:
        assert rows(spark, root, name) == rows(spark, f"{scratch}/full", name), name
    fresh = {r["symbol"]: r for r in Store(spark, f"{scratch}/full").table("symbol_state").collect()}
    assert state.keys() == fresh.keys()
    for s in state:
        assert (state[s]["raw_date"], state[s]["raw_close"], state[s]["tail"]) == (fresh[s]["raw_date"], fresh[s]["raw_close"], fresh[s]["tail"]), s
        assert [x and round(x, 6) for x in state[s]["state"]] == [x and round(x, 6) for x in fresh[s]["state"]], s


def test_a_correction_deals_no_stored_row(spark, scratch, small):
    """Rows of other symbols are rewritten from the buckets in which they lie."""
    row = lambda s, d, x: (s, dt.date(2024, 1, d), float(x))
    table = lambda rows: spark.createDataFrame(rows, "symbol string, trade_date date, close_price double")
    entry = S.write_daily(table([row(f"S{i}", d, i) for i in range(20) for d in (2, 3)]), f"{scratch}/t", "first", 2)
    with S.bucketed_scans(spark):
        rows_ = daily._beside(S.open_daily(spark, entry), table([row("S3", 1, 0)]).select("symbol"), table([row("S3", 2, 9), row("S3", 3, 9), row("S4", 4, 4)]), 2)
        assert S._dealt(rows_, 2)
        again = S.write_daily(rows_, f"{scratch}/again", "second", 2)
    assert len([f for f in os.listdir(f"{scratch}/again/year=2024") if f.endswith(".parquet")]) <= 2
    got = {(r["symbol"], r["trade_date"].day): r["close_price"] for r in S.open_daily(spark, again).collect()}
    assert got == {(f"S{i}", d): 9.0 if i == 3 else float(i) for i in range(20) for d in (2, 3)} | {("S4", 4): 4.0}
