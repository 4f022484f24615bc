"""How the registered queries deal their rows."""

from pyspark.sql import functions as F

from tickwell.operators import gold
from tickwell.operators import verify as V
from tickwell.plans import registry as R
from tickwell.sources import fixtures


def test_tasks_of_symbols_follow_the_bars(spark, monkeypatch):
    """What one task sorts stays bounded: tasks were as many as 64 MB pieces of well compressed bars."""
    bars = spark.range(1000)
    assert R.symbol_tasks(bars) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(R, "TASK_BARS", 10)
    assert R.symbol_tasks(bars) == 100


def test_the_dimension_of_the_fact_is_that_of_silver(spark):
    rows = [("A", "a", True), ("A", "b", True), ("B", "a", True), ("B", "z", False), ("C", "a", False)]
    sp = spark.createDataFrame(rows, "symbol string, source string, is_valid boolean")
    members = spark.createDataFrame([("B",)], "code string")
    fact = gold.valid_only(sp).drop("is_valid")
    want = gold.dim_stock(sp, members).collect()
    assert sorted(gold.dim_stock(fact.withColumn("is_valid", F.lit(True)), members).collect()) == sorted(want) and len(want) == 2


def test_drift_takes_the_row_numbers_of_ours(spark):
    names = V._DRIFT_COLS
    rows = spark.range(300).select(F.lit("A").alias("symbol"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("trade_date"),
                                   (F.col("id") + 1).alias("row_num"), *[F.lit(2.0).alias(c) for c in names])
    ref = rows.withColumns({c: F.col(c) + 1 for c in names}).drop("row_num")
    with_fact = V.drift_report(rows.drop("row_num"), ref, rows)
    without = V.drift_report(rows, ref)
    assert sorted(without.collect()) == sorted(with_fact.collect())
    assert without.first()["rows"] == 50
    plan = without._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_bars_are_dealt_and_sorted_by_numbers(spark):
    rows = [(1, 5, 2, 1, 3.0, 10.0, 0.01, 0.02, "2020-01-01"), (1, 4, 2, 1, 3.0, 10.0, 0.05, 0.02, "2020-01-01"), (3, 5, None, 1, 3.0, 10.0, 0.01, 0.02, None)]
    li = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                     "l_discount double, l_tax double, l_shipdate string")
    b = fixtures.bars(li)
    assert "hashpartitioning(code" not in b._jdf.queryExecution().executedPlan().toString()
    got = {r["code"]: (r["o"], r["c"], r["v"], r["k"]) for r in b.collect()}
    assert got == {"S2": (22 * 103, 22 * 99, 6, 1), None: (None, None, 3, 3)}
    prices = {r["code"]: (str(r["open"]), str(r["close"])) for r in fixtures.bronze_prices_from_bars(b).collect()}
    assert prices == {"S2": ("22.6600", "21.7800"), None: ("None", "None")}
