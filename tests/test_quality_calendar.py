"""Quality gates (Q1..Q5) and calendar / coverage (C1..C5)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwell.operators import calendar as K
from tickwell.operators import quality as Q

D = dt.date


def test_gates_count_failures(spark):
    df = spark.createDataFrame([("A", 1, 50.0), ("A", 1, 120.0), (None, 2, None), ("B", 3, 10.0)],
                               "symbol string, d int, rsi_14 double")
    gates = [Q.unique(df, ["symbol", "d"], "l", "m"), Q.unique(df, "symbol", "l", "m"),
             Q.not_null(df, "symbol", "l", "m"),
             Q.expression_is_true(df, "rsi_14 >= 0 AND rsi_14 <= 100", "l", "m", "rsi_14 IS NOT NULL")]
    got = {r["test"]: r["failures"] for r in Q.report(gates).collect()}
    assert got == {"unique_combination(symbol, d)": 1, "unique(symbol)": 1, "not_null(symbol)": 1,
                   "expression_is_true(rsi_14 >= 0 AND rsi_14 <= 100)": 1}
    with pytest.raises(Q.QualityError) as e:
        Q.enforce(gates)
    assert e.value.failures["m.not_null(symbol)"] == 1


def test_null_expression_passes(spark):
    df = spark.createDataFrame([(None,), (5.0,)], "ma200 double")
    assert Q.enforce([Q.expression_is_true(df, "ma200 > 0", "g", "m")])[0]["failures"] == 0


def test_dim_date_parts_and_holidays(spark):
    hol = spark.createDataFrame([(D(2024, 1, 1),)], "date date")
    cal = {r["date"]: r for r in K.dim_date(spark, "2023-12-30", "2024-01-08", hol).collect()}
    assert len(cal) == 10
    r = cal[D(2024, 1, 1)]
    assert (r["day"], r["day_of_week"], r["month"], r["quarter"], r["year"]) == (1, "Monday", 1, 1, 2024)
    assert not r["is_trading_day"] and cal[D(2024, 1, 2)]["is_trading_day"]
    assert not cal[D(2023, 12, 30)]["is_trading_day"]          # Saturday


def test_count_trading_days(spark):
    days = spark.range(1).select(F.explode(F.sequence(F.lit(D(2020, 1, 1)), F.lit(D(2022, 12, 31)))).alias("date"))
    cal = K.calendar_frame(days, K.fixed_holidays(days))
    # Weekdays by numpy's business-day count, less the holidays that fall on weekdays.
    fixed = [f"{y}-{md}" for y in (2020, 2021, 2022) for md in ("01-01", "04-30", "05-01", "09-02", "09-03")]
    ranges = {(D(2020, 1, 1), D(2020, 12, 31)): 257, (D(2021, 4, 28), D(2021, 5, 3)): 3, (D(2022, 1, 8), D(2022, 1, 9)): 0,
              (D(2020, 9, 2), D(2020, 9, 2)): 0, (D(2021, 3, 5), D(2022, 8, 1)): None}
    for s, e in ranges:
        days_between = int(np.busday_count(s, e + dt.timedelta(days=1), holidays=fixed))
        assert ranges[(s, e)] in (None, days_between)
        ranges[(s, e)] = days_between
    rdf = spark.createDataFrame(list(ranges), "start date, end date")
    got = {(r["start"], r["end"]): r["trading_days"] for r in K.count_trading_days(rdf, cal).collect()}
    assert got == ranges


def test_coverage_gate(spark):
    days = spark.range(1).select(F.explode(F.sequence(F.lit(D(2024, 1, 1)), F.lit(D(2024, 12, 31)))).alias("date"))
    cal = K.calendar_frame(days, K.fixed_holidays(days))
    td = 257        # 262 weekdays of 2024 less 1 Jan, 30 Apr, 1 May, 2 Sep and 3 Sep
    members = spark.createDataFrame([("A",), ("B",)], "code string")
    tdays = [r["date"] for r in cal.filter("is_trading_day").orderBy("date").collect()]
    full = spark.createDataFrame([(c, d) for c in ("A", "B") for d in tdays], "code string, date date")
    r = K.coverage(full, members, cal).first()
    assert (r["symbols"], r["trading_days"], r["expected_rows"], r["existing_rows"]) == (2, td, 2 * td, 2 * td)
    assert r["threshold"] == int(0.8 * 2 * td) and not r["needs_load"]
    half = full.filter(F.col("code") == "A")
    assert K.coverage(half, members, cal).first()["needs_load"]
    assert K.coverage(full, members, cal, force=True).first()["needs_load"]


def test_universe_modes(spark):
    allsym = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    members = spark.createDataFrame([("A",)], "code string")
    got = lambda m: sorted(r["symbol"] for r in K.resolve_universe(allsym, members, m).collect())
    assert got("vn30") == ["A"] and got("others") == ["B", "C"] and got("all") == ["A", "B", "C"]
    assert len(got(None)) == 30
    listing = spark.createDataFrame([("A", "STOCK", "HSX"), ("B", "ETF", "HSX"), ("C", "STOCK", "HNX")],
                                    "symbol string, type string, exchange string")
    assert [r["symbol"] for r in K.listed_stocks(listing).collect()] == ["A"]
