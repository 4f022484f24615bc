"""Landing contract, audit, de-duplication (IO2..IO6)."""

import datetime as dt
from decimal import Decimal

import pytest

from tickwell.sources import bronze as B

D = dt.date


def bars(spark, rows):
    return spark.createDataFrame(rows, "code string, date date, open double, high double, low double, "
                                       "close double, volume bigint, source string")


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([("A", D(2024, 1, 2), 1.0, 2.0, 0.5, 1.5)],
                               "code string, date date, open double, high double, low double, close double")
    with pytest.raises(B.ContractError, match="volume"):
        B.require_columns(df)


def test_audit_counts_but_keeps_rows(spark):
    df = bars(spark, [("A", D(2024, 1, 2), -10.0, 2.0, 1.0, 1.5, 100, "s"),
                      (None, D(2024, 1, 3), 1.0, 2.0, 1.0, 1.5, -5, "s"),
                      ("A", D(2024, 1, 4), 1.0, 2.0, 1.0, 0.0, 10, "s")])
    a = B.audit_bars(df).first().asDict()
    assert a == {"rows": 3, "null_code": 1, "null_date": 0, "nonpositive_open": 1, "nonpositive_high": 0,
                 "nonpositive_low": 0, "nonpositive_close": 1, "negative_volume": 1}
    assert df.count() == 3


def test_check_audit_rejects_null_keys_and_empty(spark):
    with pytest.raises(B.ContractError, match="null keys"):
        B.check_audit(bars(spark, [(None, D(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1, "s")]))
    with pytest.raises(B.ContractError, match="empty"):
        B.check_audit(bars(spark, []))


def test_normalise_landing_frame(spark):
    land = spark.createDataFrame([("2024-01-02", 10.0, 11.0, 9.0, 10.5, 100)],
                                 "time string, open double, high double, low double, close double, volume bigint")
    out = B.normalise_bars(land, "FPT", "VCI").first()
    assert out["code"] == "FPT" and out["date"] == D(2024, 1, 2)
    assert out["source"] == "vnstock_VCI"
    assert out["close"] == Decimal("10.5000")


def test_union_and_dedup_last(spark):
    a = bars(spark, [("A", D(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1, "s1")])
    b = bars(spark, [("A", D(2024, 1, 2), 2.0, 2.0, 2.0, 2.0, 2, "s2"),
                     ("B", D(2024, 1, 2), 3.0, 3.0, 3.0, 3.0, 3, "s1")])
    u = B.union_bars([a, b])
    assert u.count() == 3
    d = {r["code"]: r for r in B.dedup_last(u, ["code", "date"], "source").collect()}
    assert d["A"]["source"] == "s2" and d["A"]["volume"] == 2 and d["B"]["volume"] == 3


def test_select_range_inclusive(spark):
    df = bars(spark, [("A", D(2024, 1, d), 1.0, 1.0, 1.0, 1.0, 1, "s") for d in range(1, 11)]
              + [("B", D(2024, 1, 5), 1.0, 1.0, 1.0, 1.0, 1, "s")])
    out = B.select_range(df, ["A"], "2024-01-03", "2024-01-06")
    assert sorted(r["date"].day for r in out.collect()) == [3, 4, 5, 6]
