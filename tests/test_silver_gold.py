"""Silver flags and correction, price fact, breadth, dimension (section 8
traps 1-7, 13, 14)."""

import datetime as dt

from pyspark.sql import functions as F

from tickwell.operators import gold, silver

D = dt.date


def bronze(spark, rows):
    df = spark.createDataFrame(rows, "code string, date date, open double, high double, low double, "
                                     "close double, volume bigint, source string")
    return df.select("code", "date", *[F.col(c).cast("decimal(18,4)").alias(c)
                                       for c in ("open", "high", "low", "close")], "volume", "source")


def flat_index(spark, days, codes=("VNINDEX", "VN30")):
    return bronze(spark, [(c, D(2024, 1, d), 1000.0, 1000.0, 1000.0, 1000.0, 1, "ix") for c in codes for d in days])


def by_date(df):
    return {r["trade_date"].day: r for r in df.collect()}


def test_flag_order_and_null_close_is_ok(spark):
    p = bronze(spark, [
        ("A", D(2024, 1, 1), 10.0, 11.0, 9.0, 10.0, 100, "f"),
        ("A", D(2024, 1, 2), 10.0, 8.0, 9.0, 0.0, 100, "f"),      # close <= 0 wins over high < low
        ("A", D(2024, 1, 3), 10.0, 8.0, 9.0, 10.0, 100, "f"),     # high < low
        ("A", D(2024, 1, 4), -1.0, 11.0, 9.0, 10.0, 100, "f"),    # other price <= 0
        ("A", D(2024, 1, 5), 10.0, 11.0, 9.0, 10.0, -1, "f"),     # negative volume
        ("A", D(2024, 1, 6), 10.0, 11.0, 9.0, None, 100, "f"),    # null close -> ok
    ])
    s = by_date(silver.silver_prices(p, flat_index(spark, range(1, 7)), audit=False))
    assert [s[d]["dq_flag"] for d in range(1, 7)] == [
        "ok", "invalid_close_price", "high_less_than_low", "invalid_ohlc", "negative_volume", "ok"]
    assert [s[d]["is_valid"] for d in range(1, 7)] == [True, False, False, False, False, True]


def test_gap_uses_raw_series_and_gold_uses_corrected(spark):
    p = bronze(spark, [
        ("A", D(2024, 1, 1), 10.0, 10.0, 10.0, 10.0, 100, "f"),
        ("A", D(2024, 1, 2), 12.0, 12.0, 12.0, 12.0, 100, "f"),   # +20 %, calm index -> gap
        ("A", D(2024, 1, 3), 12.0, 12.0, 12.0, 12.0, 100, "f"),   # 0 % vs raw 12 -> ok
    ])
    s = silver.silver_prices(p, flat_index(spark, range(1, 4)), audit=False)
    r = by_date(s)
    assert r[2]["dq_flag"] == "abnormal_price_gap" and r[2]["is_valid"]
    assert r[2]["close_price"] == 10.0 and r[2]["open_price"] == 10.0 and r[2]["volume"] == 0
    assert r[3]["dq_flag"] == "ok"
    f = by_date(gold.fact_stock_price(s, audit=False))
    assert (f[1]["gain"], f[1]["loss"]) == (0.0, 0.0)
    assert f[2]["gain"] == 0.0 and f[3]["gain"] == 2.0     # jump appears one day later


def test_gap_not_flagged_when_index_moves(spark):
    p = bronze(spark, [("A", D(2024, 1, 1), 10.0, 10.0, 10.0, 10.0, 1, "f"),
                       ("A", D(2024, 1, 2), 12.0, 12.0, 12.0, 12.0, 1, "f")])
    ix = bronze(spark, [("VNINDEX", D(2024, 1, 1), 1000.0, 1000.0, 1000.0, 1000.0, 1, "ix"),
                        ("VNINDEX", D(2024, 1, 2), 1050.0, 1050.0, 1050.0, 1050.0, 1, "ix")])
    assert by_date(silver.silver_prices(p, ix, audit=False))[2]["dq_flag"] == "ok"


def test_row_num_counts_valid_rows_only(spark):
    p = bronze(spark, [("A", D(2024, 1, 1), 10.0, 10.0, 10.0, 10.0, 1, "f"),
                       ("A", D(2024, 1, 2), 10.0, 10.0, 10.0, 0.0, 1, "f"),
                       ("A", D(2024, 1, 3), 10.0, 10.0, 10.0, 11.0, 1, "f")])
    f = by_date(gold.fact_stock_price(silver.silver_prices(p, flat_index(spark, range(1, 4)), audit=False),
                                      audit=False))
    assert sorted(f) == [1, 3] and f[3]["row_num"] == 2 and f[3]["gain"] == 1.0


def test_breadth_drops_first_row_and_days_without_both_indices(spark):
    p = bronze(spark, [(s, D(2024, 1, d), 10.0, 10.0, 10.0, c, 5, "f")
                       for s, closes in (("A", (10.0, 10.5, 10.2)), ("B", (10.0, 9.9, 9.9)))
                       for d, c in zip((1, 2, 3), closes)])
    ix = flat_index(spark, (1, 2, 3), ("VNINDEX",)).unionByName(flat_index(spark, (1, 2), ("VN30",)))
    sp = silver.silver_prices(p, ix, audit=False)
    summ = by_date(gold.fact_market_summary(gold.fact_stock_price(sp, audit=False),
                                            silver.silver_index(ix, audit=False)))
    assert sorted(summ) == [2]          # day 1: no row after skip_first; day 3: no VN30
    r = summ[2]
    assert (r["gainers"], r["losers"], r["unchanged"], r["total_symbols"], r["total_volume"]) == (1, 1, 0, 2, 10)


def test_dim_stock_max_source_and_member_flag(spark):
    p = bronze(spark, [("A", D(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1, "feed_a"),
                       ("A", D(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1, "feed_b"),
                       ("B", D(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1, "feed_a")])
    comps = spark.createDataFrame([("A",)], "code string")
    sp = silver.silver_prices(p, flat_index(spark, (1, 2)), audit=False)
    d = {r["symbol"]: r for r in gold.dim_stock(sp, comps).collect()}
    assert d["A"]["exchange"] == "feed_b" and d["A"]["is_vn30"] and not d["B"]["is_vn30"]
    assert d["A"]["default_exchange"] == "HOSE"
