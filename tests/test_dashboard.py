"""Extracts, movers, measures and signals (D1..D8, M1..M6, T1..T5, S1..S4)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tickwell.functions.columns import normalize_index, normalize_price
from tickwell.operators import dashboard as D
from tickwell.operators import signals as S

d = dt.date


def test_unit_normalisation_and_half_even(spark):
    df = spark.createDataFrame([(25000.0, 125000.0), (25.0, 1250.0), (None, None)], "p double, i double")
    got = [(r["p"], r["i"]) for r in df.select(normalize_price("p").alias("p"), normalize_index("i").alias("i"))
           .collect()]
    assert got == [(25.0, 1250.0), (25.0, 1250.0), (None, None)]
    r = spark.range(1).select(F.bround(F.lit(0.125), 2).alias("b"), F.round(F.lit(0.125), 2).alias("r")).first()
    assert float(r["b"]) == 0.12 and float(r["r"]) == 0.13


def _summary(spark, days):
    return spark.createDataFrame([(d(2024, 1, x), 1, 1, 0, 2, 10, 125000.0, 1500.0) for x in days],
                                 "trade_date date, gainers long, losers long, unchanged long, total_symbols long, "
                                 "total_volume long, vnindex_close double, vn30_close double")


def test_latest_market_and_history(spark):
    s = _summary(spark, [1, 2, 3])
    lm = D.latest_market(s).first()
    assert lm["trade_date"] == d(2024, 1, 3) and lm["vnindex_close"] == 1250.0 and lm["vn30_close"] == 1500.0
    assert D.market_history(s, days=1).count() == 2


def test_top_movers_ties_and_null_change(spark):
    fact = spark.createDataFrame(
        [(s, d(2024, 1, x), c, 100) for s, closes in
         (("A", (10.0, 11.0)), ("B", (10.0, 11.0)), ("C", (10.0, 9.0))) for x, c in zip((1, 2), closes)]
        + [("N", d(2024, 1, 2), 5.0, None)],
        "symbol string, trade_date date, close_price double, volume long")
    dim = spark.createDataFrame([("A", True)], "symbol string, is_vn30 boolean")
    ext = D.price_extract(fact, dim)
    top = D.top_movers(ext, _summary(spark, [1, 2]), n=10).collect()
    assert [r["symbol"] for r in top] == ["A", "B", "C", "N"]
    n = top[-1]
    assert n["pct_change"] == 0.0 and n["volume"] == 0
    assert top[0]["pct_change"] == 10.0 and top[0]["is_vn30"]
    assert [r["symbol"] for r in D.top_movers(ext, _summary(spark, [1, 2]), members_only=True).collect()] == ["A"]


def test_member_breadth_vs_kpis_null_handling(spark):
    ext = spark.createDataFrame([("A", d(2024, 1, 2), 10.0, 5, True), ("B", d(2024, 1, 1), 10.0, 5, True),
                                 ("B", d(2024, 1, 2), 10.0, None, True)],
                                "symbol string, trade_date date, close_price double, volume long, is_vn30 boolean")
    b = {r["trade_date"]: r for r in D.member_breadth(ext).collect()}
    assert (b[d(2024, 1, 2)]["unchanged"], b[d(2024, 1, 2)]["gainers"]) == (1, 0)   # A's null change: no bucket
    k = D.member_kpis(ext, _summary(spark, [1, 2])).first()
    assert k["unchanged"] == 2 and k["total_volume"] == 5                          # shown as 0.0: flat


def test_measures_close_vs_open(spark):
    prices = spark.createDataFrame(
        [("A", d(2024, 1, 4), 10.0, 11.0, 1), ("B", d(2024, 1, 4), 10.0, 9.0, 2), ("C", d(2024, 1, 4), 10.0, 10.0, 3),
         ("A", d(2024, 1, 5), 10.0, 12.0, 4), ("A", d(2024, 1, 8), 11.0, 12.0, 5)],
        "symbol string, trade_date date, open_price double, close_price double, volume long")
    from tickwell.operators import calendar as K
    cal = K.dim_date(spark, "2024-01-01", "2024-01-10")
    lb = D.measure_latest_breadth(prices, cal).first()
    assert lb["trade_date"] == d(2024, 1, 8) and (lb["gainers"], lb["total_volume"]) == (1, 5)
    pc = D.measure_percent_change(prices, cal).collect()
    assert [(r["symbol"], r["percent_change"]) for r in pc] == [("A", 0.0)]
    t = {r["trade_date"]: r for r in D.measure_trend(prices).collect()}
    assert (t[d(2024, 1, 4)]["gainers"], t[d(2024, 1, 4)]["losers"], t[d(2024, 1, 4)]["unchanged"]) == (1, 1, 1)


def test_signals(spark):
    ind = spark.createDataFrame(
        [("A", d(2024, 1, 1), 10.0, 1.0, 2.0, 75.0, -0.5, 12.0, 9.0),
         ("A", d(2024, 1, 2), 12.0, 3.0, 2.0, 25.0, 0.5, 12.0, 9.0)],
        "symbol string, trade_date date, close_price double, ma50 double, ma200 double, rsi_14 double, "
        "macd_histogram double, bb_upper double, bb_lower double")
    r = {x["trade_date"].day: x for x in S.signals(ind).collect()}
    assert r[1]["ma_cross"] is None and r[2]["ma_cross"] == "golden"
    assert (r[1]["rsi_zone"], r[2]["rsi_zone"]) == ("overbought", "oversold")
    assert r[2]["macd_cross"] == "bullish" and r[2]["band_touch"] == "upper"


def test_payload_sections_are_json(spark):
    fact = spark.createDataFrame([("A", d(2024, 1, x), 10.0 + x, 100) for x in (1, 2)],
                                 "symbol string, trade_date date, close_price double, volume long")
    dim = spark.createDataFrame([("A", True)], "symbol string, is_vn30 boolean")
    ind = fact.select("symbol", "trade_date", "close_price", *[F.lit(None).cast("double").alias(c) for c in (
        "ma50", "ma200", "bb_upper", "bb_lower", "rsi_14", "macd_line", "macd_signal", "macd_histogram")])
    p = D.dashboard_payload(_summary(spark, [1, 2]), D.price_extract(fact, dim), D.indicator_extract(ind, dim))
    rows = {(r["section"], r["key"]): json.loads(r["json"]) for r in p.collect()}
    assert rows[("symbols", "A")] == {"symbol": "A", "is_vn30": True}
    assert rows[("movers", "A")]["pct_change"] == 9.09
    assert rows[("indicators_by_symbol", "A")]["trade_date"] == ["2024-01-01", "2024-01-02"]
    assert rows[("top_movers", "top_movers")]["items"][0]["symbol"] == "A"
