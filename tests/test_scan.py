"""Block scan against plain loops (section 5 plan, item 3): EMA, Wilder,
RSI, MACD on random series with nulls, with blocks small enough that the
carry crosses several blocks."""

import datetime as dt
import math
import random
import re

import numpy as np
import pytest

from tickwell.operators import indicators as I
from tickwell.operators.scan import ScanSpec, carry_depth, linear_scan


def series_frame(spark, series):
    rows = [(k, i + 1, v) for k, xs in series.items() for i, v in enumerate(xs)]
    return spark.createDataFrame(rows, "symbol string, row_num long, x double")


def loop(a, b):
    out, y, bad = [], 0.0, False
    for v in b:
        bad = bad or v is None
        y = None if bad else a * y + v
        out.append(y)
    return out


@pytest.mark.parametrize("block", [40, 200, None])
def test_linear_scan_matches_loop(spark, block):
    rng = random.Random(block)
    series = {f"S{k}": [rng.uniform(-5, 5) for _ in range(rng.randint(1, 700))] for k in range(6)}
    series["NUL"] = [1.0] * 300 + [None] + [2.0] * 10
    a = 0.8
    df = series_frame(spark, series)
    out = linear_scan(df, [ScanSpec("y", a, df["x"])], "symbol", "row_num", block)
    got = {(r["symbol"], r["row_num"]): r["y"] for r in out.collect()}
    for k, xs in series.items():
        for i, want in enumerate(loop(a, xs)):
            g = got[(k, i + 1)]
            if want is None:
                assert g is None, (k, i)
            else:
                assert g == pytest.approx(want, rel=1e-12, abs=1e-12), (k, i)


def test_zero_coefficient_is_identity(spark):
    df = series_frame(spark, {"A": [1.0, 2.0, 3.0]})
    out = linear_scan(df, [ScanSpec("y", 0.0, df["x"])], "symbol", "row_num", 2)
    assert sorted(r["y"] for r in out.collect()) == [1.0, 2.0, 3.0]


def test_carry_depth_reaches_underflow():
    for a in (7 / 9, 11 / 13, 25 / 27, 13 / 14):
        for block in (64, 512):
            m = carry_depth(a, block)
            assert (a ** block) ** m == 0.0 or m * block * -math.log(a) > 745


def decayed(x, seed, a, w):
    """Closed form of y_0 = seed, y_r = a * y_(r-1) + w * x_r: weights times inputs. Null from the first null on."""
    x = np.array([np.nan if v is None else v for v in x], float)
    r = np.arange(len(x))
    weights = np.tril(w * a ** np.maximum(r[:, None] - r, 0.0))
    y = a ** (r + 1.0) * seed + weights @ np.nan_to_num(x)
    return np.where(np.maximum.accumulate(np.isnan(x)) if len(x) else False, np.nan, y)


def smoothed(x, period, a, w, first):
    """Mean of x[first:first + period] at the seed row, decayed from there; NaN before."""
    out = np.full(len(x), np.nan)
    if len(x) < first + period:
        return out
    seed = np.nanmean(np.array([np.nan if v is None else v for v in x[first:first + period]], float))
    out[first + period - 1] = seed
    out[first + period:] = decayed(x[first + period:], seed, a, w)
    return out


def ema_of(x, period):
    alpha = 2 / (period + 1)
    return smoothed(x, period, 1 - alpha, alpha, 0)


def same(got, want, tol=1e-9):
    return got is None if np.isnan(want) else got == pytest.approx(want, rel=tol, abs=tol)


def fact_frame(spark, closes):
    rows = []
    for k, xs in closes.items():
        prev = None
        for i, c in enumerate(xs):
            c = None if c is None else float(c)
            chg = 0.0 if prev is None or c is None else c - prev
            rows.append((k, i + 1, i, c, max(chg, 0.0), abs(min(chg, 0.0))))
            prev = c
    df = spark.createDataFrame(rows, "symbol string, row_num long, d int, close_price double, gain double, "
                                     "loss double")
    from pyspark.sql import functions as F
    return df.withColumn("trade_date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d"))).drop("d")


@pytest.mark.parametrize("block", [60, None])
def test_ema_with_seed_and_null(spark, block):
    rng = np.random.default_rng(7)
    xs = list(100 + np.cumsum(rng.normal(size=80)))
    ys = list(xs)
    ys[40] = None
    fact = fact_frame(spark, {"A": xs, "B": ys, "SHORT": xs[:11]})
    out = I.ema(fact, 12, "close_price", block=block)
    got = {(r["symbol"], r["row_num"]): r["ema_12"] for r in out.collect()}
    assert not any(k[0] == "SHORT" for k in got)
    for k, series in (("A", xs), ("B", ys)):
        for i, want in list(enumerate(ema_of(series, 12)))[11:]:
            assert same(got[(k, i + 1)], want, 1e-12)


def test_rsi_and_macd_match_closed_form(spark):
    rng = np.random.default_rng(3)
    closes = {f"S{k}": list(50 + np.cumsum(rng.normal(size=int(rng.integers(10, 140))))) for k in range(5)}
    closes["FLAT"] = [10.0] * 40
    gap = list(50 + np.cumsum(rng.normal(size=90)))
    closes["NULL30"] = gap[:29] + [None] + gap[30:]          # line ends before its 9th row
    closes["NULL60"] = gap[:59] + [None] + gap[60:]          # line and signal end at row 60
    fact = fact_frame(spark, closes)
    ours = {(r["symbol"], (r["trade_date"] - dt.date(2020, 1, 1)).days): r for r in I.Indicators(fact, block=48).fact().collect()}
    moves = {(r["symbol"], r["row_num"] - 1): r for r in fact.collect()}
    for k, xs in closes.items():
        line = ema_of(xs, 12) - ema_of(xs, 26)
        signal = np.full(len(xs), np.nan)
        signal[25:] = ema_of(line[25:], 9)
        gain, loss = ([moves[(k, i)][c] for i in range(len(xs))] for c in ("gain", "loss"))
        up, down = (smoothed(v, 14, 13 / 14, 1 / 14, 1) for v in (gain, loss))
        for i in range(len(xs)):
            r = ours[(k, i)]
            assert same(r["macd_line"], line[i]) and same(r["macd_signal"], signal[i] if not np.isnan(line[i]) else np.nan), (k, i)
            rsi = np.nan if np.isnan(up[i]) or up[i] == down[i] == 0 else 100.0 if down[i] == 0 else 100 - 100 / (1 + up[i] / down[i])
            assert same(r["rsi_14"], rsi, 1e-4), (k, i)


def test_both_scans_share_blocks_and_sorts(spark):
    plan = I.Indicators(fact_frame(spark, {"A": [1.0] * 30})).wide._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bSort \[", plan)) == 2


def test_a_scan_is_two_windows_and_indicators_are_six(spark):
    """Every window operator copies each row: a scan of any number of recurrences has one inside the blocks and one over
    those before (it had four), averages, bands and seeds two together."""
    fact = fact_frame(spark, {"A": [1.0] * 30})
    windows = lambda df: len(re.findall(r"\bWindow \[", df._jdf.queryExecution().executedPlan().toString()))
    assert windows(linear_scan(fact, [ScanSpec("y", 0.8, fact["gain"]), ScanSpec("z", 0.9, fact["loss"])])) == 2
    assert windows(I.Indicators(fact).wide) == 6


def test_a_null_nulls_all_later_blocks(spark):
    df = series_frame(spark, {"A": [1.0, None] + [1.0] * 10, "B": [1.0] * 12})
    out = linear_scan(df, [ScanSpec("y", 0.5, df["x"])], "symbol", "row_num", 3)
    got = {k: [r["y"] for r in sorted(out.filter(df["symbol"] == k).collect(), key=lambda r: r["row_num"])] for k in "AB"}
    assert got["A"] == [1.0] + [None] * 11
    assert got["B"] == pytest.approx(loop(0.5, [1.0] * 12))
