"""The running-sum moving average equals Spark's sliding-frame
average, with null closes inside the frame and short series."""

import random

import pytest
from pyspark.sql import functions as F

from tickwell.operators.windows import bollinger_frame, sma_col, trailing, with_sma


def test_running_sum_sma_matches_sliding_frame(spark):
    rng = random.Random(11)
    rows = []
    for k in range(5):
        n = rng.randint(3, 260)
        for i in range(n):
            c = None if rng.random() < 0.05 else round(rng.uniform(1, 2000), 4)
            rows.append((f"S{k}", i, i + 1, c))
    df = (spark.createDataFrame(rows, "symbol string, d int, row_num long, close_price double")
          .withColumn("trade_date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d"))).drop("d"))
    fast = with_sma(df, {"m5": 5, "m50": 50, "m200": 200})
    slow = fast.select("*", sma_col(5).alias("s5"), sma_col(50).alias("s50"), sma_col(200).alias("s200"))
    for r in slow.collect():
        for a, b in (("m5", "s5"), ("m50", "s50"), ("m200", "s200")):
            if r[b] is None:
                assert r[a] is None, (r["symbol"], r["row_num"], a)
            else:
                assert r[a] == pytest.approx(r[b], rel=1e-12, abs=1e-9), (r["symbol"], r["row_num"], a)


def test_bands_match_a_sliding_frame_and_have_none_in_the_plan(spark):
    rng = random.Random(12)
    rows = []
    for k in range(6):
        for i in range(rng.randint(3, 120)):
            c = None if rng.random() < 0.05 else 123456.75 if k == 0 else round(rng.uniform(1, 10 ** rng.randint(1, 8)), 4)
            rows.append((f"S{k}", i, i + 1, c))
    df = (spark.createDataFrame(rows, "symbol string, d int, row_num long, close_price double")
          .withColumn("trade_date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d"))).drop("d"))
    bands = bollinger_frame(df)
    plan = bands._jdf.queryExecution().executedPlan().toString()
    assert "RowFrame, -19" not in plan and "unboundedpreceding" in plan
    w = trailing(20)
    for r in bands.withColumns({"m": F.avg("close_price").over(w), "s": F.stddev_pop("close_price").over(w)}).collect():
        if r.row_num < 20 or r.m is None:
            assert r.bb_upper is None and r.bb_lower is None
        else:
            assert r.bb_upper == pytest.approx(r.m + 2 * r.s, rel=1e-11) and r.bb_lower == pytest.approx(r.m - 2 * r.s, rel=1e-9, abs=1e-6)
            if r.symbol == "S0" and r.row_num > 40:
                assert r.bb_upper == r.bb_lower == 123456.75
