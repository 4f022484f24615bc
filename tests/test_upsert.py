"""IO7 / IO8 / IO10: idempotent upsert into the year-partitioned table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickwell.sources import bronze as B
from tickwell.sources import published as P

D = dt.date


def batch(spark, rows, seq=1):
    df = spark.createDataFrame(rows, "code string, date date, open double, high double, low double, "
                                     "close double, volume bigint, source string")
    return (df.select("code", "date", *[F.col(c).cast("decimal(18,4)").alias(c)
                                        for c in ("open", "high", "low", "close")], "volume", "source")
            .withColumn("seq", F.lit(seq)))


def ten(spark, close=10.0, seq=1):
    return batch(spark, [("AAA", D(2023, 12, 28) + dt.timedelta(days=i), 10.0, 11.0, 9.0, close, 100 + i, "feed")
                         for i in range(10)], seq)


def table(spark, path):
    return B.read_stored(spark, path)


def test_partial_then_full_write_gives_all_rows(spark, scratch):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    full = ten(spark)
    B.upsert_into(spark, full.filter(F.col("volume") < 105), path, stage)
    assert table(spark, path).count() == 5
    B.upsert_into(spark, full, path, stage)
    assert table(spark, path).count() == 10
    assert sorted(r["year"] for r in table(spark, path).select("year").distinct().collect()) == [2023, 2024]


def test_rerun_is_idempotent_and_replaces_non_keys(spark, scratch):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    B.upsert_into(spark, ten(spark), path, stage)
    upd = ten(spark, close=12.5, seq=2).filter(F.col("date") >= D(2024, 1, 1))
    B.upsert_into(spark, upd, path, stage)
    first = sorted(table(spark, path).collect())
    B.upsert_into(spark, upd, path, stage)
    assert sorted(table(spark, path).collect()) == first
    closes = {r["date"]: float(r["close"]) for r in first}
    assert closes[D(2023, 12, 31)] == 10.0 and closes[D(2024, 1, 3)] == 12.5


def test_batch_duplicates_keep_highest_seq(spark):
    existing = ten(spark).drop("seq").limit(0)
    b = ten(spark, close=1.0, seq=1).unionByName(ten(spark, close=2.0, seq=3))
    out = B.upsert_bronze(existing, b)
    assert out.count() == 10
    assert {float(r["close"]) for r in out.collect()} == {2.0}


def test_replace_components_empty_is_noop(spark, scratch):
    path = f"{scratch}/components"
    codes = spark.createDataFrame([("A",), ("B",), ("A",)], "code string")
    assert B.replace_components(spark, codes, path) == 2
    assert B.replace_components(spark, codes.limit(0), path) == 0
    assert table(spark, path).count() == 2


def _files(path):
    import os
    out = {}
    for root, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.join(root, n)] = os.path.getmtime(os.path.join(root, n))
    return out


def test_month_grain_rewrites_only_touched_months(spark, scratch):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    B.upsert_into(spark, ten(spark), path, stage, grain=B.YEAR_MONTH)
    parts = {(r["year"], r["month"]) for r in table(spark, path).select("year", "month").distinct().collect()}
    assert parts == {(2023, 12), (2024, 1)}
    before = _files(path)
    upd = ten(spark, close=12.5, seq=2).filter(F.col("date") >= D(2024, 1, 1))
    B.upsert_into(spark, upd, path, stage, grain=B.YEAR_MONTH)
    after = _files(path)
    dec = {p: t for p, t in before.items() if "month=12" in p}
    assert dec and all(after.get(p) == t for p, t in dec.items())      # December untouched
    rows = B.read_bronze(spark, scratch, "bronze").collect()
    assert len(rows) == 10 and {"year", "month"} <= set(rows[0].asDict())
    closes = {r["date"]: float(r["close"]) for r in rows}
    assert closes[D(2023, 12, 31)] == 10.0 and closes[D(2024, 1, 3)] == 12.5
    jan = B.select_range(table(spark, path), ["AAA"], "2024-01-02", "2024-01-03")
    assert sorted(r["date"].day for r in jan.collect()) == [2, 3]


def closes(spark, path):
    return {(r["code"], str(r["date"])): r["close"] and float(r["close"]) for r in table(spark, path).collect()}


def test_unknown_column_is_refused_and_nothing_is_lost(spark, scratch):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    B.upsert_into(spark, ten(spark), path, stage)
    before = closes(spark, path)
    with pytest.raises(B.ContractError, match="extra"):
        B.upsert_into(spark, ten(spark, close=1.0).limit(1).withColumn("extra", F.lit(1)), path, stage)
    assert closes(spark, path) == before


def test_narrow_batch_keeps_stored_columns(spark, scratch):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    stamp = F.lit("2024-01-09 00:00:00").cast("timestamp")
    B.upsert_into(spark, ten(spark).withColumn("ingested_at", stamp), path, stage)
    B.upsert_into(spark, ten(spark, close=12.0).filter("volume < 103"), path, stage)
    rows = table(spark, path).collect()
    assert len(rows) == 10 and sum(r["ingested_at"] is None for r in rows) == 3
    assert sorted({float(r["close"]) for r in rows}) == [10.0, 12.0]


def test_grain_is_the_stored_one(spark, scratch):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    B.upsert_into(spark, ten(spark), path, stage)
    B.upsert_into(spark, ten(spark, close=12.0), path, stage, grain=B.YEAR_MONTH)
    assert "month" not in table(spark, path).columns
    assert set(closes(spark, path).values()) == {12.0} and table(spark, path).count() == 10


def test_unreadable_table_is_raised(spark, scratch):
    import os
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    os.makedirs(f"{path}/year=2024")
    with open(f"{path}/year=2024/part-0.parquet", "w") as f:
        f.write("this is no parquet file")
    with pytest.raises(Exception):
        B.upsert_into(spark, ten(spark), path, stage)
    assert os.listdir(f"{path}/year=2024") == ["part-0.parquet"]


def test_null_key_is_refused_with_its_count(spark, scratch):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    bad = ten(spark).withColumn("code", F.when(F.col("volume") > 101, F.col("code")))
    with pytest.raises(B.ContractError, match="code=2"):
        B.upsert_into(spark, bad, path, stage)
    assert not B.path_exists(spark, path)


@pytest.mark.parametrize("turn", [1, -1])
def test_duplicates_without_seq_keep_the_latest_whatever_their_order(spark, scratch, turn):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    stamped = [ten(spark, close=c).drop("seq").withColumn("ingested_at", F.lit(t).cast("timestamp"))
               for c, t in ((1.0, "2024-01-02"), (2.0, "2024-01-05"), (3.0, "2024-01-03"), (4.0, None))]
    assert B.upsert_into(spark, B.union_bars(stamped[::turn]).coalesce(1), path, stage) == 10
    assert set(closes(spark, path).values()) == {2.0}


STEPS = ("dedup_last", "upsert_bronze", "_partitions", "rename_path")


@pytest.mark.parametrize("step", [*STEPS, "publish"])
def test_a_run_that_ends_anywhere_has_changed_nothing(spark, scratch, monkeypatch, step):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    B.upsert_into(spark, ten(spark), path, stage)
    with monkeypatch.context() as m:
        m.setattr(B if step in STEPS else P, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            B.upsert_into(spark, ten(spark, close=12.0).filter("volume < 108"), path, stage)
    assert set(closes(spark, path).values()) == {10.0}
    B.upsert_into(spark, ten(spark, close=13.0).filter("volume = 109"), path, stage)
    assert sorted(closes(spark, path).values()) == [10.0] * 9 + [13.0]
    import os
    assert os.listdir(stage) == []


def test_of_two_writers_the_second_is_refused_and_readers_see_one_state(spark, scratch, monkeypatch):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    B.upsert_into(spark, ten(spark), path, stage)
    before = table(spark, path)  # a reader that has resolved the first publication
    renamed, moved = B.rename_path, []

    def rename(spark_, old, new):
        renamed(spark_, old, new)
        moved.append(new)
        if len(moved) == 1:  # the first writer has one of its two years in place when the second comes and a reader looks
            assert set(closes(spark, path).values()) == {10.0}
            assert B.upsert_into(spark, ten(spark, close=20.0).filter("volume < 104"), path, stage) == 4
            assert sorted(closes(spark, path).values()) == [10.0] * 6 + [20.0] * 4

    monkeypatch.setattr(B, "rename_path", rename)
    with pytest.raises(P.Conflict):
        B.upsert_into(spark, ten(spark, close=12.0), path, stage)
    assert sorted(closes(spark, path).values()) == [10.0] * 6 + [20.0] * 4
    assert {float(r["close"]) for r in before.collect()} == {10.0}


def test_an_unfinished_publication_does_not_count(spark, scratch):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    B.upsert_into(spark, ten(spark), path, stage)
    with open(f"{path}/{P.FOLDER}/00000002.json", "w") as f:
        f.write('{"parts": [')
    assert set(closes(spark, path).values()) == {10.0}
    with pytest.raises(P.Conflict):  # its writer may still be at it
        B.upsert_into(spark, ten(spark, close=12.0), path, stage)
    import os
    os.utime(f"{path}/{P.FOLDER}/00000002.json", (1, 1))
    B.upsert_into(spark, ten(spark, close=12.0), path, stage)
    assert set(closes(spark, path).values()) == {12.0}


def test_a_table_from_before_any_upsert_is_taken_over(spark, scratch):
    import glob
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    B.write_partitioned(ten(spark).drop("seq"), path)
    for close in (11.0, 12.0, 13.0):
        B.upsert_into(spark, ten(spark, close=close).filter("year(date) = 2024"), path, stage)
    assert sorted(closes(spark, path).values()) == [10.0] * 4 + [13.0] * 6
    assert "PartitionFilters: [isnotnull(year" in B.select_range(table(spark, path), ["AAA"], "2024-01-02", "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    # superseded folders go, but for those of the publication before
    assert len(glob.glob(f"{path}/year=2024/load=*")) == 2 and not glob.glob(f"{path}/year=2024/*.parquet")


def test_the_batch_is_evaluated_once(spark, scratch):
    path, stage = f"{scratch}/bronze", f"{scratch}/stage"
    B.upsert_into(spark, ten(spark), path, stage)
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    batch_ = ten(spark, close=12.0).coalesce(1)
    assert B.upsert_into(spark, batch_.mapInArrow(seen, batch_.schema), path, stage) == 10
    assert runs.value == 10


def test_components_swap_that_stops_leaves_the_old_list(spark, scratch, monkeypatch):
    path = f"{scratch}/components"
    codes = spark.createDataFrame([("A",), ("B",)], "code string")
    B.replace_components(spark, codes, path)
    with monkeypatch.context() as m:
        m.setattr(P, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            B.replace_components(spark, codes.filter("code = 'A'"), path)
    assert table(spark, path).count() == 2
    for _ in range(3):
        assert B.replace_components(spark, table(spark, path).filter("code = 'B'"), path) == 1
    assert [r["code"] for r in table(spark, path).collect()] == ["B"]


def test_stored_rows_are_not_shuffled(spark):
    old, new = ten(spark).drop("seq"), ten(spark, close=2.0).filter("volume < 102")
    plan = B.upsert_bronze(old, new)._jdf.queryExecution().toString()
    assert "LeftAnti" in plan
    merged = B.upsert_bronze(old, new)
    assert sorted(float(r["close"]) for r in merged.collect()) == [2.0] * 2 + [10.0] * 8


def test_bounded_load_prunes_partitions(spark, scratch):
    B.write_partitioned(ten(spark).drop("seq"), f"{scratch}/bronze_prices")
    wanted = spark.createDataFrame([("AAA",)], "code string")
    out = B.select_range(B.read_bronze(spark, scratch, "bronze_prices"), wanted, "2024-01-02", "2024-01-03")
    assert sorted(r["date"].day for r in out.collect()) == [2, 3]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_ordered_extract_reads_back_in_order(spark, scratch):
    import glob
    import json
    B.write_ordered(ten(spark).select("code", "date", "volume").repartition(5), f"{scratch}/x", ["volume"])
    rows = [json.loads(line)["volume"] for f in sorted(glob.glob(f"{scratch}/x/part-*")) for line in open(f)]
    assert rows == list(range(100, 110))


def test_a_stored_partition_lies_in_few_files(spark, scratch):
    """Files grow with tasks plus partitions, not with their product: a first load, and a merge with a large batch."""
    rows = spark.range(24 * 60).select(F.concat(F.lit("C"), F.col("id") % 60).alias("code"), F.add_months(F.lit(dt.date(2020, 1, 31)), (F.col("id") / 60).cast("int")).alias("date"),
                                       F.lit(1.0).cast("decimal(18,4)").alias("close"))
    tasks, months = 8, 24
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        B.write_partitioned(rows, f"{scratch}/t", grain=B.YEAR_MONTH)
        stored = spark.read.parquet(f"{scratch}/t")
        assert len(stored.inputFiles()) <= tasks + months
        new = B.with_grain(rows.withColumn("close", F.lit(2.0).cast("decimal(18,4)")).filter("code < 'C3'"), B.YEAR_MONTH)
        for small in (True, False):
            out = B.upsert_rows(stored, new, ("code", "date"), small, B.YEAR_MONTH)
            out.write.mode("overwrite").partitionBy("year", "month").parquet(f"{scratch}/m{small}")
            back = spark.read.parquet(f"{scratch}/m{small}")
            assert back.count() == 24 * 60 and back.filter("close = 2").count() == new.count()
        assert len(spark.read.parquet(f"{scratch}/mFalse").inputFiles()) <= tasks + months
    finally:
        spark.conf.unset(setting)
