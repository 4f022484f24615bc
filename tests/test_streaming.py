"""Landing files -> bronze through Structured Streaming (availableNow)."""

import json
import os

from tickwell.sources import bronze as B
from tickwell.streaming.landing import start_bronze_ingest


def land(dirpath, name, rows):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def bar(code, date, close, ts="2024-01-05T00:00:00"):
    return {"code": code, "date": date, "open": 10.0, "high": 12.0, "low": 9.0, "close": close,
            "volume": 100, "source": "feed", "ingested_at": ts}


def run(spark, scratch):
    q = start_bronze_ingest(spark, f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/chk", f"{scratch}/stage")
    q.awaitTermination(120)
    assert q.exception() is None


def test_ingest_dedup_and_upsert(spark, scratch):
    land(f"{scratch}/landing", "a.json", [bar("A", "2023-12-29", 10.0), bar("A", "2024-01-02", 11.0),
                                          bar("A", "2024-01-02", 11.5, "2024-01-06T00:00:00"),
                                          bar("B", "2024-01-02", 20.0)])
    run(spark, scratch)
    t = B.read_stored(spark, f"{scratch}/bronze")
    got = {(r["code"], str(r["date"])): float(r["close"]) for r in t.collect()}
    assert got == {("A", "2023-12-29"): 10.0, ("A", "2024-01-02"): 11.5, ("B", "2024-01-02"): 20.0}

    land(f"{scratch}/landing", "b.json", [bar("B", "2024-01-02", 21.0, "2024-01-07T00:00:00"),
                                          bar("B", "2024-01-03", 22.0)])
    run(spark, scratch)
    t = B.read_stored(spark, f"{scratch}/bronze")
    got = {(r["code"], str(r["date"])): float(r["close"]) for r in t.collect()}
    assert got[("B", "2024-01-02")] == 21.0 and got[("B", "2024-01-03")] == 22.0 and len(got) == 4
    assert sorted(r["year"] for r in t.select("year").distinct().collect()) == [2023, 2024]


def test_null_keys_are_set_aside_and_the_stream_goes_on(spark, scratch):
    land(f"{scratch}/landing", "bad.json", [bar(None, "2024-01-02", 10.0), bar("A", "2024-01-02", 11.0), bar("B", None, 9.0)])
    run(spark, scratch)
    t = B.read_stored(spark, f"{scratch}/bronze")
    assert [(r["code"], r["ingested_at"] is not None) for r in t.collect()] == [("A", True)]
    assert spark.read.json(f"{scratch}/stage/rejected").count() == 2
    q = start_bronze_ingest(spark, f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/chk2", f"{scratch}/stage")
    q.awaitTermination(120)
    assert q.exception() is None
    assert spark.read.json(f"{scratch}/stage/rejected").count() == 4  # a new checkpoint replaces nothing set aside before
    land(f"{scratch}/landing", "good.json", [bar("C", "2024-01-03", 12.0)])
    run(spark, scratch)
    assert B.read_stored(spark, f"{scratch}/bronze").count() == 2


def test_replayed_batch_leaves_table_unchanged(spark, scratch):
    land(f"{scratch}/landing", "a.json", [bar("A", "2024-01-02", 11.0), bar("B", "2024-01-02", 20.0),
                                          bar("B", "2024-01-03", 21.0)])
    run(spark, scratch)
    first = sorted(B.read_stored(spark, f"{scratch}/bronze").collect())
    # A new stream checkpoint replays every landed file, as after a failure
    # between the sink write and the checkpoint commit.
    q = start_bronze_ingest(spark, f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/chk2", f"{scratch}/stage")
    q.awaitTermination(120)
    assert q.exception() is None
    assert sorted(B.read_stored(spark, f"{scratch}/bronze").collect()) == first
