"""Stored tables of a warehouse: daily tables by year and in buckets by symbol.

A daily table's rows lie in folders by year, in each year one file for each bucket of symbols, sorted by symbol and day.
A reader that takes it through ``Store.table`` gets Spark's own bucketed scan: rows come hash-partitioned by symbol, so
windows, gates and joins by symbol add no exchange, and the year partitions still prune. The catalog entry that tells
Spark so is made in the session, from the publication's list of (year, load, folder): nothing but the files and that list
is stored. A load is what one run wrote; the daily run adds folders or replaces those of a year.

All tables of a root change together, by one publication (``sources/published.py``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import bronze as B
from ..sources import published as P

KEY, DATE = "symbol", "trade_date"


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as shuffle partitions: a task then writes whole buckets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _ddl(df: DataFrame, without: set[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in without)


@contextmanager
def bucketed_scans(spark: SparkSession) -> Iterator[None]:
    """Stored buckets are read as such also where the plan alone wouldn't need it, as a table in the same buckets is
    written from it. The caller's setting is put back."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_daily(df: DataFrame, path: str, load: str, buckets: int) -> dict:
    """Writes a daily table; returns what a publication says of it. A ``year`` that rows have is that of their day. Rows that are hash-partitioned by symbol into
    ``buckets`` are written from where they are, at most ``buckets`` files a year; others are dealt so first."""
    spark = df.sparkSession
    rows = df if "year" in df.columns else B.with_grain(df, date=DATE)
    if not _dealt(rows, buckets):
        rows = rows.repartition(buckets, KEY)
    name = f"tickwell_{uuid.uuid4().hex}"
    B.by_symbol_writer(rows, KEY).format("parquet").mode("errorifexists").option("path", path).partitionBy("year").bucketBy(buckets, KEY).sortBy(KEY, DATE).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, as the path is the caller's
    fs, p = P.filesystem(spark, path)
    years = sorted(int(s.getPath().getName()[5:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("year="))
    return {"buckets": buckets, "columns": _ddl(df, {"year"}), "parts": [[y, load, f"{path}/year={y}"] for y in years]}


def _dealt(df: DataFrame, buckets: int) -> bool:
    """Whether the plan's rows are hash-partitioned by the key into so many partitions already."""
    kind = df._jdf.queryExecution().executedPlan()
    kind = (kind.inputPlan() if kind.nodeName() == "AdaptiveSparkPlan" else kind).outputPartitioning().toString()
    return kind.startswith(f"hashpartitioning({KEY}#") and kind.count("#") == 1 and kind.endswith(f", {buckets})")


def open_daily(spark: SparkSession, entry: dict) -> DataFrame:
    """A daily table as published, with ``year``; hash-partitioned by symbol where a query needs it."""
    name = f"tickwell_{uuid.uuid4().hex}"
    if not entry["parts"]:
        return spark.createDataFrame([], f"{entry['columns']}, year int")
    spark.sql(f"CREATE TABLE {name} ({entry['columns']}, year int, load string) USING parquet PARTITIONED BY (year, load) "
              f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}, {DATE}) INTO {entry['buckets']} BUCKETS LOCATION '{entry['parts'][0][2]}/_{name}'")
    spec = " ".join(f"PARTITION (year={y}, load='{load}') LOCATION '{where}'" for y, load, where in entry["parts"])
    spark.sql(f"ALTER TABLE {name} ADD {spec}")
    return spark.table(name).drop("load")


def latest_dates(spark: SparkSession, entry: dict, n: int = 1) -> list[date]:
    """The ``n`` latest distinct days of a daily table, latest first, from its last years on: a year is read only if the
    later ones have too few."""
    found: list[date] = []
    for year in sorted({p[0] for p in entry["parts"]}, reverse=True):
        mine = open_daily(spark, {**entry, "parts": [p for p in entry["parts"] if p[0] == year]})
        found += [r[DATE] for r in mine.select(DATE).distinct().orderBy(F.col(DATE).desc()).limit(n - len(found)).collect()]
        if len(found) == n:
            break
    return found


class Store:
    """The tables of a root as its last publication has them."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.number, state = P.latest(spark, root)
        self.tables: dict[str, dict] = state.get("tables", {})
        self.info: dict = state.get("info", {})

    def table(self, name: str) -> DataFrame:
        return open_entry(self.spark, self.tables[name])

    def publish(self, tables: dict[str, dict], info: dict) -> None:
        """Publishes ``tables``, all of one state, in place of the present ones. What only publications before the present
        one named is removed: readers that have resolved that one can finish."""
        spark, old = self.spark, self.number
        self.number = P.publish(spark, self.root, self.number, {"tables": tables, "info": info})
        kept = _folders(tables) | _folders(self.tables)
        for number in range(max(1, old - 1), old):
            before = P.read(spark, self.root, number) if B.path_exists(spark, P._path(self.root, number)) else None
            for folder in sorted(_folders((before or {}).get("tables", {})) - kept):
                B.delete_path(spark, folder)
        P.forget(spark, self.root, old)
        self.tables, self.info = tables, info


def open_entry(spark: SparkSession, entry: dict) -> DataFrame:
    return open_daily(spark, entry) if "buckets" in entry else spark.read.parquet(entry["path"])


def _folders(tables: dict[str, dict]) -> set[str]:
    return {x for e in tables.values() for x in ([p[2] for p in e["parts"]] if "parts" in e else [e["path"]])}
