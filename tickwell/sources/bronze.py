"""Bronze sources and maintenance: read, normalise, validate, de-duplicate,
upsert, and year-partitioned writes.

The landing zone is files (Parquet, JSON lines or CSV) with the landing
contract ``time, open, high, low, close, volume`` per symbol, or the bar
contract ``code, date, open, high, low, close, volume, source``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from .. import schemas
from ..functions.columns import tag_source
from . import published as P


class ContractError(ValueError):
    """Landing or bar data that breaks the column contract."""


# --- storage ------------------------------------------------------------------

def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists, in whatever store it names. A listing that
    fails raises: it never reads as "no table yet"."""
    fs, p = P.filesystem(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = P.filesystem(spark, path)
    fs.delete(p, True)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    fs, a = P.filesystem(spark, old)
    b = P.filesystem(spark, new)[1]
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"could not rename {old} to {new}")


# --- IO1 / IO13 -------------------------------------------------------------

def read_bronze(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """IO1: read a bronze table (``bronze_prices``, ``bronze_index`` or
    ``bronze_components``) with its explicit schema. The partition columns
    (``year``, ``month``) stay, so that ``select_range`` prunes the scan."""
    schema = schemas.COMPONENTS if name.endswith("components") else schemas.BRONZE_BARS
    return read_stored(spark, f"{root}/{name}", fmt, schema)


def read_stored(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A stored table as last published: the folders that the publication
    names, read whole, whatever a writer is adding meanwhile. A table that
    no upsert has published is read from its folder."""
    reader = spark.read.format(fmt) if schema is None else spark.read.format(fmt).schema(schema)
    number, state = P.latest(spark, path)
    if not number:
        return reader.load(path)
    if "folder" in state:
        return reader.load(f"{path}/{state['folder']}")
    plain = [f"{path}/{x}" for x in state["parts"] if "/load=" not in x]
    loads = [f"{path}/{x}" for x in state["parts"] if "/load=" in x]
    reader = reader.option("basePath", path)
    frames = [reader.load(x) for x in (plain, loads) if x]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.drop("load") for f in frames])


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(P.latest(spark, path)[0]) or path_exists(spark, path)


# Partition grains: the reference's layout is by year. ("year", "month")
# bounds what a daily upsert rewrites to one month instead of one year.
YEAR = ("year",)
YEAR_MONTH = ("year", "month")


def with_grain(df: DataFrame, grain=YEAR, date: str = "date") -> DataFrame:
    out = df.withColumn("year", F.year(F.col(date)))
    return out.withColumn("month", F.month(F.col(date))) if "month" in grain else out


def _period(c_year: Column, c_month: Column | None) -> Column:
    return c_year if c_month is None else c_year * 100 + c_month


def select_range(df: DataFrame, symbols=None, start=None, end=None,
                 code: str = "code", date: str = "date") -> DataFrame:
    """IO13 / P10: bars of the listed symbols between start and end, both
    inclusive. ``symbols`` is a short list, or a frame with a ``code`` column
    (a universe that grows with the listing stays off the driver: it is a
    semi join). When the frame carries the partition columns (``year``, and
    ``month`` for the finer grain) the implied bounds on them are added so
    the scan prunes partitions."""
    cond = F.lit(True)
    month = "month" in df.columns and "year" in df.columns
    part = _period(F.col("year"), F.col("month") if month else None)

    def bound(d):
        d = F.lit(d).cast("date")
        return _period(F.year(d), F.month(d) if month else None)

    if symbols is not None and not isinstance(symbols, DataFrame):
        cond = cond & F.col(code).isin(list(symbols))
    if start is not None:
        cond = cond & (F.col(date) >= F.lit(start).cast("date"))
        if "year" in df.columns:
            cond = cond & (part >= bound(start))
    if end is not None:
        cond = cond & (F.col(date) <= F.lit(end).cast("date"))
        if "year" in df.columns:
            cond = cond & (part <= bound(end))
    out = df.filter(cond)
    if isinstance(symbols, DataFrame):
        wanted = symbols.select(F.col("code").alias("_wanted"))
        out = out.join(wanted, F.col(code) == F.col("_wanted"), "left_semi")
    return out


# --- IO2 / IO3 / IO5 ---------------------------------------------------------

def require_columns(df: DataFrame, cols=C.BAR_COLUMNS) -> DataFrame:
    """IO3: raise when a required column is missing (schema check only, no
    job)."""
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ContractError(f"Missing required columns: {missing}")
    return df


def normalise_bars(df: DataFrame, code: str | Column | None = None, source: str = "VCI") -> DataFrame:
    """IO2: landing frame -> bar contract. ``time`` becomes ``date`` (a text
    that is no date becomes null, which the audit counts as a null key),
    the symbol comes from ``code`` (a literal, a column, or the frame's own
    ``code`` column), the source is tagged ``<prefix>_<source>``."""
    require_columns(df, C.LANDING_COLUMNS if "time" in df.columns else ("date", "open", "high", "low", "close", "volume"))
    date_col = "time" if "time" in df.columns else "date"
    if code is None:
        require_columns(df, ["code"])
        code_col = F.col("code")
    else:
        code_col = code if isinstance(code, Column) else F.lit(code)
    src = F.col("source") if "source" in df.columns and source is None else tag_source(F.lit(source))
    return df.select(
        code_col.cast("string").alias("code"),
        F.col(date_col).try_cast("date").alias("date"),
        F.col("open").cast(schemas.PRICE).alias("open"),
        F.col("high").cast(schemas.PRICE).alias("high"),
        F.col("low").cast(schemas.PRICE).alias("low"),
        F.col("close").cast(schemas.PRICE).alias("close"),
        F.col("volume").cast("bigint").alias("volume"),
        src.alias("source"),
    )


def union_bars(dfs) -> DataFrame:
    """IO5 / U1: UNION ALL by column name."""
    dfs = list(dfs)
    if not dfs:
        raise ContractError("union_bars needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b), dfs)


# --- IO4 ---------------------------------------------------------------------

def audit_bars(df: DataFrame) -> DataFrame:
    """IO4: one-row content audit (counts only; nothing is dropped)."""
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_if(F.col("code").isNull()).cast("bigint").alias("null_code"),
        F.count_if(F.col("date").isNull()).cast("bigint").alias("null_date"),
        F.count_if(F.col("open") <= 0).cast("bigint").alias("nonpositive_open"),
        F.count_if(F.col("high") <= 0).cast("bigint").alias("nonpositive_high"),
        F.count_if(F.col("low") <= 0).cast("bigint").alias("nonpositive_low"),
        F.count_if(F.col("close") <= 0).cast("bigint").alias("nonpositive_close"),
        F.count_if(F.col("volume") < 0).cast("bigint").alias("negative_volume"),
    )


def check_audit(df: DataFrame) -> dict:
    """Run the audit (one small job, one row to the driver). An empty batch
    raises; a null key rejects the batch (the key constraint of the table)."""
    row = audit_bars(df).first().asDict()
    if row["rows"] == 0:
        raise ContractError("batch is empty")
    check_keys(row)
    return row


def check_keys(row: dict) -> None:
    if row["null_code"] or row["null_date"]:
        raise ContractError(f"batch has null keys: code={row['null_code']} date={row['null_date']}")


def key_is_null(keys=("code", "date")) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


# --- IO6 / IO7 / IO8 ---------------------------------------------------------

def dedup_last(df: DataFrame, keys, order) -> DataFrame:
    """IO6: keep the last row per key under ``order`` (a column name or a
    list of them, compared left to right, null first). Rows that tie are told
    apart by their other columns, so the survivor never depends on the input
    order.

    One ``row_number``: one exchange and one sort. The planner keeps only the
    first row per key and task before the exchange (a group limit), so a key
    with many copies never gathers its raw rows in one task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *rest]])
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def batch_order(columns, seq: str = "seq") -> list[str]:
    """Which of a batch's duplicate bars is the last: the highest ``seq``
    where there is one, else the latest ``ingested_at``, then ``source``."""
    return [seq] if seq in columns else [c for c in ("ingested_at", "source") if c in columns]


def upsert_bronze(existing: DataFrame, batch: DataFrame, keys=("code", "date"), seq: str = "seq", unique: bool = False) -> DataFrame:
    """IO7: merged table after upserting ``batch`` into ``existing`` on
    ``keys``: a batch row replaces every non-key column of a stored row; of
    the batch's own duplicates the last stays (``unique``: it has none).
    Idempotent.

    Stored rows only pass an anti join with the batch's keys: the batch is
    the small side, and when the planner broadcasts it no stored row moves."""
    cols = [c for c in existing.columns if c != seq]
    new = (batch if unique else dedup_last(batch, list(keys), batch_order(batch.columns, seq))).select(*cols)
    return existing.select(*cols).join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def replace_components(spark: SparkSession, codes: DataFrame, path: str) -> int:
    """IO8: truncate-and-load the constituent list with distinct codes; an
    empty list is a no-op (the stored list is kept). Returns the count.

    The list is written into a folder of its own, and a publication names it
    then: readers (``read_stored``) have the old list or the new one, also
    when a run ends in between, and the input may be the stored list."""
    number, state = P.latest(spark, path)
    distinct = codes.select(F.col("code").cast("string")).filter(F.col("code").isNotNull()).distinct()
    folder, seen = f"_list-{uuid.uuid4().hex}", Observation()
    (distinct.withColumn("ingested_at", F.current_timestamp()).observe(seen, F.count(F.lit(1)).alias("n"))
     .write.parquet(f"{path}/{folder}"))
    if seen.get["n"]:
        P.publish(spark, path, number, {"folder": folder, "before": state.get("folder")})
        P.forget(spark, path, number)
        if state.get("before"):  # readers of the list just replaced can finish
            delete_path(spark, f"{path}/{state['before']}")
    else:
        delete_path(spark, f"{path}/{folder}")
    return seen.get["n"]


# --- IO9 / IO10 / IO12 -------------------------------------------------------

def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """IO9: a fully rebuilt table."""
    df.write.mode("overwrite").format(fmt).save(path)


#: Rows of a Parquet page: the page index tells a reader of one symbol which pages of a file sorted by symbol hold it.
PAGE_ROWS = 512


def by_symbol_writer(df: DataFrame, key: str):
    """A Parquet writer for rows sorted by ``key``: small pages, and a Bloom filter by which files without a symbol are
    passed over."""
    return (df.write.option("parquet.page.row.count.limit", PAGE_ROWS)
            .option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true"))


def write_partitioned(df: DataFrame, path: str, date: str = "date", mode: str = "overwrite",
                      cluster_by=("code",), grain=YEAR) -> None:
    """IO10: table partitioned by year (or by year and month); any year is
    accepted.

    Rows are dealt in ranges of (partition, code), not by the partition
    alone: one year can hold a large share of all rows, and dealing by it
    alone would put each year in one task. A task holds a few neighbouring
    partitions or a part of one, so there are at most as many files as tasks
    and partitions together. Each is sorted by (code, date) so row-group
    statistics on the key prune well for the readers."""
    out = with_grain(df, grain, date)
    keys = [c for c in cluster_by if c in out.columns]
    if keys:
        out = out.repartitionByRange(*grain, *keys)
    dealt = out.sortWithinPartitions(*grain, *keys, date)
    writer = by_symbol_writer(dealt, keys[0]) if keys else dealt.write
    writer.mode(mode).partitionBy(*grain).parquet(path)


#: Rows of a batch from which on a merge deals all rows of the partitions it rewrites anew.
LARGE_BATCH = 250_000


def write_csv(df: DataFrame, path: str) -> None:
    """IO12: CSV with a header; dates as yyyy-MM-dd."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_ordered(df: DataFrame, path: str, order, fmt: str = "json") -> None:
    """T5: an extract in order: range-partitioned and sorted, so the files in
    name order hold the rows in ``order`` (column names or columns)."""
    order = [order] if isinstance(order, str | Column) else list(order)
    out = df.orderBy(*order).write.mode("overwrite")
    out = out.option("header", True) if fmt == "csv" else out
    out.format(fmt).save(path)


def stored_grain(columns) -> tuple[str, ...]:
    return tuple(c for c in YEAR_MONTH if c in columns)


def upsert_into(spark: SparkSession, batch: DataFrame, path: str, staging_root: str,
                keys=("code", "date"), seq: str = "seq", grain=None) -> int:
    """IO7 writer: merge ``batch`` into the partitioned bronze table at
    ``path``, rewriting only the partitions (years, or months with the finer
    grain) the batch touches. Returns the batch's bars after de-duplication.

    * Columns and grain are the stored table's; ``grain`` (by default years)
      counts for the first load only. A stored column that the batch lacks
      is null in its bars; a column that the table lacks is refused.
    * The batch is evaluated once: its last bars are stored, and its rows and
      null keys are counted as they pass. A null key refuses the batch.
    * Any failure to read the stored table is raised.
    * All or nothing: the merged partitions are written beside the stored
      ones, each in a folder of this load, and one publication then names
      the folders of every partition. Readers (``read_stored``) follow it.
      Of two writers that started from the same publication the second is
      refused (``published.Conflict``) and has changed nothing. The folders
      that the publication before still names stay for its readers."""
    number, state = P.latest(spark, path)
    load = f"b{uuid.uuid4().hex}"
    work = f"{staging_root}/upsert-{load}"
    try:
        return _upsert(spark, batch, path, keys, seq, grain, number, state, load, work)
    finally:
        delete_path(spark, work)


def _upsert(spark, batch, path, keys, seq, grain, number, state, load, work) -> int:
    stored = read_stored(spark, path) if number or path_exists(spark, path) else None
    if stored is None:
        grain, columns = grain or YEAR, [c for c in batch.columns if c != seq]
    else:
        grain = stored_grain(stored.columns)
        columns = [c for c in stored.columns if c not in grain]
        if unknown := sorted(set(batch.columns) - set(columns) - {seq}):
            raise ContractError(f"the table at {path} has no columns {unknown}")
    audit = Observation()
    counted = batch.observe(audit, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys])
    last = dedup_last(counted, list(keys), batch_order(batch.columns, seq))
    if stored is not None:
        kinds = stored.schema
        last = last.select(*[(F.col(c) if c in last.columns else F.lit(None)).cast(kinds[c].dataType).alias(c) for c in columns])
    last.select(*columns).write.parquet(f"{work}/batch")
    if audit.get["rows"] == 0:
        return 0
    if any(audit.get[f"null_{k}"] for k in keys):
        raise ContractError("batch has null keys: " + " ".join(f"{k}={audit.get[f'null_{k}']}" for k in keys))
    new = spark.read.schema(last.select(*columns).schema).parquet(f"{work}/batch")
    if stored is None:
        write_partitioned(new, f"{work}/table", grain=grain)
    else:
        month = "month" in grain
        period = _period(F.year("date"), F.month("date") if month else None).alias("_p")
        # One value per touched partition: bounded by the calendar.
        touched = [r["_p"] for r in new.select(period).distinct().collect()]
        part = _period(F.col("year"), F.col("month") if month else None)
        merged = upsert_rows(with_grain(stored.filter(part.isin(touched)).select(*columns), grain), with_grain(new, grain), keys, new.count() < LARGE_BATCH, grain)
        by_symbol_writer(merged.sortWithinPartitions(*grain, *keys), keys[0]).partitionBy(*grain).parquet(f"{work}/table")
    fresh = _partitions(spark, f"{work}/table", len(grain))
    parts = state.get("parts") if number else _partitions(spark, path, len(grain)) if stored is not None else []
    kept = [x for x in parts if x.split("/load=")[0] not in fresh]
    for x in fresh:
        rename_path(spark, f"{work}/table/{x}", f"{path}/{x}/load={load}")
    P.publish(spark, path, number, {"parts": sorted(kept + [f"{x}/load={load}" for x in fresh]), "before": sorted(parts)})
    P.forget(spark, path, number)
    for x in set(state.get("before", [])) - set(parts):
        _drop_part(spark, path, x)
    return new.count()


def upsert_rows(stored: DataFrame, new: DataFrame, keys, small: bool, grain) -> DataFrame:
    """The rows that a merge writes, dealt so that a task holds few partitions. Stored files are dealt already: under a
    ``small`` batch, whose keys go to every task, their rows stay in the tasks that read them. A large batch's keys meet
    them through a shuffle, after which every task would hold rows of every partition."""
    if small:
        return upsert_bronze(stored, new.repartitionByRange(*grain, *keys), keys, unique=True)
    return upsert_bronze(stored, new, keys, unique=True).repartitionByRange(*grain, *keys)


def _drop_part(spark: SparkSession, path: str, part: str) -> None:
    """A partition's superseded folder; of one from before the first publication the files alone."""
    if "/load=" in part:
        delete_path(spark, f"{path}/{part}")
        return
    fs, p = P.filesystem(spark, f"{path}/{part}")
    for s in fs.listStatus(p) if fs.exists(p) else []:
        if s.isFile():
            fs.delete(s.getPath(), False)


def _partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The partition folders under ``path``, relative to it."""
    out = [""]
    for _ in range(depth):
        found = []
        for x in out:
            fs, p = P.filesystem(spark, f"{path}/{x}" if x else path)
            names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
            found += [f"{x}/{n}" if x else n for n in names if "=" in n]
        out = found
    return sorted(out)
