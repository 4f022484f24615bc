"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root


BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Holds the session's Arrow batches to BATCH_BYTES, in the executors' buffers and in their Python workers, so that
    long texts don't make them large; a lower setting stays. A batch has one row at least, whatever its length."""
    now = spark.conf.get(_BATCH_SETTING).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


class Scratch:
    """One folder under ``spark.checkpoint.dir`` for the tables of one call.

    A saved table is computed once and read back by every later branch, so a lost executor costs the tasks it ran
    and no earlier stage. Its size on disk is exact, so the planner broadcasts it only where it is small.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        bounded_batches(spark)
        self.spark = spark
        self.folder = f"{checkpoint_root(spark)}/tables/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by name, whatever characters the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
