"""Daily bar ingestion as a Structured Streaming job.

New landing files (bar contract: code, date, open, high, low, close, volume,
source, optional ingested_at) are picked up by a file stream. Rows with a
null key are set aside under ``<staging_root>/rejected/stream=<id>/epoch=<n>``
(one bad file doesn't stop the stream; a stream with a new checkpoint has an
id of its own, so nothing set aside before is replaced); the rest of each
micro-batch is upserted into the partitioned bronze table, of duplicate
(code, date) the latest ``ingested_at``, rewriting only the partitions it
touches. ``ingested_at`` is stored.

The upsert is idempotent, so a micro-batch replayed after a failure (the
sink is at-least-once, the checkpoint tracks which files were read) leaves
the table unchanged. ``trigger(availableNow=True)`` processes what has
landed and stops, which matches a daily schedule.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..sources import bronze as B

LANDING_BARS = T.StructType([f for f in schemas.BRONZE_BARS.fields if f.name != "raw_json"])


def landing_stream(spark: SparkSession, landing_dir: str, fmt: str = "json",
                   schema: T.StructType = LANDING_BARS) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("header", True).load(landing_dir)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint gives its stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def _batch_writer(bronze_path: str, staging_root: str, checkpoint: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        B.require_columns(batch)
        # The audit and the upsert both read the micro-batch: keep it for the
        # duration of this write (recomputed from the landing files if lost).
        batch = batch.persist()
        try:
            bad = B.key_is_null()
            audit = B.audit_bars(batch).first()
            if audit["null_code"] or audit["null_date"]:
                stream = _stream_id(batch.sparkSession, checkpoint)
                batch.filter(bad).write.mode("overwrite").json(f"{staging_root}/rejected/stream={stream}/epoch={epoch_id}")
            B.upsert_into(batch.sparkSession, batch.filter(~bad), bronze_path, staging_root)
        finally:
            batch.unpersist()
    return write


def start_bronze_ingest(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint: str,
                        staging_root: str, fmt: str = "json", available_now: bool = True) -> StreamingQuery:
    writer = (landing_stream(spark, landing_dir, fmt).writeStream
              .foreachBatch(_batch_writer(bronze_path, staging_root, checkpoint))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
