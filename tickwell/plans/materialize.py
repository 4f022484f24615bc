"""Lineage cuts for frames that several branches of a plan reuse.

``checkpointed`` writes the frame as a Parquet table under the shared folder
named by ``spark.checkpoint.dir`` and returns a frame that reads it back.
An eager ``Dataset.checkpoint`` computes the plan once for its action and
again to write the checkpoint files (unless it is also persisted); a
written table is computed once, is columnar, and lets each reader prune
columns. The files are on shared storage, so a lost executor loses nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import checkpoint_root


def checkpointed(df: DataFrame, name: str = "frame") -> DataFrame:
    path = f"{checkpoint_root(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
