"""Spark session helpers.

The library never creates a session inside an operator; callers pass one in.
``build_session`` is for scripts and tests. ``checkpoint_root`` reads the
shared folder the cluster names in ``spark.checkpoint.dir``; only a local
session without that setting gets a scratch folder of its own.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Session settings the engine is designed for. AQE re-plans joins at runtime
# (broadcast when a side turns out small, skew splitting otherwise) and
# coalesces small shuffle partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Joins between frames that are already hash-partitioned by symbol may
    # reuse that partitioning (symbol groups are bounded by the number of
    # trading days, see README "Scale").
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tickwell", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(ENGINE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folders made for local sessions whose settings name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. A session
    whose tasks run in the driver's own process (``local[n]``, as in tests)
    gets one new folder for its lifetime; any other session without the
    setting is refused, because its executors would each write to their own
    disk and later reads would miss rows.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that the driver and all executors share (master {master})")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tickwell-ckpt-")
    return _LOCAL_ROOTS[app]
