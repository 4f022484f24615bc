"""Which stored files are current: numbered publications.

``<root>/_published/<n>.json`` is written once, after all it names is in place, and the highest complete number counts.
Readers resolve it, so they see everything of one publication or everything of the one before; a run that stops at any
point before has changed nothing. A writer publishes the number after the one it started from. The file is created only
if absent, so of two writers that started from the same one the second is refused (``Conflict``) and can start again.

What a publication says is the caller's (a mapping that JSON can hold). On an object store whose ``create`` doesn't
refuse an existing file, writers have to be kept apart by the scheduler.
"""

from __future__ import annotations

import json
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_published"
#: An unfinished file this old is one of a writer that ended; its number is free again.
STALE_SECONDS = 600


class Conflict(RuntimeError):
    """Another writer has published since this one started."""


def filesystem(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, p = filesystem(spark, f"{root}/{FOLDER}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def _path(root: str, number: int) -> str:
    return f"{root}/{FOLDER}/{number:08d}.json"


def read(spark: SparkSession, root: str, number: int) -> dict | None:
    """A publication, or None where its file is not complete."""
    fs, p = filesystem(spark, _path(root, number))
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The number of the last complete publication and what it says; (0, {}) where there is none."""
    for number in _numbers(spark, root):
        if (state := read(spark, root, number)) is not None:
            return number, state
    return 0, {}


def publish(spark: SparkSession, root: str, started_from: int, state: dict) -> int:
    """Publishes ``state`` as the number after ``started_from``; raises ``Conflict`` if that one is taken."""
    number = started_from + 1
    fs, p = filesystem(spark, _path(root, number))
    if fs.exists(p) and read(spark, root, number) is None and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 > STALE_SECONDS:
        fs.delete(p, False)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception):
            raise Conflict(f"publication {number} of {root} is another writer's") from e
        raise
    try:
        out.write(json.dumps(state).encode("utf-8"))
    finally:
        out.close()
    return number


def forget(spark: SparkSession, root: str, before: int) -> None:
    """Removes the files of publications before a number; readers of older ones keep what they resolved."""
    for number in _numbers(spark, root):
        if number < before:
            fs, p = filesystem(spark, _path(root, number))
            fs.delete(p, False)
