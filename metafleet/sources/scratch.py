"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []

#: Spark's setting that deletes a query's shuffle files at its end, and how many writes of this process want it now.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writing, _was = threading.Lock(), 0, None


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in local mode a temporary one where that is unset.

    A cluster without the setting is an error: a machine-local folder would lose data there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go as each write ends; else they stay until the driver collects its garbage."""
    global _writing, _was
    with _lock:
        _writing += 1
        if _writing == 1:
            _was = spark.conf.get(_CLEAN)
            spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        with _lock:
            _writing -= 1
            if not _writing:
                spark.conf.set(_CLEAN, _was)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new path of the shared folder and read again: computed once, whoever reads it.

    It cuts the lineage and survives lost executors. Its shuffle files go at once.
    """
    path = new_path(df.sparkSession, name)
    _made.append(path)
    with _cleaned(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def outcome(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, ``written``; what was written on the way goes, so no other thread may write meanwhile."""
    before = len(_made)
    out = written(make(), name)
    path = _made.pop()
    while len(_made) > before:
        dropped(out.sparkSession, _made.pop())
    _made.append(path)
    return out


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a path of the shared folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``written`` has written inside: for work whose result has been stored by then."""
    before = len(_made)
    try:
        yield
    finally:
        while len(_made) > before:
            dropped(spark, _made.pop())
