"""Row history as Parquet by month of the end of validity: reads at a time and expiry go by folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metafleet.operators import history

MONTH = "_month"


class MonthlyHistory:
    """The closed versions of a table under ``path``, as ``operators.history.history_append`` gives them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def append(self, closed: DataFrame) -> None:
        """Adds closed versions; old folders aren't read or written again."""
        closed.hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).option("compression", "zstd").parquet(self.path)

    def read(self) -> DataFrame | None:
        """All versions that haven't expired, or None before the first."""
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def as_of(self, current: DataFrame, t) -> DataFrame:
        """The rows as they were at ``t``: a version that was valid then ended in that month or later."""
        rows = self.read()
        if rows is None:
            return current.where(F.col("_ModifyDate") <= F.lit(t))
        return history.as_of(current, rows.where(F.col(MONTH) >= history.month(F.lit(t))).drop(MONTH), t)

    def between(self, current: DataFrame, start, end) -> DataFrame:
        """All versions that were valid at some time from ``start`` to ``end``."""
        rows = self.read()
        none = history.all_versions(current, current.withColumns({c: F.col("_ModifyDate") for c in ("_ValidFrom", "_ValidTo")}).limit(0))
        old = none.limit(0) if rows is None else rows.where(F.col(MONTH) >= history.month(F.lit(start))).drop(MONTH)
        return history.between(current, old, start, end)

    def months(self) -> list[int]:
        """The months that have a folder."""
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{MONTH}=") and n.split("=")[1].isdigit())

    def expire(self, now, months: int = 6) -> list[int]:
        """Deletes the folders of versions that ended longer ago than so many months, without reading a row.

        The month that the limit lies in stays; ``expire_history`` passes over its older versions.
        """
        first = self.spark.range(1).select(history.month(F.lit(now).cast("timestamp_ntz") - F.make_interval(months=F.lit(months)))).first()[0]
        gone = [m for m in self.months() if m < first]
        for m in gone:
            self._fs.delete(self._path(f"{self.path}/{MONTH}={m}"), True)
        return gone
