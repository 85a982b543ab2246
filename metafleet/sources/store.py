"""Current-state tables as Parquet, partitioned by a hash of the scope, so that a merge rewrites few partitions.

New partitions are written aside. A journal that names them appears by one rename, and then they move into the
place of the old ones. Until the journal is there every reader sees the old table, and from then on the new one:
a partition that hasn't moved yet is read where it was written. After a crash the next writer, or
``recover``, ends the moves. One writer per table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "_part"


class ScopedTable:
    """``path`` is in any file system that Spark reads and that renames folders in one step; ``scope`` are the columns that
    partitions are made of."""

    def __init__(self, spark: SparkSession, path: str, scope: list[str], parts: int = 64):
        self.spark, self.path, self.scope, self.parts = spark, path.rstrip("/"), scope, parts
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def part(self):
        return F.pmod(F.xxhash64(*self.scope), F.lit(self.parts)).cast("int")

    def exists(self) -> bool:
        return self._is(f"{self.path}/_schema/_SUCCESS")

    def touched(self, scopes: DataFrame) -> list[int]:
        """The partitions that scopes are in: as many numbers as there are partitions, at most."""
        return sorted(r[0] for r in scopes.select(self.part()).distinct().collect())

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """The table, or some partitions of it: only their folders are read."""
        schema = self.spark.read.parquet(f"{self.path}/_schema").schema
        journal = self._journal()
        if journal is None:
            rows = self.spark.read.schema(schema).parquet(self.path)
            return (rows if parts is None else rows.where(F.col(PART).isin(parts))).drop(PART)
        places = [self._place(p, journal) for p in (range(self.parts) if parts is None else parts)]
        places = [p for p in places if p and self._is(p)]
        plain = type(schema)([f for f in schema.fields if f.name != PART])
        return self.spark.read.schema(plain).parquet(*places) if places else self.spark.createDataFrame([], plain)

    def overwrite(self, df: DataFrame, parts: list[int] | None = None) -> None:
        """Replaces the partitions ``parts`` (default: all) by ``df``, which holds all of their rows.

        The rows may come from the partitions that they replace.
        """
        self.recover()
        rows = df.withColumn(PART, self.part())
        rows = rows if parts is None else rows.where(F.col(PART).isin(parts))
        aside = f"{self.path}/_aside-{uuid.uuid4().hex}"
        # Rebalancing splits large partitions and joins small ones into files of one size.
        rows.hint("rebalance", PART).write.partitionBy(PART).option("compression", "zstd").parquet(aside)
        if not self.exists():
            # Readers pass over it; a table without rows keeps its columns by it.
            self.spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{self.path}/_schema")
        full = [p for p in range(self.parts) if self._is(f"{aside}/{PART}={p}")]
        self._write(f"{self.path}/_journal", json.dumps({"aside": aside, "parts": list(range(self.parts)) if parts is None else parts, "full": full}))
        self.recover()

    def recover(self) -> None:
        """Ends the moves that the journal names, if there is one."""
        journal = self._journal()
        if journal is None:
            return
        for p in journal["parts"]:
            self._move(p, journal)
        self._fs.delete(self._path(journal["aside"]), True)
        self._fs.delete(self._path(f"{self.path}/_journal"), False)

    def mark(self, consumer: str, batch_id: int) -> None:
        """Remembers that a consumer's batch is in the table."""
        self._write(f"{self.path}/_applied/{consumer}", str(batch_id))

    def marked(self, consumer: str) -> int:
        """The last batch of a consumer that is in the table; -1 before the first."""
        return int(self._text(f"{self.path}/_applied/{consumer}") or -1)

    def _is(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _place(self, p: int, journal: dict) -> str | None:
        """The folder that holds a partition now; None if it has lost its rows."""
        own, aside = f"{self.path}/{PART}={p}", f"{journal['aside']}/{PART}={p}"
        if p not in journal["parts"]:
            return own
        return None if p not in journal["full"] else aside if self._is(aside) else own

    def _move(self, p: int, journal: dict) -> None:
        own, aside = self._path(f"{self.path}/{PART}={p}"), self._path(f"{journal['aside']}/{PART}={p}")
        if p not in journal["full"]:
            self._fs.delete(own, True)
        elif self._fs.exists(aside):
            self._fs.delete(own, True)
            self._fs.rename(aside, own)

    def _journal(self) -> dict | None:
        text = self._text(f"{self.path}/_journal")
        return json.loads(text) if text else None

    def _write(self, path: str, text: str) -> None:
        """A small file that is there as a whole or not at all."""
        new = self._path(f"{path}-{uuid.uuid4().hex}")
        stream = self._fs.create(new)
        stream.write(text.encode())
        stream.close()
        self._fs.delete(self._path(path), False)
        self._fs.rename(new, self._path(path))

    def _text(self, path: str) -> str | None:
        if not self._is(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
