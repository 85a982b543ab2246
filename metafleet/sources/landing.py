"""Landed snapshots: folders by scope and range of keys, and a digest of each, so that what didn't move is never read.

A range's digest is the sum of its rows' checksums, and the digests of a scope's ranges add up to the scope's checksum
(``operators.status.dataset_checksum``). So a gate reads the small digest table alone. The rows of a moved range are found by
dynamic partition pruning: the ranges that moved are a filter of the scan's folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metafleet.functions.keys import item_id
from metafleet.operators.merge import BOOKKEEPING, Merge, merge_snapshot
from metafleet.operators.status import dataset_checksum
from metafleet.sources.scratch import written

RANGE, SLOT = "_range", "_slot"
#: Ranges that are sent to every task, at most; more are joined by a shuffle.
SENT = 1 << 18


class Landing:
    """One run's snapshots of a dataset under ``path``; the ranges are ``ranges`` parts of the keys' hashes."""

    def __init__(self, spark: SparkSession, path: str, scope: Sequence[str], keys: Sequence[str], volatile: Sequence[str] = (), ranges: int = 16):
        self.spark, self.path, self.scope, self.keys, self.volatile, self.ranges = spark, path.rstrip("/"), list(scope), list(keys), list(volatile), ranges

    def range_of(self):
        """The range that a row's keys lie in."""
        return F.pmod(item_id(*self.keys), F.lit(self.ranges)).cast("int")

    def _slot(self):
        """The folder of a scope's range: one number, so that pruning goes by scope and range together."""
        return item_id(*self.scope, RANGE)

    def land(self, snapshot: DataFrame, scopes: DataFrame) -> Landing:
        """Writes the rows of the collected ``scopes`` and their digests. A scope may have come empty."""
        rows = snapshot.join(scopes.select(*self.scope).distinct(), self.scope, "left_semi").withColumn(RANGE, self.range_of())
        by, rows = [*self.scope, RANGE], rows.withColumn(SLOT, self._slot())
        rows.hint("rebalance", SLOT).write.partitionBy(SLOT).option("compression", "zstd").parquet(f"{self.path}/rows")
        rows.limit(0).write.parquet(f"{self.path}/schema")
        scopes.select(*self.scope).distinct().write.parquet(f"{self.path}/scopes")
        columns = [c for c in snapshot.columns if c not in {*self.scope, *self.volatile}]
        dataset_checksum(self.snapshot(), by, columns).write.parquet(f"{self.path}/digests")
        return self

    def snapshot(self) -> DataFrame:
        """All landed rows, with their range."""
        return self._stored().drop(SLOT)

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self.spark.read.parquet(f"{self.path}/schema").schema).parquet(f"{self.path}/rows")

    def scopes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/scopes")

    def digests(self) -> DataFrame:
        """(scope, _range, n_rows, checksum) of every range that has rows."""
        return self.spark.read.parquet(f"{self.path}/digests")

    def checksums(self) -> DataFrame:
        """(scope, n_rows, checksum) of every collected scope, rolled up from its ranges; no row is read."""
        total = F.sum(F.col("checksum").cast("decimal(38,0)")) % F.lit(1 << 62)
        sums = self.digests().groupBy(*self.scope).agg(F.sum("n_rows").alias("n_rows"), total.cast("long").alias("checksum"))
        out = self.scopes().join(sums, self.scope, "left")
        return out.select(*self.scope, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("checksum", F.lit(0).cast("long")).alias("checksum"))

    def moved(self, known: DataFrame, on_empty: str = "keep") -> DataFrame:
        """(scope, _range, moved): every range of the collected scopes, ``moved`` 1 if its digest isn't the one in ``known``.

        ``known``: the digests of the last landing that was merged. A range may have lost its last row. With
        ``on_empty="keep"`` scopes that came without any row have not moved.
        """
        by = [*self.scope, RANGE]
        new = self.digests().select(*by, F.col("checksum").alias("_new"), F.col("n_rows").alias("_n"))
        old = known.select(*by, F.col("checksum").alias("_old"), F.col("n_rows").alias("_m")).join(self.scopes(), self.scope, "left_semi")
        both = new.join(old, by, "full_outer")
        differs = ~F.col("_new").eqNullSafe(F.col("_old")) | ~F.col("_n").eqNullSafe(F.col("_m"))
        if on_empty == "keep":
            some = self.digests().select(*self.scope).distinct().withColumn("_some", F.lit(True))
            both = both.join(some, self.scope, "left")
            differs = differs & F.col("_some").isNotNull()
        return written(both.select(*by, differs.cast("int").alias("moved")), "moved")

    def rows(self, moved: DataFrame) -> DataFrame:
        """The rows of the moved ranges, or of moved scopes where ``moved`` has no ranges: only their folders are read."""
        hit = moved.where("moved = 1").select(*self.scope, *([RANGE] if RANGE in moved.columns else []))
        if RANGE not in hit.columns:
            hit = hit.withColumn(RANGE, F.explode(F.sequence(F.lit(0), F.lit(self.ranges - 1))))
        hit = hit.withColumn(SLOT, self._slot())
        sent = F.broadcast(hit) if hit.count() <= SENT else hit
        return self._stored().join(sent, hit.columns, "left_semi").drop(SLOT)


def merge_moved(current: DataFrame, landing: Landing, moved: DataFrame, as_of, **options) -> Merge:
    """``merge_snapshot`` of what moved: rows of other ranges stay as they are."""
    scope = [*landing.scope, RANGE]
    keyed = current.select(*[c for c in current.columns if c not in BOOKKEEPING], landing.range_of().alias(RANGE), *[c for c in BOOKKEEPING if c in current.columns])
    merge = merge_snapshot(keyed, landing.rows(moved), moved.where("moved = 1"), landing.keys, as_of, scope, on_empty="clear", volatile=landing.volatile, **options)
    drop = lambda side: F.when(F.col(side).isNotNull(), F.struct(*(F.col(f"{side}.{c}").alias(c) for c in current.columns))).alias(side)
    return Merge(merge.rows.select(*landing.scope, *landing.keys, "_action", drop("before"), drop("after")), [*landing.scope, *landing.keys])
