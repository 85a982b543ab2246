"""Two-pass external shuffle (operator 10).

Pass one scatters the records uniformly over buckets that fit in memory, by a seeded hash of their
contents. Pass two shuffles each bucket with a seeded Fisher-Yates pass. A record's place in the
whole order is its bucket's offset plus its place in the bucket, so only one count per bucket is
summed up outside the tasks. The offsets meet the buckets in the same shuffle, so texts move once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of records that a bucket holds on average.
BUCKET_BYTES = 16 << 20


def record_size(text) -> F.Column:
    """UTF-8 bytes of the text (null: none) plus 8 for the id."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """Where each of n records goes: a Fisher-Yates pass with a seeded generator."""
    rng = np.random.default_rng(seed)
    order = np.arange(n)
    picks = (rng.random(max(n - 1, 0)) * np.arange(n, 1, -1)).astype(np.int64)
    order_list = order.tolist()
    for i, j in zip(range(n - 1, 0, -1), picks.tolist()):
        order_list[i], order_list[j] = order_list[j], order_list[i]
    out = np.empty(n, dtype=np.int64)
    out[np.asarray(order_list, dtype=np.int64)] = np.arange(n)
    return out


def _shuffle_bucket(rows: pa.Table, offset: pa.Table, seed: int, shards: int) -> pa.Table:
    """One bucket's rows in their new order, with shard and slot; the result does not depend on arrival order."""
    order = pa.compute.sort_indices(rows, [("_mf_rank", "ascending"), ("_mf_tie", "ascending")])
    start, n, bucket = (offset.column(c)[0].as_py() for c in ("_mf_from", "_mf_all", "_mf_bucket"))
    place = fisher_yates(len(rows), (seed << 20) ^ bucket)
    back = np.empty(len(rows), dtype=np.int64)
    back[place] = order.to_numpy()
    at = start + np.arange(len(rows))
    # Shard s holds the places from ceil(s * n / shards) on.
    shard = at * shards // n
    slot = at - (shard * n + shards - 1) // shards
    kept = rows.select(["doc_id", "text"]).take(pa.array(back))
    return kept.append_column("shard", pa.array(shard, pa.int32())).append_column("slot", pa.array(slot))


def two_pass_shuffle(docs: DataFrame, shards: int = 24, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows of ``docs`` (id and text) in a random order: doc_id, text, shard, slot.

    Shards hold consecutive parts of the order; their row counts differ by one at most, and slots
    of a shard run from 0 without gaps. Rows with null ids or texts are shuffled like the others;
    equal rows (same id and text) share a bucket, and it makes no difference which of them gets
    which of their places. A bucket holds at least one whole text, of whatever length. An empty table
    gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(record_size("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(buckets)).alias("_mf_bucket")

    counts = rows.select(bucket).groupBy("_mf_bucket").agg(F.count("*").alias("n"))
    # One row per bucket of many MB: the running sum is over the bucket counts only.
    before = Window.orderBy("_mf_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_mf_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_mf_from"), F.sum("n").over(Window.partitionBy()).alias("_mf_all"))

    scattered = rows.select("doc_id", "text", bucket, F.xxhash64(F.lit(seed + 1), "doc_id", "text").alias("_mf_rank"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_mf_tie"))
    both = scattered.groupBy("_mf_bucket").cogroup(offsets.groupBy("_mf_bucket"))
    return both.applyInArrow(lambda rows, offset: _shuffle_bucket(rows, offset, seed, shards), "doc_id long, text string, shard int, slot long")


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write the shuffled rows: a folder per shard, of files that hold buckets in slot order; no further shuffle."""
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_shards`` wrote: doc_id, text, slot, shard."""
    return spark.read.schema("doc_id long, text string, slot long, shard int").parquet(path)
