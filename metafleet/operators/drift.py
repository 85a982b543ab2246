"""Where databases of a fleet differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metafleet.sources.scratch import written

#: Bits of a bitmap, as ``bitmap_construct_agg`` makes them.
BITS = 32_768
#: Scopes that are sent to every task, at most; more are joined by a shuffle.
SENT = 1 << 18


def presence_counts(items: DataFrame, scopes: DataFrame, item: Sequence[str], scope: str) -> DataFrame:
    """(item, present, missing): in how many of the scopes each item is and isn't."""
    n = scopes.select(scope).distinct().count()
    found = items.join(scopes.select(scope).distinct(), scope, "left_semi").groupBy(*item).agg(F.countDistinct(scope).alias("present"))
    return found.select(*item, "present", (F.lit(n) - F.col("present")).alias("missing"))


def _numbered(scopes: DataFrame, scope: str) -> tuple[DataFrame, int]:
    """(scope, _bucket, _bit) of every scope, and the number of buckets: a bitmap has 32,768 bits, and a bucket half as many scopes, about."""
    each = scopes.select(scope).where(F.col(scope).isNotNull()).distinct()
    buckets = max(1, -(-each.count() // (BITS // 2)))
    rows = each.withColumn("_bucket", F.pmod(F.xxhash64(scope), F.lit(buckets)).cast("int"))
    bit = F.row_number().over(Window.partitionBy("_bucket").orderBy(scope)) - 1
    return written(rows.withColumn("_bit", bit.cast("long")), "scopes"), buckets


def presence_drift(items: DataFrame, scopes: DataFrame, item: Sequence[str], scope: str) -> DataFrame:
    """(item, scope): every scope that lacks an item which some other has.

    The scopes are numbered, and an item's scopes become bitmaps, one for each bucket of the fleet. A bitmap that has all of its
    bucket's scopes leaves no row; of the others the bits that are not set name the scopes that lack the item. Null scopes don't count.
    """
    numbers, buckets = _numbered(scopes, scope)
    small = numbers.count() <= SENT
    sent = F.broadcast if small else lambda df: df
    bits = items.join(sent(numbers), scope).groupBy(*item, "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_have"))
    fleet = numbers.groupBy("_bucket").agg(F.collect_list(F.struct("_bit", scope)).alias("_all"))
    if buckets > 1:
        # Buckets of which an item is in no scope have no bitmap yet.
        bits = written(bits, "bitmaps")
        every = bits.select(*item).distinct().withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
        same = F.lit(True)
        for c in (*item, "_bucket"):
            same = same & F.col(f"e.{c}").eqNullSafe(F.col(f"b.{c}"))
        bits = every.alias("e").join(bits.alias("b"), same, "left").select("e.*", "b._have")
    lacking = bits.join(sent(fleet), "_bucket").where(F.coalesce(F.bitmap_count("_have"), F.lit(0)) < F.size("_all"))
    byte = lambda bit: F.conv(F.hex(F.substring("_have", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    unset = lambda s: F.col("_have").isNull() | (byte(s["_bit"]).bitwiseAND(F.pow(F.lit(2), s["_bit"] % 8).cast("int")) == 0)
    return lacking.select(*item, F.explode(F.filter("_all", unset)).alias("_gone")).select(*item, F.col(f"_gone.{scope}").alias(scope))


def majority(rows: DataFrame, item: Sequence[str], value: str) -> DataFrame:
    """(item, versions, usual): the number of values, and the most frequent one; the least of equals."""
    counts = rows.groupBy(*item, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*item).agg(F.count("*").alias("versions"), F.min_by(value, F.struct((-F.col("n")).alias("k"), F.col(value).alias("v"))).alias("usual"))


def definition_drift(rows: DataFrame, item: Sequence[str], scope: str, value: str) -> DataFrame:
    """(item, scope, value, usual): rows whose value isn't the item's usual one. Null values don't count."""
    known = rows.where(F.col(value).isNotNull())
    usual = majority(known, item, value).where("versions > 1").drop("versions")
    return known.join(usual, list(item)).where(F.col(value) != F.col("usual")).select(*item, scope, value, "usual")


def config_drift(settings: DataFrame, setting: str, scope: str, value: str) -> DataFrame:
    """Settings that differ from the fleet's usual value."""
    return definition_drift(settings, [setting], scope, value)


def orphans(facts: DataFrame, items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts whose item is deleted or not known yet."""
    return facts.join(items, list(keys), "left_anti")
