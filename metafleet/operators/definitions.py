"""Definitions, stored once for the whole fleet by content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.functions.keys import NO_HASH, content_hash
from metafleet.operators.merge import Merge, merge_snapshot


def with_hash(rows: DataFrame, text: str = "definition") -> DataFrame:
    return rows.withColumn("definition_hash", content_hash(text))


def first_per_hash(rows: DataFrame, order: str, text: str = "definition") -> DataFrame:
    """(definition_hash, first, definition): one row per content, from the least ``order``."""
    hashed = with_hash(rows, text).where(F.col("definition_hash") != NO_HASH)
    return hashed.groupBy("definition_hash").agg(F.min(order).alias("first"), F.min_by(text, order).alias("definition"))


def definition_upsert(store: DataFrame, rows: DataFrame, order: str, text: str = "definition") -> DataFrame:
    """The store (definition_hash, definition) with the contents it lacked; texts move only for unseen hashes."""
    unseen = with_hash(rows, text).join(store.select("definition_hash"), "definition_hash", "left_anti")
    return store.unionByName(first_per_hash(unseen.drop("definition_hash"), order, text).select("definition_hash", "definition"))


def modules_merge(current: DataFrame, snapshot: DataFrame, collected: DataFrame, keys: Sequence[str], as_of, text: str = "definition", **options) -> Merge:
    """``merge_snapshot`` of modules by the hash of their definition instead of its text: a row is updated if either differs."""
    return merge_snapshot(current, with_hash(snapshot, text).drop(text), collected, keys, as_of, **options)


def definition_versions(rows: DataFrame, names: Sequence[str], text: str = "definition") -> DataFrame:
    """(names, definition_hash, n): how many rows have each content of an item."""
    return with_hash(rows, text).groupBy(*names, "definition_hash").agg(F.count("*").alias("n"))


def object_definition(objects: DataFrame, modules: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Objects with their definitions: object, module, store; the text is joined last."""
    return objects.join(modules, key).join(store, "definition_hash")
