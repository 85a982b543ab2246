"""Item dimensions: deterministic ids, soft deletion and return."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.functions.keys import DB_LEVEL, item_id, name_key


def resolve(names: DataFrame, scope: Sequence[str], parts: Sequence[str], out: str) -> DataFrame:
    """Distinct items by (scope, names) with their id; no lookup and no shuffle but the distinct.

    Names that differ only in case or trailing blanks are one item; the least spelling names it.
    """
    keyed = names.withColumns({f"_{p}_key": name_key(p) for p in parts})
    keys = [*scope, *(f"_{p}_key" for p in parts)]
    items = keyed.groupBy(*keys).agg(*(F.min(p).alias(p) for p in parts))
    return items.select(item_id(*keys).alias(out), *scope, *parts)


def resolve_objects(names: DataFrame) -> DataFrame:
    """(database_id, schema_name, object_name, object_type) with ``object_key``."""
    return resolve(names, ["database_id"], ["schema_name", "object_name", "object_type"], "object_key")


def resolve_indexes(names: DataFrame) -> DataFrame:
    """(object_key, index_name, kind) with ``index_key``; ``kind`` keeps statistics and indexes of one name apart."""
    return resolve(names, ["object_key"], ["index_name", "kind"], "index_key")


def resolve_columns(names: DataFrame) -> DataFrame:
    """(object_key, column_name) with ``column_key``."""
    return resolve(names, ["object_key"], ["column_name"], "column_key")


def id_collisions(items: DataFrame, id_col: str, names: Sequence[str]) -> DataFrame:
    """Ids that two items share; a run with any must stop."""
    return items.groupBy(id_col).agg(F.countDistinct(F.struct(*names)).alias("n")).where("n > 1")


def sync_items(dim: DataFrame, seen: DataFrame, collected: DataFrame, id_col: str, scope: str, as_of, full: bool = True, level: str = "object") -> DataFrame:
    """The dimension after an import, in one full outer join: new items in, missing ones marked, seen ones back.

    ``dim``: id, scope, names, is_deleted, delete_date. Only scopes in ``collected`` lose items, and only
    on ``full`` imports. ``level="object"`` leaves database-level items (schema ``<<DB>>``) alone,
    ``level="database"`` deletes none but those.
    """
    names = [c for c in dim.columns if c not in (id_col, "is_deleted", "delete_date")]
    now = seen.select(id_col, *names).distinct()
    joined = dim.alias("d").join(now.alias("s"), F.col(f"d.{id_col}") == F.col(f"s.{id_col}"), "full_outer")
    hit = collected.select(F.col(scope).alias("_scope")).distinct().withColumn("_collected", F.lit(True))
    joined = joined.join(hit, F.coalesce(F.col(f"d.{scope}"), F.col(f"s.{scope}")) == F.col("_scope"), "left")
    present = F.col(f"s.{id_col}").isNotNull()
    gone = ~present & F.lit(full) & F.coalesce(F.col("_collected"), F.lit(False))
    if "schema_name" in names:
        db_level = F.col("d.schema_name") == DB_LEVEL
        gone = gone & (db_level if level == "database" else ~db_level)
    was = F.coalesce(F.col("d.is_deleted"), F.lit(False))
    deleted = F.when(present, F.lit(False)).when(gone, F.lit(True)).otherwise(was)
    at = F.when(present, F.lit(None)).when(gone & ~was, F.lit(as_of)).otherwise(F.col("d.delete_date"))
    return joined.select(
        F.coalesce(f"d.{id_col}", f"s.{id_col}").alias(id_col), *(F.coalesce(f"d.{c}", f"s.{c}").alias(c) for c in names),
        deleted.alias("is_deleted"), at.cast(dim.schema["delete_date"].dataType).alias("delete_date"),
    )
