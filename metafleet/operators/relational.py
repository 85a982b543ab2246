"""Filters, lookups and set operations with null-safe semantics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def user_objects(df: DataFrame, flag: str = "is_ms_shipped") -> DataFrame:
    """Without system objects."""
    return df.where(~F.col(flag))


def active_only(df: DataFrame, enabled: str | None = None, deleted: str | None = None) -> DataFrame:
    """Rows that are enabled and not deleted, by the flags that are named."""
    if enabled:
        df = df.where(F.col(enabled))
    return df.where(~F.col(deleted)) if deleted else df


def stable_projection(df: DataFrame, volatile: Sequence[str]) -> DataFrame:
    """Without the columns that change by themselves; hash what is left."""
    return df.select(*(c for c in df.columns if c not in volatile))


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on the keys."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[k])
    return out


def null_safe_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys, nulls included, are in ``right``."""
    return left.join(right, same(left, right, keys), "left_semi")


def new_keys(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``incoming`` that ``existing`` lacks; null equals null."""
    fresh = incoming.select(*keys).distinct()
    return fresh.join(existing, same(fresh, existing, keys), "left_anti")


def row_differs(columns: Sequence[str], left: str, right: str) -> Column:
    """Whether two aliased rows differ in any column; null equals null."""
    return ~F.struct(*(F.col(f"{left}.{c}") for c in columns)).eqNullSafe(F.struct(*(F.col(f"{right}.{c}") for c in columns)))


def hash_changed(left: str, right: str) -> Column:
    return F.col(left) != F.col(right)


def union_distinct(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def name_enrich(df: DataFrame, names: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Attaches names by (scope, id). ``how="left"`` keeps rows without a parent."""
    return df.join(names, list(keys), how)


def multi_role_enrich(df: DataFrame, names: DataFrame, scope: Sequence[str], roles: dict[str, str], id_col: str, name_cols: Sequence[str]) -> DataFrame:
    """Joins the same names once for each role ({role: its id column}); columns get the role before them."""
    for role, column in roles.items():
        side = names.select(*scope, F.col(id_col).alias(column), *(F.col(c).alias(f"{role}_{c}") for c in name_cols))
        df = df.join(side, [*scope, column])
    return df


def optional_scope_lookup(df: DataFrame, scopes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attaches the scope's id where the scope is registered and keeps the other rows."""
    return df.join(scopes, list(keys), "left")


def stats_left_fill(items: DataFrame, stats: DataFrame, keys: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """Every item with its counters; absent ones are 0."""
    found = items.join(stats, list(keys), "left")
    return found.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counters})


def lateral_rows(df: DataFrame, column: str, *outputs: str) -> DataFrame:
    """A row for each element of an array of structs or scalars."""
    return df.select("*", F.explode(column).alias(*outputs)).drop(column)


def replica_flag(databases: DataFrame, replicas: DataFrame, key: str) -> DataFrame:
    """Adds ``is_primary_replica`` from the database's local replica; null where it has none."""
    local = replicas.where("is_local").groupBy(key).agg(F.max("is_primary_replica").alias("is_primary_replica"))
    return databases.join(local, key, "left")


def ordered_concat(df: DataFrame, keys: Sequence[str], value: str, order: str, name: str, sep: str = "_") -> DataFrame:
    """The group's values in order, joined."""
    return df.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).cast("string").alias("v")))), lambda x: x.v), sep).alias(name))


def distinct_targets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)
