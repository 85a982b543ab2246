"""Rules over the whole fleet's catalog, violations as rows: rule, database, schema, object, item, current, proper.

A table is named by its database, schema and name: tables of one name in two schemas are two tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metafleet.functions.keys import joined, name_key, quoted
from metafleet.operators.relational import ordered_concat


#: What names a table in a fleet.
TABLE = ("database_id", "schema_name", "object_name")


def _rows(df: DataFrame, rule: str, item: Column, current: Column, proper: Column) -> DataFrame:
    text = lambda c: c.cast("string")
    return df.select(F.lit(rule).alias("rule"), *TABLE, text(item).alias("item"), text(current).alias("current"), text(proper).alias("proper"))


def _part(name: Column) -> Column:
    """A name as part of a dotted one: in brackets unless it is a plain identifier."""
    return F.when(name.rlike("^[A-Za-z_@#][A-Za-z0-9_@#$]*$"), name).otherwise(quoted(name))


def _text(value: Column) -> Column:
    """The value as a string literal, quotes doubled."""
    return joined(F.lit("N'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))


def rename_script(schema: Column, current: Column, proper: Column, table: Column | None = None) -> Column:
    """The statement that gives a constraint, or an index of ``table``, its proper name; it can be run as it is."""
    parts = [_part(c) for c in ([schema, current] if table is None else [schema, table, current])]
    kind = "OBJECT" if table is None else "INDEX"
    return joined(F.lit("EXEC sp_rename "), _text(F.concat_ws(".", *parts)), F.lit(", "), _text(proper), F.lit(f", N'{kind}';"))


def name_convention(df: DataFrame, rule: str, actual: str, proper: Column) -> DataFrame:
    """Names that aren't, letter for letter, what they should be."""
    return _rows(df.where(F.col(actual) != proper), rule, F.col(actual), F.col(actual), proper)


def default_name(defaults: DataFrame) -> DataFrame:
    """``defaults``: TABLE, column_name, name; proper is DF_table_column."""
    return name_convention(defaults, "default_name", "name", F.concat_ws("_", F.lit("DF"), "object_name", "column_name"))


def foreign_key_name(columns: DataFrame) -> DataFrame:
    """``columns``: TABLE, name, column_name, ordinal; proper is FK_table_columns."""
    keys = ordered_concat(columns, [*TABLE, "name"], "column_name", "ordinal", "columns")
    return name_convention(keys, "foreign_key_name", "name", F.concat_ws("_", F.lit("FK"), "object_name", "columns"))


def index_name(columns: DataFrame) -> DataFrame:
    """``columns``: as above with kind (PK, UQ, IX), is_clustered, is_included; included columns don't count."""
    group = [*TABLE, "name", "kind", "is_clustered"]
    keys = ordered_concat(columns.where("not is_included"), group, "column_name", "ordinal", "columns")
    prefix = F.concat(F.when(F.col("is_clustered"), "C").otherwise(""), F.col("kind"))
    return name_convention(keys, "index_name", "name", F.concat_ws("_", prefix, "object_name", "columns"))


def heap(indexes: DataFrame) -> DataFrame:
    """``indexes``: TABLE, type; tables without a clustered index."""
    return _rows(indexes.where("type = 0"), "heap", F.col("object_name"), F.lit("heap"), F.lit("clustered index"))


def missing_default(columns: DataFrame, defaults: DataFrame, names: Sequence[str] = ("_ModifyDate", "_InsertDate")) -> DataFrame:
    """The named columns without a default; history tables are exempt."""
    asked = columns.where(F.col("column_name").isin(*names)).where(~F.col("object_name").like(r"%\_history"))
    bare = asked.join(defaults.select(*TABLE, "column_name").distinct(), [*TABLE, "column_name"], "left_anti")
    return _rows(bare, "missing_default", F.col("column_name"), F.lit("none"), F.lit("default"))


def missing_foreign_key(columns: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named id columns, in any table, that no foreign key starts from."""
    asked = columns.where(F.col("column_name").isin(*names))
    bare = asked.join(keys.select(*TABLE, "column_name").distinct(), [*TABLE, "column_name"], "left_anti")
    return _rows(bare, "missing_foreign_key", F.col("column_name"), F.lit("none"), F.lit("foreign key"))


def type_used(columns: DataFrame, rule: str, kinds: Sequence[str], proper: str, own_only: bool = False) -> DataFrame:
    """Columns of a type that shouldn't be used; ``own_only`` looks at names that begin with _."""
    hit = columns.where(name_key("type_name").isin(*kinds))
    hit = hit.where(F.col("column_name").like(r"\_%")) if own_only else hit
    return _rows(hit, rule, F.col("column_name"), F.col("type_name"), F.lit(proper))


def datetime_used(columns: DataFrame) -> DataFrame:
    """Own columns (not synced ones) of type datetime."""
    return type_used(columns, "datetime_used", ["datetime"], "datetime2", own_only=True)


def variant_in_type(columns: DataFrame) -> DataFrame:
    return type_used(columns, "variant_in_type", ["sql_variant"], "a declared type")


def missing_reference(refs: DataFrame, objects: DataFrame) -> DataFrame:
    """``refs`` (TABLE, ref_schema, ref_name): names that aren't among the objects, by name key."""
    have = objects.select("database_id", name_key("schema_name").alias("_s"), name_key("object_name").alias("_k")).distinct()
    named = refs.where("ref_name is not null").withColumns({"_s": name_key("ref_schema"), "_k": name_key("ref_name")})
    lost = named.join(have, ["database_id", "_s", "_k"], "left_anti")
    return _rows(lost, "missing_reference", F.col("ref_name"), F.lit("missing"), F.lit("an existing object"))


def companion_missing(df: DataFrame, value: str, companion: str) -> DataFrame:
    """Rows where one column is set and the one that goes with it isn't."""
    hit = df.where(F.col(value).isNotNull() & F.col(companion).isNull())
    return _rows(hit, "companion_missing", F.lit(companion), F.lit(None), F.lit("a value"))


def exclusive(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows with both of two columns set of which one may be."""
    hit = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return _rows(hit, "exclusive", F.concat_ws("/", F.lit(a), F.lit(b)), F.concat_ws("/", F.col(a).cast("string"), F.col(b).cast("string")), F.lit("one of them"))


def class_changed(old: DataFrame, new: DataFrame, dependants: DataFrame, key: str, kind: str) -> DataFrame:
    """(key, old_kind, new_kind): rows of another class than before that something still depends on."""
    moved = old.select(key, F.col(kind).alias("old_kind")).join(new.select(key, F.col(kind).alias("new_kind")), key).where("old_kind <> new_kind")
    return moved.join(dependants.select(key).distinct(), key, "left_semi")


def required_column(columns: DataFrame, position: int, name: str, kind: str) -> DataFrame:
    """Tables that don't have the named column of that type at that position."""
    tables = columns.select(*TABLE).distinct()
    good = columns.where((F.col("ordinal") == position) & (F.col("column_name") == name) & (F.col("type_name") == kind))
    bad = tables.join(good, list(TABLE), "left_anti")
    return _rows(bad, "required_column", F.lit(name), F.lit("missing"), F.lit(f"{position}:{name}:{kind}"))


def duplicate_keys(snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n): keys that occur more than once; nulls are equal."""
    return snapshot.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def missing_references(facts: DataFrame, items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts whose reference is set and isn't there; nulls refer to nothing."""
    for k in keys:
        facts = facts.where(F.col(k).isNotNull())
    return facts.join(items.select(*keys).distinct(), list(keys), "left_anti")


class RuleError(ValueError):
    """A run found violations."""


def require_none(violations: DataFrame, most: int = 20) -> None:
    """Raises with the first violations if there are any."""
    found = violations.limit(most).collect()
    if found:
        raise RuleError("; ".join(str(r.asDict()) for r in found))
