"""Snapshots: reading, aligning to a declared schema, scopes, properties and target lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snapshot_scan(spark: SparkSession, path: str, collected_at, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """All columns of a landed snapshot, and when it was collected. ``fmt``: parquet, orc, json, csv, ..."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).withColumn("_CollectionDate", F.lit(collected_at))


def snapshot_jdbc(spark: SparkSession, url: str, table: str, collected_at, **options) -> DataFrame:
    """The same from a live source; filters and columns are pushed down to it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().withColumn("_CollectionDate", F.lit(collected_at))


def align_to_schema(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """The declared columns in order: typed nulls for absent ones; an undeclared column raises unless not ``strict``."""
    unknown = sorted(set(df.columns) - set(schema.fieldNames()))
    if strict and unknown:
        raise ValueError(f"columns that the schema doesn't declare: {', '.join(unknown)}")
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def optional_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, or no rows where there is none."""
    try:
        return align_to_schema(spark.read.format(fmt).load(path), schema, strict=False)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def add_scope(df: DataFrame, level: str, scope) -> DataFrame:
    """Puts ``_InstanceID`` or ``_DatabaseID`` first; ``scope`` is a value or a column."""
    name = {"instance": "_InstanceID", "database": "_DatabaseID"}[level]
    return df.select((scope if hasattr(scope, "cast") else F.lit(scope)).alias(name), "*")


def properties_wide(rows: DataFrame, scope: Sequence[str], names: dict[str, str], name_col: str = "name", value_col: str = "value") -> DataFrame:
    """One row per scope with a column per listed property (name: type); absent ones are null."""
    wide = rows.groupBy(*scope).pivot(name_col, list(names)).agg(F.max(value_col))
    return wide.select(*scope, *(F.col(f"`{n}`").try_cast(kind).alias(n) for n, kind in names.items()))


def targets_from_json(configs: DataFrame, column: str) -> DataFrame:
    """(instance_name, database_name) from configuration texts with ``TargetDatabases``."""
    kind = "struct<TargetDatabases:array<struct<Instance:string,Database:string>>>"
    found = configs.select(F.inline(F.from_json(column, kind)["TargetDatabases"]))
    return found.select(F.col("Instance").alias("instance_name"), F.col("Database").alias("database_name")).distinct()


def scope_filter(df: DataFrame, **scope) -> DataFrame:
    """The rows of one scope, as equality filters that reach the scan."""
    for name, value in scope.items():
        df = df.where(F.col(name) == F.lit(value))
    return df
