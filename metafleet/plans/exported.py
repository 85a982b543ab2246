"""Registered queries of the exports and of properties and files, with DuckDB SQL of the same rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metafleet.functions import keys as K
from metafleet.operators import merge, status
from metafleet.plans import registry, schemas, sync
from metafleet.plans.exports import Catalog
from metafleet.plans.fixtures import Inputs
from metafleet.plans.queries import ORACLES, T0, T1, at, query

#: Catalog tables of a fleet in both engines' SQL: databases are nations, tables customers, indexes orders, index columns lines.
#: Object ids repeat from database to database, as they do in a fleet.
TABLES = {
    "versions": "SELECT n_nationkey AS _DatabaseID, 14 + n_nationkey % 3 AS version FROM nation",
    "schemas": "SELECT DISTINCT c_nationkey AS _DatabaseID, CAST(length(c_mktsegment) AS INT) AS schema_id, concat('s', CAST(length(c_mktsegment) AS STRING)) AS name FROM customer",
    "objects": "SELECT c_nationkey AS _DatabaseID, c_name AS name, CAST(c_custkey AS INT) AS object_id, CAST(length(c_mktsegment) AS INT) AS schema_id, 'U' AS type, c_custkey % 10 = 0 AS is_ms_shipped, c_custkey % 3 = 0 AS is_published FROM customer",
    "views": "SELECT c_nationkey AS _DatabaseID, concat('v', c_name) AS name, CAST(c_custkey AS INT) AS object_id, CAST(length(c_mktsegment) AS INT) AS schema_id, 'V' AS type, c_custkey % 7 = 0 AS is_ms_shipped, c_custkey % 2 = 0 AS has_snapshot, CAST(c_custkey % 5 AS SMALLINT) AS ledger_view_type FROM customer",
    "indexes": "SELECT c_nationkey AS _DatabaseID, CAST(o_custkey AS INT) AS object_id, CAST(o_orderkey AS INT) AS index_id, concat('ix', CAST(o_orderkey AS STRING)) AS name, CAST(o_orderkey % 3 AS SMALLINT) AS type, o_orderkey % 2 = 0 AS is_unique, o_orderkey % 4 = 0 AS optimize_for_sequential_key FROM orders JOIN customer ON o_custkey = c_custkey",
    "stats": "SELECT c_nationkey AS _DatabaseID, CAST(o_custkey AS INT) AS object_id, CAST(o_orderkey AS INT) AS stats_id, concat('st', CAST(o_orderkey AS STRING)) AS name, o_orderkey % 5 = 0 AS auto_created, o_orderkey % 2 = 0 AS has_persisted_sample, o_orderkey % 4 = 1 AS auto_drop FROM orders JOIN customer ON o_custkey = c_custkey",
    "columns": "SELECT DISTINCT c_nationkey AS _DatabaseID, CAST(o_custkey AS INT) AS object_id, CAST(l_linenumber AS INT) AS column_id, concat('c', CAST(l_linenumber AS STRING)) AS name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey",
    "index_columns": "SELECT DISTINCT c_nationkey AS _DatabaseID, CAST(o_custkey AS INT) AS object_id, CAST(o_orderkey AS INT) AS index_id, CAST(l_linenumber AS INT) AS index_column_id, CAST(l_linenumber AS INT) AS column_id, CAST(l_linenumber AS SMALLINT) AS column_store_order_ordinal FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey",
    "partitions": "SELECT c_nationkey AS _DatabaseID, CAST(o_orderkey AS BIGINT) AS partition_id, CAST(o_custkey AS INT) AS object_id, CAST(o_orderkey AS INT) AS index_id, 1 AS partition_number, CAST(round(o_totalprice) AS BIGINT) AS rows, o_orderkey % 2 = 0 AS xml_compression FROM orders JOIN customer ON o_custkey = c_custkey",
    "foreign_keys": "SELECT c_nationkey AS _DatabaseID, concat('fk', CAST(o_orderkey AS STRING)) AS name, CAST(o_orderkey AS INT) AS object_id, CAST(length(c_mktsegment) AS INT) AS schema_id, CAST(o_custkey AS INT) AS parent_object_id, 'F' AS type, CAST(o_custkey AS INT) AS referenced_object_id, CAST(o_orderkey AS INT) AS key_index_id, o_orderkey % 6 = 0 AS is_ms_shipped FROM orders JOIN customer ON o_custkey = c_custkey",
    "check_constraints": "SELECT c_nationkey AS _DatabaseID, concat('ck', CAST(o_orderkey AS STRING)) AS name, CAST(o_orderkey AS INT) AS object_id, CAST(length(c_mktsegment) AS INT) AS schema_id, CAST(o_custkey AS INT) AS parent_object_id, 'C' AS type, CAST(o_orderkey % 9 AS INT) AS parent_column_id, false AS is_ms_shipped FROM orders JOIN customer ON o_custkey = c_custkey",
    "key_constraints": "SELECT c_nationkey AS _DatabaseID, concat('uq', CAST(o_orderkey AS STRING)) AS name, CAST(o_orderkey AS INT) AS object_id, CAST(length(c_mktsegment) AS INT) AS schema_id, CAST(o_custkey AS INT) AS parent_object_id, 'UQ' AS type, CAST(o_orderkey AS INT) AS unique_index_id, o_orderkey % 4 = 0 AS is_ms_shipped FROM orders JOIN customer ON o_custkey = c_custkey",
    "foreign_key_columns": "SELECT DISTINCT c_nationkey AS _DatabaseID, CAST(o_custkey AS INT) AS constraint_object_id, CAST(l_linenumber AS INT) AS constraint_column_id, CAST(o_custkey AS INT) AS parent_object_id, CAST(l_linenumber AS INT) AS parent_column_id, CAST(o_custkey AS INT) AS referenced_object_id, CAST(l_linenumber % 3 + 1 AS INT) AS referenced_column_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey",
    "computed_columns": "SELECT c_nationkey AS _DatabaseID, CAST(o_custkey AS INT) AS object_id, concat('cc', CAST(o_orderkey AS STRING)) AS name, CAST(o_orderkey AS INT) AS column_id, o_orderkey % 2 = 0 AS is_dropped_ledger_column FROM orders JOIN customer ON o_custkey = c_custkey",
    "triggers": "SELECT c_nationkey AS _DatabaseID, concat('tr', CAST(o_orderkey AS STRING)) AS name, CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_orderkey END AS INT) AS object_id, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS parent_class, CAST(o_custkey AS INT) AS parent_id, 'TR' AS type, o_orderkey % 10 = 0 AS is_ms_shipped FROM orders JOIN customer ON o_custkey = c_custkey",
    "database_files": "SELECT s_nationkey AS _DatabaseID, CAST(s_suppkey AS INT) AS file_id FROM supplier WHERE s_suppkey % 4 <> 0",
    "dm_io_virtual_file_stats": "SELECT s_nationkey AS _DatabaseID, CAST(s_suppkey AS INT) AS file_id, CAST(s_suppkey * 3 AS BIGINT) AS num_of_reads, CAST(s_suppkey AS BIGINT) AS num_of_pushed_reads FROM supplier",
}


def _catalog(i: Inputs) -> Catalog:
    tables = {name: i.sql(sql) for name, sql in TABLES.items()}
    return Catalog(tables, tables["versions"])


def _sql(text: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({TABLES[n]})" for n in TABLES) + ", no AS (SELECT o._DatabaseID, o.object_id, o.name, o.type, s.name AS schema_name FROM objects o JOIN schemas s ON s._DatabaseID = o._DatabaseID AND s.schema_id = o.schema_id WHERE NOT o.is_ms_shipped), ni AS (SELECT _DatabaseID, object_id, index_id, CASE WHEN type = 0 THEN '<<HEAP>>' ELSE name END AS index_name FROM indexes) " + text


def _join(alias: str, table: str, **on: str) -> str:
    return f" JOIN {table} {alias} ON {alias}._DatabaseID = x._DatabaseID" + "".join(f" AND {alias}.{k} = x.{v}" for k, v in on.items())


_V = _join("v", "versions")
_OWN = _join("o", "no", object_id="object_id")
_NAMES = "o.schema_name AS _SchemaName, o.name AS _ObjectName, o.type AS _ObjectType"
_SELF = "s.name AS _SchemaName, x.name AS _ObjectName, x.type AS _ObjectType"
_SCHEMA = _join("s", "schemas", schema_id="schema_id")
_since = lambda c, version: f"CASE WHEN v.version >= {version} THEN x.{c} END AS {c}"

#: By dataset: the columns that are compared, and the SQL of them.
CHECKS = {
    "objects": (["_SchemaName", "_ObjectName", "_ObjectType", "object_id", "is_published", "principal_id"], f"SELECT x._DatabaseID, {_SELF}, x.object_id, x.is_published, NULL::INT AS principal_id FROM objects x{_SCHEMA} WHERE NOT x.is_ms_shipped"),
    "views": (["_SchemaName", "_ObjectName", "has_snapshot", "ledger_view_type"], f"SELECT x._DatabaseID, s.name AS _SchemaName, x.name AS _ObjectName, {_since('has_snapshot', 15)}, {_since('ledger_view_type', 16)} FROM views x{_SCHEMA}{_V} WHERE NOT x.is_ms_shipped"),
    "stats": (["_SchemaName", "_ObjectName", "_ObjectType", "_IndexName", "has_persisted_sample", "auto_drop"], f"SELECT x._DatabaseID, {_NAMES}, x.name AS _IndexName, {_since('has_persisted_sample', 15)}, {_since('auto_drop', 16)} FROM stats x{_OWN}{_V} WHERE NOT x.auto_created"),
    "indexes": (["_SchemaName", "_ObjectName", "_ObjectType", "_IndexName", "index_id", "optimize_for_sequential_key"], f"SELECT x._DatabaseID, {_NAMES}, CASE WHEN x.type = 0 THEN '<<HEAP>>' ELSE x.name END AS _IndexName, x.index_id, {_since('optimize_for_sequential_key', 15)} FROM indexes x{_OWN}{_V}"),
    "columns": (["_SchemaName", "_ObjectName", "_ObjectType", "_ColumnName", "column_id"], f"SELECT x._DatabaseID, {_NAMES}, x.name AS _ColumnName, x.column_id FROM columns x{_OWN}"),
    "index_columns": (["_ObjectName", "_IndexName", "_ColumnName", "index_column_id", "column_store_order_ordinal"], f"SELECT x._DatabaseID, o.name AS _ObjectName, i.index_name AS _IndexName, c.name AS _ColumnName, x.index_column_id, {_since('column_store_order_ordinal', 15)} FROM index_columns x{_OWN}{_join('i', 'ni', object_id='object_id', index_id='index_id')}{_join('c', 'columns', object_id='object_id', column_id='column_id')}{_V}"),
    "partitions": (["_ObjectName", "_IndexName", "partition_id", "rows", "xml_compression"], f"SELECT x._DatabaseID, o.name AS _ObjectName, i.index_name AS _IndexName, x.partition_id, x.rows, {_since('xml_compression', 16)} FROM partitions x{_OWN}{_join('i', 'ni', object_id='object_id', index_id='index_id')}{_V}"),
    "computed_columns": (["_ObjectName", "_ColumnName", "is_dropped_ledger_column"], f"SELECT x._DatabaseID, o.name AS _ObjectName, x.name AS _ColumnName, {_since('is_dropped_ledger_column', 16)} FROM computed_columns x{_OWN}{_V}"),
    "foreign_keys": (["_SchemaName", "_ObjectName", "_ParentSchemaName", "_ParentObjectName", "_ReferencedObjectName", "_ReferencedIndexName"], f"SELECT x._DatabaseID, s.name AS _SchemaName, x.name AS _ObjectName, p.schema_name AS _ParentSchemaName, p.name AS _ParentObjectName, r.name AS _ReferencedObjectName, i.index_name AS _ReferencedIndexName FROM foreign_keys x{_SCHEMA}{_join('p', 'no', object_id='parent_object_id')}{_join('r', 'no', object_id='referenced_object_id')}{_join('i', 'ni', object_id='referenced_object_id', index_id='key_index_id')} WHERE NOT x.is_ms_shipped"),
    "foreign_key_columns": (["_ObjectName", "_ParentColumnName", "_ReferencedColumnName", "constraint_column_id"], f"SELECT x._DatabaseID, o.name AS _ObjectName, pc.name AS _ParentColumnName, rc.name AS _ReferencedColumnName, x.constraint_column_id FROM foreign_key_columns x{_join('o', 'no', object_id='constraint_object_id')}{_join('p', 'no', object_id='parent_object_id')}{_join('pc', 'columns', object_id='parent_object_id', column_id='parent_column_id')}{_join('r', 'no', object_id='referenced_object_id')}{_join('rc', 'columns', object_id='referenced_object_id', column_id='referenced_column_id')}"),
    "key_constraints": (["_SchemaName", "_ObjectName", "_ParentObjectName", "_UniqueIndexName"], f"SELECT x._DatabaseID, s.name AS _SchemaName, x.name AS _ObjectName, p.name AS _ParentObjectName, i.index_name AS _UniqueIndexName FROM key_constraints x{_SCHEMA}{_join('p', 'no', object_id='parent_object_id')}{_join('i', 'ni', object_id='parent_object_id', index_id='unique_index_id')} WHERE NOT x.is_ms_shipped"),
    "check_constraints": (["_SchemaName", "_ObjectName", "_ParentObjectName", "_ParentColumnName"], f"SELECT x._DatabaseID, s.name AS _SchemaName, x.name AS _ObjectName, p.name AS _ParentObjectName, c.name AS _ParentColumnName FROM check_constraints x{_SCHEMA}{_join('p', 'no', object_id='parent_object_id')} LEFT{_join('c', 'columns', object_id='parent_object_id', column_id='parent_column_id')} WHERE NOT x.is_ms_shipped"),
}


def _register(dataset: str, columns: list[str], sql: str) -> None:
    @query(f"export_{dataset}")
    def _(i: Inputs) -> DataFrame:
        return _catalog(i).export(dataset).select("_DatabaseID", *columns)

    ORACLES[f"export_{dataset}"] = _sql(sql)


for _dataset, (_columns, _text) in CHECKS.items():
    _register(_dataset, _columns, _text)


# --- the registry's own datasets, from export to merged tables ------------------------------------------------

#: Rows dealt by scope and object stay where they are for lookups by object and index or column; where all parts of a lookup are
#: small, its rows are hashed and not sorted.
_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m"}
_SYNCED = ("objects", "indexes", "stats", "columns", "index_columns", "partitions", "foreign_keys", "check_constraints", "key_constraints")
_DIMENSIONS = {"_ObjectID": "database_id int, _SchemaName string, _ObjectName string, _ObjectType string", "_IndexID": "database_id int, _ObjectID long, _IndexName string, _IndexKind string", "_ColumnID": "database_id int, _ObjectID long, _ColumnName string"}


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold inside only."""
    was = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in was.items():
            spark.conf.set(name, value)


def _catalog_run(i: Inputs) -> sync.SyncRun:
    """A first run of the registry's specs: ids are resolved as objects, indexes and columns come, and what refers to them follows."""
    specs = [spec for spec in registry.DATASETS if spec.name in _SYNCED]
    catalog = _catalog(i)
    catalog.tables["indexes"] = catalog.tables["indexes"].withColumn("type", F.lit(1))  # one heap a table at most
    catalog = catalog.with_ids()
    scopes = i.nation.select(F.lit(0).alias("instance_id"), F.col("n_nationkey").cast("int").alias("database_id"), F.lit(True).alias("is_enabled"))
    sources = {}
    for spec in specs:
        rows = catalog.export(spec.name).drop("_RowHash").withColumns({"instance_id": F.lit(0), "database_id": F.col("_DatabaseID").cast("int")}).drop("_DatabaseID")
        if "_IndexID" in spec.roles:
            rows = rows.withColumn("_IndexKind", F.lit("stat" if spec.name == "stats" else "index"))
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.SCHEMAS[spec.name].struct())
        none = i.spark.createDataFrame([], "instance_id int, database_id int, " + ", ".join(f"{role} long" for role in spec.roles) + f", {fields}").limit(0)  # with a limit of 0 Spark plans no join with it
        items = spec.defines and i.spark.createDataFrame([], f"{spec.defines} long, {_DIMENSIONS[spec.defines]}, is_deleted boolean, delete_date timestamp_ntz").limit(0)
        sources[spec.name] = sync.Source(merge.first_load(none, sync.SCOPE["database"], spec.keys, at(T0)), rows, scopes, items=items or None)
    known = i.sql("SELECT * FROM status").limit(0)
    instances = scopes.select("instance_id", "is_enabled").distinct()
    return sync.sync_run(specs, status.task_matrix(registry.spec_frame(i.spark, specs), instances, scopes, known), known, sources, at(T1))


@query("sync_catalog")
def _(i):
    out = None
    with _set(i.spark, _SETTINGS):
        run = _catalog_run(i)
    for name, df in run.tables.items():
        part = df.groupBy("database_id").agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("dataset"), "database_id", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


ORACLES["sync_catalog"] = _sql(" UNION ALL ".join(f"SELECT '{d}' AS dataset, _DatabaseID::INT AS database_id, count(*) AS n_rows FROM ({CHECKS[d][1]}) GROUP BY _DatabaseID" for d in _SYNCED))


@query("export_triggers")
def _(i):
    return _catalog(i).triggers().select("_DatabaseID", "_SchemaName", "_ObjectName", "_ParentObjectName", "parent_class")


ORACLES["export_triggers"] = _sql(f"""SELECT x._DatabaseID, o.schema_name AS _SchemaName, x.name AS _ObjectName, p.name AS _ParentObjectName, x.parent_class FROM triggers x{_OWN}{_join('p', 'no', object_id='parent_id')} WHERE NOT x.is_ms_shipped AND x.parent_class = 1
UNION SELECT x._DatabaseID, '<<DB>>', x.name, NULL, x.parent_class FROM triggers x WHERE NOT x.is_ms_shipped AND x.parent_class = 0""")


@query("export_file_stats")
def _(i):
    return _catalog(i).file_stats(at(T0)).select("_DatabaseID", "file_id", "num_of_reads", "num_of_pushed_reads", "_CollectionDate")


ORACLES["export_file_stats"] = _sql(f"SELECT x._DatabaseID, x.file_id, x.num_of_reads, {_since('num_of_pushed_reads', 16)}, {T0} AS _CollectionDate FROM dm_io_virtual_file_stats x{_join('f', 'database_files', file_id='file_id')}{_V}")


@query("variant_properties", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS text, CASE WHEN json_extract_string(props, '$.k') IS NULL THEN NULL ELSE 'BIGINT' END AS kind FROM events")
def _(i):
    kept = K.as_variant(i.events.select("event_id", "props"), ["props"])
    return K.variant_fields(kept, "props", {"k": "bigint", "text": "string"}, {"text": "$.k"}).withColumn("kind", F.schema_of_variant(F.try_variant_get("props", "$.k", "variant"))).drop("props")
