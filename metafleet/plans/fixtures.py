"""Inputs in the shape of catalog snapshots, derived from the test tables; one SQL text for both engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

#: Later entries may use earlier ones.
FIXTURES = {
    "scope_instance": "SELECT r_regionkey AS instance_id, r_name AS instance_name, r_regionkey <> 4 AS is_enabled FROM region",
    "scope_database": "SELECT n_nationkey AS database_id, n_regionkey AS instance_id, n_name AS database_name, n_nationkey % 7 <> 0 AS is_enabled FROM nation",
    "item_object": "SELECT c_nationkey AS database_id, c_custkey AS object_id, c_mktsegment AS schema_name, c_name AS object_name, 'U' AS object_type, c_custkey % 11 = 0 AS is_deleted FROM customer",
    "item_index": "SELECT o_custkey AS object_id, o_orderkey AS index_id, CAST(o_orderkey AS STRING) AS index_name, o_orderstatus AS kind, o_orderkey % 13 = 0 AS is_deleted FROM orders",
    "index_column": "SELECT l_orderkey AS index_id, l_linenumber AS key_ordinal, min(l_partkey) AS column_id FROM lineitem GROUP BY l_orderkey, l_linenumber",
    "item_column": "SELECT o_custkey AS object_id, l_partkey AS column_id, count(*) % 5 = 4 AS is_deleted FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey",
    "replica": "SELECT n_nationkey AS database_id, n_nationkey % 2 = 0 AS is_local, n_nationkey % 4 = 0 AS is_primary_replica FROM nation WHERE n_nationkey % 5 <> 0",
    "snap_cur": "SELECT o_custkey % 8 AS scope_id, o_orderkey AS item_key, o_orderstatus AS status, o_orderpriority AS priority, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_orderkey % 10 <> 0",
    "snap_new": "SELECT o_custkey % 8 AS scope_id, o_orderkey AS item_key, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status, o_orderpriority AS priority, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_orderkey % 10 <> 1 AND o_custkey % 8 NOT IN (6, 7)",
    "collected": "SELECT DISTINCT o_custkey % 8 AS scope_id FROM orders WHERE o_custkey % 8 <> 7",
    "part_cur": "SELECT l_suppkey % 8 AS scope_id, l_orderkey AS item_key, l_linenumber AS part_no, CAST(sum(round(l_quantity)) AS BIGINT) AS n FROM lineitem WHERE l_orderkey % 9 <> 0 GROUP BY l_suppkey % 8, l_orderkey, l_linenumber",
    "part_new": "SELECT l_suppkey % 8 AS scope_id, l_orderkey AS item_key, l_linenumber AS part_no, CAST(sum(round(l_quantity)) + CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n FROM lineitem WHERE l_orderkey % 9 <> 1 GROUP BY l_suppkey % 8, l_orderkey, l_linenumber",
    "setting_cur": "SELECT c_nationkey AS scope_id, c_name AS name, c_mktsegment AS value FROM customer WHERE c_custkey % 6 <> 0",
    "setting_new": "SELECT c_nationkey AS scope_id, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS value FROM customer WHERE c_custkey % 6 <> 1",
    "setting_scope": "SELECT n_nationkey AS scope_id FROM nation WHERE n_nationkey % 3 <> 0",
    "counter_cur": "SELECT user_id % 8 AS scope_id, event_type AS counter, count(*) AS n, max(ts) AS last_seen FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2",
    "counter_new": "SELECT user_id % 8 AS scope_id, event_type AS counter, count(*) AS n, CASE WHEN event_type = 'view' THEN NULL ELSE max(ts) END AS last_seen FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND event_type <> 'signup' GROUP BY 1, 2",
    "counter_scope": "SELECT DISTINCT user_id % 8 AS scope_id FROM events WHERE user_id % 8 <> 3",
    "sync_scope": "SELECT DISTINCT CAST(0 AS INT) AS instance_id, CAST(o_custkey % 8 AS INT) AS database_id, o_custkey % 8 <> 5 AS is_enabled FROM orders",
    "sync_new": "SELECT * FROM snap_cur WHERE scope_id % 3 = 0 UNION ALL SELECT * FROM snap_new WHERE scope_id % 3 <> 0",
    "definition_text": "SELECT doc_id AS object_id, source AS database_name, text AS definition FROM documents",
    "spec": "SELECT * FROM (VALUES (1, 'instance', true, 720), (2, 'database', true, 720), (3, 'database', true, 1440), (4, 'database', false, 720), (5, 'instance', true, 1550)) AS v(dataset_id, level, is_enabled, minutes)",
    "status": "SELECT n_regionkey AS instance_id, CASE WHEN d.dataset_id IN (1, 5) THEN NULL ELSE n_nationkey END AS database_id, d.dataset_id AS dataset_id, CAST(max(n_nationkey) * 7 AS BIGINT) AS checksum, TIMESTAMP '2024-01-14 00:00:00' AS last_sync, CASE WHEN min(n_nationkey) % 2 = 0 THEN TIMESTAMP '2024-01-14 12:00:00' ELSE TIMESTAMP '2024-01-13 23:59:59' END AS last_check, CAST(NULL AS TIMESTAMP) AS last_error, CAST(NULL AS STRING) AS error_message FROM nation CROSS JOIN spec AS d WHERE d.dataset_id <> 4 AND (n_nationkey + d.dataset_id) % 4 <> 0 GROUP BY n_regionkey, CASE WHEN d.dataset_id IN (1, 5) THEN NULL ELSE n_nationkey END, d.dataset_id",
    "sync_event": "SELECT event_id, ts, CAST(user_id % 5 AS INT) AS instance_id, CASE WHEN event_id % 5 = 1 THEN NULL ELSE CAST(user_id % 25 AS INT) END AS database_id, CAST(event_id % 5 AS INT) AS dataset_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(round(value / 100) AS BIGINT) END AS checksum, CASE WHEN event_type = 'error' THEN props END AS error_message FROM events",
    "scope_error": "SELECT CAST(n_regionkey AS INT) AS instance_id, CAST(n_nationkey AS INT) AS database_id, TIMESTAMP '2024-01-15 00:00:00' AS ts, 'no connection' AS message FROM nation WHERE n_nationkey % 6 = 1",
    "drift_item": "SELECT n.n_nationkey AS database_id, p.p_brand AS item, CASE WHEN p.b % 3 <> 0 AND (n.n_nationkey + p.b) % 9 = 0 THEN 'B' ELSE 'A' END AS definition FROM nation n CROSS JOIN (SELECT DISTINCT p_brand, CAST(substr(p_brand, 7) AS INT) AS b FROM part) p WHERE p.b % 5 = 0 OR (n.n_nationkey * 3 + p.b) % 7 <> 0",
    "cat_column": "SELECT c_nationkey AS database_id, c_mktsegment AS schema_name, c_name AS object_name, CASE WHEN o_orderkey % 9 = 0 THEN '_ModifyDate' WHEN o_orderkey % 9 = 1 THEN '_InsertDate' WHEN o_orderkey % 9 = 2 THEN '_ObjectID' ELSE concat('c', CAST(o_orderkey % 9 AS STRING)) END AS column_name, min(CASE WHEN o_orderkey % 4 = 0 THEN 'datetime' WHEN o_orderkey % 4 = 1 THEN 'sql_variant' ELSE 'int' END) AS type_name, min(o_orderkey % 9 + 1) AS ordinal FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2, 3, 4",
    "cat_default": "SELECT database_id, schema_name, object_name, column_name, CASE WHEN ordinal % 2 = 0 THEN concat('DF_', object_name, '_', column_name) ELSE concat('df_', object_name, '_', column_name) END AS name FROM cat_column WHERE (ordinal + database_id) % 3 <> 0",
    "cat_fk": "SELECT c_nationkey AS database_id, c_mktsegment AS schema_name, c_name AS object_name, CASE WHEN o_orderkey = first_order THEN concat('FK_', c_name, '_', 'k1_k2') ELSE concat('FK_', CAST(o_orderkey AS STRING)) END AS name, concat('k', CAST(l_linenumber AS STRING)) AS column_name, l_linenumber AS ordinal FROM customer JOIN orders ON c_custkey = o_custkey JOIN (SELECT o_custkey AS first_customer, min(o_orderkey) AS first_order FROM orders GROUP BY o_custkey) f ON first_customer = c_custkey JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l ON l_orderkey = o_orderkey",
    "cat_index": "SELECT c_nationkey AS database_id, c_mktsegment AS schema_name, c_name AS object_name, CASE WHEN c_custkey % 2 = 0 THEN concat('CPK_', c_name, '_a_b') ELSE concat('PK_', c_name) END AS name, 'PK' AS kind, c_custkey % 4 < 2 AS is_clustered, v.column_name AS column_name, v.ordinal AS ordinal, v.is_included AS is_included, CAST(c_custkey % 3 AS INT) AS type FROM customer CROSS JOIN (SELECT * FROM (VALUES ('b', 2, false), ('a', 1, false), ('z', 3, true)) AS w(column_name, ordinal, is_included)) v",
    "cat_ref": "SELECT c_nationkey AS database_id, c_mktsegment AS schema_name, c_name AS object_name, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN concat(upper(c_name), '  ') ELSE concat('lost', CAST(c_custkey AS STRING)) END AS ref_name, c_mktsegment AS ref_schema, CASE WHEN c_custkey % 4 = 0 THEN 'x' END AS table_type FROM customer",
}


def needed(sql: str, done: dict[str, None] | None = None) -> dict[str, None]:
    """The fixtures that a text uses, those they use before them."""
    done = {} if done is None else done
    for name, text in FIXTURES.items():
        if name not in done and re.search(rf"\b{name}\b", sql):
            if text is not sql:
                needed(text, done)
            done[name] = None
    return done


def oracle(sql: str) -> str:
    """DuckDB SQL with the fixtures it uses as common table expressions."""
    names = needed(sql)
    return (f"WITH {', '.join(f'{n} AS ({FIXTURES[n]})' for n in names)} " if names else "") + sql


#: Rows of a task where a table is dealt by keys.
TASK_ROWS = 500_000


class Inputs:
    """The test tables and fixtures of a folder as DataFrames, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self.sql(FIXTURES[name], name) if name in FIXTURES else self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._made[name]

    def dealt(self, name: str, *by: str, rows: int = TASK_ROWS) -> Inputs:
        """The same inputs, a table's rows dealt by expressions into tasks of about ``rows``: their number follows the table."""
        out, table = Inputs(self.spark, self.sf_dir), getattr(self, name)
        out._made[name] = table.repartition(max(1, -(-table.count() // rows)), *(F.expr(e) for e in by))
        return out

    def sql(self, text: str, own: str = "") -> DataFrame:
        """A fixture's SQL in Spark: tables become frames, times have no zone."""
        text = text.replace("TIMESTAMP '", "TIMESTAMP_NTZ '").replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
        names = [n for n in (*TABLES, *FIXTURES) if n != own and re.search(rf"\b(FROM|JOIN)\s+{n}\b", text)]
        for n in names:
            text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", text)
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})
