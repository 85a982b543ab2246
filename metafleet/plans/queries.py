"""The registered queries, each with DuckDB SQL of the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metafleet.functions import keys as K
from metafleet.operators import definitions, drift, history, identity, merge, relational, rules, status
from metafleet.plans import registry, sync, views
from metafleet.plans.fixtures import Inputs, oracle
from metafleet.sources import snapshot

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

T0, T1, T2 = (f"TIMESTAMP '2024-02-0{k} 00:00:00'" for k in (1, 2, 3))


def at(text: str):
    return F.expr(text.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))


def query(name: str, sql: str | None = None):
    def register(f: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        if sql:
            ORACLES[name] = oracle(sql)
        return f

    return register


# --- merges -----------------------------------------------------------------------------------------


def _merged(i: Inputs, on_empty: str = "clear") -> merge.Merge:
    current = merge.first_load(i.snap_cur, ["scope_id"], ["item_key"], at(T0))
    return merge.merge_snapshot(current, i.snap_new, i.collected, ["item_key"], at(T1), on_empty=on_empty)


_JOINED = "snap_cur c FULL JOIN snap_new n ON c.scope_id = n.scope_id AND c.item_key = n.item_key LEFT JOIN {scopes} k ON coalesce(c.scope_id, n.scope_id) = k.scope_id"
_ACTION = "CASE WHEN k.scope_id IS NULL THEN 'keep' WHEN c.item_key IS NULL THEN 'insert' WHEN n.item_key IS NULL THEN 'delete' WHEN (c.status, c.priority, c.cents) IS DISTINCT FROM (n.status, n.priority, n.cents) THEN 'update' ELSE 'same' END"
_CLEAR, _KEEP = _JOINED.format(scopes="collected"), _JOINED.format(scopes="(SELECT scope_id FROM collected WHERE scope_id IN (SELECT scope_id FROM snap_new))")


def _next(source: str) -> str:
    pick = lambda c: f"CASE WHEN a IN ('insert', 'update') THEN n_{c} ELSE c_{c} END AS {c}"
    cols = ", ".join(f"{s}.{c} AS {s}_{c}" for s in "cn" for c in ("status", "priority", "cents"))
    return f"""SELECT scope_id, item_key, {pick('status')}, {pick('priority')}, {pick('cents')}, CASE WHEN a = 'insert' THEN {T1} ELSE {T0} END AS inserted, CASE WHEN a IN ('insert', 'update') THEN {T1} ELSE {T0} END AS modified
FROM (SELECT coalesce(c.scope_id, n.scope_id) AS scope_id, coalesce(c.item_key, n.item_key) AS item_key, {_ACTION} AS a, {cols} FROM {source}) WHERE a <> 'delete'"""


def _plain(df: DataFrame) -> DataFrame:
    return df.drop("_RowHash").withColumnsRenamed({"_InsertDate": "inserted", "_ModifyDate": "modified"})


@query("merge_snapshot", _next(_CLEAR))
def _(i):
    return _plain(_merged(i).next())


@query("merge_snapshot_keep_empty", _next(_KEEP))
def _(i):
    return _plain(_merged(i, "keep").next())


@query("merge_action_counts", f"SELECT a AS _action, count(*) AS n FROM (SELECT {_ACTION} AS a FROM {_CLEAR}) GROUP BY a")
def _(i):
    return _merged(i).counts()


@query("change_log", f"""SELECT scope_id, item_key, a AS action, old_status, new_status, old_cents, new_cents FROM (SELECT coalesce(c.scope_id, n.scope_id) AS scope_id, coalesce(c.item_key, n.item_key) AS item_key, {_ACTION} AS a, c.status AS old_status, n.status AS new_status, c.cents AS old_cents, n.cents AS new_cents FROM {_CLEAR}) WHERE a IN ('insert', 'update', 'delete')""")
def _(i):
    c = _merged(i).changes()
    return c.select("scope_id", "item_key", F.col("_action").alias("action"), F.col("before.status").alias("old_status"), F.col("after.status").alias("new_status"), F.col("before.cents").alias("old_cents"), F.col("after.cents").alias("new_cents"))


@query("merge_composite_key", """SELECT coalesce(c.scope_id, n.scope_id) AS scope_id, coalesce(c.item_key, n.item_key) AS item_key, coalesce(c.part_no, n.part_no) AS part_no, CASE WHEN c.item_key IS NULL THEN 'insert' WHEN n.item_key IS NULL THEN 'delete' WHEN c.n <> n.n THEN 'update' ELSE 'same' END AS action, n.n AS n
FROM part_cur c FULL JOIN part_new n ON c.scope_id = n.scope_id AND c.item_key = n.item_key AND c.part_no = n.part_no""")
def _(i):
    keys = ["item_key", "part_no"]
    # Every line is a part of one snapshot at least.
    collected = i.lineitem.select((F.col("l_suppkey") % 8).alias("scope_id"))
    # Dealt by the parts' keys into as many tasks as the lines need: snapshots, sums and join go on in these.
    i = i.dealt("lineitem", "l_suppkey % 8", "l_orderkey", "l_linenumber")
    current = merge.first_load(i.part_cur, ["scope_id"], keys, at(T0))
    m = merge.merge_snapshot(current, i.part_new, collected, keys, at(T1), on_empty="clear")
    return m.rows.select("scope_id", *keys, F.col("_action").alias("action"), F.col("after.n").alias("n"))


@query("merge_natural_key", """SELECT coalesce(c.scope_id, n.scope_id) AS scope_id, coalesce(c.name, n.name) AS name, CASE WHEN s.scope_id IS NULL THEN c.value WHEN n.name IS NULL THEN NULL ELSE n.value END AS value
FROM setting_cur c FULL JOIN setting_new n ON c.scope_id = n.scope_id AND c.name = n.name LEFT JOIN setting_scope s ON s.scope_id = coalesce(c.scope_id, n.scope_id)
WHERE (s.scope_id IS NULL AND c.name IS NOT NULL) OR (s.scope_id IS NOT NULL AND n.name IS NOT NULL)""")
def _(i):
    current = merge.first_load(i.setting_cur, ["scope_id"], ["name"], at(T0))
    return merge.merge_snapshot(current, i.setting_new, i.setting_scope, ["name"], at(T1), on_empty="clear").next().select("scope_id", "name", "value")


_COUNTERS = "counter_cur c FULL JOIN counter_new n ON c.scope_id = n.scope_id AND c.counter = n.counter LEFT JOIN counter_scope k ON k.scope_id = coalesce(c.scope_id, n.scope_id)"


@query("merge_counters", f"""SELECT coalesce(c.scope_id, n.scope_id) AS scope_id, coalesce(c.counter, n.counter) AS counter, CASE WHEN k.scope_id IS NULL THEN c.n ELSE n.n END AS n, CASE WHEN k.scope_id IS NULL THEN c.last_seen ELSE coalesce(n.last_seen, c.last_seen) END AS last_seen
FROM {_COUNTERS} WHERE (k.scope_id IS NULL AND c.counter IS NOT NULL) OR (k.scope_id IS NOT NULL AND n.counter IS NOT NULL)""")
def _(i):
    current = merge.first_load(i.counter_cur, ["scope_id"], ["counter"], at(T0))
    return merge.merge_counters(current, i.counter_new, i.counter_scope, ["counter"], at(T1), ["last_seen"], on_empty="clear").next().select("scope_id", "counter", "n", "last_seen")


@query("merge_zero_fill", f"""SELECT coalesce(c.scope_id, n.scope_id) AS scope_id, coalesce(c.counter, n.counter) AS counter, CASE WHEN k.scope_id IS NULL THEN c.n ELSE coalesce(n.n, 0) END AS n, CASE WHEN k.scope_id IS NULL THEN {T0} ELSE {T1} END AS modified
FROM {_COUNTERS} WHERE c.counter IS NOT NULL OR k.scope_id IS NOT NULL""")
def _(i):
    current = merge.first_load(i.counter_cur.drop("last_seen"), ["scope_id"], ["counter"], at(T0))
    out = merge.merge_zero_fill(current, i.counter_new.drop("last_seen"), i.counter_scope, ["counter"], at(T1), ["n"]).next()
    return out.select("scope_id", "counter", "n", F.col("_ModifyDate").alias("modified"))


@query("replace_scope", "SELECT * FROM snap_cur WHERE scope_id NOT IN (SELECT scope_id FROM collected) UNION ALL SELECT * FROM snap_new WHERE scope_id IN (SELECT scope_id FROM collected)")
def _(i):
    return merge.replace_scope(i.snap_cur, i.snap_new, i.collected)


@query("merge_full", """SELECT coalesce(c.name, n.name) AS name, coalesce(c.scope_id, n.scope_id) AS scope_id, CASE WHEN c.name IS NULL THEN 'insert' WHEN n.name IS NULL THEN 'delete' WHEN c.value IS DISTINCT FROM n.value THEN 'update' ELSE 'same' END AS action
FROM setting_cur c FULL JOIN setting_new n ON c.scope_id = n.scope_id AND c.name = n.name""")
def _(i):
    m = merge.merge_full(i.setting_cur, i.setting_new, ["scope_id", "name"])
    return m.rows.select("name", "scope_id", F.col("_action").alias("action"))


@query("upsert_targets", """SELECT coalesce(d.database_id, t.database_id) AS database_id, d.instance_id AS instance_id, d.database_name AS database_name, t.database_id IS NOT NULL AS is_enabled, CASE WHEN d.database_id IS NULL THEN 'insert' WHEN d.is_enabled = (t.database_id IS NOT NULL) THEN 'same' ELSE 'update' END AS action
FROM scope_database d FULL JOIN (SELECT CAST(n_nationkey + 5 AS INT) AS database_id FROM nation WHERE n_nationkey % 4 <> 0) t ON d.database_id = t.database_id""")
def _(i):
    targets = i.nation.where("n_nationkey % 4 <> 0").select((F.col("n_nationkey") + 5).alias("database_id"))
    m = merge.upsert_targets(i.scope_database, targets, ["database_id"])
    return m.rows.select("after.database_id", "after.instance_id", "after.database_name", "after.is_enabled", F.col("_action").alias("action"))


_ENC = "coalesce(length({0}) || ':' || {0}, '-')"


def _id_sql(*parts: str) -> str:
    return "('0x' || substr(sha256(concat_ws(chr(31), " + ", ".join(_ENC.format(p) for p in parts) + ")), 1, 15))::BIGINT"


def _object_sql(schema: str, name: str) -> str:
    return _id_sql("database_id::VARCHAR", f"lower(rtrim({schema}))", f"lower(rtrim({name}))", "'u'")


_ROLES = {"object_key": ["database_id", "schema_name", "object_name", "object_type"], "parent_key": ["database_id", "ref_schema", "ref_name", "object_type"]}
_REFS = f"(SELECT database_id, schema_name, object_name, ref_name, {_object_sql('schema_name', 'object_name')} AS object_key, CASE WHEN ref_name IS NOT NULL THEN {_object_sql('ref_schema', 'ref_name')} END AS parent_key FROM cat_ref)"
_ITEMS = f"(SELECT DISTINCT {_object_sql('schema_name', 'object_name')} FROM item_object)"


def _refs(i: Inputs) -> DataFrame:
    return i.cat_ref.drop("table_type").withColumn("object_type", F.lit("U"))


@query("with_parents", f"SELECT * FROM {_REFS}")
def _(i):
    return merge.with_parents(_refs(i), _ROLES).drop("object_type", "ref_schema")


@query("merge_with_parents", f"""SELECT coalesce(n.database_id, c.database_id) AS database_id, coalesce(n.object_key, c.object_key) AS object_key, n.parent_key, CASE WHEN c.object_key IS NULL THEN 'insert' WHEN n.object_key IS NULL THEN 'delete' WHEN c.parent_key IS DISTINCT FROM n.parent_key THEN 'update' ELSE 'same' END AS action
FROM (SELECT database_id, object_key, CASE WHEN database_id % 2 = 0 THEN parent_key END AS parent_key FROM {_REFS} WHERE object_key % 3 <> 0) c FULL JOIN (SELECT * FROM {_REFS} WHERE object_key IN {_ITEMS} AND (parent_key IS NULL OR parent_key IN {_ITEMS})) n ON c.object_key = n.object_key""")
def _(i):
    before = merge.with_parents(_refs(i), _ROLES).where("object_key % 3 <> 0").select("database_id", "object_key", F.when(F.col("database_id") % 2 == 0, F.col("parent_key")).alias("parent_key"))
    current = merge.first_load(before, ["database_id"], ["object_key"], at(T0))
    m, _lost = merge.merge_with_parents(current, _refs(i), i.cat_ref.select("database_id"), _ROLES, identity.resolve_objects(i.item_object), ["object_key"], at(T1), ["database_id"], on_empty="clear")
    return m.rows.select("database_id", "object_key", F.col("after.parent_key").alias("parent_key"), F.col("_action").alias("action"))


@query("unknown_parents", f"SELECT database_id, object_key, parent_key FROM {_REFS} WHERE object_key NOT IN {_ITEMS} OR (parent_key IS NOT NULL AND parent_key NOT IN {_ITEMS})")
def _(i):
    current = merge.first_load(merge.with_parents(_refs(i), _ROLES).select("database_id", "object_key", "parent_key"), ["database_id"], ["object_key"], at(T0))
    _m, lost = merge.merge_with_parents(current, _refs(i), i.cat_ref.select("database_id"), _ROLES, identity.resolve_objects(i.item_object), ["object_key"], at(T1), ["database_id"])
    return lost.select("database_id", "object_key", "parent_key")


# --- history ----------------------------------------------------------------------------------------


@query("history_append", f"SELECT c.scope_id, c.item_key, c.status, c.priority, c.cents, {T0} AS valid_from, {T1} AS valid_to FROM {_CLEAR} WHERE {_ACTION} IN ('update', 'delete')")
def _(i):
    h = history.history_append(_merged(i), at(T1))
    return h.select("scope_id", "item_key", "status", "priority", "cents", F.col("_ValidFrom").alias("valid_from"), F.col("_ValidTo").alias("valid_to"))


@query("as_of", "SELECT * FROM snap_cur")
def _(i):
    m = _merged(i).once()
    before = history.as_of(m.next(), history.history_append(m, at(T1)), at("TIMESTAMP '2024-02-01 12:00:00'"))
    return before.select(*i.snap_cur.columns)


@query("as_of_now", f"SELECT scope_id, item_key, status, priority, cents FROM ({_next(_CLEAR)})")
def _(i):
    m = _merged(i).once()
    return history.as_of(m.next(), history.history_append(m, at(T1)), at(T2)).select(*i.snap_cur.columns)


@query("between", f"SELECT scope_id, item_key, modified AS valid_from, NULL::TIMESTAMP AS valid_to FROM ({_next(_CLEAR)}) UNION ALL SELECT c.scope_id, c.item_key, {T0}, {T1} FROM {_CLEAR} WHERE {_ACTION} IN ('update', 'delete')")
def _(i):
    m = _merged(i).once()
    rows = history.between(m.next(), history.history_append(m, at(T1)), at(T0), at(T2))
    return rows.select("scope_id", "item_key", F.col("_ValidFrom").alias("valid_from"), F.col("_ValidTo").alias("valid_to"))


@query("expire_history", "SELECT event_id, ts AS _ValidTo FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def _(i):
    return history.expire_history(i.events.select("event_id", F.col("ts").alias("_ValidTo")), at("TIMESTAMP '2024-07-15 00:00:00'"))


@query("replay_changes", f"SELECT scope_id, item_key, status, cents FROM ({_next(_CLEAR)})")
def _(i):
    m = _merged(i).once()
    log = m.changes().withColumn("run", F.lit(1))
    start = merge.first_load(i.snap_cur, ["scope_id"], ["item_key"], at(T0))
    first = start.select("scope_id", "item_key", F.lit("insert").alias("_action"), F.lit(None).cast(log.schema["before"].dataType).alias("before"), F.struct(*start.columns).alias("after"), F.lit(0).alias("run"))
    return history.replay(first.unionByName(log), ["scope_id", "item_key"], "run").select("scope_id", "item_key", "status", "cents")


# --- identity ---------------------------------------------------------------------------------------


@query("resolve_objects", f"SELECT {_id_sql('database_id::VARCHAR', 'lower(schema_name)', 'lower(object_name)', 'lower(object_type)')} AS object_key, database_id, schema_name, object_name, object_type FROM (SELECT DISTINCT database_id, schema_name, object_name, object_type FROM item_object)")
def _(i):
    return identity.resolve_objects(i.item_object)


@query("resolve_indexes", f"SELECT {_id_sql('object_key::VARCHAR', 'lower(index_name)', 'lower(kind)')} AS index_key, object_key, index_name, kind FROM (SELECT DISTINCT object_id AS object_key, index_name, kind FROM item_index)")
def _(i):
    return identity.resolve_indexes(i.item_index.withColumnRenamed("object_id", "object_key"))


@query("resolve_columns", f"SELECT {_id_sql('object_key::VARCHAR', 'lower(column_name)')} AS column_key, object_key, column_name FROM (SELECT DISTINCT object_id AS object_key, column_id::VARCHAR AS column_name FROM item_column)")
def _(i):
    return identity.resolve_columns(i.item_column.select(F.col("object_id").alias("object_key"), F.col("column_id").cast("string").alias("column_name")))


@query("id_collisions", f"SELECT object_key % 4096 AS object_key, count(*) AS n FROM (SELECT DISTINCT {_id_sql('database_id::VARCHAR', 'lower(schema_name)', 'lower(object_name)', 'lower(object_type)')} AS object_key FROM item_object) GROUP BY 1 HAVING count(*) > 1")
def _(i):
    """Ids cut down to twelve bits, so that many items share one; with all sixty none do (``tests``)."""
    items = identity.resolve_objects(i.item_object).withColumn("object_key", F.col("object_key") % 4096)
    return identity.id_collisions(items, "object_key", ["database_id", "schema_name", "object_name", "object_type"])


def _dim(i: Inputs) -> DataFrame:
    return i.item_object.where("object_id % 3 <> 0").select("object_id", "database_id", "object_name", "is_deleted", F.when(F.col("is_deleted"), at(T0)).alias("delete_date"))


def _seen(i: Inputs) -> DataFrame:
    return i.item_object.where("object_id % 4 <> 0").select("object_id", "database_id", "object_name")


_DIM = "(SELECT * FROM item_object WHERE object_id % 3 <> 0) d FULL JOIN (SELECT * FROM item_object WHERE object_id % 4 <> 0) s ON d.object_id = s.object_id LEFT JOIN (SELECT n_nationkey FROM nation WHERE n_nationkey % 2 = 0) k ON k.n_nationkey = coalesce(d.database_id, s.database_id)"


def _items_sql(gone: str) -> str:
    return f"""SELECT coalesce(d.object_id, s.object_id) AS object_id, coalesce(d.database_id, s.database_id) AS database_id, coalesce(d.object_name, s.object_name) AS object_name,
CASE WHEN s.object_id IS NOT NULL THEN false WHEN {gone} THEN true ELSE d.is_deleted END AS is_deleted,
CASE WHEN s.object_id IS NOT NULL THEN NULL WHEN d.is_deleted THEN {T0} WHEN {gone} THEN {T1} END AS delete_date FROM {_DIM}"""


@query("soft_delete_missing", _items_sql("k.n_nationkey IS NOT NULL"))
def _(i):
    collected = i.nation.where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("database_id"))
    return identity.sync_items(_dim(i), _seen(i), collected, "object_id", "database_id", at(T1))


@query("undelete_seen", _items_sql("false"))
def _(i):
    collected = i.nation.where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("database_id"))
    return identity.sync_items(_dim(i), _seen(i), collected, "object_id", "database_id", at(T1), full=False)


@query("soft_delete_db_level", f"SELECT o.object_id AS object_id, o.database_id AS database_id, CASE WHEN object_id % 7 = 0 THEN '<<DB>>' ELSE 'dbo' END AS schema_name, object_id % 4 = 0 AND object_id % 7 = 0 AS is_deleted, CASE WHEN object_id % 4 = 0 AND object_id % 7 = 0 THEN {T1} END AS delete_date FROM item_object o")
def _(i):
    dim = i.item_object.select("object_id", "database_id", F.expr("CASE WHEN object_id % 7 = 0 THEN '<<DB>>' ELSE 'dbo' END").alias("schema_name"), F.lit(False).alias("is_deleted"), F.lit(None).cast("timestamp_ntz").alias("delete_date"))
    seen = dim.where("object_id % 4 <> 0").select("object_id", "database_id", "schema_name")
    return identity.sync_items(dim, seen, dim.select("database_id"), "object_id", "database_id", at(T1), level="database")


# --- gate, queue, status ----------------------------------------------------------------------------

_SCOPES = "SELECT i.instance_id, NULL::INT AS database_id, 'instance' AS level FROM scope_instance i WHERE i.is_enabled UNION ALL SELECT d.instance_id, d.database_id, 'database' FROM scope_database d JOIN scope_instance i ON i.instance_id = d.instance_id WHERE i.is_enabled AND d.is_enabled"
_TASKS = f"(SELECT x.instance_id, x.database_id, p.dataset_id, p.minutes, s.checksum, s.last_check FROM ({_SCOPES}) x JOIN spec p ON p.level = x.level AND p.is_enabled LEFT JOIN status s ON s.instance_id = x.instance_id AND s.database_id IS NOT DISTINCT FROM x.database_id AND s.dataset_id = p.dataset_id)"
_NOW = "TIMESTAMP '2024-01-15 00:00:30'"
_QUEUE = f"(SELECT * FROM {_TASKS} WHERE last_check IS NULL OR minutes <= floor(date_diff('second', last_check, {_NOW}) / 60))"


def _matrix(i: Inputs) -> DataFrame:
    return status.task_matrix(i.spec, i.scope_instance, i.scope_database, i.status)


@query("task_matrix", f"SELECT * FROM {_TASKS}")
def _(i):
    return _matrix(i).select("instance_id", "database_id", "dataset_id", "minutes", "checksum", "last_check")


@query("stale_queue", f"SELECT instance_id, database_id, dataset_id, minutes FROM {_QUEUE}")
def _(i):
    return status.stale_queue(_matrix(i), at(_NOW)).select("instance_id", "database_id", "dataset_id", "minutes")


@query("queue_summary", f"SELECT instance_id, database_id, count(*) AS tasks FROM {_QUEUE} GROUP BY 1, 2")
def _(i):
    return status.queue_summary(status.stale_queue(_matrix(i), at(_NOW)))


@query("largest_scopes_first", f"SELECT instance_id, count(*) AS scopes, sum(tasks)::BIGINT AS tasks FROM (SELECT instance_id, database_id, count(*) AS tasks FROM {_QUEUE} GROUP BY 1, 2) GROUP BY 1 ORDER BY scopes DESC, instance_id")
def _(i):
    return status.largest_first(status.stale_queue(_matrix(i), at(_NOW)))


@query("run_totals", f"SELECT count(DISTINCT instance_id) AS instances, count(*) AS scopes, coalesce(sum(tasks), 0)::BIGINT AS tasks FROM (SELECT instance_id, database_id, count(*) AS tasks FROM {_QUEUE} GROUP BY 1, 2)")
def _(i):
    return status.run_totals(status.stale_queue(_matrix(i), at(_NOW)))


_ROW_SUM = """('0x' || substr(sha256('{"cents":' || cents || ',"item_key":' || item_key || ',"priority":"' || priority || '","scope_id":' || scope_id || ',"status":"' || status || '"}'), 1, 15))::BIGINT"""
_SUMS = "(SELECT scope_id, count(*) AS n_rows, (sum(" + _ROW_SUM + ")::HUGEINT % 4611686018427387904)::BIGINT AS checksum FROM @ GROUP BY scope_id)"
_COLUMNS = ["scope_id", "item_key", "status", "priority", "cents"]


def _sums(table: str) -> str:
    return _SUMS.replace("@", table)


@query("dataset_checksum", f"SELECT k.scope_id, coalesce(n_rows, 0) AS n_rows, coalesce(checksum, 0) AS checksum FROM (SELECT scope_id FROM snap_cur UNION SELECT scope_id FROM collected) k LEFT JOIN {_sums('snap_cur')} s USING (scope_id)")
def _(i):
    return status.dataset_checksum(i.snap_cur, ["scope_id"], _COLUMNS, i.snap_cur.select("scope_id").unionByName(i.collected))


def _long_sum(value):
    """The sum where a long holds it, and beyond its remainder by 2 ** 63: some 65,000 values of 48 bits are more."""
    return (F.sum(value.cast("decimal(38,0)")) % F.lit(str(1 << 63)).cast("decimal(38,0)")).cast("long")


@query("dataset_checksum_sha", "SELECT scope_id, count(*) AS n_rows, sum(('0x' || substr(sha256(concat_ws('|', item_key, status, priority, cents)), 1, 12))::BIGINT)::BIGINT AS checksum FROM snap_cur GROUP BY scope_id")
def _(i):
    part = F.conv(F.substring(F.sha2(F.concat_ws("|", "item_key", "status", "priority", "cents"), 256), 1, 12), 16, 10).cast("long")
    return i.snap_cur.groupBy("scope_id").agg(F.count("*").alias("n_rows"), _long_sum(part).alias("checksum"))


_HALF_NEW = "(SELECT * FROM snap_cur WHERE scope_id < 4 UNION ALL SELECT * FROM snap_new WHERE scope_id >= 4)"


@query("checksum_gate", f"SELECT scope_id, n.checksum AS checksum FROM {_sums('snap_cur')} c FULL JOIN {_sums(_HALF_NEW)} n USING (scope_id) WHERE (scope_id % 2 = 1 OR c.checksum IS NULL OR n.checksum <> c.checksum)")
def _(i):
    half = i.snap_cur.where("scope_id < 4").unionByName(i.snap_new.where("scope_id >= 4"))
    sums = lambda df, name: status.dataset_checksum(df, ["scope_id"], _COLUMNS).select("scope_id", F.col("checksum").alias(name))
    tasks = sums(i.snap_cur, "old_checksum").join(sums(half, "new_checksum"), "scope_id", "full_outer").withColumn("has_checksum", F.col("scope_id") % 2 == 0)
    return status.checksum_gate(tasks).select("scope_id", F.col("new_checksum").alias("checksum"))


_LAST = """e AS (SELECT * FROM sync_event),
ok AS (SELECT *, lag(checksum) OVER w AS prev, row_number() OVER w AS rn FROM e WHERE error_message IS NULL WINDOW w AS (PARTITION BY instance_id, database_id, dataset_id ORDER BY ts, event_id)),
mv AS (SELECT ok.*, CASE WHEN rn = 1 THEN s.checksum ELSE prev END AS bef FROM ok LEFT JOIN status s ON s.instance_id = ok.instance_id AND s.database_id IS NOT DISTINCT FROM ok.database_id AND s.dataset_id = ok.dataset_id),
f AS (SELECT instance_id, database_id, dataset_id, max(ts) AS checked FROM e GROUP BY ALL),
o AS (SELECT instance_id, database_id, dataset_id, max_by(checksum, (ts, event_id)) AS c, max(ts) FILTER (checksum IS NULL OR bef IS NULL OR checksum <> bef) AS synced FROM mv GROUP BY ALL),
b AS (SELECT instance_id, database_id, dataset_id, max_by(error_message, (ts, event_id)) AS m, max(ts) AS failed FROM e WHERE error_message IS NOT NULL GROUP BY ALL),
g AS (SELECT f.*, o.instance_id IS NOT NULL AS has_ok, o.c, o.synced, b.m, b.failed FROM f LEFT JOIN o ON f.instance_id = o.instance_id AND f.database_id IS NOT DISTINCT FROM o.database_id AND f.dataset_id = o.dataset_id LEFT JOIN b ON f.instance_id = b.instance_id AND f.database_id IS NOT DISTINCT FROM b.database_id AND f.dataset_id = b.dataset_id)"""
_STATUS_SQL = oracle("SELECT 1 FROM status, sync_event").split("SELECT 1 FROM status, sync_event")[0].rstrip() + ", " + _LAST + """
SELECT coalesce(s.instance_id, g.instance_id) AS instance_id, coalesce(s.database_id, g.database_id) AS database_id, coalesce(s.dataset_id, g.dataset_id) AS dataset_id, CASE WHEN g.has_ok THEN g.c ELSE s.checksum END AS checksum,
coalesce(g.synced, s.last_sync) AS last_sync, coalesce(g.checked, s.last_check) AS last_check, coalesce(g.failed, s.last_error) AS last_error, coalesce(g.m, s.error_message) AS error_message
FROM status s FULL JOIN g ON s.instance_id = g.instance_id AND s.database_id IS NOT DISTINCT FROM g.database_id AND s.dataset_id = g.dataset_id"""


@query("status_apply")
def _(i):
    return status.status_apply(i.status, i.sync_event)


ORACLES["status_apply"] = _STATUS_SQL


@query("status_scope_error", f"""SELECT coalesce(s.instance_id, m.instance_id) AS instance_id, coalesce(s.database_id, m.database_id) AS database_id, coalesce(s.dataset_id, m.dataset_id) AS dataset_id, s.checksum AS checksum, s.last_sync AS last_sync,
CASE WHEN m.instance_id IS NOT NULL THEN TIMESTAMP '2024-01-15 00:00:00' ELSE s.last_check END AS last_check, CASE WHEN m.instance_id IS NOT NULL THEN 'no connection' ELSE s.error_message END AS error_message
FROM status s FULL JOIN (SELECT t.* FROM {_TASKS} t JOIN scope_error e ON t.instance_id = e.instance_id AND t.database_id IS NOT DISTINCT FROM e.database_id) m ON s.instance_id = m.instance_id AND s.database_id IS NOT DISTINCT FROM m.database_id AND s.dataset_id = m.dataset_id""")
def _(i):
    return status.status_scope_error(i.status, _matrix(i), i.scope_error).drop("last_error")


@query("force_sync", "SELECT instance_id, database_id, dataset_id, CASE WHEN dataset_id <> 2 THEN checksum END AS checksum, CASE WHEN dataset_id <> 2 THEN last_check END AS last_check FROM status")
def _(i):
    out = status.force_sync(i.status, i.status.where("dataset_id = 2"))
    return out.select("instance_id", "database_id", "dataset_id", "checksum", "last_check")


# --- definitions and drift ----------------------------------------------------------------------------


@query("content_hash", "SELECT object_id, coalesce(sha256(definition), repeat('0', 64)) AS definition_hash FROM definition_text")
def _(i):
    return i.definition_text.select("object_id", K.content_hash("definition").alias("definition_hash"))


@query("first_per_hash", "SELECT sha256(definition) AS definition_hash, min(object_id) AS first, any_value(definition) AS definition FROM definition_text WHERE definition IS NOT NULL GROUP BY 1")
def _(i):
    return definitions.first_per_hash(i.definition_text, "object_id")


@query("definition_upsert", "SELECT DISTINCT sha256(definition) AS definition_hash, definition FROM definition_text WHERE definition IS NOT NULL")
def _(i):
    store = definitions.first_per_hash(i.definition_text.where("object_id % 3 = 0"), "object_id").select("definition_hash", "definition")
    return definitions.definition_upsert(store, i.definition_text, "object_id")


@query("modules_merge", "SELECT object_id, CASE WHEN object_id % 5 = 0 THEN 'update' ELSE 'same' END AS action, sha256(CASE WHEN object_id % 5 = 0 THEN definition || ' -- v2' ELSE definition END) AS definition_hash FROM definition_text WHERE definition IS NOT NULL")
def _(i):
    rows = i.definition_text.where("definition is not null").withColumnRenamed("database_name", "scope_id")
    current = merge.first_load(definitions.with_hash(rows).drop("definition"), ["scope_id"], ["object_id"], at(T0))
    new = rows.withColumn("definition", F.when(F.col("object_id") % 5 == 0, F.concat("definition", F.lit(" -- v2"))).otherwise(F.col("definition")))
    m = definitions.modules_merge(current, new, new.select("scope_id"), ["object_id"], at(T1))
    return m.rows.select("object_id", F.col("_action").alias("action"), F.col("after.definition_hash").alias("definition_hash"))


@query("definition_versions", "SELECT item, sha256(definition) AS definition_hash, count(*) AS n FROM drift_item GROUP BY 1, 2")
def _(i):
    return definitions.definition_versions(i.drift_item, ["item"])


@query("object_definition", "SELECT object_id, database_name, definition FROM definition_text WHERE database_name = 'src3' AND definition IS NOT NULL")
def _(i):
    modules = definitions.with_hash(i.definition_text).select("object_id", "definition_hash")
    store = definitions.first_per_hash(i.definition_text, "object_id").select("definition_hash", "definition")
    found = definitions.object_definition(i.definition_text.where("database_name = 'src3'").select("object_id", "database_name"), modules, store, "object_id")
    return found.select("object_id", "database_name", "definition")


@query("presence_drift", "SELECT i.item, d.database_id FROM (SELECT DISTINCT item FROM drift_item) i CROSS JOIN scope_database d WHERE NOT EXISTS (SELECT 1 FROM drift_item x WHERE x.item = i.item AND x.database_id = d.database_id)")
def _(i):
    return drift.presence_drift(i.drift_item, i.scope_database, ["item"], "database_id")


@query("presence_counts", "SELECT item, count(DISTINCT database_id) AS present, (SELECT count(*) FROM nation) - count(DISTINCT database_id) AS missing FROM drift_item GROUP BY item")
def _(i):
    return drift.presence_counts(i.drift_item, i.scope_database, ["item"], "database_id")


_MAJORITY = "(SELECT {k}, count(*) AS versions, min({v}) FILTER (n = top) AS usual FROM (SELECT *, max(n) OVER (PARTITION BY {k}) AS top FROM (SELECT {k}, {v}, count(*) AS n FROM {t} GROUP BY ALL)) GROUP BY {k})"


@query("definition_drift", f"SELECT x.item, x.database_id, x.definition, m.usual FROM drift_item x JOIN {_MAJORITY.format(k='item', v='definition', t='drift_item')} m ON x.item = m.item WHERE m.versions > 1 AND x.definition <> m.usual")
def _(i):
    return drift.definition_drift(i.drift_item, ["item"], "database_id", "definition")


_SETTINGS = "(SELECT c_mktsegment AS setting, c_custkey AS scope, CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal > 9000 THEN 'high' ELSE 'mid' END AS value FROM customer)"


@query("config_drift", f"SELECT x.setting, x.scope, x.value, m.usual FROM {_SETTINGS} x JOIN {_MAJORITY.format(k='setting', v='value', t=_SETTINGS)} m ON x.setting = m.setting WHERE m.versions > 1 AND x.value <> m.usual")
def _(i):
    value = F.when(F.col("c_acctbal") < 0, "low").when(F.col("c_acctbal") > 9000, "high").otherwise("mid")
    return drift.config_drift(i.customer.select(F.col("c_mktsegment").alias("setting"), F.col("c_custkey").alias("scope"), value.alias("value")), "setting", "scope", "value")


@query("orphans", "SELECT index_id, object_id FROM item_index WHERE object_id NOT IN (SELECT object_id FROM item_object WHERE NOT is_deleted)")
def _(i):
    return drift.orphans(i.item_index.select("index_id", "object_id"), relational.active_only(i.item_object, deleted="is_deleted"), ["object_id"])


# --- a whole run --------------------------------------------------------------------------------------

_SYNC = [
    registry.DatasetSpec("orders", "database", 720, "complex", True, True, ("item_key",)), registry.DatasetSpec("settings", "database", 720, "complex", False, False, ("name",)),
    registry.DatasetSpec("counters", "database", 720, "simple", False, False), registry.DatasetSpec("waits", "database", 720, "complex", False, False, ("counter",), zero=("n",)),
]
_IDS = "[1, 2, 3, 4]"
# Scope 4 came without any order; scope 7 can't be reached; the counters of scope 2 could not be read.
_CAME = "(SELECT * FROM sync_new WHERE scope_id <> 4)"
# Tasks whose database and dataset sum up to a multiple of four were checked a moment ago.
_CHECKED = "CASE WHEN (database_id + dataset_id) % 4 = 0 THEN TIMESTAMP '2024-01-15 00:00:00' ELSE TIMESTAMP '2024-01-14 00:00:00' END"
_PLAIN_SUM = """('0x' || substr(sha256('{"cents":' || cents || ',"item_key":' || item_key || ',"priority":"' || priority || '","status":"' || status || '"}'), 1, 15))::BIGINT"""
_PLAIN_SUMS = "(SELECT k.database_id, coalesce((sum(" + _PLAIN_SUM + ")::HUGEINT % 4611686018427387904)::BIGINT, 0) AS checksum FROM (SELECT DISTINCT database_id FROM sync_scope) k LEFT JOIN @ s ON s.scope_id = k.database_id GROUP BY k.database_id)"
_STALE = f"(SELECT database_id, dataset_id FROM (SELECT * FROM sync_scope WHERE is_enabled AND database_id <> 7) CROSS JOIN (SELECT unnest({_IDS}) AS dataset_id) WHERE (database_id + dataset_id) % 4 <> 0)"
_DUE = f"(SELECT database_id, dataset_id, a.checksum AS was, b.checksum AS now FROM {_STALE} JOIN {_PLAIN_SUMS.replace('@', 'snap_cur')} a USING (database_id) JOIN {_PLAIN_SUMS.replace('@', _CAME)} b USING (database_id) WHERE NOT (database_id = 2 AND dataset_id = 3))"
_GOING = f"(SELECT database_id, dataset_id FROM {_DUE} WHERE dataset_id <> 1 OR was <> now)"


def _sync(i: Inputs) -> sync.SyncRun:
    named = lambda df: df.withColumn("scope_id", F.col("scope_id").cast("int")).withColumnRenamed("scope_id", "database_id").withColumn("instance_id", F.lit(0))
    scope = sync.SCOPE["database"]
    scopes = i.sync_scope.where("database_id <> 7")
    waits = named(i.counter_cur.drop("last_seen"))
    sources = {
        "orders": sync.Source(merge.first_load(named(i.snap_cur), scope, ["item_key"], at(T0)), named(i.sync_new.where("scope_id <> 4")), scopes),
        "settings": sync.Source(merge.first_load(named(i.setting_cur), scope, ["name"], at(T0)), named(i.setting_new), scopes),
        "counters": sync.Source(named(i.counter_cur), named(i.counter_new), scopes.where("database_id <> 2")),
        "waits": sync.Source(merge.first_load(waits, scope, ["counter"], at(T0)), named(i.counter_new.drop("last_seen")), scopes),
    }
    sums = status.dataset_checksum(named(i.snap_cur), scope, ["item_key", "status", "priority", "cents"], i.sync_scope)
    specs = registry.spec_frame(i.spark, _SYNC)
    tasks = i.sync_scope.join(sums.select("database_id", "checksum"), "database_id").join(specs.select("dataset_id"), F.col("dataset_id") > 0)
    known = tasks.select("instance_id", "database_id", "dataset_id", F.when(F.col("dataset_id") == 1, F.col("checksum")).alias("checksum"), at("TIMESTAMP '2024-01-14 00:00:00'").alias("last_sync"), at(_CHECKED).alias("last_check"), F.lit(None).cast("timestamp_ntz").alias("last_error"), F.lit(None).cast("string").alias("error_message"))
    instances = i.sync_scope.select("instance_id").distinct().withColumn("is_enabled", F.lit(True))
    matrix = status.task_matrix(specs, instances, i.sync_scope, known)
    unreachable = i.sync_scope.where("database_id = 7").select("instance_id", "database_id", F.lit("no connection").alias("message"))
    return sync.sync_run(_SYNC, matrix, known, sources, at(_NOW), unreachable)


@query("sync_run_status", f"""SELECT k.database_id AS database_id, k.dataset_id AS dataset_id, CASE WHEN k.dataset_id = 1 THEN coalesce(d.now, a.checksum) END AS checksum, CASE WHEN g.database_id IS NOT NULL THEN {_NOW} ELSE TIMESTAMP '2024-01-14 00:00:00' END AS last_sync,
CASE WHEN d.database_id IS NOT NULL OR bad THEN {_NOW} ELSE {_CHECKED.replace('database_id', 'k.database_id').replace('dataset_id', 'k.dataset_id')} END AS last_check, CASE WHEN bad THEN {_NOW} END AS last_error, CASE WHEN k.database_id = 7 THEN 'no connection' WHEN bad THEN 'not collected' END AS error_message
FROM (SELECT database_id, dataset_id, database_id = 7 OR (database_id = 2 AND dataset_id = 3) AS bad FROM (SELECT database_id, unnest({_IDS}) AS dataset_id FROM sync_scope)) k JOIN {_PLAIN_SUMS.replace('@', 'snap_cur')} a ON a.database_id = k.database_id LEFT JOIN {_DUE} d ON d.database_id = k.database_id AND d.dataset_id = k.dataset_id LEFT JOIN {_GOING} g ON g.database_id = k.database_id AND g.dataset_id = k.dataset_id""")
def _(i):
    return _sync(i).status.drop("instance_id")


def _next_sql(name: str, k: int, current: str, new: str, key: str, keep: bool = True) -> str:
    going = f"SELECT database_id FROM {_GOING} WHERE dataset_id = {k}" + f" AND database_id IN (SELECT scope_id FROM {new})" * keep
    rows = f"(SELECT scope_id, {key} FROM {current} WHERE scope_id NOT IN ({going}) UNION ALL SELECT scope_id, {key} FROM {new} WHERE scope_id IN ({going}))"
    return f"SELECT '{name}' AS dataset, scope_id::INT AS database_id, count(*) AS n_rows, count(*) AS n_keys FROM {rows} GROUP BY scope_id"


_WAITS_GOING = f"(SELECT database_id FROM {_GOING} WHERE dataset_id = 4 AND database_id IN (SELECT scope_id FROM counter_new))"
_WAITS = f"""SELECT 'waits' AS dataset, coalesce(c.scope_id, n.scope_id)::INT AS database_id, count(*) AS n_rows, sum(CASE WHEN k.database_id IS NULL THEN c.n ELSE coalesce(n.n, 0) END)::BIGINT AS n_keys
FROM counter_cur c FULL JOIN counter_new n ON c.scope_id = n.scope_id AND c.counter = n.counter LEFT JOIN {_WAITS_GOING} k ON k.database_id = coalesce(c.scope_id, n.scope_id) WHERE c.counter IS NOT NULL OR k.database_id IS NOT NULL GROUP BY 2"""


@query("sync_run_tables", " UNION ALL ".join([_next_sql("orders", 1, "snap_cur", _CAME, "item_key"), _next_sql("settings", 2, "setting_cur", "setting_new", "name"), _next_sql("counters", 3, "counter_cur", "counter_new", "counter", keep=False), _WAITS]))
def _(i):
    parts = []
    for name, df in _sync(i).tables.items():
        total = F.sum("n") if name == "waits" else F.count("*")
        parts.append(df.groupBy("database_id").agg(F.count("*").alias("n_rows"), total.alias("n_keys")).select(F.lit(name).alias("dataset"), "database_id", "n_rows", "n_keys"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("sync_run_history", f"SELECT c.scope_id::INT AS database_id, c.item_key AS item_key, c.status AS status, {T0} AS valid_from, {_NOW} AS valid_to FROM snap_cur c LEFT JOIN {_CAME} n ON c.scope_id = n.scope_id AND c.item_key = n.item_key WHERE c.scope_id IN (SELECT database_id FROM {_GOING} WHERE dataset_id = 1 AND database_id IN (SELECT scope_id FROM {_CAME})) AND (n.item_key IS NULL OR (c.status, c.priority, c.cents) IS DISTINCT FROM (n.status, n.priority, n.cents))")
def _(i):
    return _sync(i).closed["orders"].select("database_id", "item_key", "status", F.col("_ValidFrom").alias("valid_from"), F.col("_ValidTo").alias("valid_to"))


# --- a run with items: objects first, then what refers to them ---------------------------------------------

_OBJECT = ("database_id", "schema_name", "object_name", "object_type")
_ITEM_SPECS = [
    registry.DatasetSpec("references", "database", 720, "complex", False, False, ("object_key",), after=("objects",), roles={"object_key": _OBJECT, "parent_key": ("database_id", "ref_schema", "ref_name", "object_type")}, refers={"object_key": "object_key", "parent_key": "object_key"}),
    registry.DatasetSpec("objects", "database", 720, "complex", False, True, ("object_key",), roles={"object_key": _OBJECT}, defines="object_key"),
]
# Every third object was there before; every fifth isn't any more, and database 3 could not be read.
_BEFORE, _SEEN = "c_custkey % 3 = 0", "c_custkey % 5 <> 0 AND c_nationkey <> 3"


def _item_run(i: Inputs) -> sync.SyncRun:
    objects = i.customer.select(F.lit(0).alias("instance_id"), F.col("c_nationkey").cast("int").alias("database_id"), F.col("c_mktsegment").alias("schema_name"), F.col("c_name").alias("object_name"), F.lit("U").alias("object_type"), "c_custkey", "c_nationkey")
    keyed = merge.with_parents(objects, {"object_key": _OBJECT})
    dim = keyed.where(_BEFORE).select("object_key", *_OBJECT, F.lit(False).alias("is_deleted"), F.lit(None).cast("timestamp_ntz").alias("delete_date"))
    current = merge.first_load(keyed.where(_BEFORE).select("instance_id", "database_id", "object_key", "c_custkey"), sync.SCOPE["database"], ["object_key"], at(T0))
    refs = i.cat_ref.select(F.lit(0).alias("instance_id"), F.col("database_id").cast("int").alias("database_id"), "schema_name", "object_name", "ref_schema", "ref_name", F.lit("U").alias("object_type"))
    none = merge.first_load(merge.with_parents(refs.limit(0), _ITEM_SPECS[0].roles).select("instance_id", "database_id", "object_key", "parent_key"), sync.SCOPE["database"], ["object_key"], at(T0))
    scopes = i.nation.where("n_nationkey <> 3").select(F.lit(0).alias("instance_id"), F.col("n_nationkey").cast("int").alias("database_id"))
    sources = {"objects": sync.Source(current, objects.where(_SEEN), scopes, items=dim), "references": sync.Source(none, refs, scopes)}
    known = i.sql("SELECT * FROM status").limit(0)
    instances = scopes.select("instance_id").distinct().withColumn("is_enabled", F.lit(True))
    every = i.nation.select(F.lit(0).alias("instance_id"), F.col("n_nationkey").cast("int").alias("database_id"), F.lit(True).alias("is_enabled"))
    return sync.sync_run(_ITEM_SPECS, status.task_matrix(registry.spec_frame(i.spark, _ITEM_SPECS), instances, every, known), known, sources, at(_NOW))


_KEYED = f"(SELECT *, {_id_sql('c_nationkey::VARCHAR', 'lower(rtrim(c_mktsegment))', 'lower(rtrim(c_name))', chr(39) + 'u' + chr(39))} AS object_key FROM customer)"
_ALIVE = f"(SELECT object_key FROM {_KEYED} WHERE ({_SEEN}) OR (c_nationkey = 3 AND {_BEFORE}))"


@query("sync_items", f"SELECT object_key, c_nationkey::INT AS database_id, c_name AS object_name, NOT ({_SEEN}) AND c_nationkey <> 3 AS is_deleted, CASE WHEN NOT ({_SEEN}) AND c_nationkey <> 3 THEN {_NOW} END AS delete_date FROM {_KEYED} WHERE ({_BEFORE}) OR ({_SEEN})")
def _(i):
    return _item_run(i).items["object_key"].select("object_key", "database_id", "object_name", "is_deleted", "delete_date")


@query("sync_references", f"""SELECT 'kept' AS found, database_id::INT AS database_id, object_key, parent_key FROM {_REFS} WHERE database_id <> 3 AND object_key IN {_ALIVE} AND (parent_key IS NULL OR parent_key IN {_ALIVE})
UNION ALL SELECT 'lost', database_id::INT, object_key, parent_key FROM {_REFS} WHERE database_id <> 3 AND (object_key NOT IN {_ALIVE} OR (parent_key IS NOT NULL AND parent_key NOT IN {_ALIVE}))""")
def _(i):
    run = _item_run(i)
    columns = ["database_id", "object_key", "parent_key"]
    return run.tables["references"].select(F.lit("kept").alias("found"), *columns).unionByName(run.lost["references"].select(F.lit("lost").alias("found"), *columns))


# --- views ------------------------------------------------------------------------------------------

_VD = "(SELECT d.database_id, d.instance_id, d.database_name, i.instance_name FROM scope_database d JOIN scope_instance i ON d.instance_id = i.instance_id WHERE d.is_enabled AND i.is_enabled)"
_VO = f"(SELECT o.object_id, o.schema_name, o.object_name, d.* FROM item_object o JOIN {_VD} d ON o.database_id = d.database_id WHERE NOT o.is_deleted)"
_VI = f"(SELECT x.index_id, x.index_name, x.kind, o.*, '[' || replace(database_name, ']', ']]') || '].[' || schema_name || '].[' || object_name || '].[' || index_name || ']' AS fqin FROM item_index x JOIN {_VO} o ON x.object_id = o.object_id WHERE NOT x.is_deleted)"


def _vd(i):
    return views.vw_database(i.scope_database, views.vw_instance(i.scope_instance))


def _vo(i):
    return views.vw_object(i.item_object, _vd(i))


@query("vw_instance", "SELECT instance_id, instance_name FROM scope_instance WHERE is_enabled")
def _(i):
    return views.vw_instance(i.scope_instance)


@query("vw_database", f"SELECT v.*, instance_name || chr(92) || database_name AS database_namespace, r.p AS is_primary_replica FROM {_VD} v LEFT JOIN (SELECT database_id, max(is_primary_replica) AS p FROM replica WHERE is_local GROUP BY 1) r ON r.database_id = v.database_id")
def _(i):
    return views.vw_database(i.scope_database, views.vw_instance(i.scope_instance), i.replica)


@query("vw_object", f"SELECT object_id, schema_name, object_name, database_name, instance_name FROM {_VO}")
def _(i):
    return _vo(i).select("object_id", "schema_name", "object_name", "database_name", "instance_name")


@query("vw_index", f"SELECT index_id, object_id, kind, fqin FROM {_VI}")
def _(i):
    return views.vw_index(i.item_index, _vo(i)).select("index_id", "object_id", "kind", "fqin")


@query("vw_column", f"SELECT c.column_id, c.object_id, o.object_name, o.database_name FROM item_column c JOIN {_VO} o ON o.object_id = c.object_id WHERE NOT c.is_deleted")
def _(i):
    return views.vw_column(i.item_column, _vo(i)).select("column_id", "object_id", "object_name", "database_name")


@query("index_columns", f"SELECT k.index_id, k.key_ordinal, k.column_id, x.fqin FROM index_column k JOIN {_VI} x ON x.index_id = k.index_id JOIN item_column c ON c.object_id = x.object_id AND c.column_id = k.column_id WHERE NOT c.is_deleted")
def _(i):
    found = views.index_columns(views.vw_index(i.item_index, _vo(i)), i.index_column)
    return found.join(relational.active_only(i.item_column, deleted="is_deleted"), ["object_id", "column_id"]).select("index_id", "key_ordinal", "column_id", "fqin")


@query("instance_attribute", "SELECT i.instance_name, d.database_name FROM scope_instance i JOIN scope_database d ON i.instance_id = d.instance_id WHERE i.is_enabled AND d.is_enabled = false")
def _(i):
    return views.instance_attribute(views.vw_instance(i.scope_instance), i.scope_database.where("not is_enabled")).select("instance_name", "database_name")


# --- rules ------------------------------------------------------------------------------------------


def _rule_sql(rule: str, item: str, current: str, proper: str, rest: str) -> str:
    return f"SELECT '{rule}' AS rule, database_id, schema_name, object_name, ({item})::VARCHAR AS item, ({current})::VARCHAR AS current, ({proper})::VARCHAR AS proper FROM {rest}"


@query("rule_default_name", _rule_sql("default_name", "name", "name", "'DF_' || object_name || '_' || column_name", "cat_default WHERE name <> 'DF_' || object_name || '_' || column_name"))
def _(i):
    return rules.default_name(i.cat_default)


def _plain_part(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^[A-Za-z_@#][A-Za-z0-9_@#$]*$') THEN {c} ELSE '[' || replace({c}, ']', ']]') || ']' END"


@query("rule_rename_script", f"SELECT name, 'EXEC sp_rename N''' || {_plain_part('schema_name')} || '.' || {_plain_part('name')} || ''', N''DF_' || object_name || '_' || column_name || ''', N''OBJECT'';' AS script FROM cat_default WHERE name <> 'DF_' || object_name || '_' || column_name")
def _(i):
    return rules.default_name(i.cat_default).select(F.col("current").alias("name"), rules.rename_script(F.col("schema_name"), F.col("current"), F.col("proper")).alias("script"))


@query("rule_fk_name", _rule_sql("foreign_key_name", "name", "name", "'FK_' || object_name || '_' || cols", "(SELECT database_id, schema_name, object_name, name, string_agg(column_name, '_' ORDER BY ordinal) AS cols FROM cat_fk GROUP BY ALL) WHERE name <> 'FK_' || object_name || '_' || cols"))
def _(i):
    return rules.foreign_key_name(i.cat_fk)


@query("rule_index_name", _rule_sql("index_name", "name", "name", "CASE WHEN is_clustered THEN 'C' ELSE '' END || kind || '_' || object_name || '_' || cols", "(SELECT database_id, schema_name, object_name, name, kind, is_clustered, string_agg(column_name, '_' ORDER BY ordinal) AS cols FROM cat_index WHERE NOT is_included GROUP BY ALL) WHERE name <> CASE WHEN is_clustered THEN 'C' ELSE '' END || kind || '_' || object_name || '_' || cols"))
def _(i):
    return rules.index_name(i.cat_index)


@query("rule_heap", _rule_sql("heap", "object_name", "'heap'", "'clustered index'", "(SELECT DISTINCT database_id, schema_name, object_name, type FROM cat_index) WHERE type = 0"))
def _(i):
    return rules.heap(i.cat_index.select(*rules.TABLE, "type").distinct())


_BARE = "cat_column c WHERE column_name IN ({n}) AND NOT EXISTS (SELECT 1 FROM {t} d WHERE d.database_id = c.database_id AND d.schema_name = c.schema_name AND d.object_name = c.object_name AND d.column_name = c.column_name)"


@query("rule_missing_default", _rule_sql("missing_default", "column_name", "'none'", "'default'", _BARE.format(n="'_ModifyDate', '_InsertDate'", t="cat_default")))
def _(i):
    return rules.missing_default(i.cat_column, i.cat_default)


@query("rule_missing_fk", _rule_sql("missing_foreign_key", "column_name", "'none'", "'foreign key'", _BARE.format(n="'_ObjectID'", t="cat_fk")))
def _(i):
    return rules.missing_foreign_key(i.cat_column, i.cat_fk, ["_ObjectID"])


@query("rule_datetime_used", _rule_sql("datetime_used", "column_name", "type_name", "'datetime2'", "cat_column WHERE type_name = 'datetime' AND column_name LIKE '\\_%' ESCAPE '\\'"))
def _(i):
    return rules.datetime_used(i.cat_column)


@query("rule_variant_in_type", _rule_sql("variant_in_type", "column_name", "type_name", "'a declared type'", "cat_column WHERE type_name = 'sql_variant'"))
def _(i):
    return rules.variant_in_type(i.cat_column)


@query("rule_name_convention", _rule_sql("name_convention", "object_name", "object_name", "upper(object_name)", "item_object WHERE object_name <> upper(object_name)"))
def _(i):
    return rules.name_convention(i.item_object, "name_convention", "object_name", F.upper("object_name"))


@query("rule_missing_reference", _rule_sql("missing_reference", "ref_name", "'missing'", "'an existing object'", "cat_ref r WHERE ref_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM item_object o WHERE o.database_id = r.database_id AND lower(rtrim(o.schema_name)) = lower(rtrim(r.ref_schema)) AND lower(rtrim(o.object_name)) = lower(rtrim(r.ref_name)))"))
def _(i):
    return rules.missing_reference(i.cat_ref, i.item_object)


@query("rule_companion_missing", _rule_sql("companion_missing", "'table_type'", "NULL", "'a value'", "cat_ref WHERE ref_name IS NOT NULL AND table_type IS NULL"))
def _(i):
    return rules.companion_missing(i.cat_ref, "ref_name", "table_type")


@query("rule_exclusive", _rule_sql("exclusive", "'ref_name/table_type'", "ref_name || '/' || table_type", "'one of them'", "cat_ref WHERE ref_name IS NOT NULL AND table_type IS NOT NULL"))
def _(i):
    return rules.exclusive(i.cat_ref, "ref_name", "table_type")


@query("rule_class_changed", "SELECT c.item_key, c.status AS old_kind, n.status AS new_kind FROM snap_cur c JOIN snap_new n ON c.item_key = n.item_key WHERE c.status <> n.status AND c.item_key IN (SELECT l_orderkey FROM lineitem)")
def _(i):
    return rules.class_changed(i.snap_cur, i.snap_new, i.lineitem.select(F.col("l_orderkey").alias("item_key")), "item_key", "status")


@query("rule_required_column", _rule_sql("required_column", "'_ModifyDate'", "'missing'", "'1:_ModifyDate:int'", "(SELECT DISTINCT database_id, schema_name, object_name FROM cat_column) t WHERE NOT EXISTS (SELECT 1 FROM cat_column c WHERE c.database_id = t.database_id AND c.schema_name = t.schema_name AND c.object_name = t.object_name AND ordinal = 1 AND column_name = '_ModifyDate' AND type_name = 'int')"))
def _(i):
    return rules.required_column(i.cat_column, 1, "_ModifyDate", "int")


@query("assert_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(i):
    return rules.duplicate_keys(i.lineitem, ["l_orderkey", "l_linenumber"])


@query("assert_references", "SELECT index_id, object_id FROM item_index WHERE object_id NOT IN (SELECT object_id FROM item_object WHERE database_id % 2 = 0)")
def _(i):
    return rules.missing_references(i.item_index.select("index_id", "object_id"), i.item_object.where("database_id % 2 = 0"), ["object_id"])


# --- filters, lookups, set operations ------------------------------------------------------------------


@query("user_objects", "SELECT object_id FROM item_object WHERE NOT is_deleted")
def _(i):
    return relational.user_objects(i.item_object, "is_deleted").select("object_id")


@query("active_only", "SELECT database_id, database_name FROM scope_database WHERE is_enabled")
def _(i):
    return relational.active_only(i.scope_database, enabled="is_enabled").select("database_id", "database_name")


@query("stable_projection", "SELECT database_id, object_id, object_name FROM item_object")
def _(i):
    return relational.stable_projection(i.item_object, ["schema_name", "object_type", "is_deleted"])


@query("auto_created_filter", "SELECT index_id FROM item_index WHERE kind NOT IN ('F', 'P') AND index_name LIKE '1%'")
def _(i):
    return i.item_index.where(~F.col("kind").isin("F", "P") & F.col("index_name").like("1%")).select("index_id")


@query("scope_filter", "SELECT * FROM snap_cur WHERE scope_id = 3 AND status = 'O'")
def _(i):
    return snapshot.scope_filter(i.snap_cur, scope_id=3, status="O")


@query("case_sensitive_ne", "SELECT ref_name FROM cat_ref WHERE ref_name <> lower(ref_name)")
def _(i):
    return i.cat_ref.where(F.col("ref_name") != F.lower("ref_name")).select("ref_name")


@query("null_safe_match", "SELECT s.instance_id, s.database_id, s.dataset_id FROM status s WHERE EXISTS (SELECT 1 FROM sync_event e WHERE e.instance_id = s.instance_id AND e.database_id IS NOT DISTINCT FROM s.database_id AND e.dataset_id = s.dataset_id)")
def _(i):
    return relational.null_safe_match(i.status, i.sync_event.select(*status.KEY).distinct(), status.KEY).select(*status.KEY)


@query("hash_changed", "SELECT c.item_key FROM snap_cur c JOIN snap_new n ON c.scope_id = n.scope_id AND c.item_key = n.item_key WHERE (c.status, c.priority, c.cents) IS DISTINCT FROM (n.status, n.priority, n.cents)")
def _(i):
    on = ["scope_id", "item_key"]
    h = lambda df, name: merge.hashed(df, ["scope_id"], ["item_key"]).select(*on, F.col("_RowHash").alias(name))
    return h(i.snap_cur, "a").join(h(i.snap_new, "b"), on).where(relational.hash_changed("a", "b")).select("item_key")


@query("row_differs", "SELECT c.name FROM setting_cur c JOIN setting_new n ON c.scope_id = n.scope_id AND c.name = n.name WHERE c.value IS DISTINCT FROM n.value")
def _(i):
    both = i.setting_cur.alias("c").join(i.setting_new.alias("n"), (F.col("c.scope_id") == F.col("n.scope_id")) & (F.col("c.name") == F.col("n.name")))
    return both.where(relational.row_differs(["scope_id", "name", "value"], "c", "n")).select("c.name")


@query("new_keys", "SELECT instance_id, database_id, dataset_id FROM sync_event EXCEPT SELECT instance_id, database_id, dataset_id FROM status")
def _(i):
    return relational.new_keys(i.sync_event, i.status, status.KEY)


@query("union_distinct", "SELECT scope_id, status FROM snap_cur UNION SELECT scope_id, status FROM snap_new")
def _(i):
    return relational.union_distinct(i.snap_cur.select("scope_id", "status"), i.snap_new.select("scope_id", "status"))


@query("union_all", "SELECT rule, count(*) AS n FROM (SELECT 'heap' AS rule FROM (SELECT DISTINCT database_id, schema_name, object_name, type FROM cat_index) WHERE type = 0 UNION ALL SELECT 'variant_in_type' FROM cat_column WHERE type_name = 'sql_variant') GROUP BY 1")
def _(i):
    both = rules.heap(i.cat_index.select(*rules.TABLE, "type").distinct()).unionByName(rules.variant_in_type(i.cat_column))
    return both.groupBy("rule").agg(F.count("*").alias("n"))


@query("anti_not_exists", "SELECT scope_id, item_key FROM snap_cur WHERE item_key NOT IN (SELECT item_key FROM snap_new)")
def _(i):
    return i.snap_cur.select("scope_id", "item_key").join(i.snap_new, "item_key", "left_anti").select("scope_id", "item_key")


@query("semi_exists", "SELECT scope_id, item_key FROM snap_cur WHERE item_key IN (SELECT item_key FROM snap_new)")
def _(i):
    return i.snap_cur.select("scope_id", "item_key").join(i.snap_new, "item_key", "left_semi").select("scope_id", "item_key")


@query("name_enrich", "SELECT x.index_id, o.schema_name, o.object_name FROM item_index x JOIN item_object o ON x.object_id = o.object_id")
def _(i):
    return relational.name_enrich(i.item_index.select("index_id", "object_id"), i.item_object.select("object_id", "schema_name", "object_name"), ["object_id"]).select("index_id", "schema_name", "object_name")


@query("multi_role_enrich", "SELECT s.s_suppkey, a.n_name AS home_n_name, b.n_name AS next_n_name FROM supplier s JOIN nation a ON a.n_regionkey = s.s_nationkey % 5 AND a.n_nationkey = s.s_nationkey JOIN nation b ON b.n_regionkey = s.s_nationkey % 5 AND b.n_nationkey = (s.s_nationkey + 5) % 25")
def _(i):
    rows = i.supplier.select("s_suppkey", (F.col("s_nationkey") % 5).alias("n_regionkey"), F.col("s_nationkey").alias("home_id"), ((F.col("s_nationkey") + 5) % 25).alias("next_id"))
    found = relational.multi_role_enrich(rows, i.nation, ["n_regionkey"], {"home": "home_id", "next": "next_id"}, "n_nationkey", ["n_name"])
    return found.select("s_suppkey", "home_n_name", "next_n_name")


@query("optional_parent", "SELECT r.object_name, o.object_id FROM cat_ref r LEFT JOIN (SELECT database_id, object_name, object_id FROM item_object WHERE object_id % 2 = 0) o ON r.database_id = o.database_id AND r.object_name = o.object_name")
def _(i):
    parents = i.item_object.where("object_id % 2 = 0").select("database_id", "object_name", "object_id")
    return relational.name_enrich(i.cat_ref.select("database_id", "object_name"), parents, ["database_id", "object_name"], "left").select("object_name", "object_id")


@query("optional_scope_lookup", "SELECT c.c_custkey, d.database_name FROM customer c LEFT JOIN scope_database d ON d.database_id = c.c_nationkey AND d.is_enabled")
def _(i):
    rows = i.customer.select("c_custkey", F.col("c_nationkey").alias("database_id"))
    scopes = relational.active_only(i.scope_database, enabled="is_enabled").select("database_id", "database_name")
    return relational.optional_scope_lookup(rows, scopes, ["database_id"]).select("c_custkey", "database_name")


@query("stats_left_fill", "SELECT o.object_id, coalesce(s.n, 0) AS n FROM item_object o LEFT JOIN (SELECT object_id, count(*) AS n FROM item_index GROUP BY 1) s ON s.object_id = o.object_id")
def _(i):
    stats = i.item_index.groupBy("object_id").agg(F.count("*").alias("n"))
    return relational.stats_left_fill(i.item_object.select("object_id"), stats, ["object_id"], ["n"])


@query("lateral_rows", "SELECT event_id, unnest([user_id, event_id]) AS id FROM events")
def _(i):
    return relational.lateral_rows(i.events.select("event_id", F.array("user_id", "event_id").alias("ids")), "ids", "id")


@query("replica_flag", "SELECT d.database_id, r.p AS is_primary_replica FROM scope_database d LEFT JOIN (SELECT database_id, max(is_primary_replica) AS p FROM replica WHERE is_local GROUP BY 1) r ON r.database_id = d.database_id")
def _(i):
    return relational.replica_flag(i.scope_database.select("database_id"), i.replica, "database_id")


@query("ordered_concat", "SELECT l_orderkey, string_agg(l_partkey::VARCHAR, '_' ORDER BY l_linenumber, l_partkey::VARCHAR) AS parts FROM lineitem GROUP BY 1")
def _(i):
    return relational.ordered_concat(i.lineitem, ["l_orderkey"], "l_partkey", "l_linenumber", "parts")


@query("distinct_targets", "SELECT DISTINCT source, lang FROM documents")
def _(i):
    return relational.distinct_targets(i.documents, ["source", "lang"])


@query("top_n", "SELECT object_id, count(*) AS n FROM item_index GROUP BY 1 ORDER BY n DESC, object_id LIMIT 100")
def _(i):
    return relational.top_n(i.item_index.groupBy("object_id").agg(F.count("*").alias("n")), 100, F.desc("n"), F.col("object_id"))


# --- scalar functions and sources ------------------------------------------------------------------------


@query("row_hash", """SELECT item_key, sha256('{' || concat_ws(',', '"cents":' || cents, '"priority":"' || priority || '"', '"status":"' || status || '"') || '}') AS row_hash FROM snap_cur""")
def _(i):
    return i.snap_cur.select("item_key", K.row_hash(["status", "priority", "cents"]).alias("row_hash"))


@query("qualified_name", "SELECT object_id, '[' || schema_name || '].[' || replace(object_name, ']', ']]') || ']' AS name FROM item_object")
def _(i):
    return i.item_object.select("object_id", K.qualified_name("schema_name", "object_name").alias("name"))


@query("scalar_names", "SELECT c_custkey, split_part(c_name || '.' || c_mktsegment, '.', -1) AS last, concat(c_mktsegment, NULL, c_custkey) AS joined, CASE c_custkey % 4 WHEN 1 THEN 'a' WHEN 2 THEN 'b' END AS chosen, lower(rtrim(c_name || '  ')) AS name_key, try_cast(c_name AS BIGINT) AS number FROM customer")
def _(i):
    return i.customer.select(
        "c_custkey", K.last_part(F.concat_ws(".", "c_name", "c_mktsegment")).alias("last"), K.joined("c_mktsegment", F.lit(None), "c_custkey").alias("joined"),
        K.chosen(F.col("c_custkey") % 4, F.lit("a"), F.lit("b")).alias("chosen"), K.name_key(F.concat("c_name", F.lit("  "))).alias("name_key"), F.col("c_name").try_cast("bigint").alias("number"),
    )


@query("stale_minutes", f"SELECT event_id, floor(date_diff('second', ts, {T0}) / 60)::BIGINT AS minutes FROM events")
def _(i):
    return i.events.select("event_id", K.stale_minutes("ts", at(T0)).alias("minutes"))


@query("sentinel_name", "SELECT object_name, name, CASE WHEN type = 0 THEN '<<HEAP>>' ELSE name END AS index_name FROM cat_index WHERE ordinal = 1")
def _(i):
    return i.cat_index.where("ordinal = 1").select("object_name", "name", K.sentinel_name("name", "type").alias("index_name"))


@query("snapshot_scan", f"SELECT s_suppkey, s_name, {T0} AS _CollectionDate FROM supplier")
def _(i):
    return snapshot.snapshot_scan(i.spark, f"{i.sf_dir}/supplier.parquet", at(T0)).select("s_suppkey", "s_name", "_CollectionDate")


@query("snapshot_query", f"SELECT n_nationkey AS _DatabaseID, s.s_suppkey, s.s_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE s.s_acctbal > 0")
def _(i):
    found = i.supplier.where("s_acctbal > 0").join(i.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return snapshot.add_scope(found.select("n_nationkey", "s_suppkey", "s_name"), "database", F.col("n_nationkey")).drop("n_nationkey")


@query("align_to_schema", "SELECT s_suppkey, s_nationkey::BIGINT AS s_nationkey, NULL::VARCHAR AS added FROM supplier")
def _(i):
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_nationkey", T.LongType()), T.StructField("added", T.StringType())])
    return snapshot.align_to_schema(i.supplier.select("s_suppkey", "s_nationkey"), schema)


@query("optional_source", "SELECT s_suppkey, s_name FROM supplier")
def _(i):
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType())])
    return snapshot.optional_source(i.spark, f"{i.sf_dir}/no_such_table.parquet", schema).unionByName(snapshot.optional_source(i.spark, f"{i.sf_dir}/supplier.parquet", schema))


@query("add_scope", "SELECT 7 AS _InstanceID, r_regionkey, r_name FROM region")
def _(i):
    return snapshot.add_scope(i.region, "instance", 7)


@query("properties_wide", "SELECT user_id, max(props) FILTER (event_type = 'view') AS \"view\", try_cast(max(props) FILTER (event_type = 'click') AS BIGINT) AS click FROM events GROUP BY user_id")
def _(i):
    return snapshot.properties_wide(i.events, ["user_id"], {"view": "string", "click": "bigint"}, "event_type", "props")


@query("targets_from_json", "SELECT DISTINCT source AS instance_name, 'db' || (doc_id % 7) AS database_name FROM documents")
def _(i):
    pair = F.struct(F.col("source").alias("Instance"), F.concat(F.lit("db"), (F.col("doc_id") % 7).cast("string")).alias("Database"))
    configs = i.documents.groupBy(F.col("doc_id") % 50).agg(F.to_json(F.struct(F.collect_list(pair).alias("TargetDatabases"))).alias("config"))
    return snapshot.targets_from_json(configs, "config")


@query("variant_cast", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, try_cast(event_type AS INT) AS bad FROM events")
def _(i):
    rows = i.events.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("bad"))
    return K.variant_cast(rows, {"k": "bigint", "bad": "int"})
