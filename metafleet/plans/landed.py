"""Registered queries over landed snapshots and monthly history, with DuckDB SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.operators import history, merge, status
from metafleet.plans.fixtures import Inputs
from metafleet.plans.queries import _CLEAR, _HALF_NEW, _KEEP, T0, T1, _id_sql, _next, _plain, at, query
from metafleet.sources.landing import Landing, merge_moved
from metafleet.sources.monthly import MonthlyHistory
from metafleet.sources.scratch import new_path

_RANGES = 8


def _landed(i: Inputs, rows: DataFrame, scopes: DataFrame) -> Landing:
    return Landing(i.spark, new_path(i.spark, "landing"), ["scope_id"], ["item_key"], ranges=_RANGES).land(rows, scopes)


# A landed row's checksum leaves its scope out: the digests are sums by scope.
_ROW = """('0x' || substr(sha256('{"cents":' || cents || ',"item_key":' || item_key || ',"priority":"' || priority || '","status":"' || status || '"}'), 1, 15))::BIGINT"""


def _digest_sql(table: str, by: str) -> str:
    return f"(SELECT {by}, count(*) AS n_rows, (sum({_ROW})::HUGEINT % 4611686018427387904)::BIGINT AS checksum FROM {table} GROUP BY {by})"


_RANGE_SQL = f"({_id_sql('item_key::VARCHAR')} % {_RANGES})::INT"


def _ranged(table: str) -> str:
    return f"(SELECT *, {_RANGE_SQL} AS rng FROM {table})"


@query("landed_gate", f"SELECT scope_id, n.checksum AS checksum FROM {_digest_sql(_HALF_NEW, 'scope_id')} n LEFT JOIN {_digest_sql('snap_cur', 'scope_id')} c USING (scope_id) WHERE c.checksum IS NULL OR n.checksum <> c.checksum")
def _(i):
    """The gate by rolled-up digests alone: no row is read to find the scopes that moved."""
    half = i.snap_cur.where("scope_id < 4").unionByName(i.snap_new.where("scope_id >= 4"))
    old, new = (_landed(i, df, df.select("scope_id")).checksums() for df in (i.snap_cur, half))
    tasks = new.select("scope_id", F.col("checksum").alias("new_checksum")).join(old.select("scope_id", F.col("checksum").alias("old_checksum")), "scope_id", "left")
    return status.checksum_gate(tasks.withColumn("has_checksum", F.lit(True))).select("scope_id", F.col("new_checksum").alias("checksum"))


@query("moved_ranges", f"""SELECT coalesce(c.scope_id, n.scope_id) AS scope_id, coalesce(c.rng, n.rng) AS _range, (c.checksum IS DISTINCT FROM n.checksum OR c.n_rows IS DISTINCT FROM n.n_rows)::INT AS moved
FROM (SELECT * FROM {_digest_sql(_ranged('snap_cur'), 'scope_id, rng')} WHERE scope_id IN (SELECT scope_id FROM collected)) c FULL JOIN {_digest_sql(_ranged('(SELECT * FROM snap_new WHERE scope_id IN (SELECT scope_id FROM collected))'), 'scope_id, rng')} n ON c.scope_id = n.scope_id AND c.rng = n.rng""")
def _(i):
    return _landed(i, i.snap_new, i.collected).moved(_landed(i, i.snap_cur, i.snap_cur).digests(), on_empty="clear")


def _merge_moved(i: Inputs, on_empty: str) -> merge.Merge:
    current = merge.first_load(i.snap_cur, ["scope_id"], ["item_key"], at(T0))
    landing = _landed(i, i.snap_new, i.collected)
    return merge_moved(current, landing, landing.moved(_landed(i, i.snap_cur, i.snap_cur).digests(), on_empty), at(T1))


@query("merge_moved_ranges", _next(_CLEAR))
def _(i):
    return _plain(_merge_moved(i, "clear").next())


@query("merge_moved_ranges_keep_empty", _next(_KEEP))
def _(i):
    return _plain(_merge_moved(i, "keep").next())


# --- history by month -------------------------------------------------------------------------------

#: Versions by month: an order is a version of its customer's last order, valid until the next one.
_VERSIONS = "(SELECT o_custkey AS customer, o_orderkey AS order_key, o_orderstatus AS status, CAST(o_orderdate AS TIMESTAMP) AS valid_from, CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS TIMESTAMP) AS valid_to FROM orders)"
_SHIPPED = "(SELECT o_custkey AS customer, l_orderkey AS shipped_order, l_linenumber AS line, l_returnflag AS status, CAST(l_shipdate AS TIMESTAMP) AS valid_from, CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP) + INTERVAL 20 DAY END AS valid_to FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
_HORIZON, _THEN = "TIMESTAMP '2002-01-01 00:00:00'", "TIMESTAMP '1996-05-15 00:00:00'"


def _versions(i: Inputs, sql: str) -> DataFrame:
    return i.sql(f"SELECT * FROM {sql}").withColumnsRenamed({"valid_from": "_ValidFrom", "valid_to": "_ValidTo"})


def _monthly(i: Inputs) -> tuple[MonthlyHistory, DataFrame]:
    """The closed versions by month, and those still valid as the current table."""
    rows = _versions(i, _VERSIONS).where("_ValidTo IS NULL OR _ValidFrom < _ValidTo")
    stored = MonthlyHistory(i.spark, new_path(i.spark, "history"))
    stored.append(rows.where("_ValidTo IS NOT NULL").withColumns({"_ModifyDate": F.col("_ValidFrom"), "_month": history.month("_ValidTo")}))
    return stored, rows.where("_ValidTo IS NULL").select("customer", "order_key", "status", F.col("_ValidFrom").alias("_ModifyDate"))


@query("as_of_months", f"SELECT customer, order_key, status, valid_from FROM {_VERSIONS} WHERE valid_from <= {_THEN} AND (valid_to IS NULL OR valid_to > {_THEN})")
def _(i):
    stored, current = _monthly(i)
    return stored.as_of(current, at(_THEN)).withColumnRenamed("_ModifyDate", "valid_from")


@query("expire_months", f"SELECT customer, order_key, valid_to FROM {_VERSIONS} WHERE valid_from < valid_to AND valid_to >= {_THEN} - INTERVAL 6 MONTH")
def _(i):
    stored, _current = _monthly(i)
    stored.expire(at(_THEN))
    return history.expire_history(stored.read(), at(_THEN)).select("customer", "order_key", F.col("_ValidTo").alias("valid_to"))


@query("temporal_join", f"""SELECT l.customer, l.order_key, l.status, r.shipped_order, r.line, r.status AS right_status, greatest(l.valid_from, r.valid_from) AS valid_from, CASE WHEN l.valid_to IS NULL AND r.valid_to IS NULL THEN NULL ELSE least(coalesce(l.valid_to, {_HORIZON}), coalesce(r.valid_to, {_HORIZON})) END AS valid_to
FROM {_VERSIONS} l JOIN {_SHIPPED} r ON l.customer = r.customer AND greatest(l.valid_from, r.valid_from) < least(coalesce(l.valid_to, {_HORIZON}), coalesce(r.valid_to, {_HORIZON}))
WHERE l.valid_from < coalesce(l.valid_to, {_HORIZON})""")
def _(i):
    """A customer's order and shipped lines as they were at one time."""
    found = history.temporal_join(_versions(i, _VERSIONS), _versions(i, _SHIPPED), ["customer"], at(_HORIZON))
    return found.withColumnsRenamed({"_ValidFrom": "valid_from", "_ValidTo": "valid_to"})
