"""Registered queries that run a stream to its end, with DuckDB SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.operators.status import KEY
from metafleet.plans.fixtures import Inputs, oracle
from metafleet.plans.queries import _CLEAR, ORACLES, _next, at, query
from metafleet.sources.scratch import new_path
from metafleet.sources.store import ScopedTable
from metafleet.streaming import stream

#: Events land in three parts; every twentieth of the first two comes a part late.
_CUTS = ("TIMESTAMP '2024-01-11 00:00:00'", "TIMESTAMP '2024-01-21 00:00:00'")
_PART = f"CASE WHEN ts < {_CUTS[0]} THEN 0 WHEN ts < {_CUTS[1]} THEN 1 ELSE 2 END + CASE WHEN event_id % 20 = 0 AND ts < {_CUTS[1]} THEN 1 ELSE 0 END"
_DELAY_MS, _IDLE_MS = 6 * 3_600_000, 48 * 3_600_000

_STREAM = f"""e AS (SELECT *, {_PART} AS part, epoch_us(ts)::HUGEINT * 10000000000 + event_id AS k FROM sync_event),
w AS (SELECT part, max(newest) OVER (ORDER BY part) // 1000 - {_DELAY_MS} AS after FROM (SELECT part, max(epoch_us(ts)) AS newest FROM e GROUP BY part)),
p AS (SELECT instance_id, database_id, dataset_id, part, max(k) AS newest FROM e GROUP BY ALL),
q AS (SELECT *, max(newest) OVER (PARTITION BY instance_id, database_id, dataset_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM p),
f AS (SELECT e.*, w.after AS wm, (w.after IS NULL OR epoch_us(ts) >= w.after * 1000) AND (q.before IS NULL OR k > q.before) AS good FROM e LEFT JOIN w ON w.part = e.part - 1
JOIN q ON q.instance_id = e.instance_id AND q.database_id IS NOT DISTINCT FROM e.database_id AND q.dataset_id = e.dataset_id AND q.part = e.part),
g AS (SELECT *, lag(part) OVER t AS part0, lag(epoch_us(ts)) OVER t AS us0 FROM f WHERE good WINDOW t AS (PARTITION BY instance_id, database_id, dataset_id ORDER BY k)),
h AS (SELECT *, sum(CASE WHEN part0 < part AND us0 // 1000 + {_IDLE_MS} <= wm THEN 1 ELSE 0 END) OVER (PARTITION BY instance_id, database_id, dataset_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS life FROM g),
o AS (SELECT *, lag(checksum) OVER t AS was, row_number() OVER t AS rn FROM h WHERE error_message IS NULL WINDOW t AS (PARTITION BY instance_id, database_id, dataset_id, life ORDER BY k)),
s AS (SELECT instance_id, database_id, dataset_id, life, max_by(checksum, k) AS checksum, max(ts) FILTER (rn = 1 OR checksum IS NULL OR was IS NULL OR checksum <> was) AS last_sync FROM o GROUP BY ALL),
b AS (SELECT instance_id, database_id, dataset_id, life, max(ts) AS last_error, max_by(error_message, k) AS error_message FROM h WHERE error_message IS NOT NULL GROUP BY ALL),
l AS (SELECT instance_id, database_id, dataset_id, life, max(ts) AS last_check, max_by(event_id, k) AS event_id FROM h GROUP BY ALL),
m AS (SELECT l.*, life < max(life) OVER (PARTITION BY instance_id, database_id, dataset_id) OR epoch_us(last_check) // 1000 + {_IDLE_MS} <= (SELECT max(after) FROM w) AS idle FROM l)"""
_STREAM_SQL = oracle("SELECT 1 FROM sync_event").split("SELECT 1 FROM sync_event")[0].rstrip() + ", " + _STREAM + """
SELECT m.instance_id, m.database_id, m.dataset_id, CASE WHEN idle THEN 'idle' ELSE 'status' END AS kind, m.event_id, s.checksum, s.last_sync, m.last_check, b.last_error, b.error_message FROM m
LEFT JOIN s ON s.instance_id = m.instance_id AND s.database_id IS NOT DISTINCT FROM m.database_id AND s.dataset_id = m.dataset_id AND s.life = m.life
LEFT JOIN b ON b.instance_id = m.instance_id AND b.database_id IS NOT DISTINCT FROM m.database_id AND b.dataset_id = m.dataset_id AND b.life = m.life
UNION ALL SELECT instance_id, database_id, dataset_id, 'late', event_id, checksum, NULL, ts, NULL, error_message FROM f WHERE NOT good"""


@query("stream_status")
def _(i: Inputs) -> DataFrame:
    """The status of every task, ended ones and events that came too late; the stream stops and goes on after each part."""
    path = new_path(i.spark, "stream")
    parts = i.sync_event.withColumn("part", F.expr(_PART.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))).withColumn("ts", F.col("ts").cast("timestamp"))
    for part in range(3):
        parts.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{path}/events")
        events = i.spark.readStream.schema(parts.drop("part").schema).parquet(f"{path}/events")
        rows = stream.stream_status(events, KEY, "ts", f"{_DELAY_MS // 1000} SECONDS", _IDLE_MS)
        stream.start_status(rows, f"{path}/status", f"{path}/checkpoint").awaitTermination()
    out = i.spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/status")
    now = stream.status_table(out, KEY).unionByName(out.where("kind <> 'status'"))
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("last_sync", "last_check", "last_error")}
    return now.withColumns(times).drop("ts")


ORACLES["stream_status"] = _STREAM_SQL

_MERGED = f"SELECT scope_id, item_key, status, priority, cents FROM ({_next(_CLEAR)})"


def _streamed(i: Inputs, path: str) -> ScopedTable:
    """The current table after two landings: all scopes, then those collected again (a null key says that one came empty)."""
    table = ScopedTable(i.spark, f"{path}/table", ["scope_id"], parts=8)
    empty = i.collected.join(i.snap_new.select("scope_id").distinct(), "scope_id", "left_anti")
    again = i.snap_new.join(i.collected, "scope_id", "left_semi").unionByName(empty, allowMissingColumns=True)
    for rows, day in ((i.snap_cur, 1), (again, 2)):
        landed = rows.withColumn("at", F.lit(f"2024-02-0{day}").cast("timestamp"))
        landed.write.mode("append").parquet(f"{path}/landed")
        stream.stream_snapshots(i.spark, f"{path}/landed", landed.schema, table, ["item_key"], "at", f"{path}/checkpoint", f"{path}/changes", log_first=True).awaitTermination()
    return table


@query("stream_snapshots", _MERGED)
def _(i: Inputs) -> DataFrame:
    return _streamed(i, new_path(i.spark, "stream")).read().select(*i.snap_cur.columns)


@query("stream_changes", _MERGED)
def _(i: Inputs) -> DataFrame:
    """A copy of the table that a consumer keeps from the stream of its changes."""
    path = new_path(i.spark, "stream")
    _streamed(i, path)
    schema = i.spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/changes").schema
    copy = ScopedTable(i.spark, f"{path}/copy", ["scope_id"], parts=8)
    changes = stream.stream_changes(i.spark, f"{path}/changes", schema)
    changes.writeStream.foreachBatch(stream.apply_changes(copy, ["item_key"], "copy")).option("checkpointLocation", f"{path}/consumer").trigger(availableNow=True).start().awaitTermination()
    return copy.read().select(*i.snap_cur.columns)
