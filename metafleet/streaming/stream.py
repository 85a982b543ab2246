"""Structured Streaming over landed snapshots and status events; batch and stream share the merge."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from metafleet.operators.history import history_append
from metafleet.operators.merge import first_load, merge_snapshot
from metafleet.sources.scratch import written
from metafleet.sources.store import ScopedTable


def latest_snapshots(batch: DataFrame, scope: Sequence[str], at: str) -> DataFrame:
    """Of several snapshots of a scope in one batch the last one; a batch may hold many."""
    # Tables of a row for each scope are written here: Spark sees their size and doesn't deal the rows by scope.
    last = written(batch.groupBy(*scope).agg(F.max(at).alias(at)), "last")
    return batch.join(last, [*scope, at], "left_semi")


def merge_into(table: ScopedTable, keys: Sequence[str], at: str, changes_path: str | None = None, history_path: str | None = None, log_first: bool = False) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: merges a batch of snapshots (scope, keys, ..., ``at``) into the table.

    Only the partitions of the batch's scopes are read, joined and written. A row whose first key is null says
    that its scope was collected, perhaps without rows. Snapshots that aren't newer than the scope's last
    merged one are dropped, so that history never runs backwards and replaying a batch changes nothing;
    a scope without rows forgets its time. Changes and closed versions of each batch go to folders of its id;
    with ``log_first`` the first load is logged as well, as inserts.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        scope = table.scope
        fresh = written(latest_snapshots(batch, scope, at), "batch")
        times = written(fresh.select(*scope, F.col(at).alias("_At")).distinct(), "times")
        parts = table.touched(times)
        if not parts:
            return
        rows = fresh.where(F.col(keys[0]).isNotNull())
        now = F.lit(batch.sparkSession.sql("SELECT current_timestamp()").first()[0])
        if not table.exists():
            start = first_load(rows.drop(at), scope, keys, now)
            if changes_path and log_first:
                whole = F.struct(*start.columns)
                logged = start.select(*scope, *keys, F.lit("insert").alias("_action"), F.when(F.lit(False), whole).alias("before"), whole.alias("after"), F.lit(batch_id).alias("_batch"))
                logged.write.mode("overwrite").parquet(f"{changes_path}/batch-{batch_id:012d}")
            table.overwrite(start.join(times, scope).withColumnRenamed("_At", "_MergedAt"))
            return
        current = table.read(parts)
        seen = written(current.groupBy(*scope).agg(F.max("_MergedAt").alias("_Seen")), "seen")
        times = written(times.join(seen, scope, "left").where(F.col("_Seen").isNull() | (F.col("_At") > F.col("_Seen"))).select(*scope, "_At"), "times")
        rows = rows.join(times, scope, "left_semi")
        merge = merge_snapshot(current.drop("_MergedAt"), rows.drop(at), times, keys, now, scope, on_empty="clear").once()
        folder = f"batch-{batch_id:012d}"
        if changes_path:
            merge.changes().withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{changes_path}/{folder}")
        if history_path:
            history_append(merge, now).write.mode("overwrite").parquet(f"{history_path}/{folder}")
        stamped = merge.next().join(times, scope, "left").join(seen, scope, "left").withColumn("_MergedAt", F.coalesce("_At", "_Seen"))
        table.overwrite(stamped.select(*current.columns), parts)

    return run


def stream_snapshots(spark: SparkSession, path: str, schema: T.StructType, table: ScopedTable, keys: Sequence[str], at: str, checkpoint: str, changes_path: str | None = None, history_path: str | None = None, log_first: bool = False) -> StreamingQuery:
    """Merges the snapshot files that have landed under ``path`` and ends; start it again for later ones."""
    source = spark.readStream.schema(schema).parquet(path)
    return source.writeStream.foreachBatch(merge_into(table, keys, at, changes_path, history_path, log_first)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_changes(spark: SparkSession, changes_path: str, schema: T.StructType) -> DataFrame:
    """The changes of all merges as a stream: rows are only ever added. ``_batch`` orders them."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(changes_path)


def apply_changes(table: ScopedTable, keys: Sequence[str], consumer: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of a consumer that keeps a copy of the merged table from its changes.

    Of several changes of a row in one batch the last by ``_batch`` counts. A batch that has been applied leaves a
    marker of its consumer and number, so a batch that is delivered again is passed over. A crash before the
    marker delivers it again too: changes carry whole rows, so applying them once more gives the same table.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        if table.marked(consumer) >= batch_id:
            return
        on = [*table.scope, *keys]
        last = batch.groupBy(*on).agg(F.max_by(F.struct("_action", "after"), F.col("_batch")).alias("_last"))
        last = written(last, "changes")
        parts = table.touched(last.select(*table.scope))
        if parts:
            rows = last.where("_last._action <> 'delete'").select("_last.after.*")
            if table.exists():
                rows = table.read(parts).join(last.select(*on), on, "left_anti").unionByName(rows)
            table.overwrite(rows, parts if table.exists() else None)
        table.mark(consumer, batch_id)

    return run


def by_batch(path: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function that writes each batch to a folder of its number: a batch run again replaces its own rows."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch-{batch_id:012d}")

    return run


def _numbers(values: pd.Series, known: pd.Series) -> list:
    """The values as Python numbers, None where they aren't known: a column of numbers with nulls would come as floats."""
    return [int(v) if k else None for v, k in zip(values, known)]


class TaskStatus(StatefulProcessor):
    """A task's status, folded from its events as ``operators.status.status_apply`` does, all events of a batch at once.

    An event that is older than the watermark or not newer than the task's last one goes to the side as ``late``.
    A timer at the last event's time and ``idle_ms`` ends the task: its state is dropped and its last
    status goes out as ``idle``.
    """

    STATE = T.StructType([T.StructField(n, T.StringType() if n == "message" else T.LongType()) for n in ("ts", "event_id", "checksum", "synced", "failed", "message")])

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("status", self.STATE)

    def _rows(self, key, **columns) -> pd.DataFrame:
        out = pd.DataFrame({n: pd.Series(v, dtype=object if n in ("kind", "error_message") else "Int64") for n, v in columns.items()})
        out.insert(0, "_key", key[0])
        return out

    def handleInputRows(self, key, rows, timerValues):
        oldest = timerValues.getCurrentWatermarkInMs() * 1000
        state = self.state.get() if self.state.exists() else None
        e = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "event_id"], kind="stable", ignore_index=True)
        good = (e["ts"] >= oldest) & ~e.duplicated(["ts", "event_id"])
        if state:
            good &= (e["ts"] > state[0]) | ((e["ts"] == state[0]) & (e["event_id"] > state[1]))
        late, e = e[~good], e[good]
        if len(late):
            none = [None] * len(late)
            ts = late["ts"].tolist()
            yield self._rows(key, kind=["late"] * len(late), ts=ts, event_id=late["event_id"].tolist(), checksum=_numbers(late["checksum"], late["summed"]), last_sync=none, last_check=ts, last_error=none, error_message=late["error_message"].tolist())
        if not len(e):
            return
        _, _, checksum, synced, failed, message = state or (None,) * 6
        lost = e["error_message"].notna()
        if lost.any():
            failed, message = int(e.loc[lost, "ts"].iloc[-1]), e.loc[lost, "error_message"].iloc[-1]
        if not lost.all():
            ok = e[~lost]
            was, knew = ok["checksum"].shift(fill_value=checksum or 0), ok["summed"].shift(fill_value=checksum is not None)
            moved = ok.loc[~ok["summed"] | ~knew | (ok["checksum"] != was), "ts"]
            synced = int(moved.iloc[-1]) if len(moved) else synced
            checksum = int(ok["checksum"].iloc[-1]) if ok["summed"].iloc[-1] else None
        if state:
            self.handle.deleteTimer(state[0] // 1000 + self.idle_ms)
        state = (int(e["ts"].iloc[-1]), int(e["event_id"].iloc[-1]), checksum, synced, failed, message)
        self.state.update(state)
        self.handle.registerTimer(state[0] // 1000 + self.idle_ms)
        yield self._status(key, "status", state)

    def _status(self, key, kind: str, state) -> pd.DataFrame:
        ts, event_id, checksum, synced, failed, message = ([v] for v in state)
        return self._rows(key, kind=[kind], ts=ts, event_id=event_id, checksum=checksum, last_sync=synced, last_check=ts, last_error=failed, error_message=message)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            yield self._status(key, "idle", self.state.get())
            self.state.clear()

    def close(self) -> None:
        pass


def stream_status(events: DataFrame, keys: Sequence[str], ts: str, delay: str, idle_ms: int) -> DataFrame:
    """The stream of task statuses from a stream of events (keys, ``ts``, event_id, checksum, error_message).

    Rows: keys, kind, ts, event_id, checksum, last_sync, last_check, last_error, error_message; ``kind`` is ``status``
    (the task's status after a batch), ``late`` (an event that changed nothing) or ``idle`` (a task that had no event
    for ``idle_ms`` before the watermark, with its last status). The state holds the tasks that aren't idle, so it doesn't grow with
    events or with tasks long gone. Events have times and numbers; keys are numbers, text, dates or booleans. Start it by ``start_status``.
    """
    watermark = int(events.sparkSession.sql(f"SELECT CAST(INTERVAL {delay} AS INTERVAL SECOND) AS d").first()[0].total_seconds() * 1000)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    # Spark itself would drop late rows by the column that has the watermark. The column that goes on has the mark
    # and no time, so that late rows arrive as well.
    unmarked = F.lit(None).cast("timestamp").alias("_event_time", metadata={"spark.watermarkDelayMs": watermark})
    # pandas has no whole numbers with nulls: a key is a JSON text here, and a checksum has a flag.
    named = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_key")
    numbers = (F.coalesce("checksum", F.lit(0)).cast("long").alias("checksum"), F.col("checksum").isNotNull().alias("summed"))
    marked = events.withWatermark(ts, delay).select(named, micros.alias("ts"), F.col("event_id").cast("long"), *numbers, "error_message", unmarked)
    kinds = ", ".join(f"`{k}` {t}" for k, t in events.select(*keys).dtypes)
    times = ("ts", "last_sync", "last_check", "last_error")
    schema = "_key string, kind string, ts long, event_id long, checksum long, last_sync long, last_check long, last_error long, error_message string"
    out = marked.groupBy("_key").transformWithStateInPandas(TaskStatus(idle_ms), schema, "Append", "EventTime")
    own = F.from_json("_key", kinds)
    return out.select(*(own[k].alias(k) for k in keys), *(F.timestamp_micros(c).alias(c) if c in times else F.col(c) for c in out.columns if c != "_key"))


def start_status(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs ``stream_status`` over what has come and ends; its rows go to ``path`` by batch. The state's timers need RocksDB."""
    conf, name = rows.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return rows.writeStream.foreachBatch(by_batch(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(name, before)


def status_table(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last status of each task that isn't idle, from what ``start_status`` wrote."""
    own = [c for c in rows.columns if c not in keys]
    last = rows.where("kind <> 'late'").groupBy(*keys).agg(F.max_by(F.struct(*own), F.struct("ts", "event_id", F.col("kind") == "idle")).alias("last"))
    return last.where("last.kind = 'status'").select(*keys, "last.*")
