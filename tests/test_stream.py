from datetime import datetime

import pytest

from metafleet.sources.store import ScopedTable
from metafleet.streaming.stream import apply_changes, latest_snapshots, merge_into, start_status, status_table, stream_changes, stream_snapshots, stream_status

D1, D2, D3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
SCHEMA = "scope_id int, k int, v string, at timestamp"


def test_snapshots_merge_and_late_ones_are_dropped(spark, tmp_path):
    landed, changes = f"file://{tmp_path}/landed", f"file://{tmp_path}/changes"
    table = ScopedTable(spark, f"file://{tmp_path}/table", ["scope_id"], parts=4)

    def land(rows):
        df = spark.createDataFrame(rows, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(landed)
        stream_snapshots(spark, landed, df.schema, table, ["k"], "at", f"file://{tmp_path}/cp", changes).awaitTermination()
        return sorted((r.scope_id, r.k, r.v) for r in table.read().collect())

    assert land([(1, 1, "a", D1), (1, 2, "b", D1), (2, 1, "c", D1)]) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]
    assert land([(1, 1, "x", D3)]) == [(1, 1, "x"), (2, 1, "c")]
    assert land([(1, 1, "old", D2), (2, 1, "d", D2)]) == [(1, 1, "x"), (2, 1, "d")]
    logged = spark.read.option("recursiveFileLookup", "true").parquet(changes)
    assert sorted(r._action for r in logged.collect()) == ["delete", "update", "update"]
    query = stream_changes(spark, changes, logged.schema).writeStream.format("memory").queryName("logged").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("logged").count() == 3


def test_empty_snapshots_history_and_touched_parts(spark, tmp_path):
    """A scope that came empty loses its rows; other partitions keep their files; closed versions are kept."""
    table = ScopedTable(spark, f"file://{tmp_path}/table", ["scope_id"], parts=8)
    run = merge_into(table, ["k"], "at", history_path=f"file://{tmp_path}/history")
    run(spark.createDataFrame([(s, 1, "a", D1) for s in range(20)], SCHEMA), 0)
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "table").glob("_part=*/*.parquet")}
    before = files()
    run(spark.createDataFrame([(3, None, None, D2), (4, 1, "b", D2)], SCHEMA), 1)
    assert sorted((r.scope_id, r.v) for r in table.read().collect()) == sorted([(s, "a") for s in range(20) if s not in (3, 4)] + [(4, "b")])
    kept = [f for f in before if f in files()]
    assert 0 < len(before) - len(kept) <= 2 * len(before) / 8 + 2
    closed = spark.read.option("recursiveFileLookup", "true").parquet(f"file://{tmp_path}/history")
    assert sorted((r.scope_id, r.v) for r in closed.collect()) == [(3, "a"), (4, "a")] and closed.where("_month is null").isEmpty()
    alone = ScopedTable(spark, f"file://{tmp_path}/alone", ["scope_id"], parts=4)
    one = merge_into(alone, ["k"], "at")
    one(spark.createDataFrame([(1, 1, "a", D1)], SCHEMA), 0)
    one(spark.createDataFrame([(1, None, None, D2)], SCHEMA), 1)
    assert alone.exists() and not list((tmp_path / "alone").glob("_part=*"))


def at(h, m=0):
    return datetime(2024, 1, 1 + h // 24, h % 24, m)


def test_status_stream(spark, tmp_path):
    """Out-of-order and late events go to the side, idle tasks end, and each run goes on from the checkpoint."""
    path, schema = f"file://{tmp_path}", "task int, ts timestamp, event_id long, checksum long, error_message string"

    def land(*rows):
        df = spark.createDataFrame(list(rows), schema)
        df.coalesce(1).write.mode("append").parquet(f"{path}/events")
        events = spark.readStream.schema(df.schema).parquet(f"{path}/events")
        rows = stream_status(events, ["task"], "ts", "1 hour", 6 * 3_600_000)
        start_status(rows, f"{path}/status", f"{path}/cp").awaitTermination()
        out = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/status")
        now = {r.task: (r.checksum, r.last_sync, r.last_check, r.last_error, r.error_message) for r in status_table(out, ["task"]).collect()}
        side = sorted((r.task, r.kind, r.event_id) for r in out.where("kind <> 'status'").collect())
        return now, side

    # In one batch events are folded in order of time, then of number.
    now, side = land((1, at(5), 2, 7, None), (1, at(1), 1, 5, None), (1, at(5), 3, None, "lost"), (2, at(5), 4, 9, None))
    assert now == {1: (7, at(5), at(5), at(5), "lost"), 2: (9, at(5), at(5), None, None)} and side == []
    # The watermark is 4 o'clock: 3:59 is too late for a new task, 4:30 is not newer than task 1's last one but is for task 3.
    now, side = land((4, at(3, 59), 5, 1, None), (1, at(4, 30), 6, 1, None), (3, at(4, 30), 7, 3, None), (1, at(6), 8, 7, None))
    assert now[1] == (7, at(5), at(6), at(5), "lost") and now[3] == (3, at(4, 30), at(4, 30), None, None) and 4 not in now
    assert side == [(1, "late", 6), (4, "late", 5)]
    # 13 o'clock moves the watermark to 12: whoever was last heard of by 6 is idle.
    now, side = land((2, at(13), 9, 9, None))
    assert now == {2: (9, at(5), at(13), None, None)} and [x for x in side if x[1] == "idle"] == [(1, "idle", 8), (3, "idle", 7)]
    # A task that comes back starts afresh: its checksum isn't known any more.
    now, _ = land((1, at(13), 10, 7, None))
    assert now[1] == (7, at(13), at(13), None, None)


class Crash(Exception):
    pass


def test_a_crash_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/table"
    rows = lambda v: spark.createDataFrame([(s, v) for s in range(30)], "scope_id int, v string")
    seen = lambda: sorted((r.scope_id, r.v) for r in ScopedTable(spark, path, ["scope_id"], 8).read().collect())
    table = ScopedTable(spark, path, ["scope_id"], 8)
    table.overwrite(rows("old"))
    moved = []

    def move(self, p, journal, own=ScopedTable._move):
        if len(moved) == 3:
            raise Crash
        moved.append(p)
        own(self, p, journal)

    def no_journal(self, path, text, own=ScopedTable._write):
        raise Crash

    with monkeypatch.context() as m, pytest.raises(Crash):
        m.setattr(ScopedTable, "_write", no_journal)
        table.overwrite(rows("lost"))
    assert seen() == [(s, "old") for s in range(30)]
    with monkeypatch.context() as m, pytest.raises(Crash):
        m.setattr(ScopedTable, "_move", move)
        table.overwrite(rows("new").where("scope_id % 2 = 0"))
    # Some partitions have moved, others not: a reader sees the whole new table.
    assert len(moved) == 3 and seen() == [(s, "new") for s in range(0, 30, 2)]
    some = ScopedTable(spark, path, ["scope_id"], 8).touched(rows("x").where("scope_id in (2, 3)"))
    part = sorted(r.scope_id for r in ScopedTable(spark, path, ["scope_id"], 8).read(some).collect())
    assert 2 in part and 3 not in part and len(part) < 15
    table.recover()
    assert seen() == [(s, "new") for s in range(0, 30, 2)] and not list((tmp_path / "table").glob("_journal"))
    assert not [f for f in (tmp_path / "table").glob("_aside-*/_part=*") if "new" in str(f)]


def test_changes_are_applied_once(spark, tmp_path):
    """A consumer's copy follows the table through batches that are delivered twice or out of date."""
    path = f"file://{tmp_path}"
    table, copy = (ScopedTable(spark, f"{path}/{n}", ["scope_id"], parts=4) for n in ("table", "copy"))
    rows = lambda t: sorted((r.scope_id, r.k, r.v) for r in t.read().collect())

    def land(*new):
        df = spark.createDataFrame(list(new), SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{path}/landed")
        stream_snapshots(spark, f"{path}/landed", df.schema, table, ["k"], "at", f"{path}/cp", f"{path}/changes", log_first=True).awaitTermination()

    def follow(checkpoint):
        schema = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/changes").schema
        stream = stream_changes(spark, f"{path}/changes", schema)
        stream.writeStream.foreachBatch(apply_changes(copy, ["k"], "copy")).option("checkpointLocation", f"{path}/{checkpoint}").trigger(availableNow=True).start().awaitTermination()

    land((1, 1, "a", D1), (1, 2, "b", D1), (2, 1, "c", D1))
    follow("one")
    assert rows(copy) == rows(table)
    land((1, 1, "x", D2))
    land((1, 3, "y", D3), (2, None, None, D3))
    follow("one")
    assert rows(copy) == rows(table) == [(1, 3, "y")] and copy.marked("copy") == 1
    # The consumer lost its checkpoint: batch 0 comes again, with everything in it, and is passed over.
    copy.overwrite(spark.createDataFrame([], copy.read().schema))
    follow("two")
    assert rows(copy) == []
    # Another consumer's name starts from the first change.
    run = apply_changes(copy, ["k"], "other")
    run(spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/changes"), 0)
    assert rows(copy) == rows(table)


def test_snapshots_are_not_dealt_by_scope(spark, tmp_path):
    """What a batch writes first: a small table of the scopes' times, which is sent to the rows."""
    rows = spark.range(3000).selectExpr("CAST(id % 3 AS INT) AS scope_id", "CAST(id AS INT) AS k", "'a' AS v", "TIMESTAMP '2024-02-01 00:00:00' AS at")
    rows.write.parquet(f"{tmp_path}/landed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    try:
        kept = latest_snapshots(spark.read.parquet(f"{tmp_path}/landed"), ["scope_id"], "at")
        n, plan = kept.count(), kept._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert n == 3000 and "BroadcastHashJoin" in plan and "hashpartitioning(scope_id" not in plan


def test_events_of_a_batch_are_folded_at_once():
    """A task's events come as tables; numbers beyond 2 ** 53 and unknown checksums keep their values."""
    import pandas as pd
    from types import SimpleNamespace as Of

    from metafleet.streaming.stream import TaskStatus

    kept, big = [], 2**53 + 1
    state = Of(exists=lambda: bool(kept), get=lambda: kept[-1], update=kept.append)
    task = TaskStatus(1000)
    task.init(Of(getValueState=lambda *a: state, registerTimer=lambda t: None, deleteTimer=lambda t: None))
    rows = [pd.DataFrame({"ts": [2000, 1000], "event_id": [2, 1], "checksum": [0, big], "summed": [False, True], "error_message": ["lost", None]}), pd.DataFrame({"ts": [3000, 3000], "event_id": [3, 3], "checksum": [big, big], "summed": [True, True], "error_message": [None, None]})]
    out = list(task.handleInputRows(("{}",), iter(rows), Of(getCurrentWatermarkInMs=lambda: 0)))
    assert kept == [(3000, 3, big, 1000, 2000, "lost")] and [list(o["kind"]) for o in out] == [["late"], ["status"]]
