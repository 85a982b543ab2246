from datetime import datetime

import pytest
from pyspark.sql import functions as F

from metafleet.operators import drift, history, merge
from metafleet.operators.status import dataset_checksum
from metafleet.sources.landing import Landing, merge_moved
from metafleet.sources.monthly import MonthlyHistory

T = [datetime(2024, 1, d) for d in (1, 2, 3)]


def scanned(df):
    """Folders and files that the scans of a frame have read, after it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        if node.getClass().getSimpleName() == "FileSourceScanExec" and "dynamicpruning" in node.toString():
            found.append(node.metrics().apply("numFiles").value())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return found


@pytest.fixture
def landings(spark, tmp_path):
    def make(rows, scopes, name):
        df = spark.createDataFrame(rows, "scope_id int, k int, v string")
        return Landing(spark, f"file://{tmp_path}/{name}", ["scope_id"], ["k"], ranges=4).land(df, spark.createDataFrame([(s,) for s in scopes], "scope_id int"))

    return make


def test_only_moved_ranges_are_read_and_the_merge_is_whole(spark, landings):
    old = [(s, k, f"v{k}") for s in range(6) for k in range(40)]
    new = [(s, k, "new" if (s, k) == (1, 7) else v) for s, k, v in old if (s, k) != (2, 9) and s != 3]
    before, after = landings(old, range(6), "old"), landings(new, [0, 1, 2, 3, 5], "new")
    # Scope 3 came empty, scope 4 was not collected; one range of 1 and one of 2 moved.
    moved = after.moved(before.digests(), "clear")
    hit = {(r.scope_id, r._range) for r in moved.where("moved = 1").collect()}
    assert {s for s, _ in hit} == {1, 2, 3} and len(hit) == 2 + 4
    assert {r.scope_id for r in after.moved(before.digests()).where("moved = 1").collect()} == {1, 2}
    rows = after.rows(moved)
    assert {(r.scope_id, r._range) for r in rows.select("scope_id", "_range").distinct().collect()} == {x for x in hit if x[0] != 3}
    # Of 4 scopes with 4 ranges each the scan opens the two folders that moved.
    assert scanned(rows) == [2]

    current = merge.first_load(spark.createDataFrame(old, "scope_id int, k int, v string"), ["scope_id"], ["k"], T[0])
    got = merge_moved(current, after, moved, T[1])
    whole = merge.merge_snapshot(current, after.snapshot().drop("_range"), after.scopes(), ["k"], T[1], on_empty="clear")
    both = [sorted(map(str, m.next().select(*current.columns).collect())) for m in (got, whole)]
    assert both[0] == both[1]
    actions = [{(r.scope_id, r.k, r._action) for r in m.changes().collect()} for m in (got, whole)]
    assert actions[0] == actions[1] and (1, 7, "update") in actions[0] and (2, 9, "delete") in actions[0]


def test_checksums_roll_up(spark, landings):
    rows = [(s, k, f"v{k % 3}") for s in range(3) for k in range(30)]
    landing = landings(rows, [0, 1, 2, 9], "one")
    want = dataset_checksum(spark.createDataFrame(rows, "scope_id int, k int, v string"), ["scope_id"], ["k", "v"], landing.scopes())
    assert sorted(map(tuple, landing.checksums().collect())) == sorted(map(tuple, want.collect()))
    assert (9, 0, 0) in [tuple(r) for r in landing.checksums().collect()]


def test_unmoved_scopes_leave_the_scan_to_the_gate(spark, landings):
    """A gate over scopes alone prunes by scope as well."""
    landing = landings([(s, k, "v") for s in range(8) for k in range(20)], range(8), "all")
    going = landing.checksums().select("scope_id", F.when(F.col("scope_id") < 2, 1).otherwise(0).alias("moved"))
    rows = landing.rows(going)
    assert rows.count() == 40 and sum(scanned(rows)) <= 8


def test_months(spark, tmp_path):
    """Reads at a time leave older folders alone, expiry deletes folders, and the limit's own month is exact."""
    stored = MonthlyHistory(spark, f"file://{tmp_path}/history")
    schema = "k int, v string, _ModifyDate timestamp_ntz, _ValidFrom timestamp_ntz, _ValidTo timestamp_ntz"
    day = lambda m, d=1: datetime(2024, m, d)
    rows = [(k, f"v{m}", day(m), day(m), day(m + 1, 15)) for k in range(3) for m in range(1, 9)]
    current = spark.createDataFrame([(9, "now", day(3))], "k int, v string, _ModifyDate timestamp_ntz")
    assert stored.read() is None and stored.months() == [] and stored.as_of(current, day(4)).count() == 1
    closed = spark.createDataFrame(rows, schema).withColumn("_month", history.month("_ValidTo"))
    stored.append(closed.where("k < 2"))
    stored.append(closed.where("k = 2"))
    assert stored.months() == [202400 + m for m in range(2, 10)]
    found = stored.as_of(current, day(5, 20))
    assert sorted((r.k, r.v) for r in found.collect()) == [(0, "v5"), (1, "v5"), (2, "v5"), (9, "now")]
    assert "PartitionFilters: [isnotnull(_month" in found._jdf.queryExecution().toString()
    assert stored.between(current, day(8), day(9)).count() == 3 * 2 + 1
    # Six months before the 20th of August: the version that ended on 15 February is gone with its folder's rows.
    assert stored.expire(datetime(2024, 10, 20)) == [202402, 202403] and stored.months()[0] == 202404
    kept = history.expire_history(stored.read(), datetime(2024, 10, 20))
    assert min(r._ValidTo for r in kept.collect()) == day(5, 15)


def test_temporal_join(spark):
    schema = "k int, v string, _ValidFrom timestamp_ntz, _ValidTo timestamp_ntz"
    d = lambda m, day=1: datetime(2024, m, day)
    left = [(1, "a", d(1), d(3)), (1, "b", d(3), None), (2, "c", d(1), d(1)), (3, "d", d(1), d(12))]
    right = [(1, "x", d(2, 15), d(4)), (1, "y", d(4), None), (3, "z", d(5), d(5, 2)), (3, "w", d(12), None), (2, "q", d(1), None)]
    horizon = d(12, 31)
    got = history.temporal_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], horizon)
    end = lambda t: t or horizon
    want = [
        (p[0], p[1], q[1], max(p[2], q[2]), None if p[3] is None and q[3] is None else min(end(p[3]), end(q[3])))
        for p in left for q in right if p[0] == q[0] and p[2] < end(p[3]) and max(p[2], q[2]) < min(end(p[3]), end(q[3]))
    ]
    assert sorted((r.k, r.v, r.right_v, r._ValidFrom, r._ValidTo) for r in got.collect()) == sorted(want, key=str) and len(want) == 4
    assert "SortMergeJoin" in got._jdf.queryExecution().toString() or "HashJoin" in got._jdf.queryExecution().toString()


def test_temporal_join_moves_versions_once(spark):
    """Versions that last for years are one row each on their way to the join; those of long histories are cut, to the same result."""
    d = lambda y, m=1: datetime(y, m, 1)
    schema = "k int, v string, _ValidFrom timestamp_ntz, _ValidTo timestamp_ntz"
    left = spark.createDataFrame([(k, f"l{k}-{y}", d(y), None if (k + y) % 3 else d(y + 2)) for k in range(4) for y in range(1990, 1992 + k)], schema)
    right = spark.createDataFrame([(k, f"r{k}-{y}", d(y, 6), None if (k + y) % 2 else d(y, 8)) for k in range(4) for y in range(1989, 1994)] + [(None, "n", d(1990), None)], schema)

    def nodes(plan):
        yield plan
        children = plan.children().iterator()
        while children.hasNext():
            yield from nodes(children.next())

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        whole = history.temporal_join(left, right, ["k"], d(2020))
        rows = sorted(map(str, whole.collect()))
        made = [n.metrics().apply("numOutputRows").value() for n in nodes(whole._jdf.queryExecution().executedPlan()) if n.nodeName() == "Generate"]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(made) == 2 and sum(made) <= left.count() + right.count()
    for long in (1, 4, 5):
        assert sorted(map(str, history.temporal_join(left, right, ["k"], d(2020), long).collect())) == rows and len(rows) > 40


def test_presence_drift_over_many_buckets(spark, monkeypatch):
    """No literal list in the plan; buckets that an item is in no scope of are told as well."""
    monkeypatch.setattr(drift, "BITS", 32)
    here = {(i, s) for i in range(12) for s in range(200) if (i * s + i) % 7 and (i != 5 or s < 3) and i != 11} | {(11, s) for s in range(200)}
    items = spark.createDataFrame([(f"i{i}", s) for i, s in here] + [("i0", 999), ("i1", None)], "item string, scope int")
    scopes = spark.createDataFrame([(s,) for s in range(200)] * 2 + [(None,)], "scope int")
    got = drift.presence_drift(items, scopes, ["item"], "scope")
    want = {(f"i{i}", s) for i in {i for i, _ in here} for s in range(200)} - {(f"i{i}", s) for i, s in here}
    assert {(r.item, r.scope) for r in got.collect()} == want and got.count() == len(want) > 300
