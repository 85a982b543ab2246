"""Merge semantics by hand-written rows, and properties of merges and history."""

import re
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from metafleet.operators import history, merge

D1, D2, D3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
SCHEMA = "scope_id int, k int, v string"
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def load(spark, data):
    return merge.first_load(spark.createDataFrame(data, SCHEMA), ["scope_id"], ["k"], D1)


def apply(spark, current, data, scopes, at=D2, **options):
    return merge.merge_snapshot(current, spark.createDataFrame(data, SCHEMA), spark.createDataFrame([(s,) for s in scopes], "scope_id int"), ["k"], at, **options)


def test_deletes_are_scoped(spark):
    m = apply(spark, load(spark, [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]), [(1, 1, "a")], [1])
    assert rows(m.next(), "scope_id", "k", "v") == [(1, 1, "a"), (2, 1, "c")]
    assert rows(m.rows, "k", "scope_id", "_action") == [(1, 1, "same"), (1, 2, "keep"), (2, 1, "delete")]


def test_dates(spark):
    m = apply(spark, load(spark, [(1, 1, "a"), (1, 2, "b")]), [(1, 1, "x"), (1, 2, "b"), (1, 3, "n")], [1])
    assert rows(m.next(), "k", "_InsertDate", "_ModifyDate") == [(1, D1, D2), (2, D1, D1), (3, D2, D2)]


@pytest.mark.parametrize("on_empty, left", [("keep", [(1, 1, "a")]), ("clear", [])])
def test_empty_snapshot(spark, on_empty, left):
    m = apply(spark, load(spark, [(1, 1, "a")]), [], [1], on_empty=on_empty)
    assert rows(m.next(), "scope_id", "k", "v") == left


def test_unknown_on_empty(spark):
    with pytest.raises(ValueError):
        apply(spark, load(spark, []), [], [1], on_empty="maybe")


def test_snapshot_of_uncollected_scope_is_ignored(spark):
    m = apply(spark, load(spark, [(1, 1, "a")]), [(1, 1, "z"), (9, 9, "q")], [2], on_empty="clear")
    assert rows(m.next(), "scope_id", "k", "v") == [(1, 1, "a")]


def test_all_null_column_keeps_the_hash(spark):
    current = load(spark, [(1, 1, "a")])
    wide = spark.createDataFrame([(1, 1, "a", None)], SCHEMA + ", added string")
    assert merge.hashed(wide, ["scope_id"], ["k"]).first()["_RowHash"] == current.first()["_RowHash"]


def test_null_and_empty_differ(spark):
    m = apply(spark, load(spark, [(1, 1, None)]), [(1, 1, "")], [1])
    assert rows(m.rows, "_action") == [("update",)]


def test_keep_last(spark):
    schema = "scope_id int, k int, n long, seen string"
    current = merge.first_load(spark.createDataFrame([(1, 1, 5, "mon")], schema), ["scope_id"], ["k"], D1)
    new = spark.createDataFrame([(1, 1, 2, None)], schema)
    out = merge.merge_counters(current, new, new.select("scope_id"), ["k"], D2, ["seen"]).next()
    assert rows(out, "n", "seen") == [(2, "mon")]


def test_zero_fill(spark):
    schema = "scope_id int, k string, n long"
    current = merge.first_load(spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "a", 7)], schema), ["scope_id"], ["k"], D1)
    new = spark.createDataFrame([(1, "a", 5)], schema)
    out = merge.merge_zero_fill(current, new, new.select("scope_id"), ["k"], D2, ["n"]).next()
    assert rows(out, "scope_id", "k", "n", "_ModifyDate") == [(1, "a", 5, D2), (1, "b", 0, D2), (2, "a", 7, D1)]


def test_replace_scope_empties_collected(spark):
    current = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA)
    out = merge.replace_scope(current, spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1,)], "scope_id int"))
    assert rows(out, "scope_id", "k", "v") == [(2, 1, "b")]


def test_plan_has_one_full_join_and_no_python(spark):
    m = apply(spark, load(spark, [(1, 1, "a")]), [(1, 1, "b")], [1])
    plan = m.next()._jdf.queryExecution().toString()
    assert plan.count("Join FullOuter") <= 3 and "Python" not in plan and "CartesianProduct" not in plan


table = st.dictionaries(st.tuples(st.integers(1, 3), st.integers(1, 4)), st.sampled_from(["a", "b", None]), max_size=8).map(lambda d: [(s, k, v) for (s, k), v in d.items()])


@few
@given(old=table, new=table, scopes=st.sets(st.integers(1, 3)))
def test_properties(spark, old, new, scopes):
    current = load(spark, old)
    m = apply(spark, current, new, scopes, on_empty="clear")
    after = rows(m.next(), "scope_id", "k", "v")
    assert after == sorted([r for r in old if r[0] not in scopes] + [r for r in new if r[0] in scopes], key=str)
    # Merging the same snapshot again changes nothing.
    assert apply(spark, m.next(), new, scopes, D3, on_empty="clear").changes().isEmpty()
    closed = history.history_append(m, D2)
    assert rows(history.as_of(m.next(), closed, D1), "scope_id", "k", "v") == sorted(old, key=str)
    assert rows(history.as_of(m.next(), closed, D2), "scope_id", "k", "v") == after
    assert closed.where("_ValidFrom >= _ValidTo").isEmpty()


def test_merge_moves_rows_by_key_alone(spark, tmp_path):
    """Scopes come to the rows, whatever Spark thinks of their number; the tasks follow the lines, and the keys' join needs no other deal."""
    from metafleet.plans.fixtures import Inputs
    from metafleet.plans.queries import QUERIES

    lines = spark.range(3000).selectExpr("id % 50 AS l_suppkey", "id DIV 3 AS l_orderkey", "CAST(id % 3 AS INT) AS l_linenumber", "CAST(id % 7 AS DOUBLE) AS l_quantity")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert Inputs(spark, str(tmp_path)).dealt("lineitem", "l_orderkey", rows=100).lineitem.rdd.getNumPartitions() == 30
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        df = QUERIES["merge_composite_key"](spark, str(tmp_path))
        n, plan = df.count(), df._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert n == 3000
    physical = plan.split("== Physical Plan ==")[1].split("== Initial Plan ==")[0]
    assert "hashpartitioning(scope_id" not in physical and physical.count("REPARTITION_BY_NUM") == 2


def test_code_of_wide_merges_is_compiled(spark, capsys):
    """The JVM never compiles a method of 8,000 bytes or more; a condition for each of 20 columns made one of 11,896."""
    columns = ", ".join(f"c{k} string" for k in range(20))
    wide = spark.createDataFrame([], f"scope_id int, k int, {columns}")
    merged = merge.merge_snapshot(merge.first_load(wide, ["scope_id"], ["k"], D1), wide, wide.select("scope_id"), ["k"], D2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged.rows.drop("scope_id", "k").explain("codegen")  # as ``once`` writes them
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert 0 < max(sizes) < 8000
