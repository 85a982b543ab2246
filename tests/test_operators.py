from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metafleet.functions import keys as K
from metafleet.operators import history, definitions, drift, identity, relational, rules, status
from metafleet.plans.registry import DATASETS, DatasetSpec, spec_frame
from metafleet.sources import snapshot
from metafleet.sources.store import ScopedTable

D1, D2, D3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_names_compare_without_case_and_trailing_blanks(spark):
    names = spark.createDataFrame([(1, "dbo", "T", "P "), (1, "DBO", "t ", "P"), (2, "dbo", "T", "P")], "database_id int, schema_name string, object_name string, object_type string")
    assert identity.resolve_objects(names).count() == 2


def test_separators_and_nulls_cannot_forge_ids(spark):
    a, b, c, d = one(spark, K.item_id(F.lit("a\x1fb"), F.lit("c")), K.item_id(F.lit("a"), F.lit("b\x1fc")), K.item_id(F.lit(None), F.lit("x")), K.item_id(F.lit("x"), F.lit(None)))
    assert len({a, b, c, d}) == 4


def test_checksum_tells_nulls_and_repeats_apart(spark):
    df = spark.createDataFrame([(1, None, 1), (2, 1, None), (3, 5, 5), (3, 5, 5)], "s int, a int, b int")
    sums = {r.s: r.checksum for r in status.dataset_checksum(df, ["s"], ["a", "b"]).collect()}
    assert sums[1] != sums[2] and sums[3] != 0


def test_microseconds_reach_the_hash(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 1),), (datetime(2024, 1, 1, 0, 0, 0, 2),)], "t timestamp")
    assert df.select(K.row_hash(["t"])).distinct().count() == 2


def test_delete_and_recreate_keeps_the_id(spark):
    names = spark.createDataFrame([(1, "dbo", "t", "U")], "database_id int, schema_name string, object_name string, object_type string")
    items = identity.resolve_objects(names)
    dim = items.withColumns({"is_deleted": F.lit(False), "delete_date": F.lit(None).cast("timestamp")})
    scope = names.select("database_id")
    gone = identity.sync_items(dim, items.limit(0), scope, "object_key", "database_id", D1)
    assert gone.first().is_deleted and gone.first().delete_date == D1
    again = identity.sync_items(gone, items.limit(0), scope, "object_key", "database_id", D2)
    assert again.first().delete_date == D1
    back = identity.sync_items(again, items, scope, "object_key", "database_id", D3, full=False)
    assert not back.first().is_deleted and back.first().delete_date is None and back.first().object_key == items.first().object_key


def test_failure_without_status_leaves_no_checksum(spark):
    schema = "instance_id int, database_id int, dataset_id int, checksum long, last_sync timestamp_ntz, last_check timestamp_ntz, last_error timestamp_ntz, error_message string"
    event = "event_id long, ts timestamp_ntz, instance_id int, database_id int, dataset_id int, checksum long, error_message string"
    empty = spark.createDataFrame([], schema)
    failed = status.status_apply(empty, spark.createDataFrame([(1, D1, 1, None, 1, 5, "no")], event))
    r = failed.first()
    assert (r.checksum, r.last_sync, r.last_check, r.error_message) == (None, None, D1, "no")
    ok = status.status_apply(failed, spark.createDataFrame([(2, D2, 1, None, 1, 5, None)], event)).first()
    assert (ok.checksum, ok.last_sync, ok.last_error, ok.error_message) == (5, D2, D1, "no")
    same = status.status_apply(status.status_apply(failed, spark.createDataFrame([(2, D2, 1, None, 1, 5, None)], event)), spark.createDataFrame([(3, D3, 1, None, 1, 5, None)], event)).first()
    assert (same.last_sync, same.last_check) == (D2, D3)


def test_gate(spark):
    tasks = spark.createDataFrame([(1, 5, 5, True), (2, 5, 6, True), (3, None, 5, True), (4, 5, None, False), (5, 5, None, True)], "id int, old_checksum long, new_checksum long, has_checksum boolean")
    assert {r.id for r in status.checksum_gate(tasks).collect()} == {2, 3, 4}
    assert [r.id for r in status.missing_checksums(tasks).collect()] == [5]


def test_stale_minutes_counts_boundaries(spark):
    a, b = F.lit(datetime(2024, 1, 1, 0, 0, 0, 900000)), F.lit(datetime(2024, 1, 1, 0, 1, 0, 100000))
    assert one(spark, K.stale_minutes(a, b))[0] == 1


def test_registry():
    assert len(DATASETS) == 49 == len({d.name for d in DATASETS})
    assert sum(d.has_checksum for d in DATASETS) == 30 and sum(d.versioned for d in DATASETS) == 16
    assert all(d.keys for d in DATASETS if d.mode == "complex")
    with pytest.raises(ValueError):
        DatasetSpec("x", "table", 1, "simple", False, False)


def test_spec_frame(spark):
    assert spec_frame(spark).groupBy("level").count().orderBy("level").collect()[0]["count"] == 32


def test_align_to_schema(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(1, 2)], "a int, c int")
    with pytest.raises(ValueError, match="c"):
        snapshot.align_to_schema(df, schema)
    assert snapshot.align_to_schema(df, schema, strict=False).collect() == [(1, None)]


def test_optional_source(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert snapshot.optional_source(spark, str(tmp_path / "none"), schema).count() == 0


def test_drift_ties_go_to_the_least_value(spark):
    df = spark.createDataFrame([("i", 1, "b"), ("i", 2, "a"), ("j", 1, "x"), ("j", 2, None)], "item string, db int, v string")
    assert drift.definition_drift(df, ["item"], "db", "v").collect() == [("i", 1, "b", "a")]


def test_presence(spark):
    items = spark.createDataFrame([("i", 1), ("i", 2), ("j", 1), ("k", 9)], "item string, db int")
    scopes = spark.createDataFrame([(1,), (2,)], "db int")
    assert drift.presence_drift(items, scopes, ["item"], "db").collect() == [("j", 2)]


def test_definitions(spark):
    rows = spark.createDataFrame([(2, "x"), (1, "x"), (3, None)], "object_id int, definition string")
    assert definitions.first_per_hash(rows, "object_id").select("first", "definition").collect() == [(1, "x")]


def test_rules(spark):
    assert rules.duplicate_keys(spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int"), ["a", "b"]).collect() == [(1, None, 2)]
    with pytest.raises(rules.RuleError):
        rules.require_none(spark.range(3))
    rules.require_none(spark.range(0))


def test_null_safe_sets(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, 5)], "x int, y int")
    b = spark.createDataFrame([(1, None)], "x int, y int")
    assert relational.new_keys(a, b, ["x", "y"]).collect() == [(2, 5)]
    assert relational.null_safe_match(a, b, ["x", "y"]).count() == 2


def test_store(spark, tmp_path):
    table = ScopedTable(spark, f"file://{tmp_path}/t", ["scope_id"], parts=4)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert not table.exists()
    first = spark.createDataFrame([(s, s * 10) for s in range(8)], "scope_id int, v int")
    table.overwrite(first)
    assert table.exists() and rows(table.read()) == [(s, s * 10) for s in range(8)]
    # Scope 3 becomes empty; only its partition is rewritten, from rows read of it.
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").glob("_part=*/*.parquet")}
    parts, before = table.touched(spark.createDataFrame([(3,)], "scope_id int")), files()
    table.overwrite(table.read(parts).where("scope_id <> 3"), parts)
    assert len(parts) == 1 and rows(table.read()) == [(s, s * 10) for s in range(8) if s != 3]
    assert all(before.get(f) == t for f, t in files().items() if f"_part={parts[0]}/" not in f)
    table.overwrite(first.limit(0))
    assert table.exists() and table.read().count() == 0 and table.read().columns == ["scope_id", "v"]


def test_two_schemas(spark):
    """Tables of one name in two schemas of a database are two tables to every rule."""
    names = lambda df: sorted((r.schema_name, r.object_name, r.item) for r in df.collect())
    fk = spark.createDataFrame([(1, s, "t", "FK_t_a", c, k) for s, c, k in (("x", "a", 1), ("y", "a", 1), ("y", "b", 2))], "database_id int, schema_name string, object_name string, name string, column_name string, ordinal int")
    assert names(rules.foreign_key_name(fk)) == [("y", "t", "FK_t_a")]
    index = fk.selectExpr("*", "'PK' AS kind", "false AS is_clustered", "false AS is_included").withColumn("name", F.lit("PK_t_a"))
    assert names(rules.index_name(index)) == [("y", "t", "PK_t_a")]
    columns = spark.createDataFrame([(1, "x", "t", "_ModifyDate", "int", 1), (1, "y", "t", "_ModifyDate", "int", 2)], "database_id int, schema_name string, object_name string, column_name string, type_name string, ordinal int")
    have = columns.where("schema_name = 'x'")
    assert names(rules.missing_default(columns, have)) == [("y", "t", "_ModifyDate")]
    assert names(rules.missing_foreign_key(columns, have, ["_ModifyDate"])) == [("y", "t", "_ModifyDate")]
    assert names(rules.required_column(columns, 1, "_ModifyDate", "int")) == [("y", "t", "_ModifyDate")]
    refs = columns.selectExpr("database_id", "schema_name", "object_name", "schema_name AS ref_schema", "'T ' AS ref_name")
    assert names(rules.missing_reference(refs, have)) == [("y", "t", "T ")]


def test_rename_scripts(spark):
    row = spark.createDataFrame([("dbo", "it's a.name]", "DF_it's", "tab le")], "s string, c string, p string, t string")
    found = row.select(rules.rename_script(F.col("s"), F.col("c"), F.col("p")).alias("a"), rules.rename_script(F.col("s"), F.col("p"), F.col("c"), F.col("t")).alias("b")).first()
    assert found.a == "EXEC sp_rename N'dbo.[it''s a.name]]]', N'DF_it''s', N'OBJECT';"
    assert found.b == "EXEC sp_rename N'dbo.[tab le].[DF_it''s]', N'it''s a.name]', N'INDEX';"


def test_expire_to_the_second(spark):
    closed = spark.createDataFrame([(1, datetime(2024, 1, 15, 9, 59, 59)), (2, datetime(2024, 1, 15, 10, 0, 0))], "k int, _ValidTo timestamp_ntz")
    for df in (closed, closed.withColumn("_month", history.month("_ValidTo"))):
        assert [r.k for r in history.expire_history(df, datetime(2024, 7, 15, 10)).collect()] == [2]


def _spec(name, **options):
    from metafleet.plans.registry import DatasetSpec

    return DatasetSpec(name, "database", 60, options.pop("mode", "complex"), options.pop("has_checksum", False), False, ("k",), **options)


def test_waves_follow_what_datasets_wait_for():
    from metafleet.plans.sync import waves

    specs = [_spec("columns", after=("objects",)), _spec("facts", after=("columns", "objects")), _spec("objects"), _spec("alone", after=("not in this run",))]
    assert [sorted(s.name for s in w) for w in waves(specs)] == [["alone", "objects"], ["columns"], ["facts"]]
    with pytest.raises(ValueError, match="a, b"):
        waves([_spec("a", after=("b",)), _spec("b", after=("a",))])


@pytest.fixture
def one_run(spark):
    """A run over scopes 1 to 3 of instance 0 for one dataset; returns rows by scope and status by scope."""
    from metafleet.operators.merge import first_load
    from metafleet.operators.status import STATE, task_matrix
    from metafleet.plans import sync
    from metafleet.plans.registry import spec_frame

    now = datetime(2024, 1, 2)

    def make(spec, snapshot, scopes, checksums=None, unreachable=None):
        frame = lambda rows: spark.createDataFrame([(0, *r) for r in rows], "instance_id int, database_id int, k int, v string")
        every = spark.createDataFrame([(0, s, True) for s in (1, 2, 3)], "instance_id int, database_id int, is_enabled boolean")
        known = spark.createDataFrame([], "instance_id int, database_id int, dataset_id int, " + ", ".join(f"{c} {t}" for c, t in STATE.items()))
        current = frame([(s, 1, "old") for s in (1, 2, 3)])
        current = current if spec.mode == "simple" else first_load(current, sync.SCOPE["database"], ["k"], F.lit(now))
        matrix = task_matrix(spec_frame(spark, [spec]), every.select("instance_id", "is_enabled").distinct(), every, known)
        got = [every.where(F.col("database_id").isin(scopes)).select("instance_id", "database_id")]
        sums = checksums and spark.createDataFrame([(0, *r) for r in checksums], "instance_id int, database_id int, checksum long")
        away = unreachable and spark.createDataFrame([(0, s, "no connection") for s in unreachable], "instance_id int, database_id int, message string")
        run = sync.sync_run([spec], matrix, known, {spec.name: sync.Source(current, frame(snapshot), got[0], checksums=sums)}, F.lit(now), away)
        rows = sorted((r.database_id, r.v) for r in run.tables[spec.name].collect())
        return rows, {r.database_id: (r.checksum, r.error_message) for r in run.status.collect()}

    return make


def test_an_empty_scope_keeps_merged_rows_and_loses_replaced_ones(one_run):
    """Scope 1 came with rows, 2 came empty, 3 could not be read."""
    rows, state = one_run(_spec("merged"), [(1, 1, "new")], [1, 2])
    assert rows == [(1, "new"), (2, "old"), (3, "old")] and state == {1: (None, None), 2: (None, None), 3: (None, "not collected")}
    rows, _ = one_run(_spec("replaced", mode="simple"), [(1, 1, "new")], [1, 2])
    assert rows == [(1, "new"), (3, "old")]


def test_unreachable_scopes_and_missing_checksums(one_run):
    rows, state = one_run(_spec("merged", has_checksum=True), [(1, 1, "new"), (2, 1, "new")], [1, 2], [(1, 7), (2, 8)], [3])
    assert rows == [(1, "new"), (2, "new"), (3, "old")] and state == {1: (7, None), 2: (8, None), 3: (None, "no connection")}
    with pytest.raises(ValueError, match="1 scopes were read and have no checksum"):
        one_run(_spec("merged", has_checksum=True), [(1, 1, "new")], [1, 2], [(1, 7)])


def test_landed_datasets_answer_the_gate_by_their_digests(spark, tmp_path):
    from metafleet.operators.merge import first_load
    from metafleet.plans import sync
    from metafleet.sources.landing import Landing

    frame = lambda rows: spark.createDataFrame([(0, *r) for r in rows], "instance_id int, database_id int, k int, v string")
    scope = sync.SCOPE["database"]
    scopes = spark.createDataFrame([(0, s) for s in (1, 2)], "instance_id int, database_id int")
    landing = Landing(spark, f"file://{tmp_path}/landed", scope, ["k"], ranges=2).land(frame([(s, k, "x") for s in (1, 2) for k in range(9)]), scopes)
    sums = {r.database_id: r.checksum for r in landing.checksums().collect()}
    tasks = spark.createDataFrame([(0, 1, sums[1]), (0, 2, 5)], "instance_id int, database_id int, old_checksum long")
    source = sync.Source(first_load(frame([]), scope, ["k"], F.lit(datetime(2024, 1, 1))), landing=landing)
    gate = sync.gated(_spec("landed", has_checksum=True), tasks, source)
    assert {(r.database_id, r.checksum, r.moved) for r in gate.collect()} == {(1, sums[1], 0), (2, sums[2], 1)}
    assert {r.database_id for r in landing.rows(gate).collect()} == {2}


def test_passing_tables_go(spark):
    from metafleet.sources import scratch

    kept = scratch.written(spark.range(3), "kept")
    with scratch.passing(spark):
        gone = scratch.written(spark.range(3), "gone")
        assert gone.count() == 3
    path = gone.inputFiles()[0].rsplit("/", 1)[0]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    assert kept.count() == 3


def test_a_snapshot_is_computed_once(spark):
    """Checksums, items, unknown ids and merge read one table; each of them computed the snapshot anew."""
    from metafleet.operators.merge import first_load
    from metafleet.plans import sync

    names = "instance_id int, database_id int, _ColumnName string"
    rows = spark.createDataFrame([(0, s, f"c{k}") for s in (1, 2) for k in range(20)], names)
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    roles = {"_ColumnID": ("database_id", "_ColumnName")}
    spec = DatasetSpec("columns", "database", 720, "complex", True, True, ("_ColumnID",), roles=roles, defines="_ColumnID", refers={"_ColumnID": "_ColumnID"})
    scopes = spark.createDataFrame([(0, 1), (0, 2)], "instance_id int, database_id int")
    none = spark.createDataFrame([], "instance_id int, database_id int, _ColumnID long, _ColumnName string")
    items = spark.createDataFrame([], "_ColumnID long, database_id int, _ColumnName string, is_deleted boolean, delete_date timestamp_ntz")
    known = spark.createDataFrame([], "instance_id int, database_id int, dataset_id int, checksum long, last_sync timestamp_ntz, last_check timestamp_ntz, last_error timestamp_ntz, error_message string")
    matrix = scopes.selectExpr("*", "1 AS dataset_id", "720 AS minutes", "cast(null AS bigint) AS checksum", "cast(null AS timestamp_ntz) AS last_check")
    source = sync.Source(first_load(none, ["instance_id", "database_id"], ["_ColumnID"], F.lit(datetime(2024, 1, 1))), rows.mapInArrow(passed, names), scopes, items=items)
    run = sync.sync_run([spec], matrix, known, {"columns": source}, F.lit(datetime(2024, 1, 2)))
    assert run.tables["columns"].count() == 40 == run.items["_ColumnID"].count() and not run.lost["columns"].count()
    assert {(r.database_id, r.n) for r in run.changes["columns"].where("_ColumnID = after._ColumnID").groupBy("database_id").agg(F.count("*").alias("n")).collect()} == {(1, 20), (2, 20)}
    assert seen.value == 40
