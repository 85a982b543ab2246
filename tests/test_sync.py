"""What a sync run costs: how often it makes an id or a checksum of a row."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from metafleet.operators import merge, status
from metafleet.plans import sync
from metafleet.plans.registry import DatasetSpec


@pytest.fixture
def counted(spark, monkeypatch):
    """Counts the rows for which a function of a module makes its column."""

    def count(module, name):
        seen, made = spark.sparkContext.accumulator(0), getattr(module, name)

        def same(value):
            seen.add(1)
            return value

        monkeypatch.setattr(module, name, lambda *a, **k: F.udf(same, "long")(made(*a, **k)))
        return seen

    return count


def test_ids_and_checksums_are_made_once_for_a_row(spark, counted):
    """Items, unknown ids, collected scopes and merge read the ids; each of them made them anew, and the gate its checksums twice."""
    ids, sums = counted(merge, "item_id"), counted(status, "row_checksum")
    rows = spark.createDataFrame([(0, s, f"c{k}") for s in (1, 2) for k in range(20)], "instance_id int, database_id int, _ColumnName string")
    spec = DatasetSpec("columns", "database", 720, "complex", True, True, ("_ColumnID",), roles={"_ColumnID": ("database_id", "_ColumnName")}, defines="_ColumnID", refers={"_ColumnID": "_ColumnID"})
    scopes = spark.createDataFrame([(0, 1), (0, 2)], "instance_id int, database_id int")
    none = spark.createDataFrame([], "instance_id int, database_id int, _ColumnID long, _ColumnName string")
    items = spark.createDataFrame([], "_ColumnID long, database_id int, _ColumnName string, is_deleted boolean, delete_date timestamp_ntz")
    known = spark.createDataFrame([], "instance_id int, database_id int, dataset_id int, checksum long, last_sync timestamp_ntz, last_check timestamp_ntz, last_error timestamp_ntz, error_message string")
    matrix = scopes.selectExpr("*", "1 AS dataset_id", "720 AS minutes", "cast(null AS bigint) AS checksum", "cast(null AS timestamp_ntz) AS last_check")
    source = sync.Source(merge.first_load(none, sync.SCOPE["database"], ["_ColumnID"], F.lit(datetime(2024, 1, 1))), rows, scopes, items=items)
    run = sync.sync_run([spec], matrix, known, {"columns": source}, F.lit(datetime(2024, 1, 2)))
    assert run.tables["columns"].count() == 40 == run.items["_ColumnID"].count()
    assert (ids.value, sums.value) == (40, 40)
