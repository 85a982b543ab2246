import pytest
from pyspark.sql import functions as F

from metafleet.functions import keys as K
from metafleet.operators.merge import with_parents
from metafleet.plans.exports import EXPORTS, Catalog
from metafleet.plans.registry import DATASETS
from metafleet.plans.schemas import SCHEMAS, Schema, versioned


def test_declared_columns_follow_the_scope_version(spark):
    schema = Schema("a int, b string", ((15, "c boolean"), (16, "d int")))
    assert schema.struct().simpleString() == "struct<a:int,b:string,c:boolean,d:int>" and schema.since() == {"c": 15, "d": 16}
    rows = spark.createDataFrame([(1, 14, "1", True, 5), (2, 15, "2", True, 5), (3, 16, "3", True, 5)], "s int, version int, a string, c boolean, d int")
    got = versioned(rows, schema, F.col("version"), ["s", "version"])
    # One pass over scopes of all versions; absent columns are typed nulls.
    assert [tuple(r) for r in got.orderBy("s").collect()] == [(1, 14, 1, None, None, None), (2, 15, 2, None, True, None), (3, 16, 3, None, True, 5)]
    with pytest.raises(ValueError, match="e, f"):
        versioned(rows.withColumns({"f": F.lit(1), "e": F.lit(1)}), schema, F.col("version"), ["s", "version"])


def test_every_export_has_a_schema():
    assert set(EXPORTS) <= set(SCHEMAS)
    for name, spec in EXPORTS.items():
        fields = SCHEMAS[name].struct().fieldNames()
        assert len(set(fields)) == len(fields)
        assert {right for look in spec.lookups for right in look.on.values()} <= set(fields), name


@pytest.fixture
def catalog(spark):
    def make(version, indexes=((1, 10, 1, "ix", 1, True), (2, 10, 1, "other", 0, None))):
        frame = spark.createDataFrame
        tables = {
            "schemas": frame([(s, 1, "dbo") for s in (1, 2)], "_DatabaseID int, schema_id int, name string"),
            "objects": frame([(1, 10, "t", 1, "U", False), (2, 10, "u", 1, "U", False), (1, 11, "sys", 1, "U", True)], "_DatabaseID int, object_id int, name string, schema_id int, type string, is_ms_shipped boolean"),
            "indexes": frame(list(indexes), "_DatabaseID int, object_id int, index_id int, name string, type int, optimize_for_sequential_key boolean"),
        }
        return Catalog(tables, frame([(1, version), (2, 14)], "_DatabaseID int, version int"))

    return make


def test_names_come_from_the_own_scope(catalog):
    """Both databases have an object 10; each index gets its own, and a heap's name is the sentinel."""
    rows = {r._DatabaseID: r for r in catalog(14).export("indexes").collect()}
    assert (rows[1]._SchemaName, rows[1]._ObjectName, rows[1]._IndexName) == ("dbo", "t", "ix")
    assert (rows[2]._ObjectName, rows[2]._IndexName) == ("u", K.HEAP)


def test_an_upgrade_alone_changes_no_hash(catalog):
    hashes = lambda c: {r._DatabaseID: r._RowHash for r in c.export("indexes").collect()}
    before = hashes(catalog(14))
    unset = [(1, 10, 1, "ix", 1, None), (2, 10, 1, "other", 0, None)]
    assert hashes(catalog(15, unset)) == before
    # The new version's column has a value: now the row differs, and only that of the scope that was upgraded.
    after = hashes(catalog(15))
    assert after[1] != before[1] and after[2] == before[2]


def test_system_objects_name_nothing(catalog):
    assert catalog(15, [(1, 11, 1, "ix", 1, None)]).export("indexes").count() == 0


def test_ids_come_with_the_lookups(spark):
    """What a lookup brings along are the ids that a row's own names make; of two databases with the same object ids as well."""
    frame = spark.createDataFrame
    tables = {
        "schemas": frame([(s, 1, "dbo") for s in (1, 2)], "_DatabaseID int, schema_id int, name string"),
        "objects": frame([(1, 10, "T ", 1, "U", False), (2, 10, "u", 1, "U", False), (1, 11, "sys", 1, "U", True)], "_DatabaseID int, object_id int, name string, schema_id int, type string, is_ms_shipped boolean"),
        "indexes": frame([(1, 10, 1, "IX", 1), (2, 10, 1, "heap", 0), (1, 11, 1, "x", 1)], "_DatabaseID int, object_id int, index_id int, name string, type int"),
        "columns": frame([(s, o, k, f"C{k}") for s, o in ((1, 10), (2, 10), (1, 11)) for k in (1, 2)], "_DatabaseID int, object_id int, column_id int, name string"),
        "index_columns": frame([(s, o, 1, k, k) for s, o in ((1, 10), (2, 10), (1, 11)) for k in (1, 2)], "_DatabaseID int, object_id int, index_id int, index_column_id int, column_id int"),
        "foreign_keys": frame([(1, "fk", 20, 1, 10, "F", 10, 1, False)], "_DatabaseID int, name string, object_id int, schema_id int, parent_object_id int, type string, referenced_object_id int, key_index_id int, is_ms_shipped boolean"),
    }
    plain = Catalog(tables, frame([(1, 15), (2, 14)], "_DatabaseID int, version int"))
    found = {"index_columns": {"_ObjectID", "_IndexID", "_ColumnID"}, "foreign_keys": {"_ParentObjectID", "_ReferencedObjectID"}}
    catalog = plain.with_ids()
    for dataset, ids in found.items():
        roles = {role: names for spec in DATASETS if spec.name == dataset for role, names in spec.roles.items() if role in ids}
        rows, want = (c.export(dataset).withColumns({"database_id": F.col("_DatabaseID"), "_IndexKind": F.lit("index")}) for c in (catalog, plain))
        assert ids <= set(rows.columns) and not ids & set(want.columns)
        columns = [*want.columns, *sorted(ids)]
        assert sorted(map(repr, rows.select(columns).collect())) == sorted(map(repr, with_parents(want, roles).select(columns).collect()))


def test_variants_keep_their_types(spark):
    rows = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, '{"a": "7", "b": {"c": 2.5}}'), (3, "no json"), (4, None)], "k int, v string")
    kept = K.as_variant(rows, ["v"])
    got = K.variant_fields(kept, "v", {"a": "int", "c": "double"}, {"c": "$.b.c"}).orderBy("k")
    assert [(r.a, r.c) for r in got.select("a", "c").collect()] == [(1, None), (7, 2.5), (None, None), (None, None)]
    kinds = kept.orderBy("k").select(F.schema_of_variant(F.try_variant_get("v", "$.a", "variant")).alias("t")).collect()
    assert [r.t for r in kinds] == ["BIGINT", "STRING", None, None]
