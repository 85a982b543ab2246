"""Every registered query against DuckDB on the small tables."""

import glob
import os

import duckdb
import pytest

from metafleet.plans.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rows = df.collect()
    if name not in ORACLES:
        assert rows
        return
    found = duck.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    ours = sorted(tuple(str(r[c]) for c in sorted(columns)) for r in rows)
    theirs = sorted(tuple(str(r[columns.index(c)]) for c in sorted(columns)) for r in found.fetchall())
    assert ours == theirs


def test_checksum_beyond_a_long(spark, duck, tmp_path):
    """A scope of so many rows that their sum is no long any more; scopes whose sum is one keep it."""
    spark.range(110_000).selectExpr("id * 10 + 1 AS o_orderkey", "CASE WHEN id < 100000 THEN 8 ELSE id END AS o_custkey", "'O' AS o_orderstatus", "'1-URGENT' AS o_orderpriority", "CAST(id AS DOUBLE) AS o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.scope_id: (r.n_rows, r.checksum) for r in QUERIES["dataset_checksum_sha"](spark, str(tmp_path)).collect()}
    whole = ORACLES["dataset_checksum_sha"].replace("FROM orders", f"FROM '{tmp_path}/orders.parquet/*.parquet'").replace("::BIGINT)::BIGINT", "::BIGINT)::HUGEINT")
    want = {s: (n, total) for s, n, total in duck.execute(whole).fetchall()}
    assert max(t for _, t in want.values()) >= 1 << 63 > min(t for _, t in want.values())
    assert got == {s: (n, t % (1 << 63)) for s, (n, t) in want.items()}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
