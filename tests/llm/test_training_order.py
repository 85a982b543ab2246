import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from metafleet.llm import training_order as to


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    out = to.permute(np.arange(n), n, 7)
    assert sorted(out.tolist()) == list(range(n))
    if n > 100:
        assert (out != to.permute(np.arange(n), n, 8)).any()
        assert abs(np.corrcoef(np.arange(n), out)[0, 1]) < 0.15


def expected(rows, length):
    out = []
    for i, t in rows:
        ids = [*(t or "").encode(), to.END]
        out += [(i, k // length, ids[k : k + length]) for k in range(0, len(ids), length)]
    return out


def test_sequences_and_files(spark, docs_of, odd_rows, tmp_path):
    docs = docs_of(odd_rows)
    ordered = to.training_order(to.byte_ids(docs), length=64, shard_bytes=64 * 50)
    rows = ordered.collect()
    want = expected([(r[0], r[1]) for r in odd_rows], 64)
    got = [(r.doc_id, r.seq_no, np.frombuffer(r.ids, "<u1")[: r.n_tokens].tolist()) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sorted(r.slot for r in rows) == list(range(len(want)))
    assert all(r.shard == r.slot // 50 and r.byte_offset == r.slot % 50 * 64 and len(r.ids) == 64 for r in rows)
    path = f"file://{tmp_path}/shards"
    written = to.write_shards(ordered, path).collect()
    by_slot = {r.slot: r.ids for r in rows}
    assert sorted((r.slot, r.ids_crc32) for r in written) == sorted((k, zlib.crc32(x)) for k, x in by_slot.items())
    assert sorted(tuple(r)[:6] for r in written if r.doc_id is not None) == sorted(tuple(r)[:6] for r in rows if r.doc_id is not None)
    assert not [f for f in (tmp_path / "shards").iterdir() if f.name.startswith(".") and not f.name.endswith(".crc")]
    for slot, n in ((0, 3), (48, 5), (len(want) - 2, 10)):
        read = to.read_slots(path, slot, n, 64, 64 * 50)
        assert [x.tobytes() for x in read] == [by_slot[s] for s in range(slot, min(slot + n, len(want)))]


def test_same_key_same_order(docs_of, prose):
    docs = docs_of([prose(k) for k in range(20)], partitions=3)
    run = lambda key: {(r.doc_id, r.seq_no): r.slot for r in to.training_order(to.byte_ids(docs), key, 32).collect()}
    assert run(1) == run(1) != run(2)


def test_empty(docs_of, spark):
    assert to.training_order(to.byte_ids(docs_of([]))).count() == 0
    assert to.training_order(spark.createDataFrame([(1, None)], "doc_id long, ids binary")).count() == 0


def test_extra_columns(docs_of):
    df = docs_of(["abc", "de"]).withColumns({c: F.lit(1) for c in ("ids", "slot", "shard", "seq_no")})
    assert to.training_order(to.byte_ids(df), length=2).count() == 4


def test_wider_ids(spark, tmp_path):
    ids = [np.arange(k * 1000, k * 1000 + 37, dtype="<u4").tobytes() for k in range(9)]
    tokens = spark.createDataFrame([(k, bytearray(x)) for k, x in enumerate(ids)], "doc_id long, ids binary")
    ordered = to.training_order(tokens, length=10, shard_bytes=160, width=4, fill=7)
    path = f"file://{tmp_path}/wide"
    slots = {(r.doc_id, r.seq_no): r.slot for r in to.write_shards(ordered, path).collect()}
    assert to.read_slots(path, slots[3, 1], 1, 10, 160, 4)[0].tolist() == list(range(3010, 3020))
    assert to.read_slots(path, slots[8, 3], 1, 10, 160, 4)[0].tolist() == [*range(8030, 8037), 7, 7, 7]


def test_changed_partitions_fail(spark):
    """Rows that come in another order at the second read stop the run, even if the counts are the same."""
    tokens = spark.range(40).repartition(1).selectExpr("id AS doc_id", "cast('ab' AS binary) AS ids")
    ordered = to.training_order(tokens, length=4)
    assert ordered.count() == 40
    # A non-deterministic column has other values at each read.
    import pyspark.sql.types as T

    clock = F.udf(lambda i: __import__("time").time_ns(), T.LongType()).asNondeterministic()
    with pytest.raises(Exception, match="changed between two reads"):
        to.training_order(tokens.withColumn("doc_id", clock("doc_id")), length=4).count()


def test_sequences_move_packed(spark, docs_of, prose):
    """What is dealt to the shards is well below the text; it was the sequences as they are, filled up."""
    files = lambda: {f: f.stat().st_size for f in Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data")}
    docs = docs_of([prose(k, 3000) for k in range(40)]).localCheckpoint()
    ordered, before = to.training_order(to.byte_ids(docs)), files()
    assert len(ordered.collect()) > 40
    moved = sum(n for f, n in files().items() if f not in before)
    assert 0 < moved < 0.5 * sum(len(r.text) for r in docs.collect())
