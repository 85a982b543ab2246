import numpy as np
from pyspark.sql import functions as F

from metafleet.llm import shuffling as s


def test_fisher_yates():
    for n in (0, 1, 2, 50):
        assert sorted(s.fisher_yates(n, 3).tolist()) == list(range(n))
    first = np.array([s.fisher_yates(4, k)[0] for k in range(4000)])
    assert np.abs(np.bincount(first) / 4000 - 0.25).max() < 0.03


def check(docs, rows, shards, **options):
    got = s.two_pass_shuffle(docs, shards, **options).collect()
    assert sorted((str(r.doc_id), r.text) if r.text is not None else (str(r.doc_id), "") for r in got) == sorted((str(i), t or "") for i, t in rows)
    sizes = [sorted(r.slot for r in got if r.shard == k) for k in range(shards)]
    assert all(x == list(range(len(x))) for x in sizes) and sum(map(len, sizes)) == len(rows)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    return sorted((str(r.doc_id), str(r.text), r.shard, r.slot) for r in got)


def test_shards(docs_of, prose):
    rows = [(k, prose(k, 20)) for k in range(101)]
    a = check(docs_of(rows), rows, 24, bucket_bytes=2000)
    assert a == check(docs_of(rows, 5), rows, 24, bucket_bytes=2000)
    assert a != check(docs_of(rows), rows, 24, bucket_bytes=2000, seed=4)
    order = [int(x[0]) for x in sorted(a, key=lambda x: (x[2], x[3]))]
    assert abs(np.corrcoef(np.arange(101), order)[0, 1]) < 0.35


def test_odd_rows(docs_of, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    check(docs_of(odd_rows), rows, 3)
    check(docs_of([]), [], 3)
    check(docs_of(odd_rows).withColumns({c: F.lit(1) for c in ("shard", "slot", "at", "n")}), rows, 30, bucket_bytes=50)


def test_files(spark, docs_of, prose, tmp_path):
    path, shuffled = f"file://{tmp_path}/out", s.two_pass_shuffle(docs_of([prose(k, 9) for k in range(30)]), 4, bucket_bytes=300)
    s.write_shards(shuffled, path)
    back = s.read_shards(spark, path)
    assert sorted(back.select(*shuffled.columns).collect()) == sorted(shuffled.collect())
    # Every file holds its rows in slot order.
    for f in [r[0] for r in back.selectExpr("input_file_name()").distinct().collect()]:
        slots = [r.slot for r in spark.read.parquet(f).collect()]
        assert slots == sorted(slots)
    s.write_shards(s.two_pass_shuffle(docs_of([]), 4), path + "-none")
    assert s.read_shards(spark, path + "-none").count() == 0


def test_texts_move_once(docs_of, prose):
    plan = s.two_pass_shuffle(docs_of([prose(1)]), 4)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
