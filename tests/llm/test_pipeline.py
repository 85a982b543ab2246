import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")

import random  # noqa: E402
import re  # noqa: E402
from pathlib import Path  # noqa: E402

import test_lines  # noqa: E402
import test_near_duplicates  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from metafleet.llm.shared import shared_dir, written  # noqa: E402


def test_stages(spark, docs_of, prose, tmp_path):
    item = " ".join(f"bench{k}" for k in range(30))
    shared = "this very line stands in more than one document of the corpus"
    base = prose(1, 120)
    rows = [(1, base), (2, base + " tail"), (3, prose(3, 60) + "\n" + shared), (4, shared + "\n" + prose(4, 60)), (5, "123 ..."), (6, None), (7, prose(7, 40) + " " + item), (8, prose(8, 50)), (None, prose(9, 50))]
    docs_of(rows).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"file://{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, f"file://{tmp_path}")
        if name != "bpe":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        out.write.parquet(f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name}")
        kept.append({r.doc_id: r for r in docs.collect()})
    assert set(kept[0]) == {1, 2, 3, 4, 7, 8, None}
    assert set(kept[1]) == set(kept[0]) and shared in kept[1][3].text and shared not in kept[1][4].text and kept[1][4].n_chars == len(kept[1][4].text)
    assert set(kept[2]) == set(kept[1])  # the copy's only line went before
    assert set(kept[3]) == {1, 2, 3, 4, 8, None}
    assert set(kept[4]) == set(kept[3]) and kept[4][8].n_tokens > 0
    whole = {r.doc_id: r.decoded for r in corpus_pipeline.run(spark, f"file://{tmp_path}").collect()}
    assert whole == {i: r.decoded for i, r in kept[4].items()}


def test_stages_leave_little(spark, docs_of, prose):
    """Of a stage's own tables only the rows and the verdict stay, and no file of its shuffles."""
    folder, local = (Path(x.removeprefix("file:")) for x in (shared_dir(spark), spark.conf.get("spark.local.dir")))
    shuffled = lambda: set(local.rglob("shuffle_*.data"))
    text = prose(1, 100)
    docs = docs_of([(4, text), (2, text + " x"), (9, prose(2, 50) + "\n" + text)]).localCheckpoint()
    for stage, names in ((corpus_pipeline.line_stage, {"drops"}), (corpus_pipeline.near_duplicate_stage, {"rows", "components"})):
        tables = set(folder.iterdir())
        stage(spark, docs, "")
        left = {p.name.rpartition("-")[0] for p in set(folder.iterdir()) - tables}
        assert left == names
    moved = docs.groupBy("lang").count().repartition(3, "count")
    files = shuffled()
    written(moved, "moved")
    assert shuffled() <= files


def test_near_duplicates_keep_one(spark, docs_of, prose, tmp_path):
    text = prose(1, 100)
    rows = [(4, text), (2, text + " x"), (9, prose(2, 50)), (None, None), (11, "")]
    out = corpus_pipeline.near_duplicate_stage(spark, docs_of(rows), "")
    assert {r.doc_id for r in out.collect()} == {2, 9, None, 11}


def test_null_and_repeated_ids(spark, docs_of, prose, tmp_path):
    item = " ".join(f"bench{k}" for k in range(30))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    texts = lambda out: sorted(r.text for r in out.collect())
    copy, one, two = prose(1, 100), prose(2, 60), prose(3, 60)
    rows = [(1, copy), (None, copy + " x"), (None, one), (7, copy + " y"), (7, two), (8, prose(4, 50)), (8, prose(4, 50))]
    assert texts(corpus_pipeline.near_duplicate_stage(spark, docs_of(rows), "")) == sorted([copy, one, two, prose(4, 50)])
    rows = [(None, item), (None, one), (7, two), (7, prose(5, 40) + " " + item)]
    assert texts(corpus_pipeline.decontamination_stage(spark, docs_of(rows), f"file://{tmp_path}")) == sorted([one, two])
    rows = [(None, one), (None, one + "\n" + two), (7, prose(5, 40) + "\n" + one), (7, prose(6, 40) + "\n" + prose(7, 40))]
    got = texts(corpus_pipeline.line_stage(spark, docs_of(rows), ""))
    assert sorted(x for t in got for x in t.split("\n") if x) == sorted([one, two, prose(5, 40), prose(6, 40), prose(7, 40)])


def test_empty(spark, docs_of, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, f"file://{tmp_path}")
        assert docs.count() == 0


def tiled(item, text):
    """The share of the item's tokens that greedy tiles of four tokens or more cover."""
    a, b = (re.findall(r"[a-z0-9]+", x.lower()) for x in (item, text))
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    for n in range(len(a), 3, -1):
        for i in range(len(a) - n + 1):
            for j in range(len(b) - n + 1):
                if all(free_a[i : i + n]) and all(free_b[j : j + n]) and a[i : i + n] == b[j : j + n]:
                    free_a[i : i + n] = free_b[j : j + n] = [False] * n
                    covered += n
    return covered / len(a) if a else 0


def brute(rows, items):
    """What the five stages leave of rows (id, text): sorted (id, text) after each of the first four."""
    out = [[r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]]
    drop = {}
    keyed = [(i if i is not None else -1, t) for i, t in out[-1]]
    # Ids are unique here but for equal rows, and null ids come first.
    drop = test_lines.brute(sorted(set(keyed)))
    out.append([(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop.get(i if i is not None else -1, ()))) for i, t in out[-1]])
    order = sorted(out[-1], key=lambda r: (r[0] is None, r[0] or 0))
    groups = test_near_duplicates.brute([(k, t) for k, (_, t) in enumerate(order)], 5, 80)
    out.append([order[k] for k, _, _, kept in groups if kept])
    out.append([r for r in out[-1] if not any(tiled(x, r[1]) >= 0.5 for x in items)])
    return [sorted(x, key=str) for x in out]


def test_against_brute_force(spark, docs_of, prose, tmp_path):
    r = random.Random(3)
    items = [" ".join(f"bench{k}x{j}" for j in range(24)) for k in range(3)]
    shared = [" ".join(f"line{k}w{j}" for j in range(14)) for k in range(4)]
    rows = [(None, "a text whose id nobody knows, " + prose(99, 30)), (50, prose(50, 70)), (50, prose(50, 70)), (51, ""), (52, None), (53, "12 ... 34")]
    for i in range(26):
        w = prose(i % 9, 60).split()
        for _ in range(r.randrange(3)):
            w[r.randrange(60)] = f"edit{r.randrange(50)}"
        lines = [" ".join(w)] + r.sample(shared, r.randrange(3))
        if i % 6 == 0:
            t = r.choice(items).split()
            lines.append(" ".join(t[12:] + ["between"] + t[: r.choice([2, 12])]))
        r.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    docs_of(rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en")).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    docs, want = spark.read.parquet(f"file://{tmp_path}/documents.parquet"), brute(rows, items)
    for (name, stage), left in zip(corpus_pipeline.STAGES[:4], want):
        stage(spark, docs, f"file://{tmp_path}").write.parquet(f"file://{tmp_path}/b-{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/b-{name}")
        assert sorted(((x.doc_id, x.text) for x in docs.collect()), key=str) == left, name
        assert docs.where("lang is null").count() == 0
    their = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coded = [(i, their.encode(t, add_special_tokens=False).ids) for i, t in want[-1]]
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert sorted((str(x.doc_id), x.n_tokens, x.decoded) for x in got) == sorted((str(i), len(e), their.decode(e, skip_special_tokens=False)) for i, e in coded)
    assert len(want[0]) > len(want[2]) > len(want[3])


def test_odd_rows_and_clashing_columns(spark, odd_rows, docs_of, tmp_path):
    spark.createDataFrame([(1, "word7 word8")], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    docs = docs_of(odd_rows).withColumns({c: F.lit("x") for c in ("_row", "_gone", "_mf_id", "_mf_key", "_mf_dropped", "row_key", "node", "component_id", "place", "lang_pred")})
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, f"file://{tmp_path}")
        kept.append(sorted((r.doc_id for r in out.collect()), key=str))
        if name != "bpe":
            assert out.columns == list(corpus_pipeline.COLUMNS)
            docs = out.withColumns({c: F.lit("x") for c in ("_row", "_gone", "_mf_id", "_mf_dropped")})
    # Rows without a letter go first, then the copies of rows 1 and 5.
    assert kept[0] == kept[1] == sorted([1, 1, None, 5, 6, 7, 9], key=str) and kept[2] == kept[4] == sorted([1, None, 5, 6, 7, 9], key=str)
