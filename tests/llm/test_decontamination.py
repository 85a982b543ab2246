import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metafleet.llm import decontamination as d


def brute(item, doc, least):
    """Greedy string tiling by definition: the longest unmarked match, earliest first, until none is long enough."""
    mi, md, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for q in range(len(doc)):
                n = 0
                while p + n < len(item) and q + n < len(doc) and item[p + n] == doc[q + n] and not mi[p + n] and not md[q + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < least:
            return tiles
        mi[p : p + n], md[q : q + n] = [True] * n, [True] * n
        tiles.append((p, q, n))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=18), st.integers(1, 4))
def test_tiling(item, doc, least):
    a, b = np.array(item, np.uint64) * np.uint64(1 << 40) + np.uint64(1 << 50), np.array(doc, np.uint64) * np.uint64(1 << 40) + np.uint64(1 << 50)
    assert sorted(d.tile(a, b, least)) == sorted(brute(item, doc, least))


def words(seed, n):
    r = random.Random(seed)
    return [f"t{r.randrange(2000)}" for _ in range(n)]


def bench_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_leaks(spark, docs_of):
    item = words(1, 40)
    parts = [item[k : k + 8] for k in range(0, 40, 8)]
    moved = [w for p in (parts[3], parts[0], parts[4], parts[2], parts[1]) for w in [*p, "gap", "gap2"]]
    texts = [
        " ".join(words(2, 50) + item + words(3, 50)), " ".join(words(4, 60) + moved + words(5, 60)), " ".join(words(6, 50) + item[:9] + words(7, 50)), " ".join(words(8, 90)),
        " ".join(words(9, 20) + item).upper().replace(" ", ",  "), " ".join(item[:19]), None, "",
    ]
    got = {r.doc_id: r for r in d.leaks(docs_of(texts), bench_of(spark, [(7, " ".join(item)), (8, None), (9, "too short"), (10, "")])).collect()}
    assert set(got) == {0, 1, 4} and {r.item_id for r in got.values()} == {7}
    assert (got[0].coverage, got[0].tiles, got[1].coverage, got[1].tiles) == (1.0, 1, 1.0, 5)


def test_seeds_do_not_span_texts_or_runs(spark, docs_of):
    item = words(1, 8)
    rows = [" ".join(item[:2]), " ".join(item[2:4]), " ".join([*item[:3], "x", *item[3:6], "y", *item[6:]])]
    assert d.leaks(docs_of(rows, 1), bench_of(spark, [(1, " ".join(item))])).count() == 0


def test_odd_rows(spark, docs_of, odd_rows):
    bench = bench_of(spark, [(1, "a text without an id but with words in it"), (1, "a text without an id but with words in it"), (2, "A plain text of a few words, to begin with.")])
    got = sorted(((r.doc_id, r.item_id) for r in d.leaks(docs_of(odd_rows), bench).collect()), key=str)
    assert got == [(1, 2), (None, 1)]
    assert d.leaks(docs_of([]), bench).count() == 0 and d.leaks(docs_of(odd_rows), bench.limit(0)).count() == 0
    df = docs_of(odd_rows).withColumns({c: F.lit(1) for c in ("tokens", "item_id", "row", "seed", "cut", "text_key")})
    assert d.leaks(df, bench).count() == 2


def test_leaks_equal_brute_force(spark, docs_of):
    """Every document against every item: tiles of the whole token lists, by the definition."""
    r = random.Random(5)
    vocabulary = [f"v{k}" for k in range(40)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randrange(4, 24)))) for k in range(8)]
    rows = []
    for k in range(200):
        text = [r.choice(vocabulary) for _ in range(r.randrange(0, 40))]
        for _ in range(r.randrange(3)):
            whole = r.choice(items)[1].split()
            cuts = sorted(r.sample(range(len(whole) + 1), 2))
            at = r.randrange(len(text) + 1)
            text[at:at] = whole[cuts[0] : cuts[1]]
        rows.append((k, r.choice([" ", ", ", "\n"]).join(text)))
    want = set()
    for doc_id, text in rows:
        tokens = text.replace(",", " ").split()
        for item_id, item in items:
            tiles = brute(item.split(), tokens, d.SEED)
            matched = sum(n for _, _, n in tiles)
            if matched >= d.COVERAGE * len(item.split()):
                want.add((doc_id, item_id, matched, len(item.split()), len(tiles)))
    got = {(x.doc_id, x.item_id, x.matched, x.item_tokens, x.tiles) for x in d.leaks(docs_of(rows), bench_of(spark, items)).collect()}
    assert not got ^ want, (len(got), len(want), sorted(got - want)[:5], sorted(want - got)[:5])
    assert len(want) > 20
