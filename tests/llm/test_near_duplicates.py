import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metafleet.llm import minhash
from metafleet.llm import linededup
from metafleet.llm.components import CENTRES, block_pairs, components, linked_classes, nodes_of, parities, shared_buckets, star_pairs


def brute(rows, shingle, percent):
    """(doc_id, n_shingles, component_id, kept) of every row, from all pairs."""
    sets = []
    for _, t in rows:
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets.append({tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} - {()})
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = group[i], group[j]
                group = [y if g == x else g for g in group]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j, g in enumerate(group) if g == group[k] and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids, default=None), i == min(ids, default=None)))
    return sorted(out, key=str)


def found(docs, **options):
    return sorted((tuple(r) for r in minhash.near_duplicates(docs, **options).collect()), key=str)


def variants(prose, seed):
    r = random.Random(seed)
    out = []
    for k in range(6):
        base = prose(seed * 100 + k, r.choice([3, 5, 9, 40, 150])).split()
        out.append(" ".join(base))
        for edits in (0, 1, 2, 5, 12):
            w = list(base)
            for _ in range(edits):
                w[r.randrange(len(w))] = f"x{r.randrange(99)}"
            out.append(" ".join(w).upper() if edits == 0 else "\n ".join(w))
    r.shuffle(out)
    return [(i, t) for i, t in zip(r.sample(range(1000), len(out)), out)]


def test_against_brute_force(docs_of, prose):
    for seed, (shingle, percent) in enumerate([(4, 80), (5, 80)]):
        rows = variants(prose, seed + 1)
        assert found(docs_of(rows), shingle=shingle, percent=percent) == brute(rows, shingle, percent)


def test_chain_through_other_members(docs_of):
    """A link between two members of a bucket that are both unlike its least node isn't lost."""
    base = [f"a{k}" for k in range(200)]
    far, near = list(base), None
    for k in range(0, 200, 30):
        far[k] = f"b{k}"
    near = list(far)
    near[101] = "c"
    rows = [(1, " ".join(base)), (2, " ".join(far)), (3, " ".join(near))]
    assert found(docs_of(rows), shingle=4) == brute(rows, 4, 80)


def test_odd_rows(docs_of, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert found(docs_of(odd_rows), shingle=4) == brute(rows, 4, 80)
    assert found(docs_of([])) == []
    df = docs_of(odd_rows).withColumns({c: F.lit(1) for c in ("node", "bucket", "bands", "sketch", "own", "root", "least")})
    assert found(df, shingle=4) == brute(rows, 4, 80)


def test_equal_ids_with_different_texts(docs_of, prose):
    rows = [(1, prose(1)), (1, prose(2)), (2, prose(2) + " tail")]
    assert found(docs_of(rows)) == brute(rows, 5, 80)


def test_signature_agrees_with_similarity():
    r = np.random.default_rng(3)
    for n in (3, 20, 2000):
        both, a, b = (r.integers(0, 1 << 63, k, np.uint64) * np.uint64(2) for k in (n * 8, n, n))
        doc = np.repeat([0, 1], n * 9)
        hashes = np.concatenate([np.sort(np.concatenate([both, a])), np.sort(np.concatenate([both, b]))])
        sign = minhash.signatures(doc, hashes, 2)
        assert abs((sign[0] == sign[1]).mean() - 0.8) < 0.2 if n == 3 else abs((sign[0] == sign[1]).mean() - 0.8) < 0.12


def test_one_shingle_fills_all_bins():
    sign = minhash.signatures(np.array([0, 2]), np.array([5, 1 << 63], np.uint64), 3)
    assert set(sign[0].tolist()) == {5} and set(sign[2].tolist()) == {1 << 63} and len(set(sign[1].tolist())) == 1


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=12))
def test_components(spark, edges):
    group = {v: v for e in edges for v in e}
    for a, b in edges * len(edges):
        group[a] = group[b] = min(group[a], group[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: g for v, g in group.items() if any(a != b and v in (a, b) for a, b in edges)}


def test_star_pairs_are_linear(spark):
    rest = spark.createDataFrame([(1, k, 0 if k < 9 else k, 0) for k in range(50)], "bucket long, node long, root long, lo long")
    pairs = star_pairs(rest, 0).collect()
    assert sorted(p.a for p in pairs) == list(range(9, 50)) and len({p.b for p in pairs}) == 1 and pairs[0].b < 9


def test_star_pairs_take_few_centres(spark):
    """Twelve buckets with a centre each don't make twelve pairs of a member; what most of its buckets have is among its centres."""
    rows = [(k, 1000 + (k % 9 if k < 9 else 4), 0, 0) for k in range(12)] + [(k, a, a, 0) for k in range(12) for a in range(1, 30)]
    pairs = star_pairs(spark.createDataFrame(rows, "bucket long, node long, root long, lo long"), 0).collect()
    assert {p.a for p in pairs} == set(range(1, 30)) == {p.a for p in pairs if p.b == 1004}
    assert len(pairs) == len({(p.a, p.b) for p in pairs}) == 29 * CENTRES


def sets_of(seed, n=40):
    """Sets with a core each, in groups that share much or little."""
    r = random.Random(seed)
    cores = [[r.getrandbits(63) for _ in range(60)] for _ in range(4)]
    return {k: set(r.sample(cores[k % 4], r.randrange(45, 60)) + [r.getrandbits(63) for _ in range(r.randrange(12))]) for k in range(n)}


def test_bit_tables_never_rule_out_a_link(spark):
    sets = sets_of(3)
    rows = [(k, h) for k, x in sets.items() for h in x]
    sketches = spark.createDataFrame(rows, "node long, h long").groupBy("node").agg(*parities(minhash.WORDS))
    members = spark.createDataFrame([(k % 2, k, k) for k in sets], "bucket long, node long, root long")
    got = {(p.a, p.b) for p in block_pairs(members, sketches, minhash.WORDS, 80).collect()}
    held = minhash.held_apart(members, sketches, 80).collect()
    assert got == {(p.a, p.b) for p in held} and len(held) == len(got)
    same = {(a, b) for a in sets for b in sets if a < b and (a - b) % 2 == 0}
    links = {(a, b) for a, b in same if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert links and links <= got and len(got) < len(same) / 2


def test_blocks_meet(spark, monkeypatch):
    """Every two members of a bucket meet, also those of different blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 7)
    sets = {k: {1, 2, 3} for k in range(30)}
    sketches = spark.createDataFrame([(k, h) for k, x in sets.items() for h in x], "node long, h long").groupBy("node").agg(*parities(minhash.WORDS))
    members = spark.createDataFrame([(1, k, k) for k in sets], "bucket long, node long, root long")
    assert minhash.held_apart(members, sketches, 80).count() == 30 * 29 // 2


def test_group_of_near_copies(docs_of):
    """Hundreds of copies with edits of their own, most of them unlike the bucket's centre."""
    r, base = random.Random(8), [f"a{k}" for k in range(120)]
    rows = []
    for i in range(260):
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
            w[r.randrange(len(w))] = f"b{r.randrange(9)}"
        rows.append((i, " ".join(w)))
    assert found(docs_of(rows), shingle=4) == brute(rows, 4, 80)
    # The same as lines: one line of each component stays.
    want = {}
    for i, _, root, _ in brute(rows, 4, 80):
        want.setdefault(root, []).append(i)
    assert linededup.dropped_lines(docs_of(rows)).where("n_dropped = 0").count() <= len(want)


@pytest.mark.parametrize("shared, more, most", [(4, 1, 0.004), (8, 2, 0.001), (32, 8, 0.001), (160, 40, 0.001)])
def test_pairs_at_the_threshold_share_a_band(shared, more, most):
    """Pairs of sets at a similarity of exactly 0.8: the share that no bucket has both of."""
    rng, pairs = np.random.default_rng(shared), 4000
    hashes = rng.integers(0, 1 << 64, (pairs, shared + more), dtype=np.uint64)
    sides = []
    for n in (shared, shared + more):
        doc = np.repeat(np.arange(pairs), n)
        flat = hashes[:, :n].ravel()
        order = np.lexsort((flat, doc))
        sides.append(minhash.band_keys(minhash.signatures(doc[order], flat[order], pairs)))
    missed = 1 - (sides[0] == sides[1]).any(axis=1).mean()
    assert missed <= most, missed


def test_a_pair_leaves_one_row_whatever_it_shares(spark):
    """Two members of many buckets are one row of the join itself, not one for each bucket that goes later."""
    members = spark.createDataFrame([(b, n, n) for b in range(12) for n in range(20)], "bucket long, node long, root long")
    sets = spark.createDataFrame([(n, h) for n in range(20) for h in range(30)], "node long, h long").groupBy("node").agg(*parities(minhash.WORDS))
    pairs = block_pairs(members, sets, minhash.WORDS, 80)
    assert sorted((p.a, p.b) for p in pairs.collect()) == [(a, b) for a in range(20) for b in range(a + 1, 20)]
    assert "Aggregate [a#" not in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_the_smallest_set_is_a_centre_by_turns(spark):
    """Lines around one passage are held against the shortest of them, whatever class has the least root."""
    members = spark.createDataFrame([(1, n, n, 0) for n in range(9)], "bucket long, node long, root long, lo long")
    sizes = spark.createDataFrame([(n, 90 if n != 5 else 40) for n in range(9)], "node long, n long")
    assert {(p.a, p.b) for p in star_pairs(members, 1, sizes).collect()} == {(n, 5) for n in range(9) if n != 5}


def test_small_buckets_are_pairs(spark):
    """Buckets of two and three nodes leave as their pairs, only larger ones as members; a lone node is no candidate."""
    held = {1: [7, -9], 2: [5, 3, -4], 3: [3, 5], 4: [8], 5: [1, 2, 3, 4]}
    pairs, members = shared_buckets(spark.createDataFrame([(b, n) for b, nodes in held.items() for n in nodes], "bucket long, node long"))
    assert sorted(tuple(p) for p in pairs.collect()) == [(-9, 7), (-4, 3), (-4, 5), (3, 5)]
    assert sorted(tuple(m) for m in members.collect()) == [(5, n, 1) for n in (1, 2, 3, 4)]
    assert sorted(r.node for r in nodes_of(pairs, members).collect()) == [-9, -4, 1, 2, 3, 4, 5, 7]


def test_small_buckets_take_one_round(spark):
    """Pairs are confirmed at once, and few pairs that blocks leave too: each round costs a row of Spark jobs."""
    buckets = [(k, n) for k in range(20) for n in (2 * k, 2 * k + 1)]
    rounds = []

    def confirm(pairs):
        rounds.append(sorted(tuple(p) for p in pairs.collect()))
        return pairs.where("a % 4 = 0 and b = a + 1")

    def sketches(nodes):
        sets = nodes.select("node", F.explode(F.array(*(F.lit(k).cast("long") for k in range(30)))).alias("h"))
        return sets.groupBy("node").agg(*parities(minhash.WORDS))

    pairs, members = shared_buckets(spark.createDataFrame(buckets, "bucket long, node long"))
    roots = {r.node: r.root for r in linked_classes(pairs, members, sketches, confirm, minhash.WORDS, 80).collect()}
    assert rounds == [[(2 * k, 2 * k + 1) for k in range(20)]] and roots == {n: n - n % 4 for k in range(0, 20, 2) for n in (2 * k, 2 * k + 1)}
    rounds.clear()
    # Unlike members of a larger bucket: every two of them are held against each other once, in stars and one more round.
    pairs, members = shared_buckets(spark.createDataFrame([(99, n) for n in range(2, 40, 4)], "bucket long, node long"))
    assert linked_classes(pairs, members, sketches, confirm, minhash.WORDS, 80).count() == 0
    seen = [p for some in rounds for p in some]
    assert len(seen) == len(set(seen)) == 10 * 9 // 2 and len(rounds) <= 4
