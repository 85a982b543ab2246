import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from metafleet.llm import manifest


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """All levels of digests over leaves, by the definition."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, at):
    out = []
    for nodes in levels[:-1]:
        first = at - at % 8
        out.append((nodes[first : first + 8], at % 8))
        at //= 8
    return out


def leaf_of(r, lower=False):
    text = r["text"]
    if lower and text is not None:
        text = text.encode().lower().decode()
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*map(part, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r), r))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: tree([x[2] for x in sorted(langs[k], key=lambda x: x[:3])]) for k in order}
    top = tree([trees[k][-1][0] for k in order])
    out = []
    for place, k in enumerate(order):
        for at, (_, _, leaf, r) in enumerate(sorted(langs[k], key=lambda x: x[:3])):
            steps = siblings(trees[k], at) + siblings(top, place)
            proof = H(*(d for run, own in steps for j, d in enumerate(run) if j != own))
            fold = leaf_of(r, r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0)
            for run, own in steps:
                fold = H(*run[:own], fold, *run[own + 1 :])
            out.append((r["doc_id"], leaf, trees[k][-1][0], top[-1][0], proof, fold, fold == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(docs):
    return sorted((tuple(r) for r in manifest.manifest(docs).select(*COLUMNS).collect()), key=str)


def rows_of(docs):
    return [r.asDict() for r in docs.collect()]


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    assert found(docs) == brute(rows_of(docs))


@pytest.mark.parametrize("n", [1, 9, 600])
def test_sizes(docs_of, n):
    docs = docs_of([(k * 7 % 1009, f"Text {k}", ["en", "de", None, "É"][k * k % 4], "s", k) for k in range(n)], 3)
    assert found(docs) == brute(rows_of(docs))


def test_many_blocks_and_a_hot_language(spark, docs_of, monkeypatch):
    monkeypatch.setattr(manifest, "DEPTH", 1)
    monkeypatch.setattr(manifest, "BLOCK", 8)
    docs = docs_of([(k, f"Text {k}", "en" if k % 3 else f"l{k % 60}", "s", k) for k in range(700)], 3)
    assert found(docs) == brute(rows_of(docs))


def test_repeated_rows_have_proofs_of_their_own(docs_of):
    docs = docs_of([(1, "Same", "en", "s", 4)] * 20 + [(None, None, None, None, None)] * 9)
    assert found(docs) == brute(rows_of(docs))


def test_empty_and_clashing_columns(docs_of):
    docs = docs_of([(1, "A", "en", "s", 1), (2, "b", "de", "s", 1)])
    assert manifest.manifest(docs.where("doc_id > 9")).count() == 0
    more = docs.withColumns({c: F.lit(7) for c in ("key", "at", "n", "leaf", "digest", "seq", "range", "block", "third", "proof")})
    assert found(more) == found(docs)


def test_sweep_keeps_a_small_heap():
    digests = [sha256(str(k).encode()).digest() for k in range(4096)]
    assert len(list(manifest.sweep(digests, 4))) == 512 + 64 + 8 + 1
    # Labels never go down.
    labels = [min((place + 1) * 8**level - 1, 4095) * 8 + level for level, place, _, _ in manifest.sweep(digests, 4)]
    assert labels == sorted(labels)
