import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from metafleet.llm import exchange, interpolation


def tokens(text):
    low = (text or "").encode().lower().decode()
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 10


def bucket(n):
    return n.bit_length()


def counted(texts):
    single, pair, context = Counter(), Counter(), Counter()
    for t in texts:
        single.update(t)
        context.update(["\t", *t[:-1]])
        pair.update(zip(["\t", *t], t))
    return single, pair, context


def estimates(model, t):
    single, pair, context = model
    n = sum(single.values())
    for v, w in zip(["\t", *t], t):
        c = context[v]
        yield bucket(c), pair[v, w] / c if c else 0.0, single[w] / n if n else 0.0


def brute(rows):
    kinds = [(doc_id, tokens(text), fold(doc_id)) for doc_id, text in rows]
    kept = counted([t for _, t, f in kinds if f not in (0, 1)])
    full = counted([t for _, t, f in kinds if f != 0])
    held = [e for _, t, f in kinds if f == 1 for e in estimates(kept, t)]
    new = 1 / (len(kept[0]) + 1)
    weights = {}
    for b in {-1, *(e[0] for e in held)}:
        p = np.array([[e[1], e[2], new] for e in held if b in (-1, e[0])]).reshape(-1, 3)
        w = np.full(3, 1 / 3)
        for _ in range(300):
            share = (p * w / (p @ w)[:, None]).sum(axis=0) + 0.5
            w = share / share.sum()
        weights[b] = w
    n, v = sum(full[0].values()), len(full[0])
    out = []
    for doc_id, t, f in kinds:
        base = sum(math.log10((full[0][w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = 0.0
        for b, pair, single in estimates(full, t):
            w = weights.get(b, weights[-1]) if n else (0, 0, 1)
            score += math.log10(w[0] * pair + w[1] * single + w[2] / (v + 1))
        out.append((doc_id, f == 0, len(t), sum(full[0][w] > 0 for w in t), n, base, score))
    return sorted(out, key=lambda r: (str(r[0]), r[2], r[5]))


def found(docs):
    return sorted((tuple(r) for r in interpolation.score(docs).collect()), key=lambda r: (str(r[0]), r[2], r[5]))


def same(got, want):
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
    # Held-out estimates are gathered in bins, so the weights differ a little.
    assert [r[6] for r in got] == pytest.approx([r[6] for r in want], rel=2e-3)


def test_equals_brute_force(docs_of, prose, odd_rows):
    rows = [*((r[0], r[1]) for r in odd_rows), *((100 + k, prose(k, n=40 + k % 30, vocabulary=60) + (" Fixed Phrase HERE" * (k % 3))) for k in range(150))]
    same(found(docs_of(rows)), brute(rows))


def test_buckets_chunks_and_parts_of_long_texts(docs_of, prose, monkeypatch):
    for name, value in (("CHUNK", 4000), ("PIECE", 300)):
        monkeypatch.setattr(interpolation, name, value)
    monkeypatch.setattr(exchange, "KEYS", 64)
    rows = [(k, prose(k, n=20 if k % 4 else 400, vocabulary=80)) for k in range(80)]
    same(found(docs_of(rows, 3)), brute(rows))


def test_nothing_in_training_and_no_rows(docs_of):
    out = next(k for k in range(100) if fold(k) == 0)
    assert found(docs_of([(out, "a b")])) == [(out, True, 3, 0, 0, 0.0, 0.0)]
    assert interpolation.score(docs_of([(1, "a")]).where("doc_id > 9")).count() == 0
    same(found(docs_of([(None, None), (None, "")])), brute([(None, None), (None, "")]))


def test_clashing_columns(docs_of, prose):
    docs = docs_of([(k, prose(k, n=20)) for k in range(30)])
    more = docs.withColumns({c: F.lit(7) for c in ("row", "kind", "chunk", "n", "bucket", "score", "types", "held_out")})
    same(found(more), found(docs))


def test_weights_favour_what_predicts():
    import pyarrow as pa

    cell = lambda b, pair, single, n: {"bucket": b, "pair": round(4 * math.log2(pair)), "single": round(4 * math.log2(single)), "n": n, "log_pair": n * math.log2(pair), "log_single": n * math.log2(single)}
    cells = pa.Table.from_pylist([cell(1, 0.9, 0.001, 1000), cell(5, 1e-6, 0.2, 1000)])
    w = interpolation.learned_weights(cells, 1e-4)
    assert w[1][0] > 0.99 and w[5][1] > 0.99 and all(abs(x.sum() - 1) < 1e-12 and (x > 0).all() for x in w.values())
