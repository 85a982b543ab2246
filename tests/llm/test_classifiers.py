import random
import zlib

import pytest
from pyspark.sql import functions as F

from metafleet.llm import language, toxicity

WORDS = {"en": "the of and to with this from that have for", "de": "der und die nicht einen werden auch schon über für", "fr": "les des être pour dans avec où très après elle"}


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def text_of(r, lang, n):
    return " ".join(r.choice(WORDS[lang].split()) + r.choice(["", "s", "en"]) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark, docs_of):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        lang, toxic = r.choice(list(WORDS)), r.random() < 0.3
        words = text_of(r, lang, r.randrange(20, 90)).split()
        for _ in range(4 * toxic):
            words.insert(r.randrange(len(words)), r.choice(["idiot", "scum", "moron"]))
        t = " ".join(words)
        rows.append((i, t, lang, "s", len(t)))
        labels.append((i, 1, int(toxic)))
    return docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(labelled):
    docs, labels = labelled
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 600 and all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.97


def test_toxicity_never_reads_held_out_labels(labelled):
    docs, labels = labelled
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda x: sorted((r.doc_id, round(r.score, 9)) for r in toxicity.toxicity(docs, x).collect())
    assert score(labels) == score(other)


def test_toxicity_odd_rows(spark, docs_of, odd_rows):
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(1, 0, 1), (None, 0, 1), (5, 0, None)], [(k, 0, k % 2) for k in range(1, 10)] * 2):
        df = docs_of(odd_rows).withColumns({c: F.lit(1) for c in ("label", "ratio", "excess", "n_words", "toxic", "curve")})
        got = toxicity.toxicity(df, spark.createDataFrame(labels, schema)).collect()
        assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
        assert len({(r.doc_id, r.score) for r in got if r.doc_id == 1}) == 1
    assert toxicity.toxicity(docs_of([]), spark.createDataFrame([], schema)).count() == 0


def test_toxicity_thins_labels(labelled):
    docs, labels = labelled
    got = toxicity.toxicity(docs, labels, fit_rows=90).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.9


def test_language_held_out(labelled):
    docs, _ = labelled
    got = language.language_table(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 600 and all(r.held_out == (fold(r.doc_id, 4) == 2) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98


def test_language_mixture(labelled, docs_of):
    docs, _ = labelled
    names, table = language.fit(docs)
    r = random.Random(9)
    rows = [text_of(r, "en", 60), text_of(r, "en", 60) + " " + text_of(r, "de", 40), text_of(r, "fr", 2)]
    got = language.identify(docs_of(rows), names, table).orderBy("doc_id").collect()
    assert [x.lang for x in got[0].languages] == ["en"] and [x.lang for x in got[2].languages] == ["fr"]
    assert {x.lang: round(x.share, 1) for x in got[1].languages} == {"en": 0.6, "de": 0.4}


def test_language_odd_rows(docs_of, odd_rows, labelled):
    df = docs_of(odd_rows).withColumns({c: F.lit(1) for c in ("letter", "lang_pred", "score", "languages")})
    got = language.language_table(df).collect()
    by_id = {r.doc_id: r.lang_pred for r in got if r.doc_id is not None}
    assert len(got) == len(odd_rows) and [by_id[k] for k in (2, 3, 4, 8)] == ["und"] * 4 and "und" not in [by_id[k] for k in (1, 5, 7, 9)]
    assert all(0 <= r.score <= 1 for r in got)
    assert language.language_table(docs_of([])).count() == 0
    unknown = language.language_table(docs_of(odd_rows).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}


def kneser_ney(texts):
    """Both classes' probabilities {(v, w): (p0, p1)} from dictionaries, ``None`` as a word that no text has."""
    pairs = [{}, {}]
    for words, label in texts:
        for v, w in zip(["<s>", *words], words):
            pairs[label][v, w] = pairs[label].get((v, w), 0) + 1
    seen = set(pairs[0]) | set(pairs[1])
    vocabulary = sorted({w for _, w in seen})
    shared = {w: sum(x == w for _, x in seen) for w in vocabulary} | {None: 0}
    everything = sum(shared.values()) + len(vocabulary) + 1
    out = {}
    ney = lambda c: (lambda a, b: a / (a + 2 * b) if a else 0.5)(sum(x == 1 for x in c), sum(x == 2 for x in c))
    for k in (0, 1):
        n = {w: sum(x == w for _, x in pairs[k]) for w in vocabulary} | {None: 0}
        d, total = ney(list(n.values())), sum(n.values())
        types = sum(x > 0 for x in n.values())
        low = {w: max(n[w] - d, 0) / total + d * types / total * (shared[w] + 1) / everything for w in n}
        high = ney(list(pairs[k].values()))
        for v in {v for v, _ in seen} | {"never"}:
            after = {w: c for (x, w), c in pairs[k].items() if x == v}
            t = sum(after.values())
            for w in low:
                p = (max(after.get(w, 0) - high, 0) / t + high * len(after) / t * low[w]) if t else low[w]
                out.setdefault((v, w), [0, 0])[k] = p
    return out


def test_kneser_ney_against_dictionaries(docs_of, spark):
    r = random.Random(4)
    texts = [([r.choice("abcdefghij") if r.random() < 0.9 else r.choice("xyz") for _ in range(r.randrange(1, 9))], k % 2) for k in range(60)] + [(["only", "toxic"], 1), (["only", "plain"], 0)]
    want = kneser_ney(texts)
    for v in {v for v, _ in want}:
        for k in (0, 1):
            assert abs(sum(p[k] for (x, _), p in want.items() if x == v) - 1) < 1e-9
    frame = spark.createDataFrame([(" ".join(w), k) for w, k in texts], "text string, label int")
    model = toxicity.fit_model(toxicity.pair_counts(frame))
    hasher = toxicity.WordHasher(toxicity.PUNCTUATION)
    import numpy as np
    import pyarrow as pa

    number = lambda w: np.uint64(0) if w == "<s>" else hasher.words(pa.array([w or "brandnew"]))[0][0]
    keys = list(want)
    got, _ = toxicity.ratios(model, np.array([number(v) for v, _ in keys], np.uint64), np.array([number(w) for _, w in keys], np.uint64))
    assert np.abs(got - [np.log(want[x][1] / want[x][0]) for x in keys]).max() < 1e-5


def test_toxic_expression_of_ordinary_words(docs_of, spark):
    """Words that both classes use alike, in an order that only toxic texts have."""
    r = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        w = [r.choice("alpha beta gamma delta go away red blue one two".split()) for _ in range(40)]
        w = [x for k, x in enumerate(w) if not (x == "away" and k and w[k - 1] == "go")]
        if i % 3 == 0:
            for _ in range(3):
                w[r.randrange(30) : 0] = ["go", "away"]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 3 == 0)))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs_of(rows), labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(x.predicted == x.toxic for x in got) / len(got) > 0.9


def test_mixture_against_plain_em():
    """Shares and chosen sets equal those of an EM written out for one text."""
    import numpy as np

    r = np.random.default_rng(2)
    table = np.log(r.dirichlet(np.full(50, 0.1), 6).T + 1e-4).astype(np.float32)
    texts = [[r.choice(50, 3, p=np.exp(table[:, k]) / np.exp(table[:, k]).sum()) for k in r.choice(langs, 60)] for langs in ([0], [1, 2], [0, 1, 2, 3], [5, 4, 3, 2, 1])]
    code = np.concatenate([np.concatenate(t) for t in texts])
    starts, words = np.arange(0, len(code), 3), np.arange(0, 60 * len(texts) + 1, 60)
    some, share, chosen = language.mixtures(code, starts, words, table)

    def em(ll, p):
        for _ in range(language.ROUNDS):
            z = p * np.exp(ll)
            p = (z / z.sum(1, keepdims=True)).mean(0)
        return p, np.log((p * np.exp(ll)).sum(1)).sum()

    for d, t in enumerate(texts):
        ll = np.array([table[w].sum(0) for w in t], dtype=np.float64)
        full, _ = em(ll, np.full(6, 1 / 6))
        order, best = np.argsort(-full), None
        for k in range(1, 7):
            keep = np.isin(np.arange(6), order[:k])
            p, value = em(ll, (full + 1e-6) * keep / ((full + 1e-6) * keep).sum())
            value -= 0.5 * (k - 1) * np.log(60)
            if best is not None and value <= best[0]:
                break
            best = (value, p)
        assert np.abs(share[d] - full).max() < 1e-3 and np.abs(chosen[d] - best[1]).max() < 1e-3
    assert (chosen > 0).sum(1).max() > 3


def test_many_languages(docs_of):
    """More than 256 languages are all learned."""
    rows = [(k, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}q{x}" for x in "abcdef") * 3, f"l{k:03d}", "s", 1) for k in range(300)]
    names, table = language.fit(docs_of(rows))
    assert len(names) == 300
    got = language.identify(docs_of(rows), names, table).collect()
    assert sum(x.lang_pred == f"l{x.doc_id:03d}" for x in got) > 280
