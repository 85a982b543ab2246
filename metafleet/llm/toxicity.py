"""Toxicity by class-conditional Kneser-Ney models (operator 8).

Each class has an interpolated Kneser-Ney model of order two. A pair of words has its discounted count in
the class; the mass taken off goes to the class's continuation counts (after how many words a word stands),
discounted as well, and the mass taken off those to the continuation counts of both classes together. So a
word that neither class has settled says little. A text's evidence is the difference of the two
log-likelihoods per word, and what its telling words exceed others by, for the length; a logistic curve,
fitted on labelled texts that no count has seen, turns them into a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.llm.shared import written
from metafleet.llm.wordhash import PUNCTUATION, WordHasher, mixed, slices

#: Labelled texts of each class that the models are fitted on, about; more are thinned out by a hash of
#: the id, to bound the tables of word pairs that every executor holds.
FIT_ROWS = 4_000
#: Of these, one in so many fits the curve instead of the counts.
CURVE = 5
#: Ratios above this speak for themselves: the word is so many times (e ** 2.5) likelier in one class.
TELLING = 2.5

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def crc_fold(id_col, folds: int) -> F.Column:
    """crc32 of the id as text modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def _pairs(hasher: WordHasher, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word before, word) of every word; 0 stands before a text's first word."""
    words, starts = hasher.words(texts)
    before = np.zeros_like(words)
    before[1:] = words[:-1]
    before[starts[:-1][starts[:-1] < starts[1:]]] = 0
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts)), before, words


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One number for a word and the word before it."""
    return mixed(v * _GOLD + w)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(v, w, c0, c1): how often w follows v in the texts (text, label) of each class; v is 0 at a text's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(PUNCTUATION)
        for b in slices(batches, "text"):
            doc, v, w = _pairs(hasher, b.column("text"))
            label = b.column("label").to_numpy(zero_copy_only=False)[doc]
            yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(w.view(np.int64)), pa.array((label == 0).astype(np.int64)), pa.array((label == 1).astype(np.int64))], names=["v", "w", "c0", "c1"])

    rows = texts.select("text", F.col("label").cast("int").alias("label")).mapInArrow(run, "v long, w long, c0 long, c1 long")
    return rows.groupBy("v", "w").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def discount(ones: int, twos: int) -> float:
    """Ney's discount from how many counts are 1 and 2."""
    return ones / (ones + 2 * twos) if ones else 0.5


def probabilities(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, list[float]] | None:
    """From ``pair_counts``: (v, w, p0, p1) of every pair seen; (v, rest0, rest1), what a word before leaves to the
    lower order in each class; (w, p0, p1), the lower order; and both classes' lower-order value of a new word.

    None if a class has no words. The lower order of class k is (max(n_k(w) - d_k, 0) + d_k * types_k * shared(w)) / n_k
    over the contexts n_k(w) of w; shared(w) are the contexts of both classes, with one more for every word
    and one for a new word, so that each model sums up to 1 over the words and the new one.
    """
    pairs = written(pairs, "pairs")
    words = pairs.groupBy("w").agg(F.count_if(F.col("c0") > 0).alias("n0"), F.count_if(F.col("c1") > 0).alias("n1"), F.count("*").alias("shared"))
    words = written(words, "words")
    befores = written(pairs.groupBy("v").agg(F.sum("c0").alias("t0"), F.sum("c1").alias("t1"), F.count_if(F.col("c0") > 0).alias("u0"), F.count_if(F.col("c1") > 0).alias("u1")), "befores")
    one = lambda c, m: F.count_if(F.col(c) == m).alias(f"{c}_{m}")
    s = words.agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "shared")), F.count("*").alias("words"), *(F.count_if(F.col(f"n{k}") >= 1).alias(f"types{k}") for k in (0, 1)), *(one(f"n{k}", m) for k in (0, 1) for m in (1, 2))).first()
    if not s.n0 or not s.n1:
        return None
    p = pairs.agg(*(one(f"c{k}", m) for k in (0, 1) for m in (1, 2))).first()
    high = [discount(p[f"c{k}_1"], p[f"c{k}_2"]) for k in (0, 1)]
    low = [discount(s[f"n{k}_1"], s[f"n{k}_2"]) for k in (0, 1)]
    passed = [low[k] * s[f"types{k}"] / s[f"n{k}"] for k in (0, 1)]
    everything = float(s.shared + s.words + 1)

    lower = words.select("w", *((F.greatest(F.col(f"n{k}") - F.lit(low[k]), F.lit(0.0)) / F.lit(float(s[f"n{k}"])) + F.lit(passed[k]) * (F.col("shared") + 1) / F.lit(everything)).alias(f"p{k}") for k in (0, 1)))
    rest = befores.select("v", *(F.when(F.col(f"t{k}") > 0, F.lit(high[k]) * F.col(f"u{k}") / F.col(f"t{k}")).otherwise(F.lit(1.0)).alias(f"rest{k}") for k in (0, 1)))
    both = pairs.join(lower, "w").join(rest.join(befores.select("v", "t0", "t1"), "v"), "v")
    upper = both.select("v", "w", *((F.when(F.col(f"c{k}") > 0, (F.col(f"c{k}") - F.lit(high[k])) / F.col(f"t{k}")).otherwise(F.lit(0.0)) + F.col(f"rest{k}") * F.col(f"p{k}")).alias(f"p{k}") for k in (0, 1)))
    return upper, rest, lower, [passed[k] / everything for k in (0, 1)]


def fit_model(pairs: DataFrame) -> dict:
    """Sorted keys and log-likelihood ratios (toxic to ordinary) of pairs, words before and words. Empty with a class missing.

    The tables have an entry for each pair of words in the texts fitted on, which ``FIT_ROWS`` bounds.
    """

    def table(rows: DataFrame, key, ratio) -> tuple[np.ndarray, np.ndarray]:
        got = rows.select(*key, ratio.cast("float").alias("ratio")).toArrow()
        keys = [got.column(c).to_numpy().view(np.uint64) for c in key]
        keys = keys[0] if len(keys) == 1 else _pair(*keys)
        order = np.argsort(keys)
        return keys[order], got.column("ratio").to_numpy()[order]

    found = probabilities(pairs)
    if found is None:
        none = (np.zeros(0, np.uint64), np.zeros(0, np.float32))
        return {"pairs": none, "befores": none, "words": none, "unseen": 0.0}
    upper, rest, lower, new = found
    return {
        "pairs": table(upper, ["v", "w"], F.log(F.col("p1") / F.col("p0"))), "befores": table(rest, ["v"], F.log(F.col("rest1") / F.col("rest0"))),
        "words": table(lower, ["w"], F.log(F.col("p1") / F.col("p0"))), "unseen": float(np.log(new[1] / new[0])),
    }


def _looked_up(table: tuple[np.ndarray, np.ndarray], key: np.ndarray, missing: float) -> np.ndarray:
    keys, values = table
    if not len(keys):
        return np.full(len(key), missing)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where(keys[at] == key, values[at].astype(np.float64), missing)


def ratios(model: dict, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The log-likelihood ratio of each word after the word before it, and that of the word in the lower order.

    Of a pair that no text had, what the word before leaves to the lower order, times the word's own.
    """
    key, which = np.unique(_pair(v, w), return_index=True)
    back = np.searchsorted(key, _pair(v, w))
    v, w = v[which], w[which]
    each = _looked_up(model["pairs"], key, np.nan)
    lower = _looked_up(model["words"], w, model["unseen"])
    open_ = np.flatnonzero(np.isnan(each))
    each[open_] = _looked_up(model["befores"], v[open_], 0.0) + lower[open_]
    return each[back], lower[back]


def evidence(docs: DataFrame, model: dict) -> DataFrame:
    """Adds to rows with ``text``: its number of words, the log-likelihood ratio per word (0 without words), by how
    much its telling words exceed ``TELLING`` altogether (``excess``), and by how much its telling pairs
    exceed it and their words (``pair_excess``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(PUNCTUATION)
        for b in slices(batches, "text"):
            doc, v, w = _pairs(hasher, b.column("text"))
            n = np.bincount(doc, minlength=len(b))
            each, lower = ratios(shared.value, v, w)
            total = np.bincount(doc, weights=each, minlength=len(b))
            excess = np.bincount(doc, weights=np.maximum(lower - TELLING, 0), minlength=len(b))
            pair_excess = np.bincount(doc, weights=np.maximum(each - np.maximum(lower, 0) - TELLING, 0), minlength=len(b))
            rest = [b.column(c) for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(n, pa.int64()), pa.array(total / np.maximum(n, 1)), pa.array(excess), pa.array(pair_excess)], names=[*(c for c in b.schema.names if c != "text"), "n_words", "ratio", "excess", "pair_excess"])

    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c != "text")
    return docs.mapInArrow(run, f"{fields}, n_words long, ratio double, excess double, pair_excess double")


#: What the curve sees of a text besides 1: the ratio per word, both excesses, and both against the noise that the length leaves.
FEATURES = ("ratio", "excess", "excess / sqrt(greatest(n_words, 1))", "pair_excess", "pair_excess / sqrt(greatest(n_words, 1))")


def fit_curve(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a small ridge."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (label - p)) - 1e-3 * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on), n_words, ratio, excess, pair_excess.

    Learns from the rows of ``labels`` (doc_id, toxic) whose fold (crc32 of the id) isn't 0; a null
    toxic teaches nothing, of several labels the greatest counts. Null and empty texts have no
    evidence: their score is the curve's at 0. Texts of any length are read whole, repeated rows score alike. Without labels of both classes every score is the
    share of toxic ones (0 without any labels). Null ids are not held out; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    fold = crc_fold("doc_id", folds)
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(fold != 0).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    rate = {k: min(1.0, fit_rows / sizes[k]) for k in sizes}
    thin = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 20)) < F.when(F.col("label") == 1, F.lit(rate.get(1, 1.0))).otherwise(F.lit(rate.get(0, 1.0))) * (1 << 20)
    sample = known.where(thin).withColumn("curve", F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(CURVE)) == 0)
    # About 2 * fit_rows rows at most, by the rates above.
    texts = rows.join(F.broadcast(sample), "doc_id")
    model = fit_model(pair_counts(texts.where("not curve")))
    held = evidence(texts.where("curve").select("text", "label"), model).select("label", *(F.expr(f).alias(f"f{k}") for k, f in enumerate(FEATURES))).toArrow()
    label = held.column("label").to_numpy()
    base = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(set(label.tolist())) == 2:
        weight = np.where(label == 1, 1 / rate.get(1, 1.0), 1 / rate.get(0, 1.0))
        seen = np.stack([np.ones(len(label)), *(held.column(f"f{k}").to_numpy() for k in range(len(FEATURES)))], axis=1)
        beta = fit_curve(seen, label, weight).tolist()
    else:
        base = min(max(base, 0.0), 1.0)
        beta = [30.0 if base == 1 else -30.0 if base == 0 else float(np.log(base / (1 - base))), *[0.0] * len(FEATURES)]
    z = F.lit(beta[0])
    for weight, feature in zip(beta[1:], FEATURES):
        z = z + F.expr(feature) * weight
    scored = evidence(rows, model).withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0)))))
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_words", "ratio", "excess", "pair_excess")
