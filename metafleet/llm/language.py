"""Language identification by multilingual mixtures (operator 9).

Every language has a distribution of byte trigrams, counted over all texts of known language. A
document is a mixture: expectation-maximisation over its words estimates each language's share. Which
languages it has is chosen by likelihood less a penalty for each share that is estimated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.llm.toxicity import crc_fold
from metafleet.llm.wordhash import slices

#: Trigram buckets of a language's table (128 KB a language, in every executor), and its smoothing.
BUCKETS, SMOOTHING = 1 << 15, 0.5
#: EM rounds; words times languages that are held at a time.
ROUNDS, CELLS = 8, 1 << 22

#: a-z and all bytes above 127 stand for themselves, A-Z for a-z, the rest is a gap.
_LETTER = np.full(256, 32, dtype=np.uint32)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of the trigram around each letter, first letter of each word, words before each text (len + 1)).

    Only letters count: their trigram holds the byte before and the byte after, a gap at the ends.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    x = _LETTER[data]
    prev, after = np.full_like(x, 32), np.full_like(x, 32)
    prev[1:], after[:-1] = x[:-1], x[1:]
    inner = offsets[(offsets > 0) & (offsets < len(x))]
    prev[inner], after[inner - 1] = 32, 32
    letter = x != 32
    code = ((prev << np.uint32(16) | x << np.uint32(8) | after) * np.uint32(0x9E3779B1)) >> np.uint32(17)
    first = (prev == 32)[letter]
    starts = np.flatnonzero(first)
    letters_before = np.concatenate([[0], np.cumsum(letter)])[offsets]
    return code[letter].astype(np.int64), starts, np.searchsorted(starts, letters_before)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all texts of ``docs`` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for b in slices(batches, "text"):
            code, starts, words = trigrams(b.column("text"))
            ends = np.concatenate([starts, [len(code)]])[words]
            for lang, i, j in zip(b.column("lang").to_pylist(), ends, ends[1:]):
                if j > i:
                    if lang not in tables:
                        tables[lang] = np.zeros(BUCKETS, dtype=np.int64)
                    tables[lang] += np.bincount(code[i:j], minlength=BUCKETS) if j - i > 2000 else 0
                    if j - i <= 2000:
                        np.add.at(tables[lang], code[i:j], 1)
        for lang, table in tables.items():
            some = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(table[some])], names=["lang", "bucket", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """All languages of ``docs`` (lang, text) and, per bucket and language, the log-probability."""
    got = trigram_counts(docs).toArrow()
    lang = got.column("lang").to_pylist()
    names = sorted(set(lang))
    table = np.zeros((BUCKETS, len(names)))
    if names:
        at = {x: k for k, x in enumerate(names)}
        table[got.column("bucket").to_numpy(), [at[x] for x in lang]] = got.column("n").to_numpy()
    return names, np.log((table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)


def _em(e: np.ndarray, doc: np.ndarray, starts: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares after so many rounds, and each document's log-likelihood of the word likelihoods ``e``."""
    counts = np.diff(np.append(starts, len(e)))[:, None]
    for _ in range(rounds):
        r = e * share[doc]
        r /= r.sum(axis=1, keepdims=True)
        share = np.add.reduceat(r, starts, axis=0) / counts
    return share, np.add.reduceat(np.log((e * share[doc]).sum(axis=1)), starts)


def mixtures(code: np.ndarray, starts: np.ndarray, words: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text that has words: its number, all shares, and the shares of the chosen set (others 0).

    The sets tried are the 1, 2, ... languages of the greatest shares, as long as the penalised
    likelihood rises; the penalty of a set is half the logarithm of the number of words for each share but one. Of equal shares
    the language that comes first by name counts as the greater.
    """
    ll = np.add.reduceat(table[code], starts, axis=0)
    top = ll.max(axis=1, keepdims=True)
    e = np.exp(np.maximum(ll - top, -40.0))
    m = np.diff(words)
    some = np.flatnonzero(m)
    size = m[some]
    doc, first = np.repeat(np.arange(len(some)), size), words[:-1][some]
    langs = table.shape[1]
    share, _ = _em(e, doc, first, np.full((len(some), langs), 1 / langs), ROUNDS)
    order = np.argsort(-share, axis=1, kind="stable")
    chosen = np.zeros_like(share)
    np.put_along_axis(chosen, order[:, :1], 1.0, axis=1)
    best = np.add.reduceat(np.log((e * chosen[doc]).sum(axis=1)), first)
    going = np.arange(len(some))
    for k in range(2, langs + 1):
        if not len(going):
            break
        sizes = size[going]
        at = np.repeat(first[going] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
        mask = np.zeros((len(going), langs))
        np.put_along_axis(mask, order[going, :k], 1.0, axis=1)
        start = share[going] * mask + 1e-6 * mask
        fitted, value = _em(e[at], np.repeat(np.arange(len(going)), sizes), np.append(0, np.cumsum(sizes)[:-1]), start / start.sum(axis=1, keepdims=True), ROUNDS)
        value = value - 0.5 * (k - 1) * np.log(np.maximum(sizes, 2))
        better = value > best[going]
        going, fitted = going[better], fitted[better]
        best[going], chosen[going] = value[better], fitted
    return some, share, chosen


def identify(docs: DataFrame, names: list[str], table: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, languages) of every row: the language of the greatest share in the chosen set.

    ``languages`` has the set with its shares. Null texts and texts without a letter, and all texts if
    no language was learned, are ``und`` with score 0. Repeated rows are predicted alike. Texts are read whole; a
    task holds 8 bytes for each word and language of its longest text.
    """
    model = docs.sparkSession.sparkContext.broadcast((names, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = model.value
        # A word has about six bytes; one text is never cut.
        for b in slices(batches, "text", max(1 << 10, min(1 << 18, 6 * CELLS // max(len(names), 1)))):
            pred, score, sets = ["und"] * len(b), [0.0] * len(b), [[] for _ in range(len(b))]
            code, starts, words = trigrams(b.column("text"))
            if names and len(starts):
                some, share, chosen = mixtures(code, starts, words, table)
                letter = b.column("letter").to_pylist()
                for d, s, c in zip(some.tolist(), share, chosen):
                    if letter[d]:
                        k = int(c.argmax())
                        pred[d], score[d] = names[k], float(min(s[k], 1.0))
                        sets[d] = [{"lang": names[i], "share": float(c[i])} for i in np.flatnonzero(c)]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred), pa.array(score), pa.array(sets, kind)], names=["doc_id", "lang_pred", "score", "languages"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>")


def language_table(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Learns from the texts of known language outside the held-out fold and predicts every row of ``docs``."""
    fold = crc_fold("doc_id", folds)
    names, table = fit(docs.where(fold != held).where("lang is not null and text is not null").select("lang", "text"))
    found = identify(docs, names, table)
    return found.select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "lang_pred", "score", "languages")
