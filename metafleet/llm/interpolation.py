"""Language-model scores by deleted interpolation (operator 13).

A token's probability after the token before it mixes three maximum-likelihood estimates: the pair's, the
token's own, and one over the vocabulary. The weights depend on how often the token before occurs, in buckets
of powers of two. They are learned by expectation-maximisation on counts that were held out: a part of the training
texts is deleted from the counts, and its tokens say which weights would have predicted them best. The counts
of the final model cover all training texts.

Counts of tokens and pairs come from ``exchange``: every chunk of texts names its tokens and pairs once and
gets their corpus-wide counts back, so no table of the corpus's pairs is sent to any task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.llm import exchange
from metafleet.llm.shared import written
from metafleet.llm.toxicity import crc_fold
from metafleet.llm.wordhash import SPACE, WordHasher, mixed, slices

#: Bytes of text in a chunk, about; bytes of a text that are hashed at once.
CHUNK, PIECE = 1 << 23, 1 << 20
#: Texts of a fold: scored only; deleted from the counts while weights are learned; counted.
HELD_OUT, DELETED, COUNTED = 0, 1, 2
#: Added to every count of the base score.
BASE = 0.1
#: Bins of a factor of two that logarithms of estimates are gathered in for the weights, and their lowest bin.
FINE, LOWEST = 4, -512
#: Turns of expectation-maximisation at most.
TURNS = 200

_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: What stands before a text's first token, and a text's end: no word's hash but by a chance of 2 ** -64.
START, END = np.uint64(1), np.uint64(2)
_SPACES = re.compile(rb"[\x20\x09-\x0D]")


class Chunk:
    """Texts of one kind, in pieces, until about ``CHUNK`` bytes have come together."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.doc_ids: list[pa.Array] = []
        self.bytes = self.n = 0

    def add(self, doc_ids: pa.Array, part: tuple[np.ndarray, ...], n_bytes: int) -> None:
        self.parts.append(part)
        self.doc_ids.append(doc_ids)
        self.bytes, self.n = self.bytes + n_bytes, self.n + len(doc_ids)

    def full(self) -> bool:
        return self.bytes >= CHUNK or self.n >= 1 << 20

    def batch(self, kind: int) -> pa.RecordBatch:
        rows, tokens, before, sizes = (np.concatenate(x) for x in zip(*self.parts))
        types, back = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        ids, first = back[: len(tokens)], back[len(tokens) :]
        numbers = {"n_parts": len(first), "n_tokens": len(ids), "n_types": len(types)}
        blobs = {"types": exchange.packed_keys(types), "rows": exchange.packed(rows), "sizes": exchange.packed(sizes), "first": exchange.packed(first.astype(np.uint32)), "ids": exchange.packed(ids.astype(np.uint32))}
        docs = pa.ListArray.from_arrays(pa.array([0, len(first)], pa.int32()), pa.concat_arrays(self.doc_ids))
        return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), docs, *(pa.array([n], pa.int64()) for n in numbers.values()), *(pa.array([x], pa.binary()) for x in blobs.values())], names=["kind", "doc_ids", *numbers, *blobs])


def text_parts(hasher: WordHasher, texts: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, tokens, before, sizes) of whole texts: each part's tokens end with ``END``; ``START`` stands before."""
    words, starts = hasher.words(texts)
    sizes = np.diff(starts) + 1
    tokens = np.insert(words, starts[1:], END)
    return rows, tokens, np.full(len(rows), START), sizes.astype(np.int64)


def long_parts(hasher: WordHasher, text: bytes, row: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The parts of one long text: each has the token before it from the part that ends there."""
    last, cut = START, list(exchange.pieces(text, _SPACES, PIECE))
    for k, piece in enumerate(cut):
        words, _ = hasher.words(pa.array([piece], pa.large_binary()).view(pa.large_string()))
        tokens = np.append(words, END) if k == len(cut) - 1 else words
        if len(tokens):
            yield np.array([row]), tokens, np.array([last]), np.array([len(tokens)])
            last = tokens[-1]


def features(docs: DataFrame) -> DataFrame:
    """Chunks of texts (doc_id, text, kind): one row each, its tokens as places among its distinct tokens' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, open_ = WordHasher(SPACE), {k: Chunk() for k in (HELD_OUT, DELETED, COUNTED)}
        for b in slices(batches, "text"):
            kinds, rows = b.column("kind").to_numpy(), b.column("row").to_numpy()
            sizes = pa.compute.fill_null(pa.compute.binary_length(b.column("text")), 0).to_numpy()
            for k in open_:
                short = np.flatnonzero((kinds == k) & (sizes <= PIECE))
                if len(short):
                    took = pa.array(short)
                    open_[k].add(b.column("doc_id").take(took), text_parts(hasher, b.column("text").take(took), rows[short]), int(sizes[short].sum()))
                for at in np.flatnonzero((kinds == k) & (sizes > PIECE)).tolist():
                    for part in long_parts(hasher, b.column("text")[at].as_py().encode(), rows[at]):
                        open_[k].add(b.column("doc_id").slice(at, 1), part, PIECE)
                        if open_[k].full():
                            yield open_[k].batch(k)
                            open_[k] = Chunk()
                if open_[k].full():
                    yield open_[k].batch(k)
                    open_[k] = Chunk()
        for k, chunk in open_.items():
            if chunk.n:
                yield chunk.batch(k)

    schema = "kind int, doc_ids array<long>, n_parts long, n_tokens long, n_types long, types binary, rows binary, sizes binary, first binary, ids binary"
    rows = docs.select("doc_id", "text", "kind", F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, schema).withColumn("chunk", F.monotonically_increasing_id())


CHUNK_COLUMNS = ("chunk", "kind", "n_parts", "n_tokens", "n_types", "types", "sizes", "first", "ids")


class Tokens:
    """A chunk's row of ``features``, unpacked."""

    def __init__(self, r: dict):
        self.types = exchange.unpacked_keys(r["types"], r["n_types"])
        self.sizes = exchange.unpacked(r["sizes"], r["n_parts"], np.int64)
        self.first = exchange.unpacked(r["first"], r["n_parts"], np.uint32).astype(np.int64)
        self.ids = exchange.unpacked(r["ids"], r["n_tokens"], np.uint32).astype(np.int64)
        self.before = np.empty_like(self.ids)
        self.before[1:] = self.ids[:-1]
        self.before[np.cumsum(self.sizes) - self.sizes] = self.first

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct pairs' keys in order, each token's place among them, and their counts."""
        found, back, counts = np.unique(self.before * len(self.types) + self.ids, return_inverse=True, return_counts=True)
        keys = mixed(self.types[found // len(self.types)] * _GOLD + self.types[found % len(self.types)])
        order = np.argsort(keys)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return keys[order], place[back], counts[order]

    def type_counts(self) -> np.ndarray:
        """How often each distinct token stands in the chunk; ``START`` counts once for each text that begins."""
        counts = np.bincount(self.ids, minlength=len(self.types))
        begins = self.types[self.first] == START
        return counts + np.bincount(self.first[begins], minlength=len(self.types))


#: What a request is about: tokens or pairs; beside it the kind of the chunk's texts.
TYPES, PAIRS = 0, 4


def asked(feats: DataFrame, bits: int) -> DataFrame:
    """The requests of all chunks for the counts of their tokens and pairs."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                t = Tokens(r)
                pairs, _, counts = t.pairs()
                # Words' hashes are spread evenly already; the two marks are not, and share the first bucket.
                yield exchange.request_batch(exchange.request_rows(r["chunk"], TYPES + r["kind"], t.types, t.type_counts(), bits) + exchange.request_rows(r["chunk"], PAIRS + r["kind"], pairs, counts, bits))

    return feats.select(*CHUNK_COLUMNS).mapInArrow(ask, exchange.REQUEST)


ANSWER = "chunk long, about int, kind int, first long, n int, kept binary, full binary, v_kept long, n_kept long, v_full long, n_full long"


def answer(bucket: exchange.Bucket) -> pa.Table:
    """Each request's counts in order of its keys, without the deleted texts and with them; only deleted texts need both.

    A row of chunk -1 has the bucket's numbers of distinct tokens and of tokens, of both.
    """
    names = [f.split()[0] for f in ANSWER.split(", ")]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4)
    kept = {a: bucket.total({a + COUNTED}) for a in (TYPES, PAIRS)}
    full = {a: bucket.total({a + COUNTED, a + DELETED}) for a in (TYPES, PAIRS)}
    rows: list[tuple] = []
    for chunk, kind, at in bucket.each():
        about, kind = kind & PAIRS, kind % PAIRS
        old = exchange.packed(kept[about][at].astype(np.uint64)) if kind == DELETED else b""
        rows.append((chunk, about, kind, int(bucket.keys[at[0]] >> np.uint64(1)), len(at), old, exchange.packed(full[about][at].astype(np.uint64)), None, None, None, None))
    word = bucket.keys != START
    sums = [int(f(x[TYPES][word])) for x in (kept, full) for f in (np.count_nonzero, np.sum)]
    rows.append((-1, TYPES, -1, -1, 0, b"", b"", *sums))
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def _counts(right: pa.Table, about: int, column: str) -> np.ndarray:
    """The answers of a chunk about tokens or pairs, in the order of its keys."""
    rows = [(r["first"], r[column], r["n"]) for r in right.select(["about", "first", "n", column]).to_pylist() if r["about"] == about]
    return np.concatenate([np.zeros(0, np.uint64), *(exchange.unpacked(blob, n, np.uint64) for _, blob, n in sorted(rows, key=lambda r: r[0]))]).astype(np.float64)


def estimates(t: Tokens, right: pa.Table, column: str, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every token: its count, the bucket of the token before it, and the estimates of the pair and of the token alone."""
    types, pairs = _counts(right, TYPES, column), _counts(right, PAIRS, column)
    _, place, _ = t.pairs()
    context, count = types[t.before], types[t.ids]
    pair = np.divide(pairs[place], context, out=np.zeros(len(context)), where=context > 0)
    return count, context_bucket(context), pair, count / max(n, 1)


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for a token that was never seen, else 1 more than the power of two that its count reaches."""
    return np.frexp(count)[1]


def held_out_cells(feats: DataFrame, found: DataFrame, n_kept: int) -> DataFrame:
    """(bucket, pair, single, n, log_pair, log_single): the deleted texts' tokens, gathered by their estimates.

    ``pair`` and ``single`` are logarithms of the estimates in ``FINE`` bins of a factor of two, null for 0; the sums of the
    exact logarithms are kept. So there are some hundred thousand rows at most,
    however large the corpus is.
    """
    names, kinds = ("bucket", "pair", "single", "n", "log_pair", "log_single"), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64())

    def cells(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[np.ndarray] = [np.zeros(0)] * 6
        for r in left.to_pylist():
            _, bucket, pair, single = estimates(Tokens(r), right, "kept", n_kept)
            logs = [np.where(p > 0, np.log2(np.where(p > 0, p, 1)), LOWEST) for p in (pair, single)]
            bins = [np.round(x * FINE).astype(np.int64) for x in logs]
            key = (bucket.astype(np.int64) << 40) + ((bins[0] - FINE * LOWEST) << 20) + (bins[1] - FINE * LOWEST)
            _, first, back, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            out = [bucket[first], bins[0][first], bins[1][first], n, *(np.bincount(back, weights=x) for x in logs)]
        return pa.Table.from_arrays([pa.array(x.astype(k.to_pandas_dtype())) for x, k in zip(out, kinds)], names=list(names))

    deleted = feats.where(F.col("kind") == DELETED).select(*CHUNK_COLUMNS)
    answers = found.where((F.col("kind") == DELETED) & (F.col("chunk") >= 0)).select("chunk", "about", "first", "n", "kept")
    each = deleted.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(cells, "bucket int, pair int, single int, n long, log_pair double, log_single double")
    return each.groupBy("bucket", "pair", "single").agg(F.sum("n").alias("n"), F.sum("log_pair").alias("log_pair"), F.sum("log_single").alias("log_single"))


def learned_weights(cells: pa.Table, new: float) -> dict[int, np.ndarray]:
    """By bucket of the token before: the weights of the pair, of the token alone and of ``new``, one over the vocabulary.

    Expectation-maximisation over the held-out tokens of each bucket; half a token of each estimate is added, so that
    no weight is 0. -1 has the weights of all buckets together, for those that no held-out token has met.
    """
    n = cells.column("n").to_numpy().astype(np.float64)
    p = [np.where(cells.column(c).to_numpy() > FINE * LOWEST, np.exp2(cells.column(f"log_{c}").to_numpy() / np.maximum(n, 1)), 0.0) for c in ("pair", "single")]
    p = np.stack([*p, np.full(len(n), new)], axis=1)
    bucket = cells.column("bucket").to_numpy()
    out = {}
    for b in (-1, *np.unique(bucket).tolist()):
        mine = np.full(len(n), True) if b == -1 else bucket == b
        weights = np.full(3, 1 / 3)
        for _ in range(TURNS):
            part = p[mine] * weights
            share = (n[mine, None] * part / part.sum(axis=1, keepdims=True)).sum(axis=0) + 0.5
            old, weights = weights, share / share.sum()
            if np.abs(weights - old).max() < 1e-9:
                break
        out[b] = weights
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words between blanks and bytes 9 to 13, A-Z as a-z, and one end of each text. Texts whose crc32 of the id modulo
    10 is 0 are held out of all counts; those of 1 are deleted from the counts while the weights are learned. ``score`` is the
    model's log10 probability of the text, ``base_score`` that of smoothed single counts. Null and empty texts are one end; a
    null id is in training. Texts of any length are read whole, in parts; repeated rows count each for itself. With nothing in
    training every token has a probability of 1; an empty table gives no rows.
    """
    kind = F.when(crc_fold("doc_id", 10) == 0, F.lit(HELD_OUT)).when(crc_fold("doc_id", 10) == 1, F.lit(DELETED)).otherwise(F.lit(COUNTED))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    fold = crc_fold("doc_id", 10)
    kind = F.when(fold == 0, HELD_OUT).when(fold == 1, DELETED).otherwise(COUNTED)
    feats = written(features(rows.withColumn("kind", kind)), "tokens")
    total = feats.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    found = written(exchange.answers(asked(feats, exchange.bucket_bits(total)), answer, ANSWER), "counts")
    s = found.where("chunk = -1").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("v_kept", "n_kept", "v_full", "n_full"))).first()
    weights = learned_weights(held_out_cells(feats, found, s.n_kept).toArrow(), 1 / (s.v_kept + 1))
    table = np.stack([weights.get(b, weights[-1]) for b in range(65)]) if s.n_full else np.tile([0.0, 0.0, 1.0], (65, 1))
    n_full, v_full = s.n_full, s.v_full

    names = ("row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r, doc_ids in zip(left.drop_columns("doc_ids").to_pylist(), left.column("doc_ids")):
            t = Tokens(r)
            count, bucket, pair, single = estimates(t, right, "full", n_full)
            p = table[bucket, 0] * pair + table[bucket, 1] * single + table[bucket, 2] / (v_full + 1)
            base = np.log10((count + BASE) / (n_full + BASE * (v_full + 1)))
            starts = np.cumsum(t.sizes) - t.sizes
            sums = [np.add.reduceat(x, starts) for x in ((count > 0).astype(np.int64), base, np.log10(p))]
            columns = [exchange.unpacked(r["rows"], r["n_parts"], np.int64), doc_ids.values, [r["kind"] == HELD_OUT] * len(starts), t.sizes, *sums]
            out.append(pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names)))
        return pa.concat_tables(out) if out else pa.schema(zip(names, kinds)).empty_table()

    answers = found.where("chunk >= 0").select("chunk", "about", "first", "n", "full")
    each = feats.select(*CHUNK_COLUMNS, "rows", "doc_ids").groupBy("chunk").cogroup(answers.groupBy("chunk"))
    parts = each.applyInArrow(scored, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    # The parts of a long text may lie in several chunks.
    whole = parts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *(F.sum(c).alias(c) for c in names[3:]))
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_full).alias("train_tokens"), "base_score", "score")
