"""Near-duplicate documents by one-permutation MinHash (operator 5).

Every document gets one signature from a single hash of its word shingles; empty bins are filled by
optimal densification. Bands of the signature are buckets. A bucket's members are tied to its centre (a
star), not to each other; bit tables of the sets rule out most pairs that can't be linked before the texts
are fetched, and never one that can; links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.llm.components import BLOCK, linked_classes, nodes_of, shared_buckets, sifted
from metafleet.llm.shared import written
from metafleet.llm.wordhash import SPACE, WordHasher, grams, mixed, slices

#: Bands of a signature, bins of a band. A pair at similarity 0.8 shares no band with a chance of
#: (1 - 0.8 ** 6) ** 36, below 2e-5.
BANDS, ROWS = 36, 6
#: Words of the bit table that rules pairs out.
WORDS = 16
#: Tries of an empty bin before it takes the next filled one.
TRIES = 64

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_table(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of all distinct n-word shingles, in order. Fewer words are one shingle as a whole."""
    lengths = np.diff(starts)
    counts = np.maximum(lengths - n + 1, 0)
    doc = np.repeat(np.arange(len(lengths)), counts)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts[:-1], counts)
    hashes = grams(words, n)[at] if len(doc) else np.zeros(0, dtype=np.uint64)
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    if len(short):
        doc = np.concatenate([doc, short])
        hashes = np.concatenate([hashes, [grams(words[starts[d] : starts[d + 1]], lengths[d])[0] for d in short]])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


def digests(doc: np.ndarray, hashes: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's number of shingles and a 64-bit digest of the set."""
    counts = np.bincount(doc, minlength=docs)
    sums = np.zeros(len(doc) + 1, dtype=np.uint64)
    np.cumsum(mixed(hashes ^ _GOLD), out=sums[1:])
    ends = np.cumsum(counts)
    return counts, mixed(sums[ends] - sums[ends - counts] + counts.astype(np.uint64)).view(np.int64)


def signatures(doc: np.ndarray, hashes: np.ndarray, docs: int, bins: int = BANDS * ROWS) -> np.ndarray:
    """A row of bins per document: the least hash of each bin; empty bins take over another bin's.

    An empty bin tries the bins of its own hash sequence until one is filled. All documents follow the
    same sequences, so two documents agree in a bin with a chance of their similarity. Documents
    without shingles keep empty bins.
    """
    out = np.full((docs, bins), _EMPTY)
    cell = doc * bins + (((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    first = np.ones(len(cell), dtype=bool)
    first[1:] = cell[1:] != cell[:-1]
    out.ravel()[cell[first]] = hashes[first]
    filled = out != _EMPTY
    row, bin_ = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    for attempt in range(1, TRIES + 1):
        if not len(row):
            return out
        pick = ((mixed(np.arange(bins, dtype=np.uint64) * _GOLD + np.uint64(attempt)) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)[bin_]
        good = filled[row, pick]
        out[row[good], bin_[good]] = out[row[good], pick[good]]
        row, bin_ = row[~good], bin_[~good]
    # Few bins are filled: the next filled one, going round.
    step = np.where(filled, np.arange(bins), 2 * bins)
    step = np.minimum.accumulate(np.concatenate([step, np.where(filled, np.arange(bins) + bins, 2 * bins)], axis=1)[:, ::-1], axis=1)[:, ::-1]
    out[row, bin_] = out[row, step[row, pick_start(bin_, bins)] % bins]
    return out


def pick_start(bin_: np.ndarray, bins: int) -> np.ndarray:
    """Where the search for the next filled bin begins."""
    return ((mixed(bin_.astype(np.uint64) * _GOLD) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)


def band_keys(sign: np.ndarray) -> np.ndarray:
    """The bucket of each band for every row of signatures, the band's number included."""
    parts = sign.reshape(len(sign), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sign), BANDS)).copy()
    for k in range(ROWS):
        out = mixed(out * _GOLD + parts[:, :, k])
    return out


def bit_tables(doc: np.ndarray, hashes: np.ndarray, docs: int) -> np.ndarray:
    """A row of ``WORDS`` words per document, as ``components.parities`` has them: each shingle turns one bit over."""
    out = np.zeros((docs, WORDS), dtype=np.uint64)
    word = ((hashes.view(np.int64) >> 6) % WORDS).astype(np.int64)
    np.bitwise_xor.at(out.ravel(), doc * WORDS + word, np.uint64(1) << (hashes & np.uint64(63)))
    return out


def _held(node: np.ndarray, root: np.ndarray, n: np.ndarray, bits: np.ndarray, part: np.ndarray, percent: int) -> list[tuple[np.ndarray, ...]]:
    """(a, b, off, ra, rb) of one group's rows: part 0 against part 1, or all against each other if there is no part 1."""
    left = np.flatnonzero(part == 0)
    right = left if len(left) == len(part) else np.flatnonzero(part == 1)
    out = []
    for k in left:
        to = right[(node[right] > node[k]) | (right is not left)]
        to = to[(root[to] != root[k]) & (np.minimum(n[to], n[k]) * 100 >= np.maximum(n[to], n[k]) * percent)]
        if len(to):
            apart = np.bitwise_count(bits[to] ^ bits[k]).sum(axis=1, dtype=np.int64)
            may = apart * (100 + percent) <= (n[to] + n[k]) * (100 - percent)
            to, apart = to[may], apart[may]
            less = node[k] < node[to]
            out.append((np.minimum(node[to], node[k]), np.maximum(node[to], node[k]), apart / (n[to] + n[k]), np.where(less, root[k], root[to]), np.where(less, root[to], root[k])))
    return out


def held_apart(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """What ``components.block_pairs`` gives, in Arrow batches.

    The members of a bucket are dealt to blocks, and every two blocks meet in a group of two blocks at most.
    """
    rows = members.select("bucket", "node", "root").join(sketches, "node")
    sized = rows.join(members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "bucket")
    mine = sized.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = mine.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    words, kinds = [f"w{k}" for k in range(WORDS)], (np.int64, np.int64, np.float64, np.int64, np.int64)
    dealt = dealt.select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).cast("int").alias("part"), "node", "root", "n", *words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(t: pa.Table) -> pa.RecordBatch:
            node, root, n, part = (t.column(c).to_numpy() for c in ("node", "root", "n", "part"))
            bits = np.stack([t.column(w).to_numpy() for w in words], axis=1).view(np.uint64)
            ends = np.append(changes(t), len(t))
            got = [x for s, e in zip(ends, ends[1:]) for x in _held(node[s:e], root[s:e], n[s:e], bits[s:e], part[s:e], percent)]
            columns = zip(*got) if got else [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, kind), *c])) for c, kind in zip(columns, kinds)], names=["a", "b", "off", "ra", "rb"])

        def changes(t: pa.Table) -> np.ndarray:
            new = np.zeros(len(t), dtype=bool)
            new[:1] = True
            for c in ("bucket", "i", "j"):
                x = t.column(c).to_numpy()
                new[1:] |= x[1:] != x[:-1]
            return np.flatnonzero(new)

        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            last = changes(t)[-1] if len(t) else 0
            yield found(t.slice(0, last))
            rest = t.slice(last)
        if rest is not None:
            yield found(rest)

    grouped = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return grouped.mapInArrow(run, "a long, b long, off double, ra long, rb long").distinct()


def features(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, node, bands, own, w0, w1, ...) of every row.

    ``node`` stands for the shingle set: a 64-bit digest of it (null: an empty set). Two of m distinct
    sets share a digest with a chance of m * m / 2 ** 65. The words are the set's bit table; ``own``
    is the text where the id is null, since it can't be fetched by id.
    """
    words_ = [f"w{k}" for k in range(WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACE)
        for b in slices(batches, "text"):
            words, starts = hasher.words(b.column("text"))
            doc, hashes = shingle_table(words, starts, shingle)
            n = len(b)
            counts, node = digests(doc, hashes, n)
            keys, bits = band_keys(signatures(doc, hashes, n)), bit_tables(doc, hashes, n).view(np.int64)
            some = counts > 0
            own = [t if i is None else None for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())] if b.column("doc_id").null_count else [None] * n
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(node, pa.int64(), mask=~some), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * BANDS)]), pa.int32()), pa.array(keys[some].view(np.int64).ravel())), pa.array(own, pa.string()), *(pa.array(np.ascontiguousarray(bits[:, k])) for k in range(WORDS))],
                names=["doc_id", "n_shingles", "node", "bands", "own", *words_],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, node long, bands array<long>, own string, " + ", ".join(f"{w} long" for w in words_))


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Of pairs (a, b) those with 100 * intersection >= percent * union, on the full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACE)

        def sets(column):
            for one in slices(iter([pa.RecordBatch.from_arrays([column], names=["text"])]), "text"):
                words, starts = hasher.words(one.column("text"))
                doc, hashes = shingle_table(words, starts, shingle)
                at = np.searchsorted(doc, np.arange(len(one) + 1))
                yield from (hashes[i:j] for i, j in zip(at, at[1:]))

        for b in batches:
            keep = []
            for x, y in zip(sets(b.column("text_a")), sets(b.column("text_b"))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(len(x) and len(y)) and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are cut at blanks and bytes 9 to 13; A-Z count as a-z. Documents are linked whose sets of
    distinct shingles have 100 * intersection >= percent * union; ``component_id`` is the least id
    reachable by links, ``kept`` says whether it is the row's own. Texts without words (null, empty)
    are linked with nothing. Rows with equal ids share their fate only if their texts are linked. A
    null id is nobody's least id: such a row is kept only if all of its component's ids are null. Texts of any
    length are compared whole, a task holds one of them at a time or two that it confirms; an empty table gives no rows.
    """
    feats = written(features(docs, shingle, id_col, text_col), "features")
    some = feats.where("node is not null")
    words = [f"w{k}" for k in range(WORDS)]
    # Copies have one node: from here on rows are distinct sets.
    classes = written(some.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), *(F.first(w).alias(w) for w in words)), "classes")
    pairs, members = (written(x, name) for x, name in zip(shared_buckets(classes.select(F.explode("bands").alias("bucket"), "node")), ("candidates", "members")))

    # The texts of all nodes that share a bucket with another, fetched once.
    wanted = classes.join(nodes_of(pairs, members), "node").select("node", "least")
    by_id = docs.select(F.col(id_col).cast("long").alias("least"), F.col(text_col).alias("text")).join(wanted.where("least is not null"), "least").select("node", "text")
    by_row = some.where("own is not null").select("node", F.col("own").alias("text")).join(wanted.where("least is null").select("node"), "node")
    texts = written(_rightful(by_id.unionByName(by_row), shingle), "texts")

    sketches = classes.select("node", "n", *words)
    likely = sifted(pairs, sketches, WORDS, percent).select("a", "b")
    roots = linked_classes(likely, members, lambda nodes: sketches.join(nodes, "node", "left_semi"), lambda some: confirmed(some, texts, shingle, percent), WORDS, percent, lambda rest, tables: held_apart(rest, tables, percent))
    named = classes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = written(named.join(names, "root").select("node", "component_id"), "named")
    # Rows without words have no node: each is its own component.
    some = some.select("doc_id", "n_shingles", "node").join(by_node, "node").select("doc_id", "n_shingles", "component_id")
    none = feats.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _rightful(found: DataFrame, shingle: int) -> DataFrame:
    """Of (node, text) the rows whose text has the node's digest (ids may repeat), one per node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACE)
        for b in slices(batches, "text"):
            words, starts = hasher.words(b.column("text"))
            doc, hashes = shingle_table(words, starts, shingle)
            yield b.filter(pa.array(digests(doc, hashes, len(b))[1] == b.column("node").to_numpy()))

    return found.select("node", "text").mapInArrow(run, "node long, text string").dropDuplicates(["node"])
