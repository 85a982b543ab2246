"""Benchmark decontamination by greedy string tiling (operator 4).

Documents and benchmark items that share a seed of ``SEED`` tokens are tiled: the longest matches of
unmarked tokens are found by Karp-Rabin hashes and marked, then the next longest, down to a seed's
length. The share of an item's tokens that tiles cover says whether the document holds it, in
whatever order its passages stand.

A match consists of seeds, so a document is cut down to the runs of tokens that may be seeds of the
benchmark before anything is shuffled; a bit table of fixed size, which every task holds, tells them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.llm.shared import written
from metafleet.llm.wordhash import PUNCTUATION, WordHasher, grams, slices

#: Tokens of a seed, the shortest tile; the share of an item's tokens that makes a leak.
SEED, COVERAGE = 4, 0.5
#: Bits of the table of seeds: 4 MB whatever the benchmark's size. A full table only filters less.
BITS = 1 << 25

_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def window_hashes(tokens: np.ndarray, n: int) -> np.ndarray:
    """The Karp-Rabin hash of every window of n tokens, from running sums."""
    if len(tokens) < n:
        return np.zeros(0, dtype=np.uint64)
    power = np.full(len(tokens) + 1, _BASE)
    power[0] = 1
    back = np.full(len(tokens) + 1, _INVERSE)
    back[0] = 1
    sums = np.zeros(len(tokens) + 1, dtype=np.uint64)
    np.cumsum(tokens * np.multiply.accumulate(power)[:-1], out=sums[1:])
    return (sums[n:] - sums[:-n]) * np.multiply.accumulate(back)[: len(tokens) - n + 1]


def tile(item: np.ndarray, doc: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: tiles (item position, document position, length), longest first.

    Tiles never overlap, in the item or in the document; ties go to the earliest positions.
    """
    item, doc, tiles, most = item.copy(), doc.copy(), [], len(item)
    fresh = iter(range(1, 2 * (len(item) + len(doc)) + 2))

    def common(n: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = window_hashes(item, n), window_hashes(doc, n)
        return np.flatnonzero(np.isin(a, b)), b

    while True:
        lo, hi = least - 1, most  # the longest match: common windows of a length contain those of any shorter
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if len(common(mid)[0]) else (lo, mid - 1)
        if lo < least:
            return tiles
        starts, hashes = common(lo)
        order = np.argsort(hashes, kind="stable")
        ranked, mine = hashes[order], window_hashes(item, lo)[starts]
        used_item, used_doc = np.zeros(len(item), dtype=bool), np.zeros(len(doc), dtype=bool)
        for p, h in zip(starts.tolist(), mine):
            if used_item[p : p + lo].any():
                continue
            for k in range(np.searchsorted(ranked, h), len(ranked)):
                if ranked[k] != h:
                    break
                q = int(order[k])
                if not used_doc[q : q + lo].any() and np.array_equal(item[p : p + lo], doc[q : q + lo]):
                    used_item[p : p + lo] = used_doc[q : q + lo] = True
                    tiles.append((p, q, lo))
                    break
        if not used_item.any():
            most = lo - 1
            continue
        # Marked tokens become values that match nothing.
        for x, used in ((item, used_item), (doc, used_doc)):
            at = np.flatnonzero(used)
            x[at] = np.fromiter((next(fresh) for _ in at), np.uint64, len(at))
        most = lo


def benchmark_tokens(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, tokens): the items' tokens as hashes; equal rows count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(PUNCTUATION)
        for b in slices(batches, "text"):
            words, starts = hasher.words(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(words.view(np.int64)))], names=["item_id", "tokens"])

    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.lower(text_col).alias("text")).distinct()
    return rows.mapInArrow(run, "item_id long, tokens array<long>")


def seed_table(lists: DataFrame, key: list[str]) -> DataFrame:
    """(key, seed): every seed in the lists of ``tokens``; lists of runs are split by nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(len(b)):
                one = b.slice(row, 1)
                tokens = one.column("tokens")[0].values.to_numpy(zero_copy_only=False).view(np.uint64)
                cut = one.column("cut")[0].as_py() if "cut" in b.schema.names else []
                bounds = [0, *cut, len(tokens)]
                seeds = np.concatenate([grams(tokens[i:j], SEED) for i, j in zip(bounds, bounds[1:])]) if len(tokens) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([*(pa.array([one.column(k)[0].as_py()] * len(seeds), one.column(k).type) for k in key), pa.array(seeds.view(np.int64))], names=[*key, "seed"])

    fields = ", ".join(f"{k} {dict(lists.dtypes)[k]}" for k in key)
    return lists.mapInArrow(run, f"{fields}, seed long")


def runs_of(docs: DataFrame, seeds: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, tokens, cut): of each document with seeds, the tokens of its runs of seeds, and where runs end."""
    bits = np.zeros(BITS // 8, dtype=np.uint8)
    places = seeds.select(F.pmod("seed", F.lit(BITS // 8)).alias("at"), F.pmod(F.shiftright("seed", 40), F.lit(8)).cast("int").alias("bit")).distinct()
    for r in places.groupBy("at").agg(F.sum(F.expr("shiftleft(1, bit)")).alias("byte")).toLocalIterator():
        bits[r["at"]] = r["byte"]
    table = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits = WordHasher(PUNCTUATION), table.value
        for b in slices(batches, "text"):
            words, starts = hasher.words(b.column("text"))
            seed = grams(words, SEED).view(np.int64)
            hit = np.zeros(len(words) + 1, dtype=bool)
            hit[: len(seed)] = bits[seed % len(bits)] >> ((seed >> 40) % 8).astype(np.uint8) & 1
            for back in range(1, SEED):  # no seed runs over a text's end
                ends = starts[1:] - back
                hit[ends[ends >= starts[:-1]]] = False
            at = np.flatnonzero(hit)
            rows, tokens, cuts = [], [], []
            text = np.searchsorted(starts, at, side="right") - 1
            for d, positions in zip(np.unique(text), np.split(at, np.flatnonzero(np.diff(text)) + 1)) if len(at) else ():
                runs = np.split(positions, np.flatnonzero(np.diff(positions) > 1) + 1)
                parts = [words[r[0] : r[-1] + SEED] for r in runs]
                rows.append(d)
                tokens.append(np.concatenate(parts).view(np.int64))
                cuts.append(np.cumsum([len(p) for p in parts])[:-1])
            picked = b.take(pa.array(np.array(rows, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays([picked.column("doc_id"), picked.column("text_key"), pa.array(tokens, pa.list_(pa.int64())), pa.array(cuts, pa.list_(pa.int32()))], names=["doc_id", "text_key", "tokens", "cut"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.lower(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, tokens array<long>, cut array<int>")


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, matched, item_tokens, coverage, tiles): the documents that hold a benchmark item.

    A row for each pair whose tiles cover ``coverage`` of the item's tokens or more. Tokens are letters
    and digits in lower case. Items of fewer tokens than a seed are never found, nor null texts; rows
    of documents with equal ids give one row for each item, the best. A null doc_id is an id like others. Texts of any
    length are read whole; of equally good rows of one id and item the one of more tiles counts. Without rows on either side
    there is no leak.
    """
    items = written(benchmark_tokens(benchmark, "item_id", "text").where(F.size("tokens") >= SEED), "items")
    seeds = written(seed_table(items, ["item_id"]).distinct(), "seeds")
    hits = runs_of(docs, seeds, id_col, text_col)
    hits = written(hits.dropDuplicates(["doc_id", "text_key"]).withColumn("row", F.xxhash64("doc_id", "text_key", F.lit(9))), "hits")
    # Tiles are made of shared seeds: too few of them can't cover enough.
    shared = seed_table(hits, ["row"]).join(seeds, "seed").groupBy("row", "item_id").agg(F.count("*").alias("n"))
    sized = shared.join(items.select("item_id", F.size("tokens").alias("item_tokens")).distinct(), "item_id")
    pairs = sized.where(F.col("n") * SEED >= F.col("item_tokens") * coverage).select("row", "item_id").distinct()
    both = pairs.join(hits, "row").join(items.withColumnRenamed("tokens", "item"), "item_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for tokens, cut, item in zip(b.column("tokens"), b.column("cut"), b.column("item")):
                tokens, item = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (tokens, item))
                # A value of its own between runs: no tile spans them.
                doc = np.insert(tokens, cut.as_py(), np.arange(len(cut), dtype=np.uint64) + np.uint64(1 << 62))
                found = tile(item, doc)
                out.append((sum(n for _, _, n in found), len(item), len(found)))
            matched, size, tiles = (list(c) for c in zip(*out)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("item_id"), pa.array(matched, pa.int32()), pa.array(size, pa.int32()), pa.array(tiles, pa.int32())], names=["doc_id", "item_id", "matched", "item_tokens", "tiles"])

    tiled = both.select("doc_id", "item_id", "tokens", "cut", "item").mapInArrow(run, "doc_id long, item_id long, matched int, item_tokens int, tiles int")
    found = tiled.withColumn("coverage", F.col("matched") / F.col("item_tokens")).where(F.col("coverage") >= coverage)
    best = F.max(F.struct("coverage", "matched", "item_tokens", "tiles")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.matched", "best.item_tokens", "best.coverage", "best.tiles")
