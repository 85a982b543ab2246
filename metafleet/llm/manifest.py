"""A Merkle manifest of a dataset by time-forward processing (operator 12).

Every node of the tree has a label that is greater than its children's: the place of its last leaf, then
its level. Going through the labels in order, a node sends its digest to its parent through a priority
queue ordered by the receiver's label, so that a parent finds its children's digests at the queue's head when
its turn comes. Going back in the opposite order, a parent sends each child what its proof ends with, until
the leaves have whole proofs.

The queue is external: what stays within a block of ``8 ** DEPTH`` leaves is a heap of a few entries in
the block's task; what leaves a block are rows, which the shuffle sorts by label and gives to the next round.
So no task holds more than a block, whatever a language's share of the rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metafleet.llm.shared import written
from metafleet.llm.wordhash import slices

#: Children of a node; levels of the tree within a block.
FAN, DEPTH = 8, 4
BLOCK = FAN**DEPTH
#: Runs of leaves that are sent to every task, at most (some 10 MB); more are joined by a shuffle.
SENT = 1 << 17


def _field(value) -> bytes:
    raw = value if isinstance(value, bytes) else str(value).encode()
    return b"%d:%s" % (len(raw), raw)


def leaf_digests(doc_id, source, lang, n_chars, text: bytes | None, tampered: bool) -> tuple[bytes, bytes | None]:
    """The digest of a row, and of the row with A-Z in its text as a-z if ``tampered``."""
    head = b"".join(b"-" if v is None else _field(v) for v in (doc_id, source, lang, n_chars))
    leaf = sha256(head + (b"-" if text is None else _field(text))).digest()
    other = None
    if tampered:
        other = leaf if text is None else sha256(head + _field(text.lower())).digest()
    return leaf, other


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, key, leaf, tampered) of every row; ``key`` orders the languages: '' for null, else 'x' and the name."""
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    key = F.coalesce(F.concat(F.lit("x"), "lang"), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            columns = [b.column(c).to_pylist() for c in ("doc_id", "source", "lang", "n_chars")]
            texts = b.column("text").cast(pa.large_binary()).to_pylist()
            found = [leaf_digests(*row) for row in zip(*columns, texts, b.column("third").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], names=["doc_id", "key", "leaf", "tampered"]
            )

    return docs.select("doc_id", "source", "lang", "n_chars", "text", key.alias("key"), third.alias("third")).mapInArrow(run, "doc_id long, key string, leaf binary, tampered binary")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``at``, a row's place among those of its ``key`` by ``order``, from 0 on, and ``n``, their number.

    Rows are dealt to ranges of (key, order), which split a key that holds most of the rows; each range counts
    its own, and the counts of the ranges before are added. Rows of equal order stand in the order of ``seq``.
    """
    spark = rows.sparkSession
    sorted_ = rows.repartitionByRange(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "key", *order, "seq").sortWithinPartitions("key", *order, "seq")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, 0
        for b in batches:
            if not len(b):
                continue
            keys = b.column("key").to_pylist()
            places = np.empty(len(b), np.int64)
            for k, key in enumerate(keys):
                at = at + 1 if key == last else 0
                last = key
                places[k] = at
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(places)], names=[*b.schema.names, "at"])

    fields = ", ".join(f"`{c}` {t}" for c, t in sorted_.dtypes)
    placed = written(sorted_.withColumn("range", F.spark_partition_id()).mapInArrow(number, f"{fields}, range int, at long"), "ranges")
    # A row for each language in each range: as many as ranges and languages together.
    runs = written(placed.groupBy("key", "range").agg(F.count("*").alias("rows")), "runs")
    each = Window.partitionBy("key")
    before = F.sum("rows").over(each.orderBy("range")) - F.col("rows")
    offsets = runs.select("key", "range", before.alias("before"), F.sum("rows").over(each).alias("n"))
    offsets = F.broadcast(offsets) if runs.count() <= SENT else offsets
    return placed.join(offsets, ["key", "range"]).withColumn("at", F.col("at") + F.col("before")).drop("range", "before", "seq")


def height(n: int) -> int:
    """Levels above ``n`` nodes, until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def sweep(digests: list[bytes], levels: int) -> Iterator[tuple[int, int, list[bytes], bytes]]:
    """(level, place, children's digests, digest) of all inner nodes over a block's leaves, in order of their labels.

    A node's label is (its last leaf, its level). Each node sends its digest to its parent's label; a parent's turn
    has come when no leaf before its label is left. The heap holds fewer than ``FAN`` entries a level.
    """
    queue: list[tuple[int, int, int, bytes]] = []
    last = len(digests) - 1

    def send(level: int, place: int, digest: bytes) -> None:
        if level < levels:
            up = place // FAN
            end = min((up + 1) * FAN ** (level + 1) - 1, last)
            heapq.heappush(queue, (end, level + 1, place, digest))

    for leaf, digest in enumerate(digests):
        send(0, leaf, digest)
        while queue and queue[0][0] <= leaf:
            label = queue[0][:2]
            children, place = [], queue[0][2] // FAN
            while queue and queue[0][:2] == label:
                children.append(heapq.heappop(queue)[3])
            made = sha256("".join(c.hex() for c in children).encode()).digest()
            yield label[1], place, children, made
            send(label[1], place, made)


def proofs(digests: list[bytes], levels: int, suffix: bytes) -> Iterator[tuple[int, bytes]]:
    """(leaf, proof) of a block's leaves, from the last to the first; ``suffix`` is what the block's top node was sent.

    A proof has for each level the number of siblings, the node's own place among them, and their digests.
    Labels go downwards here: each node takes its suffix from the queue and sends one to each of its children.
    """
    last = len(digests) - 1
    nodes = {(level, place): children for level, place, children, _ in sweep(digests, levels)}
    queue: list[tuple[int, int, int, bytes]] = [(-last, -levels, 0, suffix)]
    while queue:
        _, level, place, own = heapq.heappop(queue)
        level = -level
        if not level:
            yield place, own
            continue
        children = nodes[level, place]
        for k in range(len(children)):
            child = place * FAN + k
            end = min((child + 1) * FAN ** (level - 1) - 1, last)
            part = bytes((len(children) - 1, k)) + b"".join(children[:k] + children[k + 1 :])
            heapq.heappush(queue, (-end, 1 - level, child, part + own))


def proof_digest(proof: bytes) -> str:
    """The digest of all siblings in hex, from the leaf's level to the root's."""
    found, at = [], 0
    while at < len(proof):
        size = 32 * proof[at]
        found.append(proof[at + 2 : at + 2 + size].hex())
        at += 2 + size
    return sha256("".join(found).encode()).hexdigest()


def folded(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    at = 0
    while at < len(proof):
        n, k = proof[at], proof[at + 1]
        others = [proof[at + 2 + 32 * j : at + 34 + 32 * j] for j in range(n)]
        leaf = sha256("".join(d.hex() for d in (*others[:k], leaf, *others[k:])).encode()).digest()
        at += 2 + 32 * n
    return leaf


def _levels(n: int) -> int:
    """Levels that a block of a language with ``n`` nodes has: all of them if there is but one block."""
    return DEPTH if n > BLOCK else height(n)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each (key, block) of sorted batches; a block has ``BLOCK`` rows and a header at most."""
    rows: list[dict] = []
    for b in batches:
        for r in b.to_pylist():
            if rows and (r["key"], r["block"]) != (rows[0]["key"], rows[0]["block"]):
                yield rows
                rows = []
            rows.append(r)
    if rows:
        yield rows


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes with the block they lie in, dealt by block and in order."""
    return nodes.withColumn("block", F.floor(F.col("at") / BLOCK)).repartition("key", "block").sortWithinPartitions("key", "block", "at")


def block_tops(nodes: DataFrame) -> DataFrame:
    """(key, at, n, digest): the nodes over the blocks of (key, at, n, digest), numbered by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: list[tuple] = []
        for rows in _groups(batches):
            digests, n = [r["digest"] for r in rows], rows[0]["n"]
            top = digests[0]
            for _, _, _, made in sweep(digests, _levels(n)):
                top = made
            tops.append((rows[0]["key"], rows[0]["block"], -(-n // BLOCK), top))
            if len(tops) >= 1024:
                yield _batch(tops)
                tops = []
        yield _batch(tops)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["key", "at", "n", "digest"])

    return _blocks(nodes.select("key", "at", "n", "digest")).mapInArrow(run, "key string, at long, n long, digest binary")


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """The tables of block tops, from the lowest round to that in which every key has one node."""
    rounds, name = [], "tops"
    while True:
        nodes = written(block_tops(nodes), name)
        rounds.append(nodes)
        if nodes.where("n > 1").isEmpty():
            return rounds


def descended(nodes: DataFrame, rounds: list[DataFrame], suffixes: DataFrame) -> DataFrame:
    """(key, at, proof) of ``nodes`` from the ``suffixes`` (key, at, proof) of the last round's."""
    for below in (*reversed(rounds[:-1]), nodes):
        suffixes = written(block_proofs(below, suffixes), "suffixes")
    return suffixes


def block_proofs(nodes: DataFrame, suffixes: DataFrame, leaf: bool = False) -> DataFrame:
    """(key, at, proof) of nodes (key, at, n, digest) whose blocks' top nodes have ``suffixes`` (key, at, proof).

    With ``leaf`` the nodes also have doc_id and tampered, and the rows are those of the manifest but for the roots.
    """
    extra = ["doc_id", "tampered"] if leaf else []
    heads = suffixes.select("key", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), F.lit(None).cast("long").alias("n"), F.col("proof").alias("digest"), *((F.lit(None).cast(t).alias(c)) for c, t in zip(extra, ("long", "binary"))))
    rows = nodes.select("key", F.floor(F.col("at") / BLOCK).alias("block"), "at", "n", "digest", *extra)
    dealt = rows.unionByName(heads).repartition("key", "block").sortWithinPartitions("key", "block", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, *rows in _groups(batches):
            found = list(proofs([r["digest"] for r in rows], _levels(rows[0]["n"]), head["digest"]))[::-1]
            if not leaf:
                columns = {"key": [r["key"] for r in rows], "at": [r["at"] for r in rows], "proof": [p for _, p in found]}
                yield pa.RecordBatch.from_arrays([pa.array(columns["key"], pa.string()), pa.array(columns["at"], pa.int64()), pa.array(columns["proof"], pa.binary())], names=list(columns))
                continue
            roots = [folded(r["tampered"] or r["digest"], p).hex() for r, (_, p) in zip(rows, found)]
            strings = {"key": [r["key"] for r in rows], "leaf": [r["digest"].hex() for r in rows], "proof_sha256": [proof_digest(p) for _, p in found], "folded_root": roots}
            yield pa.RecordBatch.from_arrays([pa.array([r["doc_id"] for r in rows], pa.int64()), *(pa.array(v, pa.string()) for v in strings.values())], names=["doc_id", *strings])

    kind = "doc_id long, key string, leaf string, proof_sha256 string, folded_root string" if leaf else "key string, at long, proof binary"
    return dealt.mapInArrow(run, kind)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of doc_id, source, lang, n_chars and text (nulls are '-', so that a null is no empty
    text). The leaves of a language ascend by doc_id, null ids first; rows of one id by their digest, so
    repeated rows stand side by side, each with a proof of its own. Every ``FAN`` nodes become one until one is
    left, the language's subroot; the subroots, null language first, become the root likewise. Rows whose
    id's crc32 is divisible by 3 are checked with A-Z in their text made a-z: ``verified`` is false where that
    changes the text. An empty table has no rows and no root. Texts of any length are hashed whole; other columns of ``docs``
    are not looked at.
    """
    rows = written(leaves(docs).withColumn("seq", F.monotonically_increasing_id()), "leaves")
    placed = ranked(rows, ["doc_id", "leaf"]).withColumnRenamed("leaf", "digest")
    rounds = climbed(placed)
    # One node is left for each language. They are the leaves of the last tree, which has one key.
    subroots = rounds[-1].select(F.lit("").alias("key"), F.col("key").alias("lang"), "digest", F.lit(0).cast("long").alias("seq"))
    tops = written(ranked(subroots, ["lang"]), "subroots")
    upper = climbed(tops)
    start = upper[-1].select("key", F.lit(0).cast("long").alias("at"), F.lit(b"").alias("proof"))
    ends = descended(tops, upper, start)
    named = tops.join(ends, ["key", "at"]).select(F.col("lang").alias("key"), F.lit(0).cast("long").alias("at"), "proof")
    for below in reversed(rounds[:-1]):
        named = written(block_proofs(below, named), "suffixes")
    found = block_proofs(placed, named, leaf=True)
    names = tops.join(upper[-1].select("key", F.col("digest").alias("top")), "key").select(F.col("lang").alias("key"), F.lower(F.hex("digest")).alias("subroot"), F.lower(F.hex("top")).alias("root"))
    # A row for each language.
    return found.join(names, "key").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
