"""Training-order materialisation (operator 2).

Token ids are cut into sequences of one length. Every sequence gets a global slot by a keyed Feistel
permutation of 0 to N - 1 (values beyond N - 1 walk on along their cycle), so the order is random, yet
computed for each sequence alone. Shards hold consecutive slots with a fixed stride: slot k lies at a
known byte of a known shard, so reading can stop and go on anywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.llm.matroska import _small
from metafleet.llm.wordhash import mixed

#: Byte-level ids: the bytes of UTF-8; two that UTF-8 never has end a text and fill the last sequence up.
END, FILL = 255, 254
#: Tokens of a sequence, bytes of a shard, bytes of a token id, rounds of the permutation.
LENGTH, SHARD_BYTES, WIDTH, ROUNDS = 1024, 64 << 20, 1, 6


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of indexes below n: a Feistel network over the next even number of bits, walked until below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mixed(right ^ k) & mask)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def byte_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the texts' UTF-8 bytes as ids of one byte, and ``END``.

    Null texts are empty ones, repeated rows have ids each; texts of any length are taken whole.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.concat(text, F.lit(bytes([END]))).alias("ids"))


def _order_sum(now: int, batch: pa.RecordBatch) -> int:
    """A checksum of rows in their order."""
    for i, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
        now = zlib.crc32(raw or b"", zlib.crc32(str(i).encode(), now))
    return now


def _partitions(tokens: DataFrame, stride: int) -> dict[int, tuple[int, int]]:
    """By partition: its number of sequences, and a checksum of its rows in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, order = 0, 0
        for b in batches:
            n += sum(-(-len(x) // stride) for x in b.column("ids").to_pylist() if x)
            order = _order_sum(order, b)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64()), pa.array([order], pa.int64())], names=["pid", "n", "order"])

    return {r.pid: (r.n, r.order) for r in tokens.mapInArrow(run, "pid int, n long, order long").collect()}


def training_order(tokens: DataFrame, key: int = 2024, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, width: int = WIDTH, fill: int = FILL) -> DataFrame:
    """(doc_id, seq_no, n_tokens, slot, shard, byte_offset, ids): all sequences, each shard's in slot order.

    ``tokens``: (doc_id, ids as little-endian numbers of ``width`` bytes); null or empty ids have no sequence.
    The last sequence of a row is filled up with ``fill``; ``n_tokens`` is its length without. Sequences are
    numbered by input partition, from one count per partition. A partition whose rows or their order differ
    between the two reads, as behind a shuffle, fails the run instead of giving two sequences one slot: give
    it a table. Repeated rows have sequences each; ids of any length are cut as a whole.
    """
    stride = width * length
    per_shard = max(1, shard_bytes // stride)
    tokens = tokens.select("doc_id", "ids")
    counts = _partitions(tokens, stride)
    total, starts = 0, {}
    for pid in sorted(counts):
        starts[pid], total = total, total + counts[pid][0]
    shared = tokens.sparkSession.sparkContext.broadcast((starts, counts))
    blank = fill.to_bytes(width, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        starts, counts = shared.value
        (n, order), at, now = counts.get(pid, (0, 0)), starts.get(pid, 0), 0
        end = at + n
        for b in _small(batches, 4 << 20):
            now = _order_sum(now, b)
            ids, rows, numbers, sizes = [], [], [], []
            for row, raw in enumerate(b.column("ids").to_pylist()):
                for no, k in enumerate(range(0, len(raw or b""), stride)):
                    part = raw[k : k + stride]
                    sizes.append(len(part) // width)
                    ids.append(zlib.compress(part))
                    rows.append(row)
                    numbers.append(no)
            if at + len(ids) > end:
                raise RuntimeError("the input's partitions changed between two reads; write it to a table first")
            slots = permute(np.arange(at, at + len(ids)), total, key)
            at += len(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(sizes, pa.int32()), pa.array(slots, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "seq_no", "n_tokens", "slot", "ids"]
            )
        if at != end or now != order:
            raise RuntimeError("the input's partitions changed between two reads; write it to a table first")

    placed = tokens.mapInArrow(run, "doc_id long, seq_no int, n_tokens int, slot long, ids binary")
    placed = placed.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("int"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [zlib.decompress(x) for x in b.column("ids").to_pylist()]
            ids = pa.array([x + blank * (length - len(x) // width) for x in parts], pa.binary())
            yield b.set_column(b.schema.get_field_index("ids"), "ids", ids)

    # Shards are consecutive slots of one size: each is a partition, and no sample is needed to find its range.
    # Packed one by one and not yet filled up, they move and are sorted: with the shards, raw ones would take the disk beyond its budget.
    ordered = placed.repartitionById(max(1, -(-total // per_shard)), F.col("shard")).sortWithinPartitions("shard", "slot")
    found = ordered.select("doc_id", "seq_no", "n_tokens", "slot", "shard", (F.col("slot") % per_shard * stride).alias("byte_offset"), "ids")
    return found.mapInArrow(whole, "doc_id long, seq_no int, n_tokens int, slot long, shard int, byte_offset long, ids binary")


def write_shards(ordered: DataFrame, path: str) -> DataFrame:
    """Writes each shard of ``training_order`` as ``path/shard-NNNNNNNN.bin``; returns all columns but ``ids``, and
    ``ids_crc32`` of each sequence as it is read back from its place in the file.

    ``path`` is a URI that all executors reach. A shard is written beside its name, read back and then moved,
    so that a lost task leaves no half of one. The files are written when the result is computed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        task, shard, out, rows = TaskContext.get().taskAttemptId(), None, None, []

        def close() -> Iterator[pa.RecordBatch]:
            if out is None:
                return
            out.close()
            name, sums = f"{root}/.{shard}-{task}", []
            with fs.open_input_file(name) as f:
                for offset, size in ((o, n) for b, n in rows for o in b.column("byte_offset").to_pylist()):
                    f.seek(offset)
                    sums.append(zlib.crc32(f.read(size)))
            fs.move(name, f"{root}/shard-{shard:08d}.bin")
            at = 0
            for b, _ in rows:
                yield b.append_column("ids_crc32", pa.array(sums[at : at + len(b)], pa.int64()))
                at += len(b)

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(batch)]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                b = batch.slice(a, z - a)
                if shards[a] != shard:
                    yield from close()
                    shard, rows = int(shards[a]), []
                    out = fs.open_output_stream(f"{root}/.{shard}-{task}")
                ids = b.column("ids").to_pylist()
                out.write(b"".join(ids))
                rows.append((b.drop_columns(["ids"]), len(ids[0])))
        yield from close()

    return ordered.mapInArrow(run, "doc_id long, seq_no int, n_tokens int, slot long, shard int, byte_offset long, ids_crc32 long")


def read_slots(path: str, slot: int, n: int, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, width: int = WIDTH) -> np.ndarray:
    """The n sequences from ``slot`` on, by seeking in the shards; fewer at the end."""
    stride = width * length
    per_shard = max(1, shard_bytes // stride)
    fs, root = pa.fs.FileSystem.from_uri(path)
    parts = []
    while n > 0:
        name = f"{root}/shard-{slot // per_shard:08d}.bin"
        if fs.get_file_info(name).type == pa.fs.FileType.NotFound:
            break
        take = min(n, per_shard - slot % per_shard)
        with fs.open_input_file(name) as f:
            f.seek(slot % per_shard * stride)
            got = f.read(take * stride)
        parts.append(np.frombuffer(got, f"<u{width}").reshape(-1, length))
        slot, n = slot + take, n - take
    return np.concatenate(parts) if parts else np.zeros((0, length), f"<u{width}")
