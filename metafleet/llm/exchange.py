"""Totals of keys over a whole corpus, looked up for every chunk of it.

A chunk names its distinct keys once, with their counts. Keys are 64-bit numbers, evenly spread, and dealt by
their leading bits into buckets of about ``KEYS`` keys, however large the corpus is: a bucket adds up what
all chunks say of its keys and answers each. A frequent key is one key of each chunk, so a bucket isn't hot.
Keys and numbers travel packed: sorted differences in planes of bytes, compressed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Keys of a bucket, about.
KEYS = 1 << 20


def packed(x: np.ndarray) -> bytes:
    """An array of whole numbers, plane by plane of their bytes."""
    x = np.ascontiguousarray(x)
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T), codec="zstd", asbytes=True) if len(x) else b""


def unpacked(blob: bytes, n: int, kind) -> np.ndarray:
    kind = np.dtype(kind)
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(blob, n * kind.itemsize, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).reshape(n)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpacked(blob, n, np.uint64), dtype=np.uint64)


def bucket_bits(keys: int) -> int:
    """Leading bits that deal so many keys into buckets of about ``KEYS``."""
    return max(0, -(-keys // KEYS) - 1).bit_length()


def by_bucket(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, end) of the stretches of sorted keys."""
    if not len(keys):
        return
    bucket = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
    for s, e in zip(cuts, cuts[1:]):
        yield int(bucket[s]), s, e


REQUEST = "bucket long, chunk long, kind int, n int, keys binary, counts binary"


def request_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["bucket", "chunk", "kind", "n", "keys", "counts"])


def request_rows(chunk: int, kind: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> list[tuple]:
    """What a chunk asks: its distinct keys in order with their counts. ``kind`` tells apart what answers need told apart."""
    return [(bucket, chunk, kind, e - s, packed_keys(keys[s:e]), packed(counts[s:e].astype(np.uint32))) for bucket, s, e in by_bucket(keys, bits)]


class Bucket:
    """The requests of one bucket: ``keys``, distinct and sorted, and for each request where its keys are among them."""

    def __init__(self, table: pa.Table):
        self.chunk, self.kind, sizes = (table.column(c).to_pylist() for c in ("chunk", "kind", "n"))
        columns = zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), sizes)
        parts = [(unpacked_keys(k, n), unpacked(c, n, np.uint32)) for k, c, n in columns]
        self.ends = np.cumsum([0, *sizes])
        self.keys, self.back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        self.counts = np.concatenate([c for _, c in parts]).astype(np.float64)

    def total(self, kinds: set[int] | None = None) -> np.ndarray:
        """The sum of each key's counts, over requests of some kinds or all. Exact up to 2 ** 53."""
        weights = self.counts if kinds is None else self.counts * np.repeat([k in kinds for k in self.kind], np.diff(self.ends))
        return np.bincount(self.back, weights=weights, minlength=len(self.keys)).astype(np.int64)

    def each(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(chunk, kind, where its keys are in ``keys``) of each request."""
        for k, (chunk, kind) in enumerate(zip(self.chunk, self.kind)):
            yield chunk, kind, self.back[self.ends[k] : self.ends[k + 1]]


def answers(requests: DataFrame, answer: Callable[[Bucket], pa.Table], schema: str) -> DataFrame:
    """The answers of all buckets; ``answer`` sees a bucket's requests together."""
    return requests.groupBy("bucket").applyInArrow(lambda table: answer(Bucket(table)), schema)


def pieces(data: bytes, ends, most: int) -> Iterator[bytes]:
    """The bytes cut before a match of ``ends`` (a compiled pattern) where ``most`` or more have come together."""
    at = 0
    while len(data) - at > most and (m := ends.search(data, at + most)):
        yield data[at : m.start()]
        at = m.start()
    yield data[at:]
