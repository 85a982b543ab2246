"""Hashes of words and of word n-grams for whole Arrow batches, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Bytes that end a word: the blank and 9 to 13.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
#: Of ASCII all but letters and digits, so that punctuation never tells words apart.
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[:128] = [not chr(b).isalnum() for b in range(128)]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Words of texts as 64-bit hashes; keeps tables of powers between batches."""

    def __init__(self, ends: np.ndarray = SPACE):
        self.ends = ends
        self.powers, self.inverses = _powers(_BASE, 1 << 12), _powers(_INVERSE, 1 << 12)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words in order, and where each text's words begin and end (len(texts) + 1).

        A-Z count as a-z. Null texts have no words.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        data = _LOWER[data]
        n = len(data)
        if n + 1 > len(self.powers):
            self.powers, self.inverses = _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
        inside = ~self.ends[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        first = np.flatnonzero(inside & (~before | edge[:n]))
        last = np.flatnonzero(inside & (~after | edge[1:])) + 1
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        hashes = mixed((sums[last] - sums[first]) * self.inverses[first])
        return hashes, np.searchsorted(first, offsets)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n-gram that begins at each word but the last n - 1."""
    out = np.zeros(max(len(words) - n + 1, 0), dtype=np.uint64)
    for k in range(n):
        out = (out + words[k : k + len(out)]) * np.uint64(_BASE)
    return mixed(out)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The batches cut where about ``most`` bytes of text have come together."""
    for b in batches:
        at, size = 0, 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(b.column(text)), 0).to_pylist()
        for k, n in enumerate(lengths):
            size += n
            if size >= most:
                yield b.slice(at, k + 1 - at)
                at, size = k + 1, 0
        if at < len(b):
            yield b.slice(at)
