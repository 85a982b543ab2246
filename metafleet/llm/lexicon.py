"""A minimal acyclic transducer from words to lists of ids, laid out for memory mapping.

States with the same right language are one state (shared suffixes); the outputs on the arcs add up to
the word's number, which places its ids in a flat table. Lookup reads the mapped bytes only.
"""

from __future__ import annotations

import mmap
import struct
from bisect import bisect_left

import numpy as np


def compile_lexicon(words: list[tuple[bytes, bytes]]) -> bytes:
    """``words``: (word, its ids as little-endian uint32), distinct words in byte order.

    Builds the automaton incrementally: when the next word leaves a path, the path's states are
    replaced by registered states that accept the same suffixes.
    """
    register: dict[tuple, int] = {}
    arcs: list[tuple] = []  # by state: ((label, target), ...)
    final: list[bool] = []
    count: list[int] = []  # words that a state accepts

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        at = register.get(key)
        if at is None:
            at = register[key] = len(arcs)
            arcs.append(key[1])
            final.append(node[0])
            count.append(node[0] + sum(count[t] for _, t in key[1]))
        return at

    path: list[list] = [[False, []]]  # open states: is final, arcs that are settled
    last = b""
    for word, _ in words:
        if path[0][1] or len(path) > 1 or path[0][0]:
            if word <= last:
                raise ValueError("words must be distinct and in byte order")
        shared = 0
        for a, b in zip(word, last):
            if a != b:
                break
            shared += 1
        while len(path) - 1 > shared:
            target = settle(path.pop())
            path[-1][1].append((last[len(path) - 1], target))
        path += [[False, []] for _ in range(len(word) - shared)]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        target = settle(path.pop())
        path[-1][1].append((last[len(path) - 1], target))
    root = settle(path[0])

    first = np.cumsum([0, *map(len, arcs)]).astype("<u4")
    labels = bytearray()
    targets: list[int] = []
    outputs: list[int] = []
    for state, row in enumerate(arcs):
        passed = int(final[state])
        for label, target in row:
            labels.append(label)
            targets.append(target)
            outputs.append(passed)
            passed += count[target]
    ids = b"".join(x for _, x in words)
    starts = np.cumsum([0, *(len(x) // 4 for _, x in words)]).astype("<u4")
    head = struct.pack("<6I", root, len(arcs), len(targets), len(words), len(ids) // 4, 0)
    pad = bytes(-len(labels) % 4) + b""
    fin = bytes(final)
    return b"".join([head, first.tobytes(), np.array(targets, "<u4").tobytes(), np.array(outputs, "<u4").tobytes(), starts.tobytes(), ids, bytes(labels), pad, fin])


class Lexicon:
    """Lookup in the bytes of ``compile_lexicon``, in memory or mapped from a file."""

    def __init__(self, data):
        self.data = view = memoryview(data)
        self.root, states, arcs, words, ids, _ = struct.unpack_from("<6I", data)
        at = 24

        def take(n):
            nonlocal at
            out = view[at : at + 4 * n].cast("I")
            at += 4 * n
            return out

        self.first, self.targets, self.outputs, self.starts = take(states + 1), take(arcs), take(arcs), take(words + 1)
        self.ids_at, at = at, at + 4 * ids
        self.labels, at = at, at + arcs + (-arcs % 4)
        self.final = at
        self.words, self.states = words, states

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: bytes) -> bytes | None:
        """The word's ids as little-endian uint32, or None."""
        data, first, labels, state, number = self.data, self.first, self.labels, self.root, 0
        for c in word:
            lo, hi = labels + first[state], labels + first[state + 1]
            k = bisect_left(data, c, lo, hi)
            if k == hi or data[k] != c:
                return None
            k -= labels
            number += self.outputs[k]
            state = self.targets[k]
        if not data[self.final + state]:
            return None
        return bytes(data[self.ids_at + 4 * self.starts[number] : self.ids_at + 4 * self.starts[number + 1]])
