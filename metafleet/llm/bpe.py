"""BPE encoding and decoding with a lexicon of the corpus's frequent words (operator 7).

The words of the whole corpus are counted; the frequent ones are encoded once, and their ids are
compiled into a transducer (``lexicon``) that executors map into memory. Words it lacks are merged
exactly, so the ids never depend on the lexicon.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import sys
import types
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.llm.lexicon import Lexicon, compile_lexicon
from metafleet.llm.matroska import _small
from metafleet.llm.shared import new_path

#: Words of the lexicon at most, the most frequent ones; all others are merged when met.
LEXICON_WORDS = 1 << 18
#: Words that a task keeps with their ids before it starts afresh.
CACHE_WORDS = 400_000
#: Distinct words that a task counts before it hands the counts on.
COUNT_WORDS = 250_000

_NONE = 1 << 62


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Bpe:
    """The tables of a tokenizer file with NFC, white space folding, lower case and word ends."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + end] for s in symbols]
        # A pair's two ids as one number; its rank and what it becomes as another, so that the least comes first.
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left] << 32 | vocab[right]] = rank << 32 | vocab[left + right]
        #: The pattern takes a run of letters as one word.
        self.letters = r"[\p{L}]+" in split
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.raw = {i: i.to_bytes(4, "little") for i in self.token}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merged(self, ids: list[int]) -> list[int]:
        """Merges the pair of lowest rank, leftmost first, until none is left."""
        merges = self.merges
        if len(ids) <= 40:
            ranks = [merges.get(a << 32 | b, _NONE) for a, b in zip(ids, ids[1:])]
            while ranks:
                best = min(ranks)
                if best == _NONE:
                    break
                k = ranks.index(best)
                ids[k : k + 2] = [best & 0xFFFFFFFF]
                del ranks[k]
                if k:
                    ranks[k - 1] = merges.get(ids[k - 1] << 32 | ids[k], _NONE)
                if k < len(ranks):
                    ranks[k] = merges.get(ids[k] << 32 | ids[k + 1], _NONE)
            return ids
        n = len(ids)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found, k, ids[k], ids[k + 1]) for k in range(n - 1) if (found := merges.get(ids[k] << 32 | ids[k + 1])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            best, k, a, b = heapq.heappop(heap)
            j = right[k]
            if not alive[k] or ids[k] != a or j >= n or ids[j] != b:
                continue
            ids[k], alive[j] = best & 0xFFFFFFFF, False
            right[k] = right[j]
            if right[j] < n:
                left[right[j]] = k
            for p in (left[k], k):
                q = right[p] if p >= 0 else n
                if p >= 0 and q < n and (found := merges.get(ids[p] << 32 | ids[q])) is not None:
                    heapq.heappush(heap, (found, p, ids[p], ids[q]))
        return [x for k, x in enumerate(ids) if alive[k]]

    def encoded(self, piece: str) -> list[int]:
        """Ids of a normalised piece without white space."""
        out: list[int] = []
        inner = self.inner
        for word in (piece,) if self.letters and piece.isascii() and piece.isalpha() else self.words.findall(piece):
            raw = word.encode()
            ids = [inner[b] for b in raw]
            ids[-1] = self.last[raw[-1]]
            out += self.merged(ids)
        return out

    def packed(self, ids: list[int]) -> bytes:
        """Ids as little-endian uint32."""
        return b"".join([self.raw[i] for i in ids])

    def parts(self, text: str) -> Iterator[int | list[str]]:
        """Ids of special tokens that the text holds, and the normalised pieces between them."""
        for k, part in enumerate(self.cut.split(text) if self.cut and "<" in text else (text,)):
            yield self.special[part] if k % 2 else pieces(part)


def pieces(text: str) -> list[str]:
    """The text in NFC and lower case, split at Unicode white space."""
    if not text.isascii():
        # Lower case letter by letter: Python alone would write a final sigma.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    text = text.lower()
    # Python also splits at the four separators below, which are no Unicode white space.
    return regex.split(r"\p{White_Space}+", text) if re.search("[\x1c-\x1f]", text) else text.split()


def shared_bpe(source: str) -> Bpe:
    """The tables of a source, built once in each Python worker."""
    held = sys.modules.setdefault("_metafleet_tables", types.ModuleType("_metafleet_tables")).__dict__
    if held.get("source") != source:
        held.update(source=source, bpe=Bpe(source))
    return held["bpe"]


class _Pieces(dict):
    """By piece: its ids as little-endian uint32, from the lexicon or else by merging, and their tokens joined by blanks."""

    def __init__(self, bpe: Bpe, lexicon: Lexicon | None):
        self.bpe, self.lexicon = bpe, lexicon

    def __missing__(self, piece: str) -> tuple[bytes, str]:
        bpe = self.bpe
        packed = self.lexicon.get(piece.encode()) if self.lexicon else None
        if packed is None:
            ids = bpe.encoded(piece)
            packed = bpe.packed(ids)
        else:
            ids = struct.unpack(f"<{len(packed) // 4}I", packed)
        found = packed, " ".join([bpe.token[i] for i in ids])
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(piece) < 200:
            self[piece] = found
        return found


def word_counts(docs: DataFrame, source: str, text_col: str = "text") -> DataFrame:
    """(word, n): how often each piece without white space stands in the whole corpus."""

    shared = docs.sparkSession.sparkContext.broadcast(source)

    def count(batches):
        bpe, seen = shared_bpe(shared.value), Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return batch

        for b in batches:
            for text in b.column(0):
                for part in bpe.parts(text.as_py() or ""):
                    if not isinstance(part, int):
                        seen.update(part)
                if len(seen) >= COUNT_WORDS:
                    yield out()
        yield out()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, source: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compiles the ``words`` most frequent words (two times at least, 100 characters at most).

    The table is bounded by that parameter. Returns the name under which executors find the file.
    """

    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(source)

    def encode(batches):
        bpe = shared_bpe(shared.value)
        for b in batches:
            ids = [bpe.packed(bpe.encoded(w)) for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["word", "ids"])

    counts = word_counts(docs, source, text_col).where((F.col("n") >= 2) & F.length("word").between(1, 100))
    top = counts.orderBy(F.desc("n"), "word").limit(words).repartition(spark.sparkContext.defaultParallelism, "word")
    rows = sorted((r.word.encode(), bytes(r.ids)) for r in top.select("word").mapInArrow(encode, "word string, ids binary").toLocalIterator())
    path = new_path(spark, "lexicon")
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    stream = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(to)
    stream.write(compile_lexicon(rows))
    stream.close()
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def encode(docs: DataFrame, source: str, lexicon: str | None = None, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids): the ids of every whole text as little-endian uint32. Null texts are empty ones.

    ``source``: the tokenizer file's contents. ``lexicon``: what ``build_lexicon`` returned. With ``decoded``
    each row's ids are decoded in the same pass, as ``decode`` does. Repeated rows are encoded each for itself,
    texts of any length whole, one at a time; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(source)

    def run(batches):
        bpe = shared_bpe(shared.value)
        pieces_ = _Pieces(bpe, Lexicon.mapped(SparkFiles.get(lexicon)) if lexicon else None)
        for b in _small(batches, 4 << 20):
            out, back = [], []
            for text in b.column(1).to_pylist():
                found: list[tuple[bytes, str]] = []
                for p in bpe.parts(text or ""):
                    if isinstance(p, int):
                        found.append((bpe.raw[p], bpe.token[p]))
                    else:
                        found += map(pieces_.__getitem__, p)
                out.append(b"".join([x for x, _ in found]))
                if decoded:
                    # A piece without ids, such as an empty one at a text's end, has no tokens.
                    back.append(" ".join([t for x, t in found if x]))
            columns = {"doc_id": b.column(0), "ids": pa.array(out, pa.binary())} | ({"decoded": pa.array(back, pa.string())} if decoded else {})
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, ids binary" + ", decoded string" * decoded
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, source: str) -> DataFrame:
    """Adds ``decoded`` to (doc_id, ids): the tokens of the ids, joined by blanks. Unknown ids raise."""
    shared = encoded.sparkSession.sparkContext.broadcast(source)

    def run(batches):
        bpe = shared_bpe(shared.value)
        token = [bpe.token.get(i) for i in range(max(bpe.token) + 1)]
        for b in _small(batches, 2 << 20):
            out = [" ".join([token[i] for i in np.frombuffer(x, "<u4").tolist()]) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(out, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded string")
