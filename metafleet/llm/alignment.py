"""Alignment of two tokenizers' tokens by whitespace-token anchors (operator 11).

A text is tokenised whole by both. Where an A token and a B token end at one byte and both next tokens begin
with a blank, the text has an anchor; anchors cut it into windows of token ids, short ones as a rule, and the
alignment of a window is kept by its two tuples of ids. The counts of linked pairs of ids are added up over the
corpus in buckets of B ids, so that a pair's count and its B id's highest are known in one place (``exchange``).
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.llm import exchange
from metafleet.llm.bpe import byte_symbols
from metafleet.llm.shared import written
from metafleet.llm.wordhash import slices

#: Bytes of text in a chunk, about; bytes of a text that are tokenised at once.
CHUNK, PIECE = 1 << 23, 1 << 20
#: Segments and windows of late that a task keeps, of each; as many older ones beside them.
KEPT = 160_000

#: Where no token of either tokenizer goes across: before blanks that follow something else than white space.
_CUT = re.compile(r"(?<=\S)(?= )")
#: Letters that all versions of Unicode have, with ASCII.
_PLAIN = re.compile("[\x00-\x7F\u00C0-\u017F]*")
_ODD = 0x9E3779B1
# Fixed value: the words of byte-level BPE.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokens:
    """Both tokenizers: ids of texts, and the bytes of every id."""

    def __init__(self, a_source: str, b_source: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_source)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_source)
        value = {s: k for k, s in enumerate(byte_symbols())}
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, k in vocab.items():
            self.a_bytes[k] = bytes(value[c] for c in token)
        piece = self.b.id_to_piece(list(range(self.b.get_piece_size())))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(piece)]
        #: A piece with a blank after another character would go across a cut: then texts aren't cut.
        self.cuts = not any(re.search("[^▁]▁", p) for p in piece)
        self.a_len, self.b_len = ([len(x) for x in t] for t in (self.a_bytes, self.b_bytes))
        self.a_size, self.b_size = np.array(self.a_len, np.int64), np.array(self.b_len, np.int64)
        self.a_blank, self.b_blank = (np.array([x[:1] == b" " for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.guard = len(self.b.encode("x"))
        self.fast = fast_form(self.a, a_source, self.a_bytes)
        self.segments, self.windows = Kept(), Kept()
        #: Segments whose tokens don't give their bytes.
        self.bad: set[str] = set()

    def learn(self, segments: list[str]) -> None:
        """Tokenises segments that aren't kept yet: A's ids and B's ids.

        Segments that end with something else than white space are tokenised as one text, since no token goes from one to the next;
        A's fast form takes those of plain letters, where its words are the same in all versions of Unicode.
        """
        inner = [s for s in segments if not s[-1].isspace()] if self.cuts else []
        plain = [s for s in inner if s.isascii() or _PLAIN.fullmatch(s)] if self.fast else []
        a = self._split(self.fast.encode_ordinary("".join(plain)), self.a_size, plain) if plain else {}
        rest = segments if not a else [s for s in segments if s not in a] if len(a) < len(segments) else []
        if rest:
            a |= {s: array("i", e.ids).tobytes() for s, e in zip(rest, self.a.encode_batch_fast(rest, add_special_tokens=False))}
        # After the guard B adds no blank of its own, also where nothing but blanks is left.
        b = self._split(self.b.encode("x" + "".join(inner))[self.guard :], self.b_size, inner) if inner else {}
        rest = segments if not b else [s for s in segments if s not in b] if len(b) < len(segments) else []
        if rest:
            b |= {s: array("i", ids[self.guard :]).tobytes() for s, ids in zip(rest, self.b.encode(["x" + s for s in rest], num_threads=1))}
        found = [(a[s], b[s]) for s in segments]
        if not self.whole(b"".join([x for x, _ in found]), b"".join([y for _, y in found]), "".join(segments).encode()):
            self.bad.update(s for s, (x, y) in zip(segments, found) if not self.whole(x, y, s.encode()))
        self.segments.young.update(zip(segments, found))

    def _split(self, ids: list[int], size: np.ndarray, segments: list[str]) -> dict[str, bytes]:
        """The ids of each of several segments from those of all; nothing if they don't fall apart so."""
        raw = np.fromiter(ids, np.int32, len(ids))
        ends = np.cumsum(size[raw])
        cuts = np.cumsum([len(s) if s.isascii() else len(s.encode()) for s in segments])
        at = np.searchsorted(ends, cuts)
        if not len(ends) or ends[-1] != cuts[-1] or (ends[at] != cuts).any():
            return {}
        blob, bounds = raw.tobytes(), (4 * (at + 1)).tolist()
        return dict(zip(segments, map(blob.__getitem__, map(slice, [0, *bounds], bounds))))

    def ids(self, piece: str) -> list[tuple[bytes, bytes]] | None:
        """A's and B's ids of the segments of a piece that begins with a blank; None if the tokens don't give its bytes."""
        parts = _CUT.split(piece) if self.cuts else [piece]
        new = self.segments.lacking(parts)
        if new:
            self.learn(new)
        young = self.segments.young
        found = [young[s] for s in parts]
        good = not self.bad or self.bad.isdisjoint(parts) or self.whole(b"".join([x for x, _ in found]), b"".join([y for _, y in found]), piece.encode())
        for s in new:
            if len(s) > 200:
                del young[s]
                self.bad.discard(s)
        return found if good else None

    def whole(self, a: bytes, b: bytes, raw: bytes) -> bool:
        return all(b"".join(map(t.__getitem__, memoryview(x).cast("i").tolist())) == raw for t, x in ((self.a_bytes, a), (self.b_bytes, b)))

    def window(self, key: tuple[bytes, bytes]) -> str:
        """A window's groups as text, for its tuples of ids. Both sides end at one byte."""
        found = self.windows.old.get(key)
        if found is None:
            a, b = memoryview(key[0]).cast("i").tolist(), memoryview(key[1]).cast("i").tolist()
            a_len, b_len = [self.a_len[k] for k in a], [self.b_len[k] for k in b]
            found = ";".join(map("%d|%d".__mod__, zip(a, b))) if a_len == b_len else self._groups(a, b, a_len, b_len)
        if len(key[0]) + len(key[1]) <= 400:
            self.windows.young[key] = found
        return found

    def _groups(self, a: list[int], b: list[int], a_len: list[int], b_len: list[int]) -> str:
        text, i, j, x, y = [], 0, 0, 0, 0
        a_end, b_end, n = a_len[0], b_len[0], len(a)
        while True:
            if a_end == b_end:
                text.append(f"{a[x]}|{b[y]}" if i == x and j == y else ",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
                i, j = x, y = x + 1, y + 1
                if i == n:
                    return ";".join(text)
                a_end, b_end = a_end + a_len[i], b_end + b_len[j]
            elif a_end < b_end:
                x += 1
                a_end += a_len[x]
            else:
                y += 1
                b_end += b_len[y]

    def aligned(self, segments: list[tuple[bytes, bytes]]) -> tuple[int, int, list[str], np.ndarray]:
        """Tokens of A, of B, the windows' groups and the links' keys of a piece.

        A key is one pair of ids, one to one: the B id comes first, spread over all leading bits.
        """
        a_raw, b_raw = b"".join([x for x, _ in segments]), b"".join([y for _, y in segments])
        a, b = np.frombuffer(a_raw, np.int32), np.frombuffer(b_raw, np.int32)
        at_a, at_b = shared_ends(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))
        # Anchors: verified shared ends before tokens that begin with a blank in both, and the piece's end.
        anchor = np.ones(len(at_a), bool)
        anchor[:-1] = self.a_blank[a[at_a[:-1] + 1]] & self.b_blank[b[at_b[:-1] + 1]]
        keys = segments
        # Between segments there is an anchor; if there is no other one the windows are the segments.
        if np.count_nonzero(anchor) != len(segments):
            xs, ys = (4 * (at_a[anchor] + 1)).tolist(), (4 * (at_b[anchor] + 1)).tolist()
            keys = list(zip(map(a_raw.__getitem__, map(slice, [0, *xs], xs)), map(b_raw.__getitem__, map(slice, [0, *ys], ys))))
        self.windows.turn()
        get, window = self.windows.young.get, self.window
        links = (b[at_b].astype(np.uint64) * np.uint64(_ODD) & np.uint64(0xFFFFFFFF)) << np.uint64(32) | a[at_a].astype(np.uint64)
        return len(a), len(b), [get(key) or window(key) for key in keys], links


class Kept:
    """What was met of late: when ``KEPT`` things are young they are old, and what was old goes."""

    def __init__(self):
        self.young, self.old = {}, {}

    def turn(self) -> None:
        if len(self.young) > KEPT:
            self.young, self.old = {}, self.young

    def lacking(self, keys: list) -> list:
        """Those of the keys that aren't kept, each once; old ones become young."""
        self.turn()
        young, old, out = self.young, self.old, []
        for key in dict.fromkeys(keys):
            if key not in young:
                if key in old:
                    young[key] = old[key]
                else:
                    out.append(key)
        return out


def fast_form(tokenizer, source: str, token_bytes: list[bytes]):
    """The same byte-level BPE by ranks, which is faster, or None where that isn't sure to give the same ids of ASCII texts.

    Merging the neighbours of the lowest rank does what the merges do if ranks follow the merges and the merges make every token
    of its own bytes: then two neighbours that make up a token are always the two that its merge names.
    """
    import tiktoken

    spec = json.loads(source)
    model, steps = spec["model"], [spec["pre_tokenizer"]]
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    known = steps[0]["type"] == "ByteLevel" and steps[0].get("use_regex", True) and not steps[0].get("add_prefix_space") and not spec["normalizer"]
    if not known or made != sorted(set(made)) or len(made) + 256 != len(model["vocab"]) - sum(t["content"] in model["vocab"] for t in spec["added_tokens"]):
        return None
    special = {t["content"] for t in spec["added_tokens"]}
    if any(len(tokenizer.model.tokenize(t)) != 1 for t in model["vocab"] if t not in special):
        return None
    ranks = {token_bytes[k]: k for t, k in model["vocab"].items() if t not in special}
    return tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


def shared_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in two ascending lists of ends at which both end at one byte."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    hit = b[at] == a
    return np.flatnonzero(hit), at[hit]


def shared_tokens(a_source: str, b_source: bytes) -> Tokens:
    """The tokenizers of two sources, loaded once in each Python worker."""
    held = sys.modules.setdefault("_metafleet_pair", types.ModuleType("_metafleet_pair")).__dict__
    if held.get("sources") != (a_source, b_source):
        held.update(sources=(a_source, b_source), tokens=Tokens(a_source, b_source))
    return held["tokens"]


def _pieces(text: str) -> Iterator[str]:
    """The text with a blank before it, in pieces that no token goes across."""
    text, at = " " + text, 0
    while len(text) - at > PIECE and (m := _CUT.search(text, at + PIECE)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def align_text(tokens: Tokens, text: str | None, keep: bool) -> tuple[int, int, int, str, np.ndarray, str | None]:
    """n_a, n_b, n_groups, groups_sha256, the links' keys in order, and with ``keep`` the groups as text."""
    none = 0, 0, 0, "", np.zeros(0, np.uint64), "" if keep else None
    if not text:
        return none
    digest, n_a, n_b, links, kept = sha256(), 0, 0, [], []
    for piece in _pieces(text) if tokens.cuts else [" " + text]:
        ids = tokens.ids(piece)
        if ids is None:
            return none
        a, b, found, keys = tokens.aligned(ids)
        groups = ";".join(found)
        digest.update((";" + groups if n_a else groups).encode())
        n_a, n_b = n_a + a, n_b + b
        links.append(keys)
        if keep:
            kept.append(groups)
    keys = np.concatenate(links)
    return n_a, n_b, len(keys), digest.hexdigest(), keys, ";".join(kept) if keep else None


_DOC = ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "groups")


def features(docs: DataFrame, a_source: str, b_source: bytes, keep: bool) -> DataFrame:
    """One row per chunk: its rows' own results as lists, the links' places among the chunk's distinct pairs, and these."""
    shared = docs.sparkSession.sparkContext.broadcast((a_source, b_source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, size, rows = shared_tokens(*shared.value), 0, []

        def chunk() -> pa.RecordBatch:
            links = np.concatenate([np.zeros(0, np.uint64), *(r[5] for r in rows)])
            keys, back = np.unique(links, return_inverse=True)
            lists = [[r[k] for r in rows] for k in (0, 1, 2, 3, 4, 6)]
            kinds = [pa.list_(t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())]
            arrays = [pa.array([x], kind) for x, kind in zip(lists, kinds)]
            rows.clear()
            blobs = [pa.array([exchange.packed(back.astype(np.uint32))], pa.binary()), pa.array([len(keys)], pa.int64()), pa.array([exchange.packed_keys(keys)], pa.binary())]
            return pa.RecordBatch.from_arrays([*arrays, *blobs], names=[*_DOC, "links", "n", "keys"])

        for b in slices(batches, "text"):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                rows.append((doc_id, *align_text(tokens, text, keep)))
                size += len(text or "")
                if size >= CHUNK or len(rows) >= 100_000:
                    yield chunk()
                    size = 0
        if rows:
            yield chunk()

    lists = ", ".join(f"{c} array<{'string' if c.startswith('groups') else 'long'}>" for c in _DOC)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"{lists}, links binary, n long, keys binary")
    return found.withColumn("chunk", F.monotonically_increasing_id())


def pair_answers(feats: DataFrame) -> DataFrame:
    """(chunk, bucket, n, counts, best): for the pairs that a chunk asks for, in the order of their keys, the corpus-wide count
    and whether it is its B id's highest."""
    bits = exchange.bucket_bits(feats.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, links, n, keys, total in zip(*(b.column(c).to_pylist() for c in ("chunk", "links", "n", "keys", "total"))):
                counts = np.bincount(exchange.unpacked(links, total, np.uint32), minlength=n)
                yield exchange.request_batch(exchange.request_rows(chunk, 0, exchange.unpacked_keys(keys, n), counts, bits))

    def answer(bucket: exchange.Bucket) -> pa.Table:
        n = bucket.total()
        b = bucket.keys >> np.uint64(32)
        first = np.flatnonzero(np.diff(b, prepend=b[0] ^ np.uint64(1)))
        best = n == np.repeat(np.maximum.reduceat(n, first), np.diff([*first, len(n)]))
        # A bucket's place orders the answers of a chunk as its keys.
        rows = [(chunk, int(bucket.keys[at[0]] >> np.uint64(1)), len(at), exchange.packed(n[at].astype(np.uint64)), exchange.packed(best[at].astype(np.uint8))) for chunk, _, at in bucket.each()]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["chunk", "first", "n", "counts", "best"])

    asked = feats.where("n > 0").select("chunk", "links", "n", "keys", F.expr("aggregate(n_groups, 0L, (s, x) -> s + x)").alias("total")).mapInArrow(ask, exchange.REQUEST)
    return exchange.answers(asked, answer, "chunk long, first long, n int, counts binary, best binary")


def align(docs: DataFrame, a_source: str, b_source: bytes, keep_groups: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_source``: a byte-level BPE as the tokenizers library writes it; ``b_source``: a SentencePiece model. Tokens that end at one
    byte are linked; the bytes between shared ends are a group. ``n_best`` links have the highest count of their
    B id over all of ``docs``, ties included; ``count_sum`` adds up the counts of all links. With ``keep_groups`` the
    groups themselves are a column, ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and those whose tokens don't give
    a blank and the text, have no tokens: 0 and ''. Texts of any length are tokenised whole, in pieces that
    no token goes across. Repeated rows count each for itself; an empty table gives no rows.
    """
    feats = written(features(docs, a_source, b_source, keep_groups), "aligned")
    found = pair_answers(feats)

    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return out_schema.empty_table()
        docs_ = {c: left.column(c)[0].values for c in _DOC}
        right = right.sort_by("first")
        part = lambda c, kind: np.concatenate([np.zeros(0, kind), *(exchange.unpacked(x, n, kind) for x, n in zip(right.column(c).to_pylist(), right.column("n").to_pylist()))])
        counts, best = part("counts", np.uint64), part("best", np.uint8)
        sizes = docs_["n_groups"].to_numpy(zero_copy_only=False)
        at = exchange.unpacked(left.column("links")[0].as_py(), int(sizes.sum()), np.uint32)
        ends = np.cumsum([0, *sizes])
        n_best, count_sum = (np.concatenate([[0], np.cumsum(x[at].astype(np.int64))]) for x in (best, counts))
        sums = [pa.array(x[ends[1:]] - x[ends[:-1]]) for x in (n_best, count_sum)]
        columns = [docs_["doc_id"], docs_["n_a"], docs_["n_b"], docs_["n_groups"], docs_["n_groups"], *sums, docs_["groups_sha256"], docs_["groups"]]
        return pa.Table.from_arrays(columns, schema=out_schema)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    out_schema = pa.schema([(c, pa.string() if c.startswith("groups") else pa.int64()) for c in names])
    joined = feats.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(rows, ", ".join(f"{c} {'string' if c.startswith('groups') else 'long'}" for c in names))
    return joined if keep_groups else joined.drop("groups")
