"""Matroska columns (operator 3): write 8-bit sample tracks, parse files into packet tables.

The parser reads variable-length EBML elements of known and unknown size, clusters, SimpleBlocks
and BlockGroups with no, Xiph, EBML or fixed-size lacing, and cues. A packet is a track's frame with
its time and its byte range in the file, so a reader can fetch frames without parsing again.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element ids of EBML and Matroska, with their length markers.
EBML, DOC_TYPE, SEGMENT, INFO, TIMESTAMP_SCALE = 0x1A45DFA3, 0x4282, 0x18538067, 0x1549A966, 0x2AD7B1
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_TYPE, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x83, 0x86
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
DEFAULT_DURATION, BLOCK_DURATION = 0x23E383, 0x9B
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1

#: Samples of a frame, frames of a laced block, blocks of a cluster.
FRAME, LACE, BLOCKS = 1024, 8, 4
#: Samples a millisecond: a frame of FRAME samples lasts FRAME / RATE ms.
RATE = 8


class MatroskaError(ValueError):
    """The bytes are not a well-formed Matroska file."""


def size_bytes(n: int) -> bytes:
    """n as an EBML size of the least length; all ones are kept for unknown sizes."""
    k = 1
    while n >= (1 << (7 * k)) - 1:
        k += 1
    return (n | 1 << (7 * k)).to_bytes(k, "big")


def id_bytes(n: int) -> bytes:
    return n.to_bytes((n.bit_length() + 7) // 8, "big")


def element(kind: int, body: bytes) -> bytes:
    return id_bytes(kind) + size_bytes(len(body)) + body


def uint(kind: int, n: int) -> bytes:
    return element(kind, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def read_id(data, at: int) -> tuple[int, int]:
    first = data[at] if at < len(data) else 0
    k = 9 - first.bit_length()
    if not first or k > 4 or at + k > len(data):
        raise MatroskaError(f"no element id at byte {at}")
    return int.from_bytes(data[at : at + k], "big"), at + k


def read_size(data, at: int) -> tuple[int | None, int]:
    """A size and where it ends; None is the unknown size."""
    first = data[at] if at < len(data) else 0
    k = 9 - first.bit_length()
    if not first or at + k > len(data):
        raise MatroskaError(f"no size at byte {at}")
    n = int.from_bytes(data[at : at + k], "big") & ((1 << (7 * k)) - 1)
    return (None if n == (1 << (7 * k)) - 1 else n), at + k


def _lacing(sizes: list[int], kind: int) -> bytes:
    """The frame count less one, and the sizes of all frames but the last, as lacing kind has them."""
    out = bytearray([len(sizes) - 1])
    if kind == 1:
        for n in sizes[:-1]:
            out += b"\xff" * (n // 255) + bytes([n % 255])
    elif kind == 3 and len(sizes) > 1:
        out += size_bytes(sizes[0])
        for a, b in zip(sizes, sizes[1:-1]):
            k = 1
            while abs(b - a) >= (1 << (7 * k - 1)) - 1:
                k += 1
            out += ((b - a + (1 << (7 * k - 1)) - 1) | 1 << (7 * k)).to_bytes(k, "big")
    return bytes(out)


def _block(track: int, time: int, frames: list[bytes]) -> bytes:
    """A block's body: one frame without lacing, equal frames with fixed-size lacing, else EBML or Xiph lacing by turns."""
    kind = 0
    if len(frames) > 1:
        kind = 2 if len({len(f) for f in frames}) == 1 else 3 if len(frames) % 2 else 1
    head = size_bytes(track) + time.to_bytes(2, "big", signed=True) + bytes([0x80 | kind << 1])
    return head + (_lacing([len(f) for f in frames], kind) if kind else b"") + b"".join(frames)


def mux(payload: bytes) -> bytes:
    """A Matroska file with the payload as one track of unsigned 8-bit samples, laced, with cues."""
    head = element(EBML, element(DOC_TYPE, b"matroska"))
    audio = element(AUDIO, element(SAMPLING_FREQUENCY, b"\x45\xfa\x00\x00") + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))
    frame = uint(DEFAULT_DURATION, FRAME * 1_000_000 // RATE)
    track = element(TRACK_ENTRY, uint(TRACK_NUMBER, 1) + uint(TRACK_TYPE, 2) + frame + element(CODEC_ID, b"A_PCM/INT/LIT") + audio)
    body = bytearray(element(INFO, uint(TIMESTAMP_SCALE, 1_000_000)) + element(TRACKS, track))
    cues, span = bytearray(), FRAME * LACE
    for start in range(0, len(payload), span * BLOCKS):
        time = start // RATE
        cluster = bytearray(uint(TIMESTAMP, time))
        for k, at in enumerate(range(start, min(len(payload), start + span * BLOCKS), span)):
            part = payload[at : at + span]
            block = _block(1, at // RATE - time, [part[i : i + FRAME] for i in range(0, len(part), FRAME)])
            cluster += element(BLOCK_GROUP, element(BLOCK, block)) if k % 2 else element(SIMPLE_BLOCK, block)
        cues += element(CUE_POINT, uint(CUE_TIME, time) + element(CUE_TRACK_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER_POSITION, len(body))))
        body += element(CLUSTER, bytes(cluster))
    body += element(CUES, bytes(cues))
    return head + element(SEGMENT, bytes(body))


def _frames(data, at: int, end: int) -> tuple[int, int, list[tuple[int, int]]]:
    """Of a block's body: its track, its time in the cluster, each frame's first byte and size."""
    track, at = read_size(data, at)
    if at + 3 > end:
        raise MatroskaError("a block is cut off")
    time, kind, at = int.from_bytes(data[at : at + 2], "big", signed=True), data[at + 2] >> 1 & 3, at + 3
    if not kind:
        return track, time, [(at, end - at)]
    n, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if kind == 1:
        for _ in range(n - 1):
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    elif kind == 3 and n > 1:
        size, at = read_size(data, at)
        sizes.append(size)
        for _ in range(n - 2):
            k = 9 - data[at].bit_length()
            size += (int.from_bytes(data[at : at + k], "big") & ((1 << (7 * k)) - 1)) - ((1 << (7 * k - 1)) - 1)
            sizes.append(size)
            at += k
    elif kind == 2:
        sizes = [(end - at) // n] * (n - 1)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise MatroskaError("a block's lacing exceeds it")
    out = []
    for size in sizes:
        out.append((at, size))
        at += size
    return track, time, out


def _elements(data, at: int, end: int, stop=frozenset()) -> Iterator[tuple[int, int, int, int]]:
    """(id, first byte, body's first byte, end) of the elements from at to end; an unknown size ends at a sibling in stop."""
    while at < end:
        start = at
        kind, at = read_id(data, at)
        size, at = read_size(data, at)
        to = end if size is None else at + size
        if size is None and kind == CLUSTER:
            to = at
            while to < end:
                inner, p = read_id(data, to)
                if inner in stop:
                    break
                n, p = read_size(data, p)
                if n is None:
                    raise MatroskaError(f"nested unknown size at byte {to}")
                to = p + n
        if to > end:
            raise MatroskaError(f"element {kind:x} at byte {start} exceeds its parent")
        yield kind, start, at, to
        at = to


def demux(data) -> tuple[list[tuple[int, int, int, int, int, bool]], list[tuple[int, int, int]]]:
    """Packets (cluster, track, time in ms, first byte, size, is laced) and cues (time, track, cluster's byte).

    A block has one time; the frames laced in it follow each other by the track's default duration, or
    else by equal parts of the block's duration. Without either all have the block's time.
    """
    packets: list[tuple[int, int, int, int, int, bool]] = []
    cues: list[tuple[int, int, int]] = []
    number = lambda a, b: int.from_bytes(data[a:b], "big")
    for kind, _, at, end in _elements(data, 0, len(data)):
        if kind != SEGMENT:
            continue
        segment, clusters, scale = at, -1, 1_000_000
        lasts: dict[int, int] = {}
        for kind, _, at, end in _elements(data, at, end, {CLUSTER, CUES, TRACKS, INFO}):
            if kind == INFO:
                scale = next((number(a, b) for k, _, a, b in _elements(data, at, end) if k == TIMESTAMP_SCALE), scale)
            elif kind == TRACKS:
                for k, _, a, b in _elements(data, at, end):
                    if k == TRACK_ENTRY:
                        found = {x: number(c, d) for x, _, c, d in _elements(data, a, b) if x in (TRACK_NUMBER, DEFAULT_DURATION)}
                        lasts[found.get(TRACK_NUMBER, 0)] = found.get(DEFAULT_DURATION, 0)
            elif kind == CLUSTER:
                clusters, base = clusters + 1, 0
                for kind, _, a, b in _elements(data, at, end):
                    if kind == TIMESTAMP:
                        base = number(a, b)
                    span = 0
                    if kind == BLOCK_GROUP:
                        group = {k: (c, d) for k, _, c, d in _elements(data, a, b)}
                        a, b = group.get(BLOCK, (0, 0))
                        span = number(*group[BLOCK_DURATION]) * scale if BLOCK_DURATION in group else 0
                    if b and kind in (SIMPLE_BLOCK, BLOCK_GROUP):
                        track, time, frames = _frames(data, a, b)
                        step = lasts.get(track, 0) or span // len(frames)
                        for k, (p, size) in enumerate(frames):
                            packets.append((clusters, track, ((base + time) * scale + k * step) // 1_000_000, p, size, len(frames) > 1))
            elif kind == CUES:
                for kind, _, a, b in _elements(data, at, end):
                    if kind == CUE_POINT:
                        time, spots = 0, []
                        for k, _, c, d in _elements(data, a, b):
                            if k == CUE_TIME:
                                time = number(c, d)
                            elif k == CUE_TRACK_POSITIONS:
                                spots.append({x: number(e, f) for x, _, e, f in _elements(data, c, d)})
                        cues += [(time, s.get(CUE_TRACK, 0), segment + s.get(CUE_CLUSTER_POSITION, 0)) for s in spots]
    return packets, cues


def payload_of(text: str | None) -> bytes:
    """UTF-8 bytes, then bytes 0 up to a positive multiple of 64."""
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % 64 or (0 if raw else 64))


PACKET = "struct<cluster:int,track:int,time_ms:long,first_byte:long,n_bytes:long,laced:boolean>"
_PACKETS = pa.list_(pa.struct([("cluster", pa.int32()), ("track", pa.int32()), ("time_ms", pa.int64()), ("first_byte", pa.int64()), ("n_bytes", pa.int64()), ("laced", pa.bool_())]))
_CUES = pa.list_(pa.struct([("time_ms", pa.int64()), ("track", pa.int32()), ("first_byte", pa.int64())]))


def _small(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut to about ``most`` bytes, so that a task holds few files at a time."""
    for batch in batches:
        rows = max(1, int(len(batch) * most / max(batch.nbytes, 1)))
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def media_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): every text's payload as a Matroska file.

    Null texts are empty ones; repeated rows have files each, equal ones; an empty table gives none. A task holds a few MB of texts at a
    time, or one text if that is longer, and its file.
    """

    def write(batches):
        for b in _small(batches, 4 << 20):
            texts = b.column(1).to_pylist()
            raw = [len((t or "").encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.int64()), pa.array([mux(payload_of(t)) for t in texts], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(write, "doc_id long, n_bytes long, media binary")


def packet_lists(media: DataFrame) -> DataFrame:
    """Adds to (doc_id, ..., media) the list of packets and of cues that the parser finds in the bytes.

    Null media have null lists; bytes that aren't Matroska too, with the reason in ``error``.
    """

    def parse(batches):
        for b in _small(batches, 4 << 20):
            packets, cues, errors = [], [], []
            for data in b.column("media").to_pylist():
                try:
                    p, c = (None, None) if data is None else demux(data)
                    errors.append(None)
                except (MatroskaError, IndexError) as e:
                    p, c = None, None
                    errors.append(str(e))
                packets.append(p and [dict(zip(("cluster", "track", "time_ms", "first_byte", "n_bytes", "laced"), x)) for x in p])
                cues.append(c and [dict(zip(("time_ms", "track", "first_byte"), x)) for x in c])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(packets, _PACKETS), pa.array(cues, _CUES), pa.array(errors, pa.string())], names=[*b.schema.names, "packets", "cues", "error"])

    schema = ", ".join(f"`{c}` {t}" for c, t in media.dtypes)
    return media.mapInArrow(parse, f"{schema}, packets array<{PACKET}>, cues array<struct<time_ms:long,track:int,first_byte:long>>, error string")


def packet_table(media: DataFrame) -> DataFrame:
    """One row per packet: doc_id, cluster, track, time, byte range, laced."""
    return packet_lists(media).select("doc_id", F.posexplode("packets").alias("packet", "p")).select("doc_id", "packet", "p.*")


def read_back(parsed: DataFrame) -> DataFrame:
    """Reads every packet's byte range from the media bytes; the digests of what was stored."""

    def digest(batches):
        for b in batches:
            out = []
            for data, packets in zip(b.column("media").to_pylist(), b.column("packets").to_pylist()):
                got = b"".join(data[p["first_byte"] : p["first_byte"] + p["n_bytes"]] for p in packets or ())
                out.append((len(got), hashlib.sha256(got).hexdigest(), zlib.crc32(got[-64:]), hashlib.sha256(data or b"").hexdigest()))
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array([len(x or b"") for x in b.column("media").to_pylist()], pa.int64()), pa.array(cols[3], pa.string()), b.column("feature")], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    feature = F.format_string(
        "packets=%d;laced=%d;clusters=%d;tracks=%d;last_ms=%d;cues=%d",
        F.size("packets"), F.size(F.filter("packets", lambda p: p.laced)), F.array_max(F.transform("packets", lambda p: p.cluster)) + 1,
        F.size(F.array_distinct(F.transform("packets", lambda p: p.track))), F.array_max(F.transform("packets", lambda p: p.time_ms)), F.size("cues"),
    )
    return parsed.withColumn("feature", feature).select("doc_id", "n_bytes", "media", "packets", "feature").mapInArrow(digest, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
