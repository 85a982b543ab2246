import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metafleet.llm import matroska as m


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 40_000), st.integers(0, 255))
def test_round_trip(n, seed):
    payload = bytes((seed + k * k) % 256 for k in range(n))
    data = m.mux(payload)
    packets, cues = m.demux(data)
    assert b"".join(data[p[3] : p[3] + p[4]] for p in packets) == payload
    assert [p[2] for p in packets] == sorted(p[2] for p in packets)
    assert all(data[c[2] : c[2] + 4] == m.id_bytes(m.CLUSTER) for c in cues)


@pytest.mark.parametrize("sizes", [[5, 5, 5], [1, 300, 7], [255, 510, 2], [700, 20], [9]])
@pytest.mark.parametrize("kind", [1, 3])
def test_lacing(sizes, kind):
    frames = [bytes([k + 1]) * n for k, n in enumerate(sizes)]
    body = m.size_bytes(1) + (5).to_bytes(2, "big") + bytes([kind << 1]) + m._lacing(sizes, kind) + b"".join(frames)
    track, time, found = m._frames(body, 0, len(body))
    assert (track, time) == (1, 5) and [body[a : a + n] for a, n in found] == frames


def test_times_of_laced_frames():
    """Frames follow each other by 128 ms, in and across blocks and clusters."""
    packets, cues = m.demux(m.mux(bytes(100_000)))
    assert [p[2] for p in packets] == [128 * k for k in range(len(packets))] and packets[0][5]
    starts = {p[0]: p[2] for p in reversed(packets)}
    assert [c[0] for c in cues] == [starts[k] for k in range(len(cues))]
    # By a block's duration where the track names none; all at once without either.
    block = m.element(m.BLOCK, m._block(3, 4, [b"ab", b"cd", b"ef"]))
    for more, times in ((m.uint(m.BLOCK_DURATION, 30), [14, 24, 34]), (b"", [14, 14, 14])):
        data = m.element(m.SEGMENT, m.element(m.CLUSTER, m.uint(m.TIMESTAMP, 10) + m.element(m.BLOCK_GROUP, block + more)))
        assert [p[2] for p in m.demux(data)[0]] == times


def test_unknown_sizes_and_long_sizes():
    block = m.element(m.SIMPLE_BLOCK, m._block(1, 3, [b"abc"]))
    cluster = m.id_bytes(m.CLUSTER) + b"\x01" + b"\xff" * 7 + m.uint(m.TIMESTAMP, 10) + block
    long = m.id_bytes(m.TRACKS) + b"\x08\x00\x00\x00\x02" + b"\xec\x80"
    data = m.id_bytes(m.SEGMENT) + b"\xff" + long + cluster + cluster
    packets, _ = m.demux(data)
    assert [(p[0], p[2], data[p[3] : p[3] + p[4]]) for p in packets] == [(0, 13, b"abc"), (1, 13, b"abc")]


@pytest.mark.parametrize("data", [b"\x00", m.mux(b"x" * 5000)[:-30], b"\x18\x53\x80\x67\x84\x1f\x43\xb6\x75"])
def test_broken(data):
    with pytest.raises((m.MatroskaError, IndexError)):
        m.demux(data)


def test_table(docs_of, odd_rows):
    got = m.read_back(m.packet_lists(m.media_table(docs_of(odd_rows)))).collect()
    want = []
    for r in odd_rows:
        raw = (r[1] or "").encode()
        p = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        want.append((r[0], len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    assert all(r.media_bytes > r.payload_bytes for r in got)
    assert len({(r.media_sha256, r.feature) for r in got if r.n_bytes == 0}) == 1


def test_packets(docs_of):
    rows = m.packet_table(m.media_table(docs_of(["x" * 70_000]))).orderBy("packet").collect()
    assert sum(r.n_bytes for r in rows) == 70_016 and rows[-1].cluster == 2 and {r.laced for r in rows} <= {True, False}


def test_null_and_broken_media(spark):
    rows = m.packet_lists(spark.createDataFrame([(1, None), (2, b"\x00")], "doc_id long, media binary")).orderBy("doc_id").collect()
    assert rows[0].packets is None and rows[0].error is None and rows[1].packets is None and rows[1].error


def test_empty_and_extra(docs_of):
    assert m.read_back(m.packet_lists(m.media_table(docs_of([])))).count() == 0
    df = docs_of(["abc"]).withColumns({c: F.lit(1) for c in ("media", "packets", "feature", "n_bytes")})
    assert m.read_back(m.packet_lists(m.media_table(df))).first().n_bytes == 3
