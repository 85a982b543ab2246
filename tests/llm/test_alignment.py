from collections import Counter
from hashlib import sha256
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metafleet.llm import alignment, exchange
from metafleet.llm.bpe import byte_symbols

A_SOURCE, B_SOURCE = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(), Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_str(A_SOURCE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=B_SOURCE)
    value = {s: k for k, s in enumerate(byte_symbols())}
    a_bytes = {k: bytes(value[c] for c in t) for t, k in a.get_vocab(with_added_tokens=False).items()}
    b_bytes = {k: bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in range(b.get_piece_size())}
    return a, b, a_bytes, b_bytes


def tokens(libraries, text):
    """Both libraries over the whole text, or nothing."""
    a, b, a_bytes, b_bytes = libraries
    if not text:
        return [], []
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw = (" " + text).encode()
    return (x, y) if b"".join(a_bytes[k] for k in x) == raw and b"".join(b_bytes[k] for k in y) == raw else ([], [])


def brute(libraries, rows):
    _, _, a_bytes, b_bytes = libraries
    out, links_of = [], []
    for doc_id, text in rows:
        x, y = tokens(libraries, text)
        ends = []
        for ids, size in ((x, a_bytes), (y, b_bytes)):
            at, found = 0, {}
            for k, i in enumerate(ids):
                at += len(size[i])
                found[at] = k
            ends.append(found)
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i, j = [], [], 0, 0
        for e in shared:
            p, q = ends[0][e], ends[1][e]
            groups.append(",".join(map(str, x[i : p + 1])) + "|" + ",".join(map(str, y[j : q + 1])))
            links.append((x[p], y[q]))
            i, j = p + 1, q + 1
        out.append([doc_id, len(x), len(y), len(groups), len(links), ";".join(groups)])
        links_of.append(links)
    count = Counter(p for links in links_of for p in links)
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    full = []
    for (doc_id, n_a, n_b, n_groups, n_links, groups), links in zip(out, links_of):
        full.append((doc_id, n_a, n_b, n_groups, n_links, sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), sha256(groups.encode()).hexdigest() if n_a else "", groups))
    return sorted(full, key=str)


def found(docs):
    return sorted((tuple(r) for r in alignment.align(docs, A_SOURCE, B_SOURCE, keep_groups=True).collect()), key=str)


ODD = [
    "trailing blanks   ", "  leading", "a  b   c\n\n\td \n e", "word▁mark ▁ x", "<|endoftext|> and <s> </s> <0x41> stay text", "can't won't I'll they've", "émigré naïve 中文 字符 😀😀 ẞ ß", "\x00\x01 nul", "x" * 700,
    " ", "\n", "１２３ ½ ²", "é combining", "a b c d　e", "http://a.b/c?d=e&f=g", "مرحبا بالعالم", "don't  'quoted' 's", "​ zero​width", "a\rb\r\nc",
]


def test_equals_both_libraries_on_odd_texts(docs_of, odd_rows, libraries):
    rows = [*((r[0], r[1]) for r in odd_rows), *((100 + k, t) for k, t in enumerate(ODD * 2))]
    docs = docs_of([(i, t) for i, t in rows])
    got, want = found(docs), brute(libraries, rows)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert got == want


def test_chunks_and_buckets(docs_of, prose, libraries, monkeypatch):
    monkeypatch.setattr(exchange, "KEYS", 16)
    rows = [(k, prose(k % 7, n=60) + " naïve" * (k % 3)) for k in range(60)]
    assert found(docs_of(rows, 5)) == brute(libraries, rows)


def test_pieces_of_a_long_text_equal_the_whole(libraries, prose, monkeypatch):
    text = prose(1, n=3000) + "  \n x" + prose(2, n=50)
    whole = alignment.align_text(alignment.Tokens(A_SOURCE, B_SOURCE), text, True)
    monkeypatch.setattr(alignment, "PIECE", 100)
    cut = alignment.align_text(alignment.Tokens(A_SOURCE, B_SOURCE), text, True)
    assert len(list(alignment._pieces(text))) > 50
    assert cut[:4] == whole[:4] and cut[5] == whole[5] and (cut[4] == whole[4]).all()
    assert whole[5] == brute(libraries, [(1, text)])[0][-1]


def test_empty_and_clashing_columns(docs_of):
    docs = docs_of([(1, "a b"), (2, "b c")])
    assert alignment.align(docs.where("doc_id > 9"), A_SOURCE, B_SOURCE).count() == 0
    more = docs.withColumns({c: F.lit(7) for c in ("chunk", "n", "keys", "links", "bucket", "n_a", "total")})
    assert found(more) == found(docs)


def test_packing():
    import numpy as np

    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (exchange.unpacked_keys(exchange.packed_keys(keys), 1000) == keys).all()
    assert exchange.packed(keys[:0]) == b"" and len(exchange.unpacked(b"", 0, np.uint32)) == 0
    assert [exchange.bucket_bits(n * exchange.KEYS) for n in (0, 1, 2, 3, 4, 5)] == [0, 0, 1, 2, 2, 3]
    cuts = list(exchange.by_bucket(keys, 4))
    assert [c[1] for c in cuts[1:]] == [c[2] for c in cuts[:-1]] and all((keys[s:e] >> np.uint64(60) == b).all() for b, s, e in cuts)
