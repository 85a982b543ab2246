import hashlib
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from metafleet.llm import bpe  # noqa: E402
from metafleet.llm.lexicon import Lexicon, compile_lexicon  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
SOURCE = open(PATH).read()
OURS = bpe.Bpe(SOURCE)
THEIRS = Tokenizer.from_file(PATH)
THEIRS.no_truncation()
THEIRS.no_padding()


def ids(text):
    out = []
    for p in OURS.parts(text):
        out += [p] if isinstance(p, int) else [i for piece in p for i in OURS.encoded(piece)]
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab'stredmlvTHE  \n\t\x1c\x1f\x85　ΣσςİıßéÁ̀KÅ²½٣12_-<|>!?😀‍中"), max_size=30))
def test_as_the_library(text):
    assert ids(text) == THEIRS.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a<|endoftext|>B<|startoftext|>", "<|endoftext", "ab" * 5000, "x" * 3000 + " " + "the cat's " * 500, "ΟΔΟΣ ΣΑΣ", ""])
def test_special_and_long(text):
    assert ids(text) == THEIRS.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.binary(min_size=0, max_size=6), st.lists(st.integers(0, 2**32 - 1), max_size=4), max_size=40))
def test_lexicon(words):
    rows = sorted((w, struct.pack(f"<{len(x)}I", *x)) for w, x in words.items())
    lexicon = Lexicon(compile_lexicon(rows))
    assert all(lexicon.get(w) == x for w, x in rows)
    assert all(lexicon.get(w) is None for w in (b"zzzzzzz", b"\xff\x00\x01\x02\x03\x04\x05") if w not in words)


def test_lexicon_shares_suffixes():
    words = [(f"{a}ing".encode(), b"\0\0\0\0") for a in "abcdefgh"]
    assert Lexicon(compile_lexicon(words)).states == 5
    with pytest.raises(ValueError):
        compile_lexicon([(b"b", b""), (b"a", b"")])


def test_query(docs_of, odd_rows):
    docs = docs_of([*odd_rows, (20, "naïve <|endoftext|> Text"), (21, "naïve naïve naïve"), (22, "  <|endoftext|>  <|endoftext|>x "), (23, "<|startoftext|>")])
    for words in (0, 5, 1000):
        lexicon = bpe.build_lexicon(docs, SOURCE, words=words)
        got = bpe.decode(bpe.encode(docs, SOURCE, lexicon), SOURCE).collect()
        want = []
        for r in docs.collect():
            e = THEIRS.encode(r.text or "", add_special_tokens=False).ids
            want.append((str(r.doc_id), len(e), hashlib.sha256(struct.pack(f"<{len(e)}I", *e)).hexdigest(), THEIRS.decode(e, skip_special_tokens=False)))
        once = bpe.encode(docs, SOURCE, lexicon, decoded=True).collect()
        for rows in (got, once):
            assert sorted((str(r.doc_id), len(r.ids) // 4, hashlib.sha256(r.ids).hexdigest(), r.decoded) for r in rows) == sorted(want)


def test_empty(docs_of):
    docs = docs_of([])
    assert bpe.decode(bpe.encode(docs, SOURCE, bpe.build_lexicon(docs, SOURCE)), SOURCE).count() == 0


def test_counts_cover_all_words(docs_of):
    got = {r.word: r.n for r in bpe.word_counts(docs_of(["The the THE cat", "the　cat <|endoftext|>", None]), SOURCE).collect()}
    assert got == {"the": 4, "cat": 2}
