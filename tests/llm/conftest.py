import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Makes a documents table from texts or (doc_id, text) pairs or whole rows."""

    def make(rows, partitions=2):
        full = []
        for k, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (k, r)
            full.append(r if len(r) == 5 else (*r, "en", f"src{k % 5}", len(r[1]) if r[1] is not None else None))
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, repeated rows, letters of several bytes."""
    long = " ".join(f"word{k * 7919 % 5003}" for k in range(60_000))
    return [
        (1, "A plain text of a few words, to begin with.", "en", "src0", 44), (1, "A plain text of a few words, to begin with.", "en", "src0", 44), (2, None, "en", "src0", None), (3, "", "en", "src1", 0),
        (4, " \n\t ", "en", "src1", 4), (None, "a text without an id but with words in it", None, None, None), (None, None, None, None, None), (5, long, "en", "src2", len(long)), (6, long, "en", "src3", len(long)),
        (7, "ÉTÉ à la plage, naïve façade; 中文字符 😀 ẞ", "fr", "src2", 30), (8, "123 456 ... !!!", None, "src4", 15), (9, "one", "en", "src4", 3),
    ]


@pytest.fixture(scope="session")
def prose():
    """Random prose from a seed; equal seeds give equal texts."""

    def make(seed, n=80, vocabulary=400):
        r = random.Random(seed)
        return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))

    return make
