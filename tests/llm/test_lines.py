import random
import re

from pyspark.sql import functions as F

from metafleet.llm import linededup as ld


def norm(line):
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", line.lower()).strip(" ")


def shingles(line):
    """All strings of 12 UTF-16 units, from every position; a shorter line as a whole."""
    u = line.encode("utf-16-be")
    return {u[k : k + 24] for k in range(0, max(len(u) - 23, 1), 2)}


def brute(rows, percent=80):
    """{doc_id: dropped line numbers} from all pairs of distinct lines."""
    places = {}
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            if norm(line):
                places.setdefault(norm(line), set()).add((i, k))
    lines = list(places)
    sets = [shingles(x) for x in lines]
    group = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both * 100 >= (len(sets[i]) + len(sets[j]) - both) * percent:
                x, y = group[i], group[j]
                group = [y if g == x else g for g in group]
    order = lambda p: (p[0] is not None, p)
    drop = {}
    for g in set(group):
        spots = sorted((p for k, x in enumerate(lines) if group[k] == g for p in places[x]), key=order)
        for i, k in spots[1:]:
            drop.setdefault(i, set()).add(k)
    return drop


def corpus(prose, seed):
    r = random.Random(seed)
    pool = [prose(seed * 50 + k, r.choice([1, 2, 6, 20, 40])) for k in range(12)]
    rows = []
    for i in r.sample(range(500), 14):
        lines = []
        for _ in range(r.randrange(7)):
            w = r.choice(pool).split()
            if len(w) > 15:
                for _ in range(r.randrange(3)):
                    w[r.randrange(len(w))] = f"y{r.randrange(30)}"
            lines.append(r.choice(["{}", "  {} ", "{}\t"]).format(" ".join(w)))
            if r.random() < 0.2:
                lines.append("")
        rows.append((i, "\n".join(lines)))
    return rows


def check(docs, rows):
    want = brute(rows)
    for r in ld.dropped_lines(docs).collect():
        assert r.dropped == sorted(want.get(r.doc_id, ())), r
        assert r.n_dropped == len(r.dropped)


def test_against_brute_force(docs_of, prose):
    rows = corpus(prose, 1) + [(1000, "shared line of a few words\nits own line here"), (1001, "Shared  line of a few words"), (1002, None)]
    check(docs_of(rows), rows)


def test_odd_rows(docs_of, odd_rows):
    check(docs_of(odd_rows), [(r[0], r[1]) for r in odd_rows])
    assert ld.dropped_lines(docs_of([])).count() == 0
    assert ld.dropped_lines(docs_of([(1, None), (2, "")])).select("n_dropped").distinct().collect() == [(0,)]


def test_texts(docs_of):
    rows = [(1, "first line of the text\nsecond line of the text"), (2, "FIRST line of the  text\n\nanother one entirely"), (3, None)]
    df = docs_of(rows).withColumns({c: F.lit("x") for c in ("line", "node", "bucket", "dropped", "line_no", "root")})
    out = ld.without_repeated_lines(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: rows[0][1], 2: "\nanother one entirely", 3: None}


def test_native(docs_of, prose):
    lines = ld.line_table(docs_of([prose(1)]))
    for df in (lines, ld.band_table(lines), ld.sketch_table(lines), ld.dropped_lines(docs_of([prose(1), prose(1)]))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_long_words_and_lines_without_blanks(docs_of):
    """Lines that begin alike and go on differently stay; equal up to a few characters, one goes."""
    rows = [
        (1, "https://www.alpha-example.com/one/completely/different/path?id=1"), (2, "https://www.alpha-shop.org/zzz/9999999999"),
        (3, "这是第一句话，它的开头和另一句完全一样，但是后面讲的是天气很好。"), (4, "这是第一句话，它的开头和另一句完全不同的内容，关于经济和市场的报告。"),
        (5, "see https://www.example.com/" + "a" * 60), (6, "see https://www.example.com/" + "b" * 30 + "/" + "c" * 30),
        (7, "Zm9vYmFyLmJheg0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3), (8, "Zm9vYmFyLmJheg" + "9876543210zyxwvutsrqponmlkjihgfedcba" * 6),
        (9, "key=" + "0123456789abcdef" * 2 + "tail one is here"), (10, "key=" + "0123456789abcdef" * 2 + "and another end of it"),
        (11, "x" * 9 + "".join(chr(97 + k * k % 26) + str(k) for k in range(80))), (12, "x" * 9 + "".join(chr(97 + k * k % 26) + str(k) for k in range(80)) + "!"),
        (13, "😀" * 3 + " smile"), (14, "😀" * 3 + " smile."),
    ]
    want = brute(rows)
    assert want == {12: {0}}
    check(docs_of(rows), rows)


def passage_pairs(n, families=70):
    """Lines that share a long passage; each two have a part of their own that differs a little."""
    r, rows = random.Random(11), []
    passage = "".join(chr(97 + r.randrange(26)) for _ in range(n))
    for k in range(families):
        own = [chr(97 + r.randrange(26)) for _ in range(260)]
        rows.append((2 * k, passage + " " + "".join(own)))
        own[r.randrange(40, 120)] = own[r.randrange(150, 250)] = "#"
        rows.append((2 * k + 1, passage + " " + "".join(own)))
    return rows


def test_lines_that_share_a_passage(docs_of):
    for n in (0, 150, 260):
        rows = passage_pairs(n)
        assert brute(rows[:30]) == {2 * k + 1: {0} for k in range(15)}
        got = {(r.doc_id, r.first_doc) for r in ld.repeated_lines(docs_of(rows)).collect()}
        assert got == {(2 * k + 1, 2 * k) for k in range(70)}


def test_recall(docs_of):
    """Pairs of lines at a similarity of 0.8 to 0.83, none of which is helped by another line: 0.99 or more are found."""
    r, rows, n = random.Random(21), [], 0
    while n < 400:
        line = "".join(chr(97 + r.randrange(26)) for _ in range(340))
        other = list(line)
        for at in (60, 160, 260)[: r.choice([2, 3])]:
            other[at + r.randrange(30)] = "#"
        other = "".join(other)[: 340 - r.randrange(12)]
        a, b = shingles(line), shingles(other)
        if 0.8 <= len(a & b) / len(a | b) < 0.85:
            rows += [(2 * n, line), (2 * n + 1, other)]
            n += 1
    found = ld.repeated_lines(docs_of(rows)).collect()
    assert all(x.doc_id == x.first_doc + 1 for x in found) and len(found) >= 0.98 * n, len(found)
    print("recall", len(found) / n)


def test_equal_ids(docs_of):
    """Rows with one id and different texts are different rows; equal rows share their fate."""
    rows = [(1, "the very same line of text\nand one"), (1, "a unique first line of its own\nthe very same line of text"), (2, "unlike all others, this line"), (2, "unlike all others, this line")]
    got = sorted(tuple(r) for r in ld.dropped_lines(docs_of(rows)).collect())
    assert sum(n for _, _, n, _ in got) == 1 and {d for i, *_, d in got if i == 2 for d in d} == set()


def test_columns_that_clash_stay(docs_of):
    rows = [(1, "one line of text\nand another line"), (2, "one line of text\nnothing else here"), (3, None)]
    names = ("_mf_id", "_mf_key", "_mf_dropped", "_MF_ID_", "row_key", "line_no", "node", "line", "lines", "id", "key")
    docs = docs_of(rows).withColumns({c: F.lit(7) for c in names})
    got = ld.without_repeated_lines(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: (r.text, r._mf_id, r._mf_dropped) for r in got.collect()} == {1: (rows[0][1], 7, 7), 2: ("nothing else here", 7, 7), 3: (None, 7, 7)}
    assert ld.dropped_lines(docs).count() == 3
