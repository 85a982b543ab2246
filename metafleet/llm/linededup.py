"""Fuzzy line deduplication by MinHash, with DataFrame operations only (operator 6).

A line's shingles are its strings of ``WIDTH`` characters, one from every position on. Lines that share a
band of their MinHash signatures are candidates, exact Jaccard similarity of the shingle sets decides,
and of every connected component one line stays: the first by document and line number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metafleet.llm.components import SENT, linked_classes, nodes_of, parities, rooted, seed, shared_buckets
from metafleet.llm.shared import outcome, written

#: Characters (UTF-16 units) of a shingle; minima of a signature.
WIDTH, MINIMA = 12, 9
#: Which minima a band has: the lines of a 3 x 3 plane, so that any two minima meet in one band. A pair at
#: similarity 0.8 shares no band with a chance of 0.0094, at 0.9 of 0.0006.
BANDS = ((0, 1, 2), (3, 4, 5), (6, 7, 8), (0, 3, 6), (1, 4, 7), (2, 5, 8), (0, 4, 8), (1, 5, 6), (2, 3, 7), (0, 5, 7), (1, 3, 8), (2, 4, 6))
#: Positions that one row of the search for minima looks at.
STEP = 8
#: Words of the bit table that rules pairs out.
WORDS = 16


def folded(low) -> Column:
    """A lower-case line with white space folded to single blanks, none at the ends."""
    # Few lines have more than single blanks: these searches are cheaper than a replacement for every line.
    odd = F.contains(low, F.lit("  "))
    for c in "\t\x0b\f\r":
        odd = odd | F.contains(low, F.lit(c))
    return F.trim(F.when(odd, F.regexp_replace(low, r"[ \t\x0b\f\r]+", " ")).otherwise(low))


def _once(value) -> Column:
    """The value as a column of its own row, so that no later expression computes it again."""
    return F.explode(F.array(value))


def _starts(units) -> Column:
    """Where the shingles of a line begin, in bytes of its UTF-16 units; a shorter line is one shingle."""
    return F.sequence(F.lit(1), F.greatest(F.octet_length(units) - (2 * WIDTH - 1), F.lit(1)), F.lit(2))


def _shingle(units, start) -> Column:
    return F.xxhash64(F.substring(units, start, F.lit(2 * WIDTH)))


def minima(lines: DataFrame) -> DataFrame:
    """(node, m0, ..., times): the minima of the shingles of every line (node, line), and how many rows have it.

    The shingle nearest to a fixed number, as bits go, is the least of a random order: a minimum per number. A row looks at
    ``STEP`` positions; those beyond the last one look at the last again, which changes no minimum.
    """
    units = lines.select("node", F.encode("line", "UTF-16BE").alias("units"))
    last = F.greatest(F.octet_length("units") - (2 * WIDTH - 1), F.lit(1))
    some = units.select("node", "units", F.explode(F.sequence(F.lit(1), last, F.lit(2 * STEP))).alias("start"))
    hashes = some.select("node", "start", *(_shingle("units", F.least(F.col("start") + 2 * j, last)).alias(f"h{j}") for j in range(STEP)))
    least = lambda k: F.least(*(F.col(f"h{j}").bitwiseXOR(seed(k)) for j in range(STEP)))
    return hashes.groupBy("node").agg(*(F.min(least(k)).alias(f"m{k}") for k in range(MINIMA)), F.count_if(F.col("start") == 1).alias("times"))


def shingle_array(line) -> Column:
    """The hashes of a line's shingles in order of their positions."""
    rows = F.transform(F.array(F.encode(line, "UTF-16BE")), lambda u: F.transform(_starts(u), lambda start: _shingle(u, start)))
    return F.get(rows, F.lit(0))


def sketch_table(texts: DataFrame) -> DataFrame:
    """(node, n, w0, ...) of distinct lines (node, line): the ``parities`` of their shingle sets."""
    arrays = texts.repartition("node").select("node", _once(F.sort_array(shingle_array("line"))).alias("all"))
    each = arrays.select("node", "all", F.posexplode("all").alias("k", "h")).where((F.col("k") == 0) | (F.col("h") != F.get("all", F.col("k") - 1)))
    return each.select("node", "h").groupBy("node").agg(*parities(WORDS))


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, line_no, node, line): every line that isn't blank, in normal form.

    ``node`` is its 64-bit hash, ``row_key`` the text's: rows with equal ids and different texts are different rows.
    """
    # A text is lowered once, as a whole: what is computed for a row of its own would be computed again at each mention.
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row_key"), F.posexplode(F.split(F.lower(text_col), "\n")).alias("line_no", "low"))
    lines = rows.select("doc_id", "row_key", "line_no", _once(folded(F.col("low"))).alias("line")).where("line <> ''")
    return lines.select("doc_id", "row_key", "line_no", F.xxhash64("line").alias("node"), "line")


def signature_table(lines: DataFrame) -> DataFrame:
    """``minima``, written. Of a minimum its last 32 bits are kept."""
    return written(minima(lines).select("node", *(F.expr(f"cast(shiftright(shiftleft(m{k}, 32), 32) as int)").alias(f"m{k}") for k in range(MINIMA)), "times"), "signatures")


def buckets(signs: DataFrame) -> DataFrame:
    """(bucket, node): a bucket for each band of every row of ``signature_table``."""
    keys = F.array(*(F.xxhash64(F.lit(b), *(f"m{k}" for k in band)) for b, band in enumerate(BANDS)))
    return signs.select(F.explode(keys).alias("bucket"), "node")


def band_table(lines: DataFrame) -> DataFrame:
    """(bucket, node): a bucket for each band of every distinct line (node, line)."""
    return buckets(signature_table(lines))


def similar(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of nodes those with 100 * intersection >= percent * union of their shingle sets.

    ``texts``: (node, line). Only the lines of pairs are dealt out, by pairs.
    """
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node")).join(texts, "node")
    both = ends.groupBy("a", "b").agg(*(F.max(F.when(F.col("node") == F.col(c), F.col("line"))).alias(f"line_{c}") for c in "ab"))
    sets = both.select("a", "b", _once(F.struct(shingle_array("line_a").alias("x"), shingle_array("line_b").alias("y"))).alias("s"))
    return sets.where(F.size(F.array_intersect("s.x", "s.y")) * 100 >= F.size(F.array_union("s.x", "s.y")) * percent).select("a", "b")


def line_classes(signs: DataFrame, lines: DataFrame, percent: int) -> DataFrame | None:
    """(node, root) of the nodes in links, or None without candidates. ``lines``: (node, line), rows may repeat."""
    pairs, members = (written(x, name) for x, name in zip(shared_buckets(buckets(signs)), ("candidates", "members")))
    nodes = nodes_of(pairs, members)
    n = nodes.count()
    if not n:
        return None
    wanted = F.broadcast(nodes) if n <= SENT else nodes
    texts = written(lines.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("line").alias("line")), "texts")
    sketches = lambda some: sketch_table(texts.join(some, "node", "left_semi"))
    return linked_classes(pairs, members, sketches, lambda some: similar(some, texts, percent), WORDS, percent)


def repeated_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, line_no, first_doc, first_line): every line to drop, and the line that stays for it.

    Lines are equal up to case and white space, or similar by ``percent``; links join into components.
    Blank lines and null texts have no lines here. A null doc_id comes before all others. Rows are told
    apart by id and text: rows with both equal are one row and share their fate. Lines of any length
    are taken whole; an empty table has no lines. Two of m distinct lines share a hash with a chance of m * m / 2 ** 65.
    """
    lines = written(line_table(docs, id_col, text_col), "lines")
    signs = signature_table(lines.select("node", "line"))
    roots = line_classes(signs, lines.select("node", "line"), percent)
    spots, several = lines.select("doc_id", "row_key", "line_no", "node"), signs.where("times > 1").select("node")
    # Few lines repeat or have a class: only their places are compared.
    if roots is None:
        spots = spots.join(several, "node", "left_semi")
    else:
        spots = rooted(spots.join(several.unionByName(roots.select("node")), "node", "left_semi"), roots).drop("node").withColumnRenamed("root", "node")
    spots = written(spots, "spots")
    place = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("at"), "doc_id", "row_key", "line_no")
    found = spots.join(spots.groupBy("node").agg(F.min(place).alias("first")), "node")
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row_key") == F.col("first.row_key")) & (F.col("line_no") == F.col("first.line_no"))
    return found.where(~own).select("doc_id", "row_key", "line_no", F.col("first.doc_id").alias("first_doc"), F.col("first.line_no").alias("first_line"))


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, or longer ones where ``docs`` has such columns."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def _drops(docs: DataFrame, percent: int, id_col: str, text_col: str, names: list[str]) -> DataFrame:
    """The lines to drop of each row, in columns of these names: id, text's hash, line numbers."""
    rows = lambda: repeated_lines(docs, percent, id_col, text_col).groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set("line_no")).alias("lines"))
    # Kept alone: the tables of lines and candidates are larger than the texts.
    found = outcome(rows, "drops")
    return found.select(*(F.col(c).alias(name) for c, name in zip(("doc_id", "row_key", "lines"), names)))


def dropped_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, dropped (line numbers in order)."""
    lines = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(F.split(text_col, "\n")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row_key"), lines.alias("n_lines"))
    drops = _drops(docs, percent, id_col, text_col, ["id", "key", "lines"])
    found = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key")), "left")
    dropped = F.coalesce("lines", F.array().cast("array<int>"))
    return found.select("doc_id", "n_lines", F.size(dropped).alias("n_dropped"), dropped.alias("dropped"))


def without_repeated_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all its columns, with the dropped lines taken out of the texts. Null texts stay null."""
    names = _free(docs, "_mf_id", "_mf_key", "_mf_dropped")
    drops = _drops(docs, percent, id_col, text_col, names)
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(names[0])) & (F.xxhash64(text_col) == F.col(names[1]))
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda _, k: ~F.array_contains(names[2], k)), "\n")
    joined = docs.join(drops, same, "left")
    return joined.withColumn(text_col, F.when(F.col(names[2]).isNull(), F.col(text_col)).otherwise(kept)).select(*docs.columns)
