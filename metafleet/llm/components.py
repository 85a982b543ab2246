"""Connected components, and the classes that similar members of shared buckets form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metafleet.llm.shared import written

#: Stars of a bucket, at least and at most, before the members of different classes are held against each other; beyond the least
#: number they go on while one leaves at most so many hundredths of the open members.
STARS, MOST_STARS, LEAVES = 3, 12, 70
#: Centres that a member is held against in one star, those that it shares most buckets with.
CENTRES = 8
#: Rows of 8 or 16 bytes that are sent to every task, at most. More are joined by a shuffle.
SENT = 1 << 20
#: Members of a bucket that one task holds against all others of it.
BLOCK = 1 << 12
#: Pairs of a node and another class that are confirmed in each further round; the last takes all that are left.
BEST = (1, 8, 64, None)
#: Pairs that are confirmed at once where so few or fewer are left.
FEW = 1 << 14

_GOLD = 0x9E3779B97F4A7C15


def seed(k: int) -> Column:
    """The k-th of evenly spread 63-bit numbers."""
    return F.lit((k + 1) * _GOLD % (1 << 63))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b): root is the least node it is connected with.

    Each round takes the least root among a node's neighbours, then the root's own root, so that long
    chains halve; rounds end when no root changes. Every round's table is written to the shared folder.
    """
    ways = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(ways.where("a <> b").distinct(), "edges")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = roots.join(near, "node").select("node", F.least("root", "near").alias("mid"), F.col("root").alias("old"))
        up = roots.select(F.col("node").alias("mid"), F.col("root").alias("top"))
        found = written(step.join(up, "mid").select("node", F.least("mid", "top").alias("root"), "old"), "roots")
        roots = found.select("node", "root")
        if found.where("root <> old").isEmpty():
            return roots


def rooted(rows: DataFrame, roots: DataFrame, node: str = "node", root: str = "root") -> DataFrame:
    """``rows`` with the root of ``node``: its own where ``roots`` lacks it."""
    named = roots.select(F.col("node").alias(node), F.col("root").alias(root))
    return rows.join(named, node, "left").withColumn(root, F.coalesce(root, node))


def with_links(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after further links (a, b): only the links between different roots are followed."""
    ends = rooted(rooted(links.select("a", "b"), roots, "a", "ra"), roots, "b", "rb")
    tops = components(ends.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    known = roots.unionByName(tops.join(roots, "node", "left_anti").select("node", F.col("node").alias("root")))
    return written(rooted(known.withColumnRenamed("root", "mid"), tops, "mid", "root").select("node", "root"), "roots")


def parities(words: int, h: str = "h") -> list[Column]:
    """Aggregates over the distinct elements of a set, hashed to ``h``: ``n`` and the words ``w0``, ``w1``, ... of a
    bit table; each element turns one bit over."""
    bit, word = F.expr(f"shiftleft(1L, cast({h} & 63 as int))"), F.pmod(F.shiftright(h, 6), F.lit(words))
    return [F.count("*").alias("n"), *(F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{k}") for k in range(words))]


def difference(a: str, b: str, words: int) -> Column:
    """How many elements two sets differ by, at least: every bit that differs has an element of its own."""
    total = F.lit(0)
    for k in range(words):
        total = total + F.bit_count(F.col(f"{a}w{k}").bitwiseXOR(F.col(f"{b}w{k}")))
    return total


def may_link(a: str, b: str, words: int, percent: int) -> Column:
    """False only for sets that are surely less similar than ``percent``.

    Sets of n and m elements that differ by s have a similarity of (n + m - s) / (n + m + s), and of
    n / m at most.
    """
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    close = difference(a, b, words) * (100 + percent) <= (n + m) * (100 - percent)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & close


def shared_buckets(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the buckets with two nodes or more hold, of distinct rows (bucket, node): pairs (a, b) and members (bucket, node, lo).

    A bucket of two or three nodes is its pairs: its extremes and all its nodes' xor name them. Larger ones stay buckets; ``lo`` is
    the least node. The aggregates are combined before they are dealt out, and only those of shared buckets are written. The join
    takes the larger ones back to the rows, and Spark splits it where a bucket is large: no task sees a whole bucket. ``buckets``
    is read twice.
    """
    sums = buckets.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n"), F.bit_xor("node").alias("all"))
    spans = written(sums.where("lo <> hi").select("bucket", "lo", "hi", "n", F.expr("all ^ lo ^ hi").alias("mid")), "spans")
    ends = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    three = F.when(F.col("n") == 3, F.array(ends("lo", "hi"), ends("lo", "mid"), ends("mid", "hi"))).otherwise(F.array(ends("lo", "hi")))
    pairs = spans.where("n <= 3").select(F.explode(three).alias("p")).select("p.a", "p.b").where("a <> b").distinct()
    large = spans.where("n > 3").select("bucket", "lo")
    large = F.broadcast(large) if large.count() <= SENT else large
    return pairs, buckets.join(large, "bucket").select("bucket", "node", "lo")


def nodes_of(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The distinct nodes of pairs and members."""
    return members.select("node").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("node"))).distinct()


def _renamed(sketches: DataFrame, side: str) -> DataFrame:
    return sketches.select(*(F.col(c).alias(side + c if c != "node" else side) for c in sketches.columns))


def sifted(pairs: DataFrame, sketches: DataFrame, words: int, percent: int) -> DataFrame:
    """Of pairs (a, b) those that may be linked, with ``off``: the share that they differ by at least."""
    both = pairs.join(_renamed(sketches, "a"), "a").join(_renamed(sketches, "b"), "b")
    return both.where(may_link("a", "b", words, percent)).withColumn("off", difference("a", "b", words) / (F.col("an") + F.col("bn")))


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members, with their roots, of the buckets whose members lie in several classes; ``lo`` is a bucket's least root."""
    named = rooted(members.select("bucket", "node"), roots)
    several = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket", "lo")
    return written(named.join(several, "bucket"), "open")


def star_pairs(members: DataFrame, turn: int, sizes: DataFrame | None = None) -> DataFrame:
    """(a, b) of each member (bucket, node, root, lo) and the centres of its buckets of this turn that are of another class.

    By turns the centre is a node of the class with the least root (a large class has the least one, as a rule), the member of the
    smallest set by ``sizes`` (node, n), which is nearest to all others where members share one passage, or any member. A member of a
    group has as many centres as buckets: of them it takes those that most of its buckets have. The others are held against it in
    later turns or blocks.
    """
    mixed = F.col("node").bitwiseXOR(seed(turn)).alias("mixed")
    if turn % 3 == 1 and sizes:
        placed = members.join(sizes, "node").groupBy("bucket").agg(F.min(F.struct("n", mixed, "root")).alias("least"))
    else:
        placed = (members.where("root = lo") if turn % 3 == 0 else members).groupBy("bucket").agg(F.min(F.struct(mixed, "root")).alias("least"))
    centres = placed.select("bucket", F.col("least.mixed").bitwiseXOR(seed(turn)).alias("centre"), F.col("least.root").alias("its"))
    each = members.join(centres, "bucket").where("root <> its").groupBy(F.col("node").alias("a")).agg(F.collect_list("centre").alias("all"))
    counted = F.transform(F.array_distinct("all"), lambda b: F.struct((-F.size(F.filter("all", lambda c: c == b))).alias("n"), b.bitwiseXOR(seed(turn)).alias("mixed")))
    return each.select("a", F.explode(F.slice(F.array_sort(counted), 1, CENTRES)["mixed"]).alias("mixed")).select("a", F.col("mixed").bitwiseXOR(seed(turn)).alias("b"))


def block_pairs(members: DataFrame, sketches: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, off, ra, rb) of all members of a bucket that lie in different classes, ra and rb, and may be linked.

    A bucket's members are dealt to blocks, and all of them are held against each block; what the sketches
    rule out leaves no row. Two members leave their row in the least of the buckets that they share.
    """
    shared = members.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))
    rows = members.select("bucket", "node", "root").join(shared, "node").join(sketches, "node")
    sized = rows.join(members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "bucket")
    side = lambda s: [F.col(c).alias(s + c) for c in ("root", "buckets", *sketches.columns) if c != "node"]
    left = sized.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("node").alias("a"), *side("a"))
    right = sized.select("bucket", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), F.col("node").alias("b"), *side("b"))
    first = F.forall("abuckets", lambda x: (x >= F.col("bucket")) | ~F.array_contains("bbuckets", x))
    both = left.join(right, ["bucket", "block"]).where((F.col("a") < F.col("b")) & (F.col("aroot") != F.col("broot")) & may_link("a", "b", words, percent) & first)
    off = difference("a", "b", words) / (F.col("an") + F.col("bn"))
    return both.select("a", "b", off.alias("off"), F.col("aroot").alias("ra"), F.col("broot").alias("rb"))


def linked_classes(pairs: DataFrame, members: DataFrame, sketches: Callable[[DataFrame], DataFrame], confirm: Callable[[DataFrame], DataFrame], words: int, percent: int, across: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, root) for the nodes that confirmed links connect; nodes without links may be left out.

    ``pairs``, ``members``: see ``shared_buckets``; candidates are a pair or share a bucket. ``sketches`` takes a table of nodes and
    returns each with the ``parities`` of its set, which rule pairs out without an error. ``confirm`` takes pairs (a, b) and returns those that are linked.
    ``across`` does what ``block_pairs`` does, in another way, from members and their sketches.

    The pairs of small buckets are confirmed at once. A larger bucket isn't expanded into pairs. In each star a member is confirmed
    with the likeliest of its buckets' centres, so that a group of copies soon is one class. Only members of buckets that still hold
    several classes are then held against each other; of the pairs that the sketches leave, a node's likeliest ones
    with each other class are confirmed first, the rest if the classes are still apart. At the end every two
    members of a bucket are of one class or known not to be linked.
    """
    spark = members.sparkSession
    roots = spark.createDataFrame([], "node long, root long")
    checked = spark.createDataFrame([], "a long, b long")

    def tested(pairs: DataFrame) -> None:
        nonlocal checked, roots
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            return
        found = written(confirm(pairs), "links")
        checked = checked.unionByName(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        if not found.isEmpty():
            roots = with_links(roots, found)

    tested(pairs)
    rest = _open(members, roots)
    n_open = rest.count()
    if not n_open:
        return roots
    sketches = written(sketches(rest.select("node").distinct()), "sketches")
    for turn in range(MOST_STARS):
        may = sifted(star_pairs(rest, turn, sketches.select("node", "n")), sketches, words, percent)
        best = may.groupBy("a").agg(F.min(F.struct("off", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
        tested(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(checked, ["a", "b"], "left_anti"))
        rest = _open(rest, roots)
        was, n_open = n_open, rest.count()
        if not n_open:
            return roots
        if turn + 1 >= STARS and n_open * 100 > was * LEAVES:
            break
    held = across(rest, sketches) if across else block_pairs(rest, sketches, words, percent)
    left = written(held.join(checked, ["a", "b"], "left_anti"), "left")
    for turn, most in enumerate(BEST):
        if turn:
            apart = rooted(rooted(left.select("a", "b", "off"), roots, "a", "ra"), roots, "b", "rb").where("ra <> rb")
            left = written(apart.join(checked, ["a", "b"], "left_anti"), "left")
        n_left = left.count()
        if not n_left:
            return roots
        if most is None or n_left <= FEW:
            tested(left.select("a", "b"))
            return roots
        rank = F.row_number().over(Window.partitionBy("a", "rb").orderBy("off", "b"))
        tested(left.select("a", "b", rank.alias("rank")).where(F.col("rank") <= most).select("a", "b"))
    return roots
