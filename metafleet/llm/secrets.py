"""Secret scans with corpus-wide ownership, with DataFrame operations only (operator 1).

Patterns find candidates with their places in every text. The values' hashes are counted over the whole
corpus by distinct repositories (documents) and owners (sources): a value that many owners have, or that
stands in many repositories of one, is a copied example; a live-looking value of one owner in few
repositories is a credential of its own, and its place is added as an ``owned`` span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metafleet.llm.shared import written

# The kinds of spans in their order, and their patterns. A match's value is its last group.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"((AKIA[A-Z0-9]{12,}))"
HEX = r"(([0-9a-f]{32,}))"
#: Long tokens without a name before them; they only count if they look live and have one owner.
TOKEN = r"(([A-Za-z0-9+/_-]{20,}))"

#: Characters of an assigned value at least; distinct characters of a live-looking value at least.
LEAST_VALUE, DISTINCT_CHARACTERS = 8, 8
#: Owners, or repositories whoever owns them, from which on a value counts as widely copied.
WIDE_OWNERS, WIDE_REPOSITORIES = 3, 20


def live_looking(value) -> F.Column:
    """Digits and letters in one value, of enough different characters."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT_CHARACTERS)


def _matches(kind: str, pattern: str, text) -> F.Column:
    """Array of (kind, i, gap, match, value): each match and the characters between it and the one before."""
    p = F.lit(pattern)
    gaps, found, values = F.transform(F.split(text, pattern, -1), F.length), F.regexp_extract_all(text, p, F.lit(1)), F.regexp_extract_all(text, p, F.lit(2))
    rows = F.transform(F.arrays_zip(found.alias("m"), values.alias("v"), gaps.alias("g")), lambda x, k: F.struct(F.lit(kind).alias("kind"), k.alias("i"), x.g.alias("gap"), F.length(x.m).alias("size"), x.v.alias("value")))
    # The piece after the last match has no match of its own.
    return F.when(text.rlike(pattern), F.slice(rows, 1, F.size(found))).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,size:int,value:string>>"))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """(row, doc_id, owner, kind, i, gap, size, value): every pattern's matches, and one row without a kind for each text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"), F.coalesce(text_col, F.lit("")).alias("text"))
    none = F.array(F.struct(*(F.lit(None).cast(t).alias(c) for c, t in (("kind", "string"), ("i", "int"), ("gap", "int"), ("size", "int"), ("value", "string")))))
    text = F.col("text")
    found = F.concat(none, *(_matches(k, p, text) for k, p in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN))))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", found.alias("found")).select("row", "doc_id", "owner", F.inline("found"))


def valued(rows: DataFrame) -> DataFrame:
    """The rows whose value counts as a candidate, with the value's hash (null for the others)."""
    counts = F.when(F.col("kind") == "assign", F.length("value") >= LEAST_VALUE).when(F.col("kind") == "token", live_looking(F.col("value"))).otherwise(F.col("kind").isNotNull())
    return rows.withColumn("hash", F.when(counts, F.sha2("value", 256)))


def ownership(rows: DataFrame) -> DataFrame:
    """(hash, repositories, owners): in how many documents and of how many owners a candidate stands."""
    places = rows.where("hash is not null").groupBy("hash", "owner", "doc_id").agg(F.lit(1).alias("one"))
    return places.groupBy("hash", "owner").agg(F.count("*").alias("n")).groupBy("hash").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_copied, repositories, owners.

    Spans are kind:start:end in code points, the end exclusive, by start and then kind, comma-joined.
    ``owned`` spans hold live-looking values of a single owner that aren't widely copied, whatever pattern
    found them; ``n_copied`` counts the places of widely copied values (``WIDE_OWNERS`` owners or
    ``WIDE_REPOSITORIES`` repositories or more), a place that several patterns find once. ``repositories`` and
    ``owners`` are those of the row's most copied value, 0 without any. Null texts are empty ones, null
    owners one owner, rows with equal ids one repository. Repeated rows are scanned each for itself, texts
    of any length as a whole. An empty table gives no rows. Candidates are written once, by hash, without their values.
    """
    found = valued(candidates(docs, id_col, text_col, owner_col))
    facts = found.select("row", "doc_id", "owner", "kind", "i", "gap", "size", "hash", live_looking(F.col("value")).alias("live"), F.length("value").alias("value_size"))
    rows = written(facts, "candidates")
    each = Window.partitionBy("row", "kind").orderBy("i")
    start = F.sum("gap").over(each) + F.coalesce(F.sum("size").over(each.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    live = rows.withColumn("start", start).withColumn("end", F.col("start") + F.col("size"))
    # Rows without a value have keys of their own, so that they don't meet in one task.
    keyed = live.withColumn("key", F.coalesce("hash", F.concat(F.lit("#"), F.col("row").cast("string"))))
    known = keyed.join(ownership(rows).withColumnRenamed("hash", "key"), "key", "left")

    base = F.col("hash").isNotNull() & F.col("kind").isin("assign", "access", "hex")
    wide = (F.col("owners") >= WIDE_OWNERS) | (F.col("repositories") >= WIDE_REPOSITORIES)
    owned = F.col("live") & (F.col("owners") == 1) & ~wide
    rank = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).otherwise(2)
    span = F.struct(F.col("start").alias("s"), rank.alias("k"), F.col("end").alias("e"))
    own = F.struct((F.col("end") - F.col("value_size")).alias("s"), F.lit(3).alias("k"), F.col("end").alias("e"))
    docs_ = known.groupBy("row", "doc_id").agg(
        *(F.count_if(base & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS[:3]),
        F.collect_list(F.when(base, span)).alias("base"), F.collect_set(F.when(F.col("hash").isNotNull() & owned, own)).alias("own"),
        F.collect_set(F.when(F.col("hash").isNotNull() & wide, own)).alias("copied"), *(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("repositories", "owners")),
    )
    names = F.array(*map(F.lit, KINDS))

    def joined(spans) -> F.Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x.k + 1), x.s.cast("string"), x.e.cast("string"))), ",")

    return docs_.select(
        "doc_id", *(f"n_{k}" for k in KINDS[:3]), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "own")).alias("spans"), F.size("own").cast("long").alias("n_owned"), F.size("copied").cast("long").alias("n_copied"), "repositories", "owners",
    )


def _sql_pattern(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


SCAN_SQL = (
    """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS text FROM documents),
m AS ("""
    + " UNION ALL ".join(f"SELECT r, doc_id, owner, '{k}' AS kind, {n} AS rank, regexp_extract_all(text, {_sql_pattern(p)}, 1) AS found, regexp_extract_all(text, {_sql_pattern(p)}, 2) AS vals, string_split_regex(text, {_sql_pattern(p)}) AS gaps FROM d WHERE regexp_matches(text, {_sql_pattern(p)})" for n, (k, p) in enumerate((("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN))))
    + f"""),
u AS (SELECT r, doc_id, owner, kind, rank, i, length(found[i]) AS size, length(gaps[i]) AS gap, vals[i] AS value FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m)),
p AS (SELECT *, (sum(gap) OVER w + coalesce(sum(size) OVER (PARTITION BY r, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS s,
  regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(list_distinct(string_split(value, ''))) >= {DISTINCT_CHARACTERS} AS live FROM u WINDOW w AS (PARTITION BY r, kind ORDER BY i)),
c AS (SELECT *, s + size AS e, sha256(value) AS hash FROM p WHERE CASE kind WHEN 'assign' THEN length(value) >= {LEAST_VALUE} WHEN 'token' THEN live ELSE true END),
o AS (SELECT hash, count(DISTINCT owner) AS owners, count(DISTINCT (owner, coalesce(doc_id::VARCHAR, ''))) AS repositories FROM c GROUP BY hash),
k AS (SELECT c.*, owners, repositories, owners >= {WIDE_OWNERS} OR repositories >= {WIDE_REPOSITORIES} AS wide FROM c JOIN o USING (hash)),
b AS (SELECT r, s, rank, e, kind FROM k WHERE kind <> 'token'),
w AS (SELECT DISTINCT r, e - length(value) AS s, 3 AS rank, e, 'owned' AS kind FROM k WHERE live AND owners = 1 AND NOT wide),
g AS (SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS base, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex FROM b GROUP BY r),
a AS (SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans, count(*) FILTER (kind = 'owned') AS n_owned FROM (FROM b UNION ALL FROM w) GROUP BY r),
n AS (SELECT r, count(DISTINCT (e - length(value), e)) FILTER (wide) AS n_copied, max(repositories) AS repositories, max(owners) AS owners FROM k GROUP BY r)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_owned, 0) AS n_owned, coalesce(n_copied, 0) AS n_copied, coalesce(repositories, 0) AS repositories, coalesce(owners, 0) AS owners
FROM d LEFT JOIN g USING (r) LEFT JOIN a USING (r) LEFT JOIN n USING (r)
"""
)
