"""Five stages over a corpus, each a step of ``STAGES``: (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metafleet.llm import bpe, decontamination, language, linededup, minhash
from metafleet.llm.queries import tokenizer_source
from metafleet.llm.shared import dropped, new_path, outcome, passing, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _rows(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row, ``_row``, written once so that it stays.

    The operators get the key in the place of the id, so that what they judge are rows, also where ids
    are null or repeat.
    """
    return written(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_id", F.col("_row"))


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` without those whose key is in ``gone`` (_row)."""
    return rows.join(gone.distinct(), "_row", "left_anti").select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that the operator finds no language in, and names the language of those that have none.

    Learns from all rows with a language. Rejected are null and empty texts and those without a letter. A null
    ``lang`` becomes the predicted one; a given one stays. If nothing can be learned, no row goes.
    Repeated rows share their fate; texts of any length are read whole.
    """
    names, table = language.fit(docs.where("lang is not null and text is not null").select("lang", "text"))
    if not names:
        return docs.select(*COLUMNS)
    rows = _rows(docs)
    found = written(language.identify(_keyed(rows), names, table).select(F.col("doc_id").alias("_row"), "lang_pred"), "verdicts")
    # Few rows are rejected or without a language: the texts need not move for them.
    lacking = found.join(rows.where("lang is null").select("_row"), "_row")
    kept = rows.join(found.where("lang_pred = 'und'").select("_row"), "_row", "left_anti").join(lacking, "_row", "left")
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out of the texts; every document stays, n_chars follows its text.

    Of similar lines the first by id and line number stays, null ids first. Null and empty texts stay as they
    are. Rows are told apart by id and text: rows with both equal lose the same lines, and the next stage
    leaves one of them.
    """
    out = linededup.without_repeated_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: five-word shingles, similarity of 0.8 or more.

    The row of the least id stays, null ids last; of repeated rows one. Texts without words (null, empty) are
    like no other and stay. Texts of any length are compared whole.
    """
    rows = _rows(docs)
    judged = lambda: minhash.near_duplicates(_keyed(rows), shingle=5, percent=80).select(F.col("doc_id").alias("_row"), "component_id")
    found = outcome(judged, "components")
    placed = found.join(rows.select("_row", "doc_id"), "_row").withColumn("place", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    best = placed.groupBy("component_id").agg(F.min("place").alias("best"))
    gone = placed.join(best, "component_id").where(F.col("_row") != F.col("best._row"))
    return _without(rows, gone.select("_row"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text holds a benchmark item: tiles cover half of its tokens or more.

    Null and empty texts hold none; repeated rows share their fate; an empty benchmark drops nothing.
    """
    rows = _rows(docs)
    found = outcome(lambda: decontamination.leaks(_keyed(rows), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("_row")), "leaks")
    return _without(rows, found)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the texts and decodes the ids: doc_id, n_tokens, ids, decoded.

    One row for each row, whatever its id; null and empty texts have no tokens and decode to an empty text.
    """
    source = tokenizer_source()
    decoded = bpe.encode(docs, source, bpe.build_lexicon(docs, source), decoded=True)
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("bpe", encoding_stage),
]

#: SQL can't express these stages; the tests hold all five against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each stage's table written and read again; what a stage has written for itself goes at its end."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS), None
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with passing(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            dropped(spark, last)
        last = path
    return docs
