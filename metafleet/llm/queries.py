"""The registered queries of the operators of this folder."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metafleet.llm import alignment, bpe, decontamination, interpolation, language, linededup, manifest, matroska, minhash, oracles, secrets, shuffling, toxicity, training_order
from metafleet.llm.shared import new_path, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = training_order.training_order(training_order.byte_ids(_table(spark, sf_dir, "documents")))
    return written(training_order.write_shards(ordered, new_path(spark, "sequences")), "slots")


def op3_media_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.read_back(matroska.packet_lists(matroska.media_table(_table(spark, sf_dir, "documents"))))


def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op6_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = linededup.dropped_lines(_table(spark, sf_dir, "documents"))
    return lines.withColumn("dropped", F.array_join(F.transform("dropped", lambda k: k.cast("string")), ","))


def tokenizer_source(name: str = "word_bpe_49k.json") -> str:
    return Path(public_tokenizers.path(name)).read_text()


def op7_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, source = _table(spark, sf_dir, "documents"), tokenizer_source()
    decoded = bpe.encode(docs, source, bpe.build_lexicon(docs, source), decoded=True)
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_toxicity_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_table(_table(spark, sf_dir, "documents"))


def op10_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "shards")
    shuffling.write_shards(shuffling.two_pass_shuffle(_table(spark, sf_dir, "documents"), shards=24), path)
    return shuffling.read_shards(spark, path).select(
        "doc_id", shuffling.record_size("text").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_whitespace_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return alignment.align(_table(spark, sf_dir, "documents"), tokenizer_source("byte_bpe_50k.json"), model)


def op12_merkle_time_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_table(spark, sf_dir, "documents"))


def op13_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secret_ownership": op1_secret_ownership,
    "op2_training_order": op2_training_order,
    "op3_media_packets": op3_media_packets,
    "op4_string_tiling": op4_string_tiling,
    "op5_minhash_near_duplicates": op5_minhash_near_duplicates,
    "op6_fuzzy_line_dedup": op6_fuzzy_line_dedup,
    "op7_bpe_lexicon": op7_bpe_lexicon,
    "op8_toxicity_kneser_ney": op8_toxicity_kneser_ney,
    "op9_language_mixture": op9_language_mixture,
    "op10_two_pass_shuffle": op10_two_pass_shuffle,
    "op11_whitespace_anchors": op11_whitespace_anchors,
    "op12_merkle_time_forward": op12_merkle_time_forward,
    "op13_deleted_interpolation": op13_deleted_interpolation,
}

ORACLES: dict[str, str] = {"op1_secret_ownership": secrets.SCAN_SQL, "op5_minhash_near_duplicates": oracles.NEAR_DUPLICATES_SQL, "op6_fuzzy_line_dedup": oracles.LINES_SQL, "op12_merkle_time_forward": oracles.MERKLE_SQL}
