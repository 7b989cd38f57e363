"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import language_id, neural_lm, quality_crf
from orderloom.llm.batches import remainder
from orderloom.llm.chunk_dedup import exact_groups
from orderloom.llm.decontamination import contamination, digest
from orderloom.llm.hard_negatives import hard_negatives, quantized
from orderloom.llm.jaccard_join import similar_groups
from orderloom.llm.length_histogram import length_histogram
from orderloom.llm.license_scan import scan
from orderloom.llm.merkle_manifest import fold, leaf_hash, manifest, proof_digest
from orderloom.llm.mixing import mix
from orderloom.llm.suffix_dedup import repeated_passages
from orderloom.llm.token_codes import token_table

TOKENIZER, END_ID = "word_bpe_49k.json", 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(divisor: int):
    return F.coalesce(remainder("doc_id", divisor) == 2, F.lit(False))


def _language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.fit(documents, ~held_out(4))
    found = language_id.identify(documents, model)
    return found.select("doc_id", held_out(4).alias("held_out"), "lang_pred", "score", "accepted")


def _lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neural_lm.score(table(spark, sf_dir, "documents"), ~held_out(7))
    numbers = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return found.select("doc_id", held_out(7).alias("held_out"), *numbers)


def _jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def _license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_crf.fit(documents, table(spark, sf_dir, "labels"), ~held_out(4))
    return quality_crf.rate(documents, model).select("doc_id", held_out(4).alias("held_out"), "score", "predicted")


def _exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        digest().alias("items_sha256"),
        "contaminated",
    )


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proofs, checked against leaves of which one in three is tampered with."""
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    altered = F.when(remainder("doc_id", 3) == 0, leaf_hash({"text": lowered}))
    proved = manifest(table(spark, sf_dir, "documents"), {"altered": altered})
    folded = fold(F.coalesce("altered", "leaf")).alias("folded_root")
    proved = proved.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), folded)
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


def _suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("kept")


def _hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantized(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_language_id": _language_id,
    "op2_chunk_dedup": _exact_dedup,
    "op3_neural_lm": _lm_scoring,
    "op4_length_histogram": _token_counts,
    "op5_jaccard_join": _jaccard_join,
    "op6_license_scan": _license_scan,
    "op7_decontamination": _decontamination,
    "op8_quality_crf": _quality,
    "op9_mixing": _mixing,
    "op10_token_codes": _token_ids,
    "op11_merkle_manifest": _manifest,
    "op12_suffix_dedup": _suffix_dedup,
    "op13_hard_negatives": _hard_negatives,
}
