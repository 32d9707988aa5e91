"""One query per operator over its whole table, and the SQL that checks it where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairtrace.llm import bpe, conversations, decontam, line_dedup, minhash, pii, quality, sharding, simhash, spelling, suffix_dedup, topk, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(_table(spark, sf_dir, "documents"), pii.configured_key(spark))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return near.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.token_digests(_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(_table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), slips=97)


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.linked_sets(_table(spark, sf_dir, "documents"))


def benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proximity matches of op2's index: where an item's rarest terms stand near their distance."""
    return decontam.proximity_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_decontamination, op3_exact_topk, op4_pii, op5_suffix_dedup,
        op6_sharding, op7_toxicity, op8_line_dedup, op9_simhash, op10_bpe, op11_conversation_repair, op12_spelling_variants,
        op13_minhash, benchmark_proximity,
    )
}

ORACLES = {
    "op2_decontamination": decontam.ORACLE, "op3_exact_topk": topk.ORACLE, "op8_line_dedup": line_dedup.ORACLE,
    "op11_conversation_repair": conversations.ORACLE, "op12_spelling_variants": spelling.ORACLE,
    "op13_minhash": minhash.ORACLE,
}
