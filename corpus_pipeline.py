"""Corpus cleaning in five stages; each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize
from pairtrace.llm import bpe, decontam, line_dedup, quality, simhash
from pairtrace.llm.rows import without

#: Rows of the Arrow batches that texts pass Python in: a batch of the default 10,000 long texts would be held four times, in both processes.
BATCH_ROWS, BATCH_SETTING = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Near copies: texts whose sets of so many-word shingles have this Jaccard similarity or more.
NEAR_SHINGLE, NEAR_SIMILARITY = 5, 0.8


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by BATCH_ROWS, unless they are smaller; a stage's rows are worked on after it returns, so the setting stays."""
    rows = int(spark.conf.get(BATCH_SETTING))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more."""
    small_batches(spark)
    trees = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "quality_score"
    while score in docs.columns:
        score += "_"
    return quality.score_quality(docs, trees, into=score).filter(F.col(score) >= 0.3).drop(score)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source removed; n_chars follows the text. No document goes."""
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    kept = line_dedup.drop_boilerplate(docs.select("source", "text", rest))
    counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    made = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, counted).otherwise(F.col("rest.n_chars"))}
    return kept.select(*[made.get(c, F.col("rest")[c]).alias(c) for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each linked group; of rows sharing doc_id and text, that of the least other columns stays."""
    small_batches(spark)
    near = simhash.similar_documents(docs, shingle=NEAR_SHINGLE, similarity=NEAR_SIMILARITY)
    near = materialize(near, "near-copies")
    kept = without(docs, near.filter("NOT stays"))
    repeated = near.filter("stays").groupBy("doc_id", "text_mark").count().filter("count > 1")
    if repeated.isEmpty():
        return kept
    spelled = F.to_json(F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]))
    return kept.groupBy("doc_id", "text").agg(F.min_by(F.struct(*docs.columns), spelled).alias("row")).select("row.*")


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return without(docs, decontam.contaminated_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of every document that is left."""
    small_batches(spark)
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("bpe", token_stage),
]

#: The classifier, SimHash and BPE have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
