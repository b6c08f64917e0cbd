"""A corpus from raw documents to token ids: language ID, line dedup, near-duplicate removal, decontamination, BPE.

Each stage takes (spark, docs, sf_dir), works on all rows it gets and, but for the last, returns the columns of
documents. ``run`` writes every stage's result to the session's shared folder and reads it again, so a lost executor
costs at most one stage's tasks.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sharefold.llm.bpe import share_tokenizer, tokenize
from sharefold.llm.common import bound_batches
from sharefold.llm.contamination import decontaminate
from sharefold.llm.jaccard import keep_one_of_each
from sharefold.llm.language import fit_language_model, identify_languages
from sharefold.llm.line_dedup import dedup_lines
from sharefold.session import scratch_path
from sharefold.sinks import pin

# Documents whose language is less certain than this are rejected, and those without letters.
MIN_SCORE = 0.4

TOKENIZER = "byte_bpe_multi_50k.tiktoken"

# No SQL can express a trained classifier or the merges of BPE.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents and drops those without letters or without a clear language. Where nothing is
    labelled, only those without letters go."""
    bound_batches(spark)
    model = fit_language_model(docs)
    if model is None:
        return docs.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    return identify_languages(docs, model).where(F.col("_language.score") >= MIN_SCORE).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later repeated runs of lines; a document of which nothing is left goes with them."""
    rest = dedup_lines(docs).where((F.col("_removed") == 0) | F.col("text").rlike(r"\S"))
    changed = F.when(F.col("_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return rest.withColumn("n_chars", changed.cast("bigint")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    bound_batches(spark)
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: doc_id, n_tokens, ids."""
    bound_batches(spark)
    tokenizer = share_tokenizer(spark, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    coded = tokenize(docs.select("doc_id", "text"), tokenizer)
    return coded.select("doc_id", F.size("_ids").cast("bigint").alias("n_tokens"), F.col("_ids").alias("ids"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), scratch_path(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
