"""A training-data pipeline over ``documents``: each stage is written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and returns rows with the columns of
``documents`` (the last adds the token ids).  The stages are operators of
``tidemark.llm`` with production parameters; what an operator decides takes effect.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, line_templates, mixing, near_dedup, quality_lr
from tidemark.llm.scratch import staged

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    It is trained on the labelled documents of this input outside the held-out fold.  The
    text is scored in place, so rows need no join to their scores."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_lr.train(docs, labels)
    return quality_lr.keep(docs, model)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines whose template an earlier document has.  A document of which
    nothing else is left goes: all of it stands in earlier ones."""
    cleaned = line_templates.dedup_lines(docs)
    emptied = F.col("dropped_lines").isNotNull() & (
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")) == 0)
    return cleaned.filter(~emptied).withColumn(
        "n_chars", F.when(F.col("dropped_lines").isNull(), F.col("n_chars"))
        .otherwise(F.length("text").cast("long"))).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return near_dedup.keep_one(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: documents are left out or taken repeatedly."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and as ``text`` what they decode to (null reads as empty)."""
    decoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded="_decoded").drop(
        "text").withColumnRenamed("_decoded", "text")
    return decoded.select(*(F.col(c).cast("string") if c == "text" else c for c in docs.columns),
                          "token_ids", F.size("token_ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_recurring_lines),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", tokenise),
]

#: Training, near duplicates and rounding are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
