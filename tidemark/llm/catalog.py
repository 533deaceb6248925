"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``.

Each query reads a whole table and derives its columns from its operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    alignment,
    bpe,
    collocations,
    exact_dedup,
    line_templates,
    mixing,
    near_dedup,
    ppm,
    quality_lr,
    secret_forest,
    token_planes,
    toxicity_fm,
    weak_rules,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Id appended to every document in token files.
END_ID = 2


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_held_out(documents(spark, sf_dir))


def op2_quality_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lr.classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark)
    found = index.add(documents(spark, sf_dir))
    index.close()
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


def op4_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.scan(documents(spark, sf_dir))


def op5_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_fm.classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.find(documents(spark, sf_dir), width=4, percent=80)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op8_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.judge(documents(spark, sf_dir))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = mixing.allocate(documents(spark, sf_dir))
    return (units.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken")))


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_templates.dedup_lines(documents(spark, sf_dir))
    return cleaned.select("doc_id", "text", "dropped_lines", F.coalesce(
        F.size("dropped_lines"), F.lit(0)).cast("long").alias("n_dropped"))


def op11_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = scratch_path(spark, "token-planes")
    token_planes.write(docs, path, BYTE_LEVEL, END_ID)
    return token_planes.read_digests(spark, path, docs.schema["doc_id"].dataType)


def op12_phrase_transducers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.find(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), BYTE_LEVEL, PIECES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ppm_score": op1_ppm_score,
    "op2_quality_lr": op2_quality_lr,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_secret_forest": op4_secret_forest,
    "op5_toxicity_fm": op5_toxicity_fm,
    "op6_odd_sketch_dedup": op6_odd_sketch_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_weak_rules": op8_weak_rules,
    "op9_source_mix": op9_source_mix,
    "op10_line_templates": op10_line_templates,
    "op11_token_planes": op11_token_planes,
    "op12_phrase_transducers": op12_phrase_transducers,
    "op13_token_alignment": op13_token_alignment,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op3_exact_dedup": r"""
        WITH hashed AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                   AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, text_sha256
        FROM hashed WINDOW same AS (PARTITION BY text_sha256)""",
}
