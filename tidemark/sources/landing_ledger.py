"""Which landed files were loaded: their path, size and time.

A run lists its landing (no file is opened), leaves out what the ledger has and loads the
rest.  Unlike a time limit this misses no file that arrives late or with an old time.
The listing and the ledger meet in a join; what comes to the driver is the names of the
pending files, which its file index for reading them holds anyway.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tidemark.session import path_exists

FILES = "path string, modified timestamp, bytes bigint"
LEDGER = f"{FILES}, loaded_at timestamp_ntz"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """(path, modified, bytes) of every file in a folder or glob."""
    return spark.read.format("binaryFile").load(landing).select(
        "path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def loaded_files(spark: SparkSession, ledger: str) -> DataFrame:
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def pending_files(spark: SparkSession, landing: str, ledger: str) -> list[Row]:
    """Landed files that the ledger lacks, or has with another size or time, by path."""
    known = loaded_files(spark, ledger).select("path", "modified", "bytes")
    new = landed_files(spark, landing).join(known, ["path", "modified", "bytes"], "left_anti")
    return sorted(new.collect(), key=lambda f: f.path)


def record_files(spark: SparkSession, ledger: str, files: Sequence[Row], run_ts) -> None:
    """Enter files as they were listed; one changed since then is pending again."""
    stamp = run_ts if isinstance(run_ts, str) else run_ts.isoformat(sep=" ")
    (spark.createDataFrame([(f.path, f.modified, f.bytes) for f in files], FILES)
     .withColumn("loaded_at", F.lit(stamp).cast("timestamp_ntz"))
     .coalesce(1).write.mode("append").parquet(ledger))


def reader_path(path: str) -> str:
    """A file's path for a reader that takes globs."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
