"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: the lineage ends
    there, and a lost executor costs no more than its running tasks.  The shuffle files of
    the write are dropped with it, as nothing reads them again."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``staged`` for tables that nothing reads after the block: they are removed at its
    end, also if it fails.  What leaves the block must have been staged outside."""
    root, made = scratch_path(spark, name), 0

    def stage(df: DataFrame, label: str) -> DataFrame:
        nonlocal made
        made += 1
        return staged(df, label, f"{root}/{label}-{made}")

    try:
        yield stage
    finally:
        delete_path(spark, root)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
