"""Stored tables: Parquet partitioned by month (or day) of their date column,
read with a declared schema."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.dates import as_date, month_bucket
from tidemark.session import delete_path, list_names, path_exists, rename_path
from tidemark.sources.keyfilter import write_filters
from tidemark.sources.swap import IN, OUT, recover, swap
from tidemark.specs import TableSpec


def part_value(col, spec: TableSpec):
    """The partition value of a date column: first day of its month, or the day."""
    c = F.col(col) if isinstance(col, str) else col
    return month_bucket(c) if spec.grain == "month" else c.cast("date")


def part_of(day, spec: TableSpec):
    """Python-side partition value of a date."""
    day = as_date(day)
    return day.replace(day=1) if spec.grain == "month" else day


def empty_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)


def stored_schema(spec: TableSpec) -> T.StructType:
    return T.StructType(list(spec.schema.fields) + [T.StructField(spec.part_col, T.DateType())])


def read_table(spark: SparkSession, path: str, spec: TableSpec,
               parts: Sequence | None = None, since=None) -> DataFrame:
    """Read with the declared schema (no inference).  An absent path reads
    as an empty table (create-if-absent).  ``parts`` (partition values) and
    ``since`` (rows with date on or after it) prune partitions at planning
    time.  An interrupted swap of the table is finished first."""
    recover(spark, path)
    if not path_exists(spark, path):
        return empty_table(spark, spec)
    df = spark.read.schema(stored_schema(spec)).parquet(path)
    pc = F.col(spec.part_col)
    if parts is not None:
        df = df.filter(pc.isin(list(parts)))
    if since is not None:
        since = as_date(since)
        df = df.filter((pc >= F.lit(part_of(since, spec)))
                       & (F.col(spec.date_col) >= F.lit(since)))
    return df.select(*spec.columns)


def write_months(df: DataFrame, path: str, spec: TableSpec) -> None:
    """Dynamic partition overwrite: only partitions (months or days) present
    in ``df`` are replaced.  ``REBALANCE`` on the partition column clusters
    rows so each partition is written by few tasks, and lets AQE split one
    larger than the advisory partition size (a hot month never funnels into
    one task) and merge small ones."""
    pc = spec.part_col
    (df.withColumn(pc, part_value(spec.date_col, spec))
       .hint("rebalance", pc)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(pc).parquet(path))


def write_table(df: DataFrame, path: str, spec: TableSpec) -> None:
    """Full (static) overwrite of a table at a fresh path."""
    pc = spec.part_col
    (df.select(*spec.columns).withColumn(pc, part_value(spec.date_col, spec))
       .hint("rebalance", pc)
       .write.mode("overwrite").partitionBy(pc).parquet(path))


def stored_parts(spark: SparkSession, path: str, spec: TableSpec) -> list:
    """Partition values present under ``path`` (one directory listing)."""
    recover(spark, path)
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = spec.part_col + "="
    out = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            out.append(dt.date.fromisoformat(name[len(prefix):][:10]))
    return sorted(out)


def write_stage(df: DataFrame, path: str, spec: TableSpec) -> str:
    """Write the new content of some partitions beside them, in a folder of the table that
    readers skip; ``swap_parts`` puts it in place without writing it again.  Where the date is
    no part of the key, the partitions get filters of their keys."""
    spark = df.sparkSession
    stage = f"{path}/_stage-{uuid.uuid4().hex[:12]}"
    try:
        write_table(df, stage, spec)
        if spec.date_col not in spec.keys:
            write_filters(spark, stage, spec, stored_parts(spark, stage, spec))
    except BaseException:
        delete_path(spark, stage)
        raise
    return stage


def clear_stages(spark: SparkSession, path: str) -> None:
    """Finish an interrupted swap, then remove what writers that never came to swapping left
    behind.  For the writer of the table, before it stages anything."""
    recover(spark, path)
    for name in list_names(spark, path):
        if name.startswith(("_stage-", "_old-", "_ledger-")):
            delete_path(spark, f"{path}/{name}")


def swap_parts(spark: SparkSession, stage: str, path: str, spec: TableSpec, parts) -> None:
    """Replace ``parts`` by what ``stage`` holds of them (nothing: the partition goes).
    Folders are renamed under a journal (see ``swap``): if a rename fails, the old
    partitions are put back; after an interruption the next reader or writer finishes."""
    staged = set(stored_parts(spark, stage, spec))
    stored = set(stored_parts(spark, path, spec))
    aside = f"{path}/_old-{uuid.uuid4().hex[:12]}"
    moves = []
    for part in sorted(set(parts) | staged):
        name = f"{spec.part_col}={part.isoformat()}"
        if part in stored:
            moves.append((OUT, f"{path}/{name}", f"{aside}/{name}"))
        if part in staged:
            moves.append((IN, f"{stage}/{name}", f"{path}/{name}"))
    swap(spark, path, moves, [stage, aside], rename=rename_path)


def stored_high_water_mark(spark: SparkSession, path: str, spec: TableSpec):
    """``max(date)`` of a stored table, reading only its newest partition (the
    maximum always lies there, since partitions are months or days of that
    date).  ``None`` for an absent or empty table."""
    for part in reversed(stored_parts(spark, path, spec)):
        v = read_table(spark, path, spec, [part]).agg(F.max(spec.date_col)).first()[0]
        if v is not None:
            return v
    return None
