"""Profiles kept per partition and merged, so that a profile reads what was written since.

Every partition keeps, in a folder of its own that readers skip, one row with its count and
per column the NULLs, the typed minimum and maximum and a HyperLogLog sketch of the values.
Counts add up, minima and maxima merge exactly, sketches unite to the sketch of all values.
The distinct count is therefore an estimate (relative standard error about 1.04 / sqrt(2 ^
``lg_k``); few values are counted exactly); ``profile`` remains the exact form.

The folder's name carries a digest of the table's columns and of ``lg_k``: after a change of
either, partitions are read anew.  Writers of this library replace whole partition folders, and
the kept row goes with them; after files were added by other means use ``recount=True``.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.profile import PROFILED_TYPES, profile, sql_type_name
from tidemark.session import delete_path, path_exists, rename_path
from tidemark.sources.tables import part_value, read_table, stored_parts
from tidemark.specs import TableSpec

LG_K = 12


def folder_name(spec: TableSpec, lg_k: int = LG_K) -> str:
    text = f"{spec.schema.simpleString()}|{lg_k}"
    return f"_profile-{hashlib.sha1(text.encode()).hexdigest()[:12]}"


def _profiled(f: T.StructField) -> bool:
    return isinstance(f.dataType, PROFILED_TYPES)


def _one_zero(f: T.StructField):
    """Minus zero is zero, as in grouping."""
    c = F.col(f.name)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return F.when(c == 0, F.lit(0.0).cast(f.dataType)).otherwise(c)
    return c


def kept_schema(spec: TableSpec) -> T.StructType:
    fields = [T.StructField("held", T.DateType()), T.StructField("n", T.LongType())]
    for i, f in enumerate(spec.schema.fields):
        fields.append(T.StructField(f"z{i}", T.LongType()))
        if _profiled(f):
            fields += [T.StructField(f"lo{i}", f.dataType), T.StructField(f"hi{i}", f.dataType),
                       T.StructField(f"s{i}", T.BinaryType())]
    return T.StructType(fields)


def partition_profiles(df: DataFrame, spec: TableSpec, lg_k: int = LG_K) -> DataFrame:
    """One row per partition (see ``kept_schema``); one scan, combined before its shuffle."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(spec.schema.fields):
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"z{i}"))
        if _profiled(f):
            digest = F.when(c.isNotNull(), F.xxhash64(_one_zero(f)))
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"),
                     F.hll_sketch_agg(digest, lg_k).alias(f"s{i}")]
    return df.groupBy(part_value(spec.date_col, spec).alias("held")).agg(*aggs)


def refresh_profiles(spark: SparkSession, path: str, spec: TableSpec, lg_k: int = LG_K,
                     recount: bool = False) -> list:
    """Profile the partitions that have no kept row; returns these partitions."""
    folder, pc = folder_name(spec, lg_k), spec.part_col
    todo = [p for p in stored_parts(spark, path, spec)
            if recount or not path_exists(spark, f"{path}/{pc}={p.isoformat()}/{folder}")]
    if todo:
        made = f"{path}/_ledger-{uuid.uuid4().hex[:12]}"
        rows = partition_profiles(read_table(spark, path, spec, todo), spec, lg_k)
        rows.withColumn(pc, F.col("held")).repartition(pc).write.partitionBy(pc).parquet(made)
        for part in stored_parts(spark, made, spec):
            name = f"{pc}={part.isoformat()}"
            delete_path(spark, f"{path}/{name}/{folder}")
            rename_path(spark, f"{made}/{name}", f"{path}/{name}/{folder}")
        delete_path(spark, made)
    return todo


def kept_profile(spark: SparkSession, path: str, spec: TableSpec, table_name: str | None = None,
                 lg_k: int = LG_K, recount: bool = False) -> DataFrame:
    """``profile`` of a stored table from the kept rows of its partitions; only partitions
    written since the last call are read.  An absent or empty table gives the row of
    ``profile``."""
    refresh_profiles(spark, path, spec, lg_k, recount)
    folder, pc = folder_name(spec, lg_k), spec.part_col
    folders = [f for f in (f"{path}/{pc}={p.isoformat()}/{folder}"
                           for p in stored_parts(spark, path, spec)) if path_exists(spark, f)]
    if not folders:
        return profile(read_table(spark, path, spec), table_name)
    fields = spec.schema.fields
    aggs = [F.sum("n").alias("n")]
    for i, f in enumerate(fields):
        aggs.append(F.sum(f"z{i}").alias(f"z{i}"))
        if _profiled(f):
            aggs += [F.min(f"lo{i}").cast("string").alias(f"lo{i}"),
                     F.max(f"hi{i}").cast("string").alias(f"hi{i}"),
                     F.hll_sketch_estimate(F.hll_union_agg(f"s{i}")).alias(f"d{i}")]
    one = spark.read.schema(kept_schema(spec)).parquet(*folders).agg(*aggs)
    per_col = [F.struct(
        F.lit(f.name).alias("column_name"), F.lit(sql_type_name(f.dataType)).alias("data_type"),
        F.col("n").alias("row_count"),
        F.round(F.col(f"z{i}").cast("double") * 100.0 / F.col("n"), 2).alias("null_pct"),
        *[(F.col(f"{p}{i}") if _profiled(f) else F.lit(None)).cast(t).alias(name)
          for p, t, name in (("lo", "string", "min_value"), ("hi", "string", "max_value"),
                             ("d", "bigint", "distinct_count"))])
        for i, f in enumerate(fields)]
    out = one.select(F.inline(F.array(*per_col)))
    return out if table_name is None else out.select(F.lit(table_name).alias("table_name"), "*")
