"""Single-pass table profile.

Per column: type, row count, NULL percentage and, for numeric / date /
timestamp columns, min, max and exact distinct count — all in **one**
aggregate over one scan.  For the exact distincts Catalyst expands each row
once per profiled column and aggregates in two shuffle stages keyed by
(column, value), so a task only ever holds per-column distinct values; this
measured faster on narrow tables than a separate pass.  The expanded rows are
as wide as the table, so for wide tables ``distinct="stacked"`` counts the
distincts of (column, value) rows in a second scan: what is shuffled grows with
the columns, not with their square.  ``distinct="approx"`` uses HyperLogLog
sketches instead (no expand).
Min and max are returned as strings so one schema fits every type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# The column types that get min / max / distinct.
PROFILED_TYPES = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.DateType,
                  T.TimestampType, T.TimestampNTZType)

SQL_TYPE_NAMES = {
    "double": "DOUBLE", "float": "FLOAT", "bigint": "BIGINT", "int": "INTEGER",
    "smallint": "SMALLINT", "tinyint": "TINYINT", "date": "DATE", "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def sql_type_name(t: T.DataType) -> str:
    s = t.simpleString()
    return SQL_TYPE_NAMES.get(s, s.upper())


def _stacked_distincts(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """(column_name, distinct_count): each value once per column, as text."""
    def text(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(c == 0, F.lit(0.0)).otherwise(c)     # one zero, as grouping has it
        return F.struct(F.lit(f.name).alias("column_name"), c.cast("string").alias("value"))

    values = df.select(F.inline(F.array(*[text(f) for f in fields]))).filter("value IS NOT NULL")
    return (values.groupBy("column_name", "value").agg(F.lit(1).alias("one"))
            .groupBy("column_name").agg(F.count("one").alias("distinct_count")))


def profile(df: DataFrame, table_name: str | None = None, distinct: str = "exact",
            extra_types: tuple = ()) -> DataFrame:
    """``(table_name, column_name, data_type, row_count, null_pct, min_value,
    max_value, distinct_count)``; an empty table yields one row with only the
    count.  ``distinct`` is "exact", "stacked" or "approx".  ``extra_types`` (e.g. ``(T.StringType,)``) opts more column types
    into min / max / distinct."""
    kinds = PROFILED_TYPES + tuple(extra_types)

    def _profiled(f: T.StructField) -> bool:
        return isinstance(f.dataType, kinds)

    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, f in enumerate(fields):
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"__z{i}"))
        if _profiled(f):
            aggs += [F.min(c).cast("string").alias(f"__lo{i}"),
                     F.max(c).cast("string").alias(f"__hi{i}"),
                     (F.approx_count_distinct(c) if distinct == "approx" else
                      F.lit(0) if distinct == "stacked" else
                      F.count_distinct(c)).alias(f"__d{i}")]
    one = df.agg(*aggs)

    n = F.col("__n")
    null_str, null_long = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    per_col = []
    for i, f in enumerate(fields):
        prof = _profiled(f)
        per_col.append(F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(sql_type_name(f.dataType)).alias("data_type"),
            n.alias("row_count"),
            F.round(F.try_divide(F.col(f"__z{i}").cast("double") * F.lit(100.0),
                                 n.cast("double")), 2).alias("null_pct"),
            (F.col(f"__lo{i}") if prof else null_str).alias("min_value"),
            (F.col(f"__hi{i}") if prof else null_str).alias("max_value"),
            (F.col(f"__d{i}").cast("bigint") if prof else null_long).alias("distinct_count")))
    empty = F.struct(null_str.alias("column_name"), null_str.alias("data_type"),
                     n.alias("row_count"), F.lit(None).cast("double").alias("null_pct"),
                     null_str.alias("min_value"), null_str.alias("max_value"),
                     null_long.alias("distinct_count"))
    out = one.select(F.inline(F.when(n > 0, F.array(*per_col)).otherwise(F.array(empty))))
    stacked = [f for f in fields if _profiled(f)] if distinct == "stacked" else []
    if stacked:
        names = out.columns
        out = (out.withColumnRenamed("distinct_count", "__counted")
               .join(_stacked_distincts(df, stacked), "column_name", "left")
               .withColumn("distinct_count", F.coalesce("distinct_count", "__counted"))
               .select(*names))
    if table_name is not None:
        out = out.select(F.lit(table_name).alias("table_name"), "*")
    return out
