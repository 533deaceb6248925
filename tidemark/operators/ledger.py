"""Check results kept per partition, so that a report after an increment reads what changed.

Every partition of a stored table keeps the failures of each check in a folder of its own:
readers skip it, and whoever replaces the partition replaces it too.  A report counts the
partitions that lack them, or have those of another definition of a check, and adds up all.
Row checks add up over any partitions; a uniqueness check does where the date is part of its
keys, as equal keys then share a partition.  Other uniqueness checks are counted over the
whole table each time (``whole_table``).

The library's writers replace whole partition folders.  After files were added to a partition
by other means, ``recount=True`` counts it anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.quality import _REPORT, Check, _status, check_report
from tidemark.session import delete_path, path_exists, rename_path
from tidemark.sources.tables import part_value, read_table, stored_parts
from tidemark.specs import TableSpec

FOLDER = "_checks"
LEDGER = "held date, check_no int, definition string, failures long"


def definition(check: Check) -> str:
    """What a check counts, as text: kept counts of another text are not used."""
    return f"{check.name}|{check.column}|{','.join(check.keys)}|{check.fails}"


def whole_table(check: Check, spec: TableSpec) -> bool:
    return bool(check.keys) and spec.date_col not in check.keys


def partition_counts(df: DataFrame, checks: Sequence[Check], spec: TableSpec) -> DataFrame:
    """Failures of every check by partition (``held``).  Row checks are counted inside the
    group-by of the first uniqueness check, so one scan and one shuffle of keys serve all."""
    held = part_value(spec.date_col, spec).alias("held")
    row_checks = [(i, c) for i, c in enumerate(checks) if c.fails is not None]
    key_checks = [(i, c) for i, c in enumerate(checks) if c.keys]
    counts = [F.count_if(c.fails).alias(f"f{i}") for i, c in row_checks]
    tables = []
    for n, (i, c) in enumerate(key_checks):
        ride = row_checks if n == 0 else []
        by_key = df.groupBy(held, *c.keys).agg(F.count(F.lit(1)).alias("__n"),
                                               *(counts if ride else []))
        tables.append((by_key.groupBy("held").agg(
            F.count_if(F.col("__n") > 1).alias(f"f{i}"),
            *[F.sum(f"f{j}").alias(f"f{j}") for j, _ in ride]), [(i, c), *ride]))
    if not key_checks:
        tables.append((df.groupBy(held).agg(*counts), row_checks))
    out = None
    for table, made in tables:
        rows = table.select("held", F.inline(F.array(*[
            F.struct(F.lit(i).alias("check_no"), F.lit(definition(c)).alias("definition"),
                     F.col(f"f{i}").cast("bigint").alias("failures")) for i, c in made])))
        out = rows if out is None else out.unionByName(rows)
    return out


def _kept(spark: SparkSession, path: str, spec: TableSpec, parts, wanted: set[str]) -> DataFrame:
    """Kept counts of the wanted definitions."""
    folders = [f"{path}/{spec.part_col}={p.isoformat()}/{FOLDER}" for p in parts]
    folders = [f for f in folders if path_exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(*folders).filter(
        F.col("definition").isin(sorted(wanted)))


def refresh(spark: SparkSession, path: str, spec: TableSpec, checks: Sequence[Check],
            recount: bool = False) -> list:
    """Count the partitions without counts of all ``checks``; returns these partitions."""
    parts = stored_parts(spark, path, spec)
    wanted = {definition(c) for c in checks}
    complete = set() if recount else {
        r.held for r in _kept(spark, path, spec, parts, wanted).groupBy("held")
        .agg(F.count_distinct("definition").alias("n")).filter(F.col("n") == len(wanted))
        .collect()}    # bounded by the calendar
    todo = [p for p in parts if p not in complete]
    if todo and checks:
        pc, made = spec.part_col, f"{path}/_ledger-{uuid.uuid4().hex[:12]}"
        counts = partition_counts(read_table(spark, path, spec, todo), checks, spec)
        (counts.withColumn(pc, F.col("held")).repartition(pc)
         .write.partitionBy(pc).parquet(made))
        for part in stored_parts(spark, made, spec):
            name = f"{pc}={part.isoformat()}"
            delete_path(spark, f"{path}/{name}/{FOLDER}")
            rename_path(spark, f"{made}/{name}", f"{path}/{name}/{FOLDER}")
        delete_path(spark, made)
    return todo


def ledger_report(spark: SparkSession, path: str, spec: TableSpec, checks: Sequence[Check],
                  recount: bool = False) -> DataFrame:
    """``check_report`` of a stored table, from the kept counts of its partitions."""
    by_part = [c for c in checks if not whole_table(c, spec)]
    refresh(spark, path, spec, by_part, recount)
    number = {definition(c): i for i, c in enumerate(checks)}
    kept = _kept(spark, path, spec, stored_parts(spark, path, spec),
                 {definition(c) for c in by_part})
    listed = spark.createDataFrame(
        [(definition(c), number[definition(c)], c.name, c.column) for c in by_part],
        "definition string, check_no int, check_name string, column_name string")
    found = (listed.join(kept.groupBy("definition").agg(F.sum("failures").alias("failures")),
                         "definition", "left")
             .select("check_no", "check_name", "column_name",
                     F.coalesce("failures", F.lit(0)).alias("failures")))
    report = found.withColumn("status", _status(F.col("failures"))).orderBy("check_no").select(
        *_REPORT.names)
    rest = [c for c in checks if whole_table(c, spec)]
    if rest:
        report = report.unionByName(check_report(read_table(spark, path, spec), rest))
    return report
