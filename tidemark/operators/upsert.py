"""Idempotent keyed upsert: delete-by-key then insert, as DataFrame algebra.

``upsert(target, batch, keys)`` = ``(target ▷ keys(batch)) ∪ batch``, column
matching by name.  Applying the same batch twice equals applying it once.
The batch is validated first (no NULL keys, no duplicate keys) so a bad batch
fails before anything is written, rather than losing the deleted rows.

Path form (``upsert_path``): tables are partitioned by month (or day, see
``TableSpec.grain``) of their date column; only the partitions the batch
touches are read, merged, written once beside the table and swapped in by
rename.  Work follows the batch, not the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.joins import anti_join_keys
from tidemark.functions.dates import as_date, month_bucket
from tidemark.sources.keyfilter import may_hold
from tidemark.sources.tables import (clear_stages, part_of, part_value, read_table, stored_parts,
                                     swap_parts, write_stage)
from tidemark.specs import TableSpec


class KeyViolation(ValueError):
    """The batch has NULL or duplicate natural keys."""


def batch_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key set of a batch."""
    return batch.select(*keys).distinct()


def key_violations(df: DataFrame, keys: Sequence[str],
                   date_col: str | None = None, spec: TableSpec | None = None
                   ) -> tuple[int, int, int, list]:
    """(#rows, #rows with a NULL key part, #key groups occurring more than
    once, distinct partition values — months, or days for a day-grain
    ``spec`` — of ``date_col``) in one aggregate job.

    Map-side partial counts combine a hot key before the shuffle, so it
    never lands whole in one task.  Each key contributes one partition value
    (a valid batch has one row per key; an invalid one is rejected anyway),
    and the set of partitions is bounded by the calendar."""
    any_null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 \
        else F.col(keys[0]).isNull()
    per_key = [F.count(F.lit(1)).alias("n"), F.max(any_null.cast("int")).alias("has_null")]
    if date_col:
        part = part_value(date_col, spec) if spec is not None else month_bucket(date_col)
        per_key.append(F.min(part).alias("m"))
    grouped = df.groupBy(*keys).agg(*per_key)
    totals = [F.sum("n").alias("rows"),
              F.sum(F.when(F.col("has_null") == 1, F.col("n")).otherwise(0)).alias("null_rows"),
              F.count_if((F.col("n") > 1) & (F.col("has_null") == 0)).alias("dup_groups")]
    if date_col:
        totals.append(F.collect_set("m").alias("months"))
    row = grouped.agg(*totals).first()
    months = sorted(row["months"] or []) if date_col else []
    return (int(row["rows"] or 0), int(row["null_rows"] or 0), int(row["dup_groups"] or 0),
            months)


def validate_keys(df: DataFrame, keys: Sequence[str], what: str = "batch",
                  date_col: str | None = None, spec: TableSpec | None = None
                  ) -> tuple[int, list]:
    """Raise ``KeyViolation`` on NULL or duplicate keys; return the row count
    and the partitions touched."""
    rows, nulls, dups, months = key_violations(df, keys, date_col, spec)
    if nulls or dups:
        raise KeyViolation(f"{what}: {nulls} row(s) with NULL key, {dups} duplicate key group(s) "
                           f"on {list(keys)}")
    return rows, months


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is absent from the batch, plus the whole batch.  How the batch
    keys reach the target (broadcast or shuffle) is decided from their measured size."""
    survivors = anti_join_keys(target, batch_keys(batch, keys), keys)
    return survivors.unionByName(batch.select(*target.columns))


def upsert_columns(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                   update_cols: Sequence[str]) -> DataFrame:
    """On key conflict update only ``update_cols`` (a NULL in the batch wins),
    keep the target's other columns; batch-only keys are inserted whole.

    One full outer join with side markers rather than ``coalesce``, so NULL
    updates are applied and the target is read once."""
    return _merge_columns(target, batch, list(keys), update_cols)


def _merge_columns(target: DataFrame, batch: DataFrame, keys: list,
                   update_cols: Sequence[str]) -> DataFrame:
    update_cols = set(update_cols)
    t = target.withColumn("__in_t", F.lit(True))
    b = batch.select(*[F.col(c).alias(f"__b_{c}") if c not in keys else F.col(c)
                       for c in target.columns]).withColumn("__in_b", F.lit(True))
    j = t.join(b, on=keys, how="full_outer")
    in_t, in_b = F.col("__in_t").isNotNull(), F.col("__in_b").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(in_b, F.col(f"__b_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(in_t, F.col(c)).otherwise(F.col(f"__b_{c}")).alias(c))
    return j.select(*out)


# --- stored tables -----------------------------------------------------------

def parts_holding(spark: SparkSession, path: str, batch: DataFrame, spec: TableSpec, parts
                  ) -> tuple[set, list]:
    """Those of the partitions ``parts`` that hold a key of the batch, and those that had to
    be read to find them: the key filters name the partitions that may, only the key columns
    of these are read.  What comes back is bounded by the calendar."""
    named = may_hold(spark, path, batch, spec, parts)
    if not named:
        return set(), []
    stored = read_table(spark, path, spec, named).select(
        *spec.keys, part_value(spec.date_col, spec).alias("__part"))
    held = stored.join(batch_keys(batch, spec.keys), list(spec.keys), "left_semi")
    return {part_of(r[0], spec) for r in held.select("__part").distinct().collect()}, named


def upsert_path(spark: SparkSession, path: str, batch: DataFrame, spec: TableSpec) -> int:
    """Keyed upsert into a partitioned Parquet table.  Returns the number of
    batch rows.  Empty batch ⇒ no-op.

    Protocol: validate keys → read only the touched partitions (where the date is not part
    of the key also those that hold a batch key, as a row may have moved; Bloom filters stored
    with the partitions say which may) → anti-join +
    union → write each touched partition once, beside the table → swap it in by renames
    under a journal.  A crash before the swap leaves the old table; one within it is finished
    by the next reader or writer."""
    clear_stages(spark, path)
    batch = batch.select(*spec.columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, parts = validate_keys(batch, spec.keys, date_col=spec.date_col, spec=spec)
        if rows == 0:
            return 0
        parts = {part_of(p, spec) for p in parts}
        if spec.date_col not in spec.keys:
            others = [p for p in stored_parts(spark, path, spec) if p not in parts]
            parts |= parts_holding(spark, path, batch, spec, others)[0]
        merged = upsert(read_table(spark, path, spec, sorted(parts)), batch, spec.keys)
        stage = write_stage(merged, path, spec)
    finally:
        batch.unpersist()
    swap_parts(spark, stage, path, spec, parts)
    return rows


def window_replace_path(spark: SparkSession, path: str, source: DataFrame, spec: TableSpec,
                        cutoff) -> int:
    """Stored window replace: every row with date on or after ``cutoff`` is
    replaced by the source's rows in that range, so keys that vanished from
    the source disappear.  Only the cutoff's own partition keeps older rows;
    partitions at or after it that end up with no rows are removed.  Returns
    the rows written."""
    clear_stages(spark, path)
    cutoff = as_date(cutoff)
    d = F.col(spec.date_col)
    fresh = source.filter(d >= F.lit(cutoff)).select(*spec.columns).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        rows, _ = validate_keys(fresh, spec.keys, date_col=spec.date_col, spec=spec)
        first = part_of(cutoff, spec)
        older = read_table(spark, path, spec, [first]).filter(d < F.lit(cutoff))
        stage = write_stage(older.unionByName(fresh), path, spec)
    finally:
        fresh.unpersist()
    swap_parts(spark, stage, path, spec,
               [p for p in stored_parts(spark, path, spec) if p >= first])
    return rows
