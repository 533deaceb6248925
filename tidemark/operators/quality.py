"""Data checks, contract enforcement, failing-row trace, freshness, faults.

All checks of a table run in **one** scan: row-level checks are ``count_if``
aggregates, computed inside the uniqueness check's group-by when there is
one (map-side partial counts, so a hot key is combined before it moves).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.upsert import upsert_columns


@dataclass(frozen=True)
class Check:
    """``fails`` is the condition a failing row satisfies (NULL ⇒ passes);
    ``keys`` marks a uniqueness check instead."""

    name: str
    column: str
    fails: Column | None = None
    keys: tuple[str, ...] = ()


def not_null(col: str) -> Check:
    return Check("not_null", col, F.col(col).isNull())


def accepted_range(col: str, min_value, max_value) -> Check:
    """Inclusive bounds; NULL passes; NaN fails the upper bound (NaN sorts
    above every number)."""
    c = F.col(col)
    return Check("accepted_range", col,
                 (~(c >= F.lit(min_value))) | (~(c <= F.lit(max_value))))


def row_rule(name: str, fails: Column | str, column: str = "") -> Check:
    """A condition that must never be true for any row."""
    return Check(name, column, F.expr(fails) if isinstance(fails, str) else fails)


def unique_combination(cols: Sequence[str]) -> Check:
    return Check("unique_combination", ",".join(cols), keys=tuple(cols))


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows a row-level check flags (NULL conditions pass)."""
    return df.filter(F.coalesce(check.fails, F.lit(False)))


def duplicate_groups(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Key groups occurring more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


_REPORT = T.StructType([T.StructField("check_name", T.StringType()),
                        T.StructField("column_name", T.StringType()),
                        T.StructField("failures", T.LongType()),
                        T.StructField("status", T.StringType())])


def _status(failures: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail"))


def check_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``(check_name, column_name, failures, status)`` for every check.

    One scan of ``df``.  With a uniqueness check, the row-level ``count_if``
    checks ride along in its group-by (per-key partial counts, then summed),
    so the whole report costs one scan and the one shuffle uniqueness needs
    anyway; without one, a single global aggregate.  Further uniqueness
    checks on other keys add one group-by each."""
    row_checks = [c for c in checks if c.fails is not None]
    key_checks = [c for c in checks if c.keys]
    counts = [F.count_if(c.fails).alias(f"f{i}") for i, c in enumerate(row_checks)]
    entries = []
    if key_checks:
        first = key_checks[0]
        per_key = df.groupBy(*first.keys).agg(F.count(F.lit(1)).alias("__n"), *counts)
        totals = per_key.agg(F.count_if(F.col("__n") > 1).alias("u0"),
                             *[F.sum(f"f{i}").alias(f"f{i}") for i in range(len(row_checks))])
        entries.append((first, "u0"))
    else:
        totals = df.agg(*counts) if counts else None
    entries += [(c, f"f{i}") for i, c in enumerate(row_checks)]
    parts = []
    if totals is not None and entries:
        parts.append(totals.select(F.inline(F.array(*[
            F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                     F.coalesce(F.col(col), F.lit(0)).cast("bigint").alias("failures"))
            for c, col in entries]))))
    for c in key_checks[1:]:
        n = duplicate_groups(df, c.keys).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(n.select(F.lit(c.name).alias("check_name"),
                              F.lit(c.column).alias("column_name"),
                              F.col("failures").cast("bigint").alias("failures")))
    if not parts:
        return df.sparkSession.createDataFrame([], _REPORT)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", _status(F.col("failures")))


# --- contract ------------------------------------------------------------------

class ContractViolation(ValueError):
    pass


def contract_diff(actual: T.StructType, expected: T.StructType) -> list[tuple]:
    """``(column, issue, expected_type, actual_type)`` for every missing,
    extra or retyped column (names compared exactly, order ignored)."""
    a = {f.name: f.dataType for f in actual.fields}
    e = {f.name: f.dataType for f in expected.fields}
    out = []
    for name, t in e.items():
        if name not in a:
            out.append((name, "missing", t.simpleString(), None))
        elif a[name] != t:
            out.append((name, "type_mismatch", t.simpleString(), a[name].simpleString()))
    for name, t in a.items():
        if name not in e:
            out.append((name, "extra", None, t.simpleString()))
    return out


def enforce_contract(df: DataFrame, expected: T.StructType, what: str = "output") -> DataFrame:
    """Raise before any write if ``df`` does not have exactly the declared
    columns and types; otherwise return it in the declared order."""
    diff = contract_diff(df.schema, expected)
    if diff:
        lines = "; ".join(f"{c}: {issue} (expected {e}, got {a})" for c, issue, e, a in diff)
        raise ContractViolation(f"{what} breaks its contract: {lines}")
    return df.select(*[f.name for f in expected.fields])


# --- trace and freshness ------------------------------------------------------------

def trace(violations: DataFrame, raw: DataFrame, keys: Sequence[str],
          raw_cols: Sequence[str] | None = None, prefix: str = "raw_",
          raw_keys: Sequence[str] | None = None) -> DataFrame:
    """Every offending row with the raw rows it was built from, and ``found``: false (and
    the raw columns NULL) if there is none or a key part is NULL.  ``raw_keys`` names the
    raw table's columns for ``keys`` where they differ."""
    keys, raw_keys = list(keys), list(raw_keys or keys)
    cols = [c for c in (raw_cols or raw.columns) if c not in raw_keys]
    r = raw.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(raw_keys)],
                   *[F.col(c).alias(prefix + c) for c in cols], F.lit(True).alias("__found"))
    match = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    return violations.join(r, match, "left").select(
        *violations.columns, *[prefix + c for c in cols],
        F.coalesce("__found", F.lit(False)).alias("found"))


def freshness(df: DataFrame, source_col: str | None, loaded_at_col: str,
              date_col: str | None = None, source_name: str | None = None) -> DataFrame:
    """Per source: last load time, last data date and row count."""
    aggs = [F.max(loaded_at_col).alias("last_loaded_at")]
    if date_col:
        aggs.append(F.max(F.col(date_col).cast("date")).alias("last_date"))
    aggs.append(F.count(F.lit(1)).alias("row_count"))
    if source_col:
        return df.groupBy(F.col(source_col).alias("source")).agg(*aggs)
    return df.agg(*aggs).select(F.lit(source_name).alias("source"), "*")


# --- fault injection (fixtures; never applied to stored data) -------------------------

def inject_impossible_rows(raw: DataFrame, at_keys: DataFrame, keys: Sequence[str],
                           temp_max: float = 5.0, temp_min: float = 25.0,
                           precipitation: float = 0.0, run_ts=None) -> DataFrame:
    """Upsert ``max < min`` rows at the given keys; on conflict only the two
    temperatures change (the source fault the row rule must catch).  An inserted row gets
    ``run_ts`` as its load time."""
    stamp = F.lit(None if run_ts is None else run_ts.isoformat(sep=" "))
    batch = at_keys.select(*keys).select(
        *[F.col(c) if c in keys else
          (F.lit(temp_max) if c == "temp_max_c" else
           F.lit(temp_min) if c == "temp_min_c" else
           F.lit(precipitation) if c == "precipitation_mm" else
           stamp if c == "extracted_at" else
           F.lit(None)).cast(raw.schema[c].dataType).alias(c)
          for c in raw.columns])
    return upsert_columns(raw, batch, keys, ["temp_max_c", "temp_min_c"])


def inject_rename(raw: DataFrame, old: str = "value", new: str = "valor") -> DataFrame:
    """Schema drift: an upstream column silently renamed."""
    return raw.withColumnRenamed(old, new)
