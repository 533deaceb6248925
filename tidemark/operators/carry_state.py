"""Carry-forward of keyed series from a small stored state instead of their history.

Per key the state holds the last observed day and the last non-null value up to it.  A load
of newer observations is filled from there: the state's row stands for the days up to the
load's first one, so the new calendar days come from the load and one state row per key.
Filled days up to the state's last day never change by newer observations, so what a load
adds is exactly what the full carry (``gap_fill`` with keys) has more.

An observation on or before its key's last day is *late*: it changes days that were already
filled.  Keys with late rows are carried anew from their history, which the caller gives;
without it such a load fails before any write.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.operators.enrich import carry_to_next
from tidemark.operators.upsert import KeyViolation, upsert_path
from tidemark.session import delete_path, list_names, path_exists, rename_path
from tidemark.sources.swap import IN, OUT, recover, swap
from tidemark.specs import TableSpec

LAST = "last_day"
BUCKET = "bucket"


def carry_state(obs: DataFrame, keys: Sequence[str], date_col: str, value_col: str) -> DataFrame:
    """(*keys, last_day, value): the state after ``obs``.  One aggregate, combined before its
    shuffle.  Rows without a date are left out."""
    day = F.col(date_col)
    return obs.filter(day.isNotNull()).groupBy(*keys).agg(
        F.max(day).alias(LAST),
        F.max_by(value_col, F.when(F.col(value_col).isNotNull(), day)).alias(value_col))


def advance_state(state: DataFrame, batch: DataFrame, keys: Sequence[str], date_col: str,
                  value_col: str) -> DataFrame:
    """The state after a further load; a later null observation keeps the value."""
    held = state.select(*keys, F.col(LAST).alias(date_col), value_col)
    return carry_state(held.unionByName(batch.select(*keys, date_col, value_col)), keys,
                       date_col, value_col)


def carry_load(state: DataFrame, batch: DataFrame, keys: Sequence[str], date_col: str,
               value_col: str, flag_col: str) -> DataFrame:
    """The calendar days that ``batch`` adds to the keys it has: (*keys, date, value, flag).
    Every row of ``batch`` must be newer than its key's ``last_day``.  One exchange on the
    key besides the one that finds the state of the batch's keys; no history is read."""
    keys = list(keys)
    points = batch.filter(F.col(date_col).isNotNull()).select(
        *keys, F.col(date_col).alias("__day"), F.col(value_col), F.lit(False).alias("__held"))
    held = state.join(points.select(*keys).distinct(), keys, "left_semi").select(
        *keys, F.col(LAST).alias("__day"), F.col(value_col), F.lit(True).alias("__held"))
    order = Window.partitionBy(*keys).orderBy("__day")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = held.unionByName(points).select(
        *keys, "__day", "__held",
        F.last(value_col, ignorenulls=True).over(so_far).alias(value_col),
        F.col(value_col).isNotNull().alias("__own"), F.lead("__day").over(order).alias("__next"))
    first = F.when(F.col("__held"), F.date_add("__day", 1)).otherwise(F.col("__day"))
    until = F.date_sub(F.coalesce("__next", F.date_add("__day", 1)), 1)
    days = own.select("*", F.explode(F.when(first <= until, F.sequence(first, until)))
                      .alias(date_col))
    return days.select(*keys, date_col, value_col,
                       (F.col("__own") & ~F.col("__held") & (F.col(date_col) == F.col("__day")))
                       .alias(flag_col))


def late_keys(state: DataFrame, batch: DataFrame, keys: Sequence[str],
              date_col: str) -> DataFrame:
    """(*keys, first_late): keys with an observation on or before their last day."""
    firsts = batch.groupBy(*keys).agg(F.min(date_col).alias("first_late"))
    return (firsts.join(state.select(*keys, LAST), list(keys))
            .filter(F.col("first_late") <= F.col(LAST)).select(*keys, "first_late"))


def state_path(path: str) -> str:
    """The carry state of the filled table at ``path``, beside it."""
    return f"{path}__carry"


def _state_schema(spec: TableSpec, value_col: str) -> T.StructType:
    keys = [k for k in spec.keys if k != spec.date_col]
    return T.StructType([*[T.StructField(k, spec.schema[k].dataType) for k in keys],
                         T.StructField(LAST, T.DateType()),
                         T.StructField(value_col, spec.schema[value_col].dataType),
                         T.StructField(BUCKET, T.IntegerType())])


def read_state(spark: SparkSession, path: str, spec: TableSpec, value_col: str,
               buckets: Sequence[int] | None = None) -> DataFrame:
    """The stored state (of some buckets); none was kept: empty."""
    recover(spark, state_path(path))
    schema = _state_schema(spec, value_col)
    if not path_exists(spark, state_path(path)):
        return spark.createDataFrame([], schema).drop(BUCKET)
    held = spark.read.schema(schema).parquet(state_path(path))
    if buckets is not None:
        held = held.filter(F.col(BUCKET).isin(list(buckets)))
    return held.drop(BUCKET)


def _write_state(spark: SparkSession, path: str, state: DataFrame, n_buckets: int,
                 keys: Sequence[str]) -> None:
    """Replace the buckets that ``state`` has, each whole, by renames under a journal."""
    root, tag = state_path(path), uuid.uuid4().hex[:12]
    stage, aside = f"{root}/_stage-{tag}", f"{root}/_old-{tag}"
    (state.withColumn(BUCKET, F.pmod(F.hash(*keys), F.lit(n_buckets)))
     .hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(stage))
    moves = []
    for name in sorted(n for n in list_names(spark, stage) if n.startswith(f"{BUCKET}=")):
        if path_exists(spark, f"{root}/{name}"):
            moves.append((OUT, f"{root}/{name}", f"{aside}/{name}"))
        moves.append((IN, f"{stage}/{name}", f"{root}/{name}"))
    swap(spark, root, moves, [stage, aside], rename=rename_path)


def carry_increment(spark: SparkSession, path: str, spec: TableSpec, batch: DataFrame,
                    value_col: str, flag_col: str, history: DataFrame | None = None,
                    n_buckets: int = 64) -> int:
    """Take a load of observations into the stored filled table at ``path`` (keys of ``spec``:
    the series' keys and the date) and into the state beside it; returns the days written.

    Only the state buckets that the load's keys fall into are read, and only the partitions
    of the days it writes.  ``history``: the observations before this load (a row of the load
    replaces the one of its key and day), read only when rows are late, and only to carry
    the late keys anew.  A null key fails the load; rows without a date lie on no calendar.

    Data goes first, then the state: a crash between the two repeats the same days.  A load
    given again after its state was written is late as a whole, so it needs ``history``.
    ``n_buckets`` stays what the first load of a table had."""
    date_col = spec.date_col
    keys = [k for k in spec.keys if k != date_col]
    recover(spark, state_path(path))
    for name in list_names(spark, state_path(path)):
        if name.startswith(("_stage-", "_old-")):    # of writers that came to no swap
            delete_path(spark, f"{state_path(path)}/{name}")
    batch = batch.select(*keys, date_col, value_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        hit = [r[0] for r in batch.select(F.pmod(F.hash(*keys), F.lit(n_buckets)))
               .distinct().collect()]    # at most n_buckets
        if not hit:
            return 0
        state = read_state(spark, path, spec, value_col, hit)
        late = late_keys(state, batch, keys, date_col).persist(StorageLevel.MEMORY_AND_DISK)
        rows, now = batch, state
        anew = None
        if not late.isEmpty():
            if history is None:
                raise KeyViolation(f"{spec.name}: observations on or before the last day of "
                                   f"their key; give the history to carry these keys anew")
            at = late.select(*keys)
            every = (history.select(*keys, date_col, value_col).join(at, keys, "left_semi")
                     .join(batch.select(*keys, date_col), [*keys, date_col], "left_anti")
                     .unionByName(batch.join(at, keys, "left_semi")))
            anew = (carry_to_next(every, date_col, value_col, keys, flag_col)
                    .join(late, keys).filter(F.col(date_col) >= F.col("first_late"))
                    .drop("first_late"))
            rows, now = (df.join(at, keys, "left_anti") for df in (batch, state))
        filled = carry_load(now, rows, keys, date_col, value_col, flag_col)
        ahead = advance_state(now, rows, keys, date_col, value_col)
        if anew is not None:
            filled = filled.unionByName(anew)
            ahead = ahead.unionByName(carry_state(every, keys, date_col, value_col))
        n = upsert_path(spark, path, filled, spec)
        _write_state(spark, path, ahead, n_buckets, keys)
        late.unpersist()
        return n
    finally:
        batch.unpersist()
