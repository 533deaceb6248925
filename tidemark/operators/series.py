"""Calendar spine and last-observation-carried-forward.

``carry_forward`` is one operator for every form:

* ``keys=()``, ``bucket=None`` — a single ordered window.  Spark runs it in one
  partition; right for a *daily* calendar (a century is 36,500 rows), wrong
  for a fact table.
* ``keys=(...)`` — the window is partitioned by the entity key, so many series
  spread over the cluster.
* ``bucket=<Column>`` (e.g. ``month_bucket("date")``, the caller's choice) — two stages for
  fine-grained spines or a dominant key: LOCF inside each (key, bucket), then
  the last non-null value of each bucket is carried across buckets on a table
  that is #keys × #buckets small, and joined back on (key, bucket), which the
  big side is already partitioned by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.dates import as_date

_BUCKET = "__tm_bucket"


def date_bounds(df: DataFrame, date_col: str = "date", keys: Sequence[str] = (),
                lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Min and max of ``date_col`` (per key), over all rows — including rows
    whose measures are NULL, so those still extend the calendar."""
    d = F.col(date_col).cast("date")
    aggs = [F.min(d).alias(lo), F.max(d).alias(hi)]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def date_bounds_scalar(df: DataFrame, date_col: str = "date") -> tuple:
    """(min, max) as Python dates — one single-row aggregate."""
    row = date_bounds(df, date_col).first()
    return (row["lo"], row["hi"]) if row is not None else (None, None)


def span_days(lo, hi) -> int:
    lo, hi = as_date(lo), as_date(hi)
    if lo is None or hi is None or lo > hi:
        return 0
    return (hi - lo).days + 1


def calendar_spine(df: DataFrame, date_col: str = "date", keys: Sequence[str] = (),
                   out_col: str | None = None) -> DataFrame:
    """One row per day from the min to the max of ``date_col`` (per key,
    inclusive).  Empty input (NULL bounds) yields no rows.

    Keyless: the bounds are read as two scalars and the days generated in
    parallel.  Keyed: each key's days are generated next to its bounds row, so
    keys spread over the cluster (a key's span is bounded by its day count)."""
    out_col = out_col or date_col
    if not keys:
        lo, hi = date_bounds_scalar(df, date_col)
        return calendar_spine_between(df.sparkSession, lo, hi, out_col)
    bounds = date_bounds(df, date_col, keys)
    return bounds.select(*keys, F.explode(
        F.sequence(F.col("lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))).alias(out_col))


def calendar_spine_between(spark: SparkSession, lo, hi, out_col: str = "date",
                           partitions: int | None = None) -> DataFrame:
    """Days ``lo..hi`` from literal bounds, generated in parallel from
    ``spark.range``: no scan, no single task holding the calendar, and the
    row count is known exactly (``span_days``)."""
    lo, hi = as_date(lo), as_date(hi)
    n = span_days(lo, hi)
    return spark.range(0, n, numPartitions=partitions).select(
        F.date_add(F.lit(lo), F.col("id").cast("int")).alias(out_col))


def time_spine(spark: SparkSession, lo, hi, step_seconds: int, out_col: str = "ts",
               partitions: int | None = None) -> DataFrame:
    """Zone-less timestamps ``lo, lo + step, …`` up to ``hi``, generated in
    parallel from ``spark.range`` — no task ever holds the whole spine, unlike
    exploding one ``sequence`` array."""
    if lo is None or hi is None or lo > hi:
        return spark.range(0).select(F.lit(None).cast("timestamp_ntz").alias(out_col))
    n = int((hi - lo).total_seconds() // step_seconds) + 1
    start = F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz")
    secs = (F.col("id") * F.lit(int(step_seconds))).cast("decimal(18,0)")
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
    return spark.range(0, n, numPartitions=partitions).select((start + step).alias(out_col))


def _last_non_null_window(keys: Sequence[str], order_col: str):
    w = Window.partitionBy(*keys) if keys else Window
    return w.orderBy(F.col(order_col)).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def carry_forward(df: DataFrame, order_col: str, cols: Sequence[str],
                  keys: Sequence[str] = (), bucket: Column | None = None,
                  observations: DataFrame | None = None,
                  spine: DataFrame | None = None) -> DataFrame:
    """Replace NULLs in ``cols`` with the last non-null value at or before the
    row, ordered by ``order_col`` within ``keys``.  Leading NULLs stay NULL;
    there is no maximum carry distance.  Column order is preserved.

    ``observations`` (rows that hold every non-null value of ``df``) and ``spine`` (its
    keys and order column): if ``df`` is their join, the two-stage form takes the last
    value of each bucket from the first and the buckets from the second, so the join is
    not run twice."""
    keys, cols = list(keys), list(cols)
    if bucket is None:
        w = _last_non_null_window(keys, order_col)
        return df.select(*[F.last(F.col(c), ignorenulls=True).over(w).alias(c) if c in cols
                           else F.col(c) for c in df.columns])

    staged = df.withColumn(_BUCKET, bucket)
    local = carry_forward(staged, order_col, cols, keys + [_BUCKET])
    # The last non-null value per (key, bucket) needs no order: one map-side aggregate.
    seen = (df if observations is None else observations).withColumn(_BUCKET, bucket)
    tails = seen.groupBy(*keys, _BUCKET).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order_col))).alias(f"{c}__tail")
          for c in cols])
    if observations is not None and spine is not None:   # buckets without observations too
        buckets = spine.withColumn(_BUCKET, bucket).select(*keys, _BUCKET).distinct()
        tails = buckets.join(tails, [*keys, _BUCKET], "left")
    cw = (Window.partitionBy(*keys) if keys else Window).orderBy(_BUCKET).rowsBetween(
        Window.unboundedPreceding, -1)
    carries = tails.select(*keys, _BUCKET, *[
        F.last(F.col(f"{c}__tail"), ignorenulls=True).over(cw).alias(f"{c}__carry")
        for c in cols])
    joined = local.join(carries, on=keys + [_BUCKET], how="left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"{c}__carry")).alias(c) if c in cols
                           else F.col(c) for c in df.columns])


def last_non_null_before(df: DataFrame, order_col: str, cols: Sequence[str],
                         before, keys: Sequence[str] = ()) -> DataFrame:
    """Per key, the last non-null value of each column strictly before
    ``before`` (a date literal).  One aggregate; no window."""
    hist = df.filter(F.col(order_col) < F.lit(as_date(before)))
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order_col))).alias(f"{c}__seed")
            for c in cols]
    return hist.groupBy(*keys).agg(*aggs) if keys else hist.agg(*aggs)


def carry_forward_increment(df: DataFrame, order_col: str, cols: Sequence[str], since,
                            keys: Sequence[str] = (), bucket: Column | None = None) -> DataFrame:
    """``carry_forward`` restricted to rows with ``order_col >= since``, seeded
    with the last non-null value before ``since`` — equal to filtering the full
    result, without windowing the whole history.  A filter on the order
    column cannot pass below an unpartitioned window, hence the explicit seed."""
    keys, cols = list(keys), list(cols)
    since_d = as_date(since)
    seeds = last_non_null_before(df, order_col, cols, since_d, keys)
    recent = carry_forward(df.filter(F.col(order_col) >= F.lit(since_d)), order_col, cols,
                           keys, bucket)
    if not keys:
        # One seed row: read it as scalars rather than joining without keys.
        row = seeds.first()
        return recent.select(*[F.coalesce(F.col(c), F.lit(row[f"{c}__seed"]).cast(
            df.schema[c].dataType)).alias(c) if c in cols else F.col(c) for c in df.columns])
    joined = recent.join(seeds, on=keys, how="left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"{c}__seed")).alias(c) if c in cols
                           else F.col(c) for c in df.columns])


__all__ = ["date_bounds", "date_bounds_scalar", "span_days", "calendar_spine",
           "calendar_spine_between", "time_spine", "carry_forward", "last_non_null_before",
           "carry_forward_increment"]
