"""Gap-fill a sparse daily series onto its calendar, and enrich facts with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.joins import join_dimension
from tidemark.functions.dates import as_date
from tidemark.operators.series import (calendar_spine_between, carry_forward, date_bounds,
                                       last_non_null_before, span_days, time_spine)


def gap_fill(obs: DataFrame, date_col: str = "date", value_col: str = "fx_rate",
             keys: Sequence[str] = (), flag_col: str = "is_published_rate",
             bounds: tuple | None = None, bucket: Column | None = None,
             since=None, seed: tuple | None = None) -> DataFrame:
    """Calendar spine ⟕ observations, presence flag, then LOCF.

    Without ``bucket`` and ``since`` neither spine nor join is needed: each observation
    carries its value to the day before the next one (``carry_to_next``), one scan and one
    exchange on the key.

    Output ``(*keys, date, value, flag)``: one row per calendar day from the
    first to the last observed date (per key).  ``flag`` is true on days with
    a non-null observation, false on filled days — computed before filling.
    A NULL observation still extends the calendar but is flagged false.
    Keyless: the calendar bounds are read as two scalars (or passed as
    ``bounds=(lo, hi)``) and the days generated in parallel.

    ``since`` returns only days on or after it — equal to filtering the full
    result — while windowing only those days: the carry is seeded with the
    last non-null value before ``since`` (one aggregate over the history,
    no sort and no window over it).  Keyless callers that already read it
    pass ``seed=(value,)``.
    """
    keys = list(keys)
    since = as_date(since)
    d = F.col(date_col).cast("date")
    if bucket is None and since is None and bounds is None:
        points = obs.select(*keys, d.alias(date_col), F.col(value_col))
        return carry_to_next(points, date_col, value_col, keys, flag_col)
    if bounds is None and not keys:
        row = date_bounds(obs, date_col).first()
        bounds = (row["lo"], row["hi"])
    if not keys:
        lo, hi = as_date(bounds[0]), as_date(bounds[1])
        if since is not None and lo is not None:
            lo = max(lo, since)
        spine = calendar_spine_between(obs.sparkSession, lo, hi, date_col)
    else:
        b = date_bounds(obs, date_col, keys)
        lo = F.col("lo") if since is None else F.greatest(F.col("lo"), F.lit(since))
        seq = F.when(lo <= F.col("hi"), F.sequence(lo, F.col("hi"), F.expr("INTERVAL 1 DAY")))
        spine = b.select(*keys, F.explode(seq).alias(date_col))
    points = obs.select(*keys, d.alias(date_col), F.col(value_col))
    if since is not None:
        points = points.filter(F.col(date_col) >= F.lit(since))
    joined = (spine.join(points, on=keys + [date_col], how="left")
              .withColumn(flag_col, F.col(value_col).isNotNull()))
    filled = carry_forward(joined, date_col, [value_col], keys, bucket, points, spine)
    if since is not None:
        seeds = last_non_null_before(obs.select(*keys, d.alias(date_col), F.col(value_col)),
                                     date_col, [value_col], since, keys)
        carry_in = F.col(f"{value_col}__seed")
        if keys:
            filled = filled.join(seeds, keys, "left")
        else:
            value = seed[0] if seed is not None else seeds.first()[f"{value_col}__seed"]
            carry_in = F.lit(value).cast(obs.schema[value_col].dataType)
        filled = filled.withColumn(value_col, F.coalesce(F.col(value_col), carry_in))
    return filled.select(*keys, date_col, value_col, flag_col)


def carry_to_next(points: DataFrame, date_col: str, value_col: str, keys: Sequence[str] = (),
                  flag_col: str = "is_published_rate") -> DataFrame:
    """Daily calendar and carry from the observations alone: a row's value (the last
    non-null one up to it) stands for its own day and all days before the next row's.
    NULL dates are left out, as they lie on no calendar."""
    keys = list(keys)
    order = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(date_col)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = points.filter(F.col(date_col).isNotNull()).select(
        *keys, F.col(date_col).alias("__day"),
        F.last(F.col(value_col), ignorenulls=True).over(so_far).alias(value_col),
        F.col(value_col).isNotNull().alias("__own"), F.lead(date_col).over(order).alias("__next"))
    until = F.greatest(F.col("__day"), F.date_sub(F.coalesce("__next", F.date_add("__day", 1)), 1))
    days = own.select("*", F.explode(F.sequence(F.col("__day"), until)).alias(date_col))
    return days.select(*keys, date_col, value_col,
                       (F.col("__own") & (F.col(date_col) == F.col("__day"))).alias(flag_col))


def gap_fill_time(obs: DataFrame, ts_col: str, value_col: str, step_seconds: int,
                  flag_col: str = "is_observed", bucket: Column | None = None) -> DataFrame:
    """``gap_fill`` for a sub-daily grid (``ts_col`` already truncated to the
    step).  The spine is generated in parallel and the carry is two-stage,
    bucketed by day unless ``bucket`` says otherwise, so no step of the plan
    funnels the series into one partition."""
    row = obs.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first()
    spine = time_spine(obs.sparkSession, row["lo"], row["hi"], step_seconds, ts_col)
    points = obs.select(F.col(ts_col), F.col(value_col))
    joined = (spine.join(points, ts_col, "left")
              .withColumn(flag_col, F.col(value_col).isNotNull()))
    bucket = F.to_date(F.col(ts_col)) if bucket is None else bucket
    filled = carry_forward(joined, ts_col, [value_col], (), bucket, points, spine)
    return filled.select(ts_col, value_col, flag_col)


def gap_fill_sized(obs: DataFrame, date_col: str = "date", value_col: str = "fx_rate",
                   flag_col: str = "is_published_rate", bucket: Column | None = None,
                   since=None) -> tuple[DataFrame, int]:
    """Keyless ``gap_fill`` plus its exact row count, from one bounds query on ``obs``."""
    since = as_date(since)
    d, v = F.col(date_col).cast("date"), F.col(value_col)
    aggs = [F.min(d).alias("lo"), F.max(d).alias("hi")]
    if since is not None:      # the carry seed rides along in the same aggregate
        aggs.append(F.max_by(v, F.when(v.isNotNull() & (d < F.lit(since)), d)).alias("seed"))
    row = obs.agg(*aggs).first()
    lo, hi = row["lo"], row["hi"]
    first = max(lo, since) if lo is not None and since is not None else lo
    return (gap_fill(obs, date_col, value_col, (), flag_col, bounds=(lo, hi), bucket=bucket,
                     since=since, seed=(row["seed"],) if since is not None else None),
            span_days(first, hi))


def enrich(facts: DataFrame, dim: DataFrame, on: Sequence[str] | str = "date",
           dim_rows: int | None = None) -> DataFrame:
    """Facts ⟕ daily dimension (N:0..1).  Facts outside the dimension's
    calendar keep NULL for every dimension column, flags included."""
    return join_dimension(facts, dim, on, "left", dim_rows)
