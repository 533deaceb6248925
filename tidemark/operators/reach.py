"""How far a change of a carried series reaches.

A day without an observation shows the last one before it, so a change on some days bears
on the days up to the next published value; a changed observation may also be the one that
stretches the calendar, so it bears on the days back to the observation before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.dates import as_date

#: End of a span after which nothing is published.
OPEN_END = as_date("9999-12-31")


def reach_spans(spans: DataFrame, obs: DataFrame, value_col: str, date_col: str = "date",
                keys: Sequence[str] = ()) -> DataFrame:
    """``spans`` (*keys, lo, hi) of changed days, each widened to the days whose carried value
    it may bear on: from the day after the last observation before it to the day before the
    first non-null value after it (open: ``OPEN_END``).  ``obs`` is the series as it is now;
    spans need not hold an observation.  One exchange; both searches walk the ordered series
    of a key once."""
    keys = list(keys)
    day = F.unix_date(F.col(date_col).cast("date"))
    points = obs.filter(F.col(date_col).isNotNull()).select(
        *keys, day.alias("__d"), day.alias("__seen"),
        F.when(F.col(value_col).isNotNull(), day).alias("__published"))
    edges = spans.select(*keys, "lo", "hi", F.explode(F.array(
        F.struct(F.unix_date("lo").alias("__d"), F.lit(True).alias("__first")),
        F.struct(F.unix_date("hi").alias("__d"), F.lit(False).alias("__first")))).alias("e")
    ).select(*keys, "lo", "hi", "e.*")
    every = points.unionByName(edges, allowMissingColumns=True)
    part = Window.partitionBy(*keys)
    before = part.orderBy("__d").rangeBetween(Window.unboundedPreceding, -1)
    after = part.orderBy(F.col("__d").desc()).rangeBetween(Window.unboundedPreceding, -1)
    found = every.select("*", F.max("__seen").over(before).alias("__before"),
                         F.min("__published").over(after).alias("__after"))
    wide = (found.filter(F.col("__first").isNotNull()).groupBy(*keys, "lo", "hi").agg(
        F.max(F.when(F.col("__first"), F.col("__before"))).alias("__before"),
        F.max(F.when(~F.col("__first"), F.col("__after"))).alias("__after")))
    return wide.select(
        *keys, F.coalesce(F.date_from_unix_date(F.col("__before") + 1), "lo").alias("lo"),
        F.coalesce(F.date_from_unix_date(F.col("__after") - 1), F.lit(OPEN_END)).alias("hi"))


def merge_spans(spans: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Overlapping or adjoining spans (*keys, lo, hi) made one."""
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy("lo", "hi")
    so_far = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = spans.select(*keys, "lo", "hi", F.coalesce(
        F.datediff("lo", so_far) > 1, F.lit(True)).cast("int").alias("__new"))
    runs = starts.withColumn("__run", F.sum("__new").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return runs.groupBy(*keys, "__run").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__run")


def differing_rows(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` that ``old`` lacks or holds with another value (NULL equals NULL)."""
    keys = list(keys)
    values = [c for c in new.columns if c not in keys]
    held = old.select(*keys, F.struct(*values).alias("__old"))
    return (new.join(held, keys, "left")
            .filter(F.col("__old").isNull() | ~F.struct(*values).eqNullSafe(F.col("__old")))
            .select(*new.columns))
