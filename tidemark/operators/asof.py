"""As-of join: each left row meets the latest right row of its key at or before its time.

Both sides are stacked by key and time and one ordered window carries the last right row
forward: one exchange and one sort, no range join, so work does not depend on how many
right rows lie before a left one.

With ``slice`` (a non-decreasing function of the time, e.g. ``month_bucket``; the caller's
choice, never switched by size) the window runs inside each (key, slice), so a dominant key
or a keyless join is spread over as many tasks as it has slices.  The last right row of each
slice is carried over the slices on a table of #keys x #slices rows and joined back on what
the stacked rows are partitioned by already.  Both inputs are then read twice.

Defined cases: every left row comes out once; one with a NULL key part or time meets
nothing and is not shuffled; right rows with one are no partners; of right rows at the same
key and time the greatest by ``cols``, compared in the order given, is met; an empty side gives
no rows or no partners; an output name that occurs twice raises.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_LEFT, _RIGHT_FIRST, _RIGHT_LAST = 1, 0, 2


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _known(df: DataFrame, names: Sequence[str]) -> Column:
    """None of the columns is NULL."""
    ok = F.lit(True)
    for name in names:
        ok = ok & _c(name).isNotNull()
    return ok


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str,
              by: Sequence[str] = (), cols: Sequence[str] = (), prefix: str = "right_",
              tolerance: str | None = None, exact: bool = True,
              slice: Callable[[Column], Column] | None = None) -> DataFrame:
    """All left columns, then the time and ``cols`` of the met right row under ``prefix``
    (NULL: none met).  ``by``: key columns of both sides.  ``tolerance``: an interval literal
    such as ``"INTERVAL 10 MINUTES"``; a partner further back is none.  ``exact=False`` asks
    for an earlier time, not an equal one."""
    by, cols = list(by), list(cols)
    shown = [right_time, *cols]
    names = [*left.columns, *[prefix + c for c in shown]]
    if len(set(names)) < len(names):
        raise ValueError(f"output names occur twice: {sorted({n for n in names if names.count(n) > 1})}")
    for lc, rc in [(left_time, right_time), *[(k, k) for k in by]]:
        lt, rt = left.schema[lc].dataType, right.schema[rc].dataType
        if lt != rt:
            raise TypeError(f"{lc} is {lt.simpleString()}, {rc} is {rt.simpleString()}")

    keys = [f"__k{i}" for i in range(len(by))]
    at = [_c(k).alias(a) for k, a in zip(by, keys)]
    met = F.struct(*[_c(c).alias(f"c{i}") for i, c in enumerate(shown)])
    known = _known(left, [*by, left_time])
    # Pruned field by field: a step that needs no left column does not read it.
    facts = left.filter(known).select(
        *at, _c(left_time).alias("__t"), F.lit(_LEFT).alias("__side"),
        F.struct(*[_c(c).alias(f"c{i}") for i, c in enumerate(left.columns)]).alias("__left"))
    offers = right.filter(_known(right, [*by, right_time])).select(
        *at, _c(right_time).alias("__t"),
        F.lit(_RIGHT_FIRST if exact else _RIGHT_LAST).alias("__side"), met.alias("__met"))
    stacked = facts.unionByName(offers, allowMissingColumns=True)

    part = list(keys)
    if slice is not None:
        stacked = stacked.withColumn("__slice", slice(F.col("__t")))
        part.append("__slice")
    order = (Window.partitionBy(*part).orderBy("__t", "__side", "__met")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = stacked.withColumn("__met", F.last("__met", ignorenulls=True).over(order))
    found = found.filter(F.col("__side") == _LEFT)
    if slice is not None:
        offered = F.when(F.col("__met").isNotNull(), F.struct("__t", "__met"))
        tails = stacked.groupBy(*part).agg(F.max(offered).alias("__tail"))
        over = (Window.partitionBy(*keys).orderBy("__slice")
                .rowsBetween(Window.unboundedPreceding, -1))
        carried = tails.select(*part, F.last("__tail", ignorenulls=True).over(over)
                               .getField("__met").alias("__carry"))
        found = (found.join(carried, part, "left")
                 .withColumn("__met", F.coalesce("__met", "__carry")))
    if tolerance is not None:
        near = F.col("__met.c0") >= F.col("__t") - F.expr(tolerance)
        found = found.withColumn("__met", F.when(near, F.col("__met")))
    out = found.select(
        *[F.col(f"__left.c{i}").alias(c) for i, c in enumerate(left.columns)],
        *[F.col(f"__met.c{i}").alias(prefix + c) for i, c in enumerate(shown)])
    alone = left.filter(~known).select(
        *[_c(c) for c in left.columns],
        *[F.lit(None).cast(right.schema[c].dataType).alias(prefix + c) for c in shown])
    return out.unionByName(alone)
