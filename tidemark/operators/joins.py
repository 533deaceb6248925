"""Join helpers; the one broadcast hint is on a day calendar of known size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Rows of a day calendar that may be broadcast: (date, double, boolean) rows of 40 bytes,
# 8 MB at most.  500 years of days.
CALENDAR_ROWS = 200_000


def join_dimension(facts: DataFrame, dim: DataFrame, on: Sequence[str] | str,
                   how: str = "left", dim_rows: int | None = None) -> DataFrame:
    """Join a fact table to a day calendar whose exact row count is known up front.

    Up to ``CALENDAR_ROWS`` the calendar is broadcast, so the facts are never shuffled.
    Any other side is left to the planner and AQE, which broadcast by measured bytes."""
    if dim_rows is not None and dim_rows <= CALENDAR_ROWS:
        dim = F.broadcast(dim)
    return facts.join(dim, on=list(on) if not isinstance(on, str) else on, how=how)


def anti_join_keys(target: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``keys_df`` (SQL ``NOT EXISTS``
    with ``=``: a NULL key never matches, so such target rows survive)."""
    return target.join(keys_df.select(*keys), on=list(keys), how="left_anti")
