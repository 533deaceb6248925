"""Joining rows to their group when one group may hold a large share of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most this many groups are joined by broadcast.
HOT_GROUPS = 256


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """Inner join of ``rows`` to ``groups``, which has one row per ``key`` with the number
    ``size`` of its rows.  A group with over 1/HOT_GROUPS of all rows would fill one task;
    there are fewer than HOT_GROUPS such groups, and they are broadcast.  The rest meet in
    a sort-merge join."""
    is_hot = F.col(size) * HOT_GROUPS > n_rows
    hot, cold = groups.filter(is_hot), groups.filter(~is_hot)
    in_hot = rows.join(F.broadcast(hot), key)
    others = (rows.join(F.broadcast(hot.select(key)), key, "left_anti")
              .join(cold.hint("merge"), key))
    return in_hot.unionByName(others)
