"""Incremental mart merge with a lookback window, window replace, rebuild.

* ``merge_incremental`` (delete+insert): first run takes every source row;
  later runs select source rows with ``date >= max(target.date) - lookback``
  (inclusive), delete target rows whose key is in that selection and insert
  it.  Keys that vanished from the source stay in the target.
* ``window_replace``: as above, but every target row at or after the cutoff
  is dropped, so vanished keys inside the window disappear.
A full rebuild is a write and a swap: ``plans.build.swap_in``.

The cutoff is a literal computed from one scalar aggregate on the target, so
the source filter reaches the Parquet scan and prunes partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import as_date
from tidemark.operators.upsert import upsert

EPOCH = dt.date(1970, 1, 1)


def high_water_mark(target: DataFrame | None, date_col: str = "date",
                    default: dt.date = EPOCH) -> dt.date:
    """``coalesce(max(date), default)`` of the target."""
    if target is None:
        return default
    v = target.agg(F.max(F.col(date_col).cast("date")).alias("m")).first()["m"]
    return as_date(v) if v is not None else default


def lookback_cutoff(target: DataFrame | None, date_col: str = "date",
                    lookback_days: int = 10) -> dt.date:
    """``coalesce(max(target.date), 1970-01-01) - lookback_days`` — rows on
    or after it are reprocessed (lookback + 1 calendar days, plus newer)."""
    return high_water_mark(target, date_col) - dt.timedelta(days=lookback_days)


def select_since(source: DataFrame, date_col: str, cutoff) -> DataFrame:
    return source.filter(F.col(date_col) >= F.lit(as_date(cutoff)))


def merge_incremental(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                      date_col: str = "date", lookback_days: int = 10,
                      since=None) -> DataFrame:
    """Delete+insert merge of the source's recent rows into the target.

    ``target=None`` (absent) ⇒ the whole source.  ``since`` overrides the
    computed cutoff (e.g. to pick up backfilled history older than it)."""
    if target is None:
        return source
    cutoff = as_date(since) if since is not None else lookback_cutoff(target, date_col,
                                                                      lookback_days)
    selection = select_since(source, date_col, cutoff).select(*target.columns)
    if date_col not in keys:
        return upsert(target, selection, keys)
    # The date is part of the key, so target rows before the cutoff cannot
    # match the selection: they pass through untouched, never shuffled.
    d = F.col(date_col)
    older = target.filter(d < F.lit(cutoff))
    return older.unionByName(upsert(target.filter(d >= F.lit(cutoff)), selection, keys))


def window_replace(target: DataFrame | None, source: DataFrame, date_col: str = "date",
                   lookback_days: int = 10, since=None) -> DataFrame:
    """Replace the whole window: target rows before the cutoff ∪ source rows
    at or after it."""
    if target is None:
        return source
    cutoff = as_date(since) if since is not None else lookback_cutoff(target, date_col,
                                                                      lookback_days)
    kept = target.filter(F.col(date_col) < F.lit(cutoff))
    return kept.unionByName(select_since(source, date_col, cutoff).select(*target.columns))
