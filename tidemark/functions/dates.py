"""Date helpers.

Day-of-week numbering differs between engines: Spark's ``dayofweek`` is
1 = Sunday … 7 = Saturday, ``weekday`` is 0 = Monday … 6 = Sunday.  The
business-day flag is written with ``weekday`` so it cannot be confused with
a Sunday-zero numbering.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def business_day(col) -> Column:
    """Monday–Friday → true, Saturday/Sunday → false, NULL → NULL.
    Holidays are not known and count as business days."""
    return F.weekday(_c(col)) < F.lit(5)


def dow_sunday0(col) -> Column:
    """Day of week with Sunday = 0 … Saturday = 6."""
    return F.dayofweek(_c(col)) - F.lit(1)


def parse_day_first(col) -> Column:
    """Day-first ``dd/MM/yyyy`` (leading zeros optional) → DATE; other shapes
    give NULL (pair with ``require_not_null`` to fail the load)."""
    return F.try_to_timestamp(_c(col), F.lit("d/M/yyyy")).cast("date")


def as_date(value) -> _dt.date | None:
    """Python-side date from a date, datetime or ISO string (None passes)."""
    if value is None or (isinstance(value, _dt.date) and not isinstance(value, _dt.datetime)):
        return value
    if isinstance(value, _dt.datetime):
        return value.date()
    return _dt.date.fromisoformat(str(value)[:10])


def month_bucket(col) -> Column:
    """First day of the month — the partition / bucket unit of stored series."""
    return F.trunc(_c(col).cast("date"), "month")


def trunc_ntz(col, unit: str) -> Column:
    """Truncate a zone-less timestamp to ``second``/``minute``/``hour``/``day``
    and keep it zone-less.  (``date_trunc`` returns a zone-aware timestamp,
    i.e. the result would depend on the session time zone.)"""
    c = _c(col)
    if unit == "day":
        return c.cast("date").cast("timestamp_ntz")
    parts = {"hour": (F.hour(c), F.lit(0), F.lit(0)),
             "minute": (F.hour(c), F.minute(c), F.lit(0)),
             "second": (F.hour(c), F.minute(c), F.second(c))}[unit]
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), *parts)
