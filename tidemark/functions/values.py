"""Value parsing helpers for landed text fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


_DECIMAL = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf(inity)?)\s*$"


def parse_grouped_number(col) -> Column:
    """'1,020.5' → 1020.5; text that is not a number → NULL (``try_cast``).

    Pair with ``require_not_null`` so a bad value still fails the load, as a
    strict float parse would, regardless of the order Spark evaluates the
    sentinel filter and the cast in.  Only decimal notation (and nan / inf) counts: the
    cast alone would also take a type suffix or hexadecimal digits.
    """
    text = F.regexp_replace(_c(col), ",", "")
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def not_sentinel(col, sentinels: Iterable[str]) -> Column:
    """True for values that are real data (NULL text is not a sentinel)."""
    return ~_c(col).isin(list(sentinels))


def require_not_null(value: Column, raw, message: str) -> Column:
    """``value`` unchanged, but raise when it is NULL while ``raw`` is not."""
    raw = _c(raw)
    return F.when(value.isNull() & raw.isNotNull(),
                  F.raise_error(F.concat(F.lit(message + ": "), raw))).otherwise(value)
