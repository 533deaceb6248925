"""Scalar column functions (all native Spark expressions)."""

from tidemark.functions.dates import (
    business_day, dow_sunday0, parse_day_first,
    month_bucket, as_date, trunc_ntz,
)
from tidemark.functions.values import (
    parse_grouped_number, not_sentinel, require_not_null,
)

__all__ = [
    "business_day", "dow_sunday0", "parse_day_first",
    "month_bucket", "as_date", "trunc_ntz", "parse_grouped_number", "not_sentinel",
    "require_not_null",
]
