"""Staging projections: 1:1 casts and renames, constant filters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.values import require_not_null


def stage(df: DataFrame, columns: Mapping[str, tuple[str, str | None]],
          strict: bool = True) -> DataFrame:
    """``{out_name: (source_col, type_or_None)}`` → ordered, cast projection.

    ``strict``: a value that does not convert fails the query instead of
    silently turning into NULL, whatever the session's ANSI setting."""
    out = []
    for name, (src, t) in columns.items():
        c = F.col(src)
        if t and strict and df.schema[src].dataType.simpleString() != t:
            c = require_not_null(c.try_cast(t), src, f"cannot cast {src} to {t}")
        elif t:
            c = c.cast(t)
        out.append(c.alias(name))
    return df.select(*out)


def keep_equal(df: DataFrame, col: str, value) -> DataFrame:
    """Constant equality filter (pushed into the Parquet scan by Catalyst)."""
    return df.filter(F.col(col) == F.lit(value))


def project(df: DataFrame, columns) -> DataFrame:
    """Explicit ordered projection onto a declared column list."""
    return df.select(*columns)
