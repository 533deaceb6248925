"""Flatten landed JSON documents into typed rows.

Documents are read with an explicit schema (never inferred):
``spark.read.schema(S).json(path)``, or ``from_json`` over a text column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.dates import parse_day_first
from tidemark.functions.values import not_sentinel, parse_grouped_number, require_not_null
from tidemark.specs import FX_SENTINELS


# A document that cannot be read as its schema fails the load: it must not vanish.
STRICT_JSON = {"mode": "FAILFAST"}
LANDED = "__landed"   # (file modification time, file path) of each landed row


def landed_file() -> Column:
    return F.struct(F.col("_metadata.file_modification_time"),
                    F.col("_metadata.file_path")).alias(LANDED)


def read_documents(spark: SparkSession, path: str, schema: T.StructType,
                   modified_after: str | None = None) -> DataFrame:
    """Documents with their landing file; ``modified_after`` (timestamp text) leaves older
    files unread."""
    reader = spark.read.schema(schema).options(**STRICT_JSON)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.json(path).select("*", landed_file())


def parse_documents(df: DataFrame, text_col: str, schema: T.StructType,
                    carry: Sequence[str] = ()) -> DataFrame:
    """JSON text column → typed struct fields (bad JSON raises)."""
    return df.select(*carry, F.from_json(F.col(text_col), schema, STRICT_JSON).alias("__doc")).select(
        *carry, *[F.col(f"__doc.{f.name}").alias(f.name) for f in schema.fields
                  if f.name not in carry])


def stamp(df: DataFrame, run_ts: dt.datetime | str, col: str = "extracted_at") -> DataFrame:
    """One load instant for every row of a load, passed in (deterministic),
    stored as a zone-less UTC timestamp."""
    text = run_ts.isoformat(sep=" ") if isinstance(run_ts, dt.datetime) else str(run_ts)
    return df.withColumn(col, F.lit(text).cast("timestamp_ntz"))


def _resolve_type(df: DataFrame, path: str) -> T.DataType:
    return df.select(F.col(path)).schema.fields[0].dataType


def explode_parallel(df: DataFrame, arrays: Mapping[str, str],
                     carry: Sequence[str] = ()) -> DataFrame:
    """One row per position of several parallel arrays.

    ``arrays`` maps output column → array path.  Stops at the shortest array
    (a missing array or a missing parent counts as empty ⇒ no rows), unlike
    ``arrays_zip``, which pads to the longest."""
    cols = {}
    for name, path in arrays.items():
        t = _resolve_type(df, path)
        cols[name] = F.coalesce(F.col(path), F.array().cast(t))
    sizes = [F.size(c) for c in cols.values()]
    n = sizes[0] if len(sizes) == 1 else F.least(*sizes)
    zipped = F.arrays_zip(*[c.alias(name) for name, c in cols.items()])
    return df.select(*carry, F.inline(F.slice(zipped, F.lit(1), n)))


def explode_points(df: DataFrame, series_path: str = "bmx.series", points_field: str = "datos",
                   date_field: str = "fecha", value_field: str = "dato",
                   carry: Sequence[str] = (), sentinels: Sequence[str] = FX_SENTINELS,
                   date_col: str = "date", value_col: str = "value") -> DataFrame:
    """Rows from the first element of a nested series array.

    A missing root, a missing or empty series array raises; a series without
    points yields no rows; sentinel values are dropped (not nulled); day-first
    dates; thousands separators stripped; any other unparsable value raises."""
    root = series_path.split(".")[0]
    series = F.col(series_path)
    first = F.when(F.col(root).isNull() | series.isNull() | (F.coalesce(F.size(series), F.lit(0)) < 1),
                   F.raise_error(F.lit(f"document has no '{series_path}' element")))
    first = first.otherwise(F.element_at(series, 1))
    pts_type = _resolve_type(df, series_path).elementType[points_field].dataType
    points = F.coalesce(first.getField(points_field), F.array().cast(pts_type))
    exploded = df.select(*carry, F.explode(points).alias("__p"))
    raw = F.col("__p").getField(value_field)
    kept = exploded.filter(F.coalesce(not_sentinel(raw, sentinels), F.lit(True)))
    parsed = parse_grouped_number(raw)
    value = F.when(parsed.isNull(), F.raise_error(F.concat(
        F.lit(f"unparsable {value_field}: "), F.coalesce(raw, F.lit("NULL"))))).otherwise(parsed)
    fecha = F.col("__p").getField(date_field)
    day = require_not_null(parse_day_first(fecha), fecha, f"unparsable {date_field}")
    return kept.select(*carry, day.alias(date_col), value.alias(value_col))



def weather_rows(docs: DataFrame, run_ts, keep: Sequence[str] = ()) -> DataFrame:
    """Weather documents (``location`` + parallel ``daily`` arrays) → typed
    raw weather rows stamped with the load instant (``keep``: document
    columns carried to every row)."""
    from tidemark import specs
    from tidemark.plans.models import stage_weather_landed

    rows = explode_parallel(docs, specs.WEATHER_ARRAYS, carry=["location", *keep])
    return stamp(stage_weather_landed(rows, keep), run_ts).select(*specs.WEATHER_RAW.columns,
                                                                   *keep)


def fx_rows(docs: DataFrame, run_ts, series_col: str = "series_name",
            keep: Sequence[str] = ()) -> DataFrame:
    """FX documents (``series_name`` + ``bmx.series[0].datos``) → typed raw FX
    rows stamped with the load instant."""
    from tidemark import specs

    rows = explode_points(docs, carry=[series_col, *keep]).withColumnRenamed(series_col, "series")
    return stamp(rows, run_ts).select(*specs.FX_RAW.columns, *keep)


def newest_landing(rows: DataFrame, keys: Sequence[str], order_col: str = LANDED) -> DataFrame:
    """One row per key: that of the greatest ``order_col`` (the newest file that has the
    key).  Two rows of a key with the same order value (one file naming a key twice) raise,
    as does a missing order value: nothing says which reading is right."""
    cols = [c for c in rows.columns if c not in keys]
    order = F.when(F.col(order_col).isNull(), F.raise_error(F.lit(f"row without {order_col}"))
                   ).otherwise(F.col(order_col))
    per_file = rows.withColumn("__order", order).groupBy(*keys, "__order").agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*cols)).alias("__r"))
    picked = per_file.groupBy(*keys).agg(F.max_by("__r", "__order").alias("__r"),
                                         F.max("__n").alias("__n"))
    once = F.when(F.col("__n") > 1, F.raise_error(F.concat_ws(
        " ", F.lit("duplicate key in one landing:"), *[F.col(k).cast("string") for k in keys])))
    return picked.withColumn("__r", once.otherwise(F.col("__r"))).select(
        *[F.col(c) if c in keys else F.col(f"__r.{c}").alias(c) for c in rows.columns])


def read_weather_landing(spark: SparkSession, path: str, run_ts,
                         modified_after: str | None = None) -> DataFrame:
    """All weather JSON documents under ``path`` (one JSON object per line); a day that
    several files hold is read from the newest."""
    from tidemark import specs

    docs = read_documents(spark, path, specs.WEATHER_PAYLOAD, modified_after)
    return newest_landing(weather_rows(docs, run_ts, [LANDED]),
                          specs.WEATHER_RAW.keys).drop(LANDED)


def read_fx_landing(spark: SparkSession, path: str, run_ts,
                    modified_after: str | None = None) -> DataFrame:
    from tidemark import specs

    docs = read_documents(spark, path, specs.FX_PAYLOAD, modified_after)
    return newest_landing(fx_rows(docs, run_ts, keep=[LANDED]), specs.FX_RAW.keys).drop(LANDED)
