"""Declared schemas, keys and per-source settings.

Schemas are passed to every read (no inference) and compared before every
write (``operators.quality.contract_diff``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """A stored table: schema, natural key and the date column it is
    partitioned on.

    ``grain`` is the partition unit: ``"month"`` (default; a small daily
    series would make tiny files per day) or ``"day"`` for large tables, so a
    daily increment rewrites only the days it touches instead of whole
    months."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    date_col: str = "date"
    grain: str = "month"

    def __post_init__(self):
        if self.grain not in ("month", "day"):
            raise ValueError("grain must be 'month' or 'day'")

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def part_col(self) -> str:
        return self.grain

    def with_grain(self, grain: str) -> "TableSpec":
        from dataclasses import replace

        return replace(self, grain=grain)


@dataclass(frozen=True)
class SourceSpec:
    """One extracted source: its raw table plus the window-planning knobs."""

    name: str
    table: TableSpec
    lag_days: int
    default_days: int = 30


def _schema(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


# Fixed values that must equal the reference's: table layouts, natural keys,
# freshness lags (weather 5 days, FX 1 day), first-run span (30 days back),
# mart lookback (10 days), FX series name and accepted FX range (5 to 50).
WEATHER_RAW = TableSpec(
    "weather_daily",
    _schema(("location", T.StringType(), False),
            ("date", T.DateType(), False),
            ("temp_max_c", T.DoubleType(), True),
            ("temp_min_c", T.DoubleType(), True),
            ("precipitation_mm", T.DoubleType(), True),
            ("extracted_at", T.TimestampNTZType(), True)),
    keys=("location", "date"),
)

FX_RAW = TableSpec(
    "fx_rates",
    _schema(("series", T.StringType(), False),
            ("date", T.DateType(), False),
            ("value", T.DoubleType(), True),
            ("extracted_at", T.TimestampNTZType(), True)),
    keys=("series", "date"),
)

MART = TableSpec(
    "daily_conditions",
    _schema(("location", T.StringType(), True),
            ("date", T.DateType(), True),
            ("temp_max_c", T.DoubleType(), True),
            ("temp_min_c", T.DoubleType(), True),
            ("temp_range_c", T.DoubleType(), True),
            ("precipitation_mm", T.DoubleType(), True),
            ("fx_usd_mxn", T.DoubleType(), True),
            ("fx_is_published_rate", T.BooleanType(), True),
            ("is_business_day", T.BooleanType(), True)),
    keys=("location", "date"),
)

STATE = TableSpec(
    "watermarks",
    _schema(("source", T.StringType(), False),
            ("last_watermark", T.DateType(), True)),
    keys=("source",),
    date_col="last_watermark",
)

WEATHER = SourceSpec("weather", WEATHER_RAW, lag_days=5, default_days=30)
FX = SourceSpec("fx", FX_RAW, lag_days=1, default_days=30)

FX_SERIES = "fx_usd_mxn"
MART_LOOKBACK_DAYS = 10
FX_RANGE = (5.0, 50.0)

# Weather payload: one document per entity with parallel daily arrays.
WEATHER_ARRAYS = {
    "date": "daily.time",
    "temp_max_c": "daily.temperature_2m_max",
    "temp_min_c": "daily.temperature_2m_min",
    "precipitation_mm": "daily.precipitation_sum",
}

WEATHER_PAYLOAD = T.StructType([
    T.StructField("location", T.StringType()),
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m_max", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m_min", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
    ])),
])

# FX payload: bmx.series[0].datos[] of {fecha 'dd/MM/yyyy', dato text}.
FX_PAYLOAD = T.StructType([
    T.StructField("series_name", T.StringType()),
    T.StructField("bmx", T.StructType([
        T.StructField("series", T.ArrayType(T.StructType([
            T.StructField("idSerie", T.StringType()),
            T.StructField("datos", T.ArrayType(T.StructType([
                T.StructField("fecha", T.StringType()),
                T.StructField("dato", T.StringType()),
            ]))),
        ]))),
    ])),
])

# Sentinels the FX source uses for "no value published".
FX_SENTINELS = ("N/E", "")
