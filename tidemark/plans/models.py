"""The model layers: staging → intermediate → mart projection.

Each model is a lazy ``DataFrame -> DataFrame`` function; composing them hands
Catalyst one plan, the way inlined views would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import specs
from tidemark.functions.dates import as_date, business_day
from tidemark.operators.enrich import enrich, gap_fill, gap_fill_sized
from tidemark.operators.staging import keep_equal, project, stage


def stage_weather(raw: DataFrame) -> DataFrame:
    return stage(raw, {
        "location": ("location", None),
        "date": ("date", "date"),
        "temp_max_c": ("temp_max_c", "double"),
        "temp_min_c": ("temp_min_c", "double"),
        "precipitation_mm": ("precipitation_mm", "double"),
        "extracted_at": ("extracted_at", None),
    })


def stage_weather_landed(rows: DataFrame, keep=()) -> DataFrame:
    """Flattened weather documents (ISO date text) → typed raw weather rows
    (plus the ``keep`` columns, unchanged)."""
    return stage(rows, {
        "location": ("location", None),
        "date": ("date", "date"),
        "temp_max_c": ("temp_max_c", "double"),
        "temp_min_c": ("temp_min_c", "double"),
        "precipitation_mm": ("precipitation_mm", "double"),
        **{k: (k, None) for k in keep},
    })


def stage_fx(raw: DataFrame, series: str = specs.FX_SERIES) -> DataFrame:
    return stage(keep_equal(raw, "series", series), {
        "series": ("series", None),
        "date": ("date", "date"),
        "fx_rate": ("value", "double"),
        "extracted_at": ("extracted_at", None),
    })


def fx_gap_filled(stg_fx: DataFrame, bounds: tuple | None = None) -> DataFrame:
    """Every calendar day between the first and last staged rate, with the
    last published rate carried forward and ``is_published_rate``."""
    return gap_fill(stg_fx, "date", "fx_rate", flag_col="is_published_rate", bounds=bounds)


def daily_conditions(stg_weather: DataFrame, fx_filled: DataFrame,
                     fx_rows: int | None = None) -> DataFrame:
    """Weather ⟕ gap-filled FX on date, plus derived columns.

    Weather dates outside the FX calendar get NULL rate and NULL
    ``fx_is_published_rate`` (three-valued, not false)."""
    fx = fx_filled.select("date", F.col("fx_rate").alias("fx_usd_mxn"),
                          F.col("is_published_rate").alias("fx_is_published_rate"))
    joined = enrich(stg_weather, fx, "date", dim_rows=fx_rows)
    return joined.select(
        "location", "date", "temp_max_c", "temp_min_c",
        (F.col("temp_max_c") - F.col("temp_min_c")).alias("temp_range_c"),
        "precipitation_mm", "fx_usd_mxn", "fx_is_published_rate",
        business_day("date").alias("is_business_day"))


def build_conditions(stg_weather: DataFrame, stg_fx: DataFrame, since=None) -> DataFrame:
    """Intermediate model end to end: gap-fill FX (sized), then enrich.

    ``since`` builds only dates on or after it (an incremental build): the
    weather facts are filtered and the FX carry is seeded instead of windowing
    the whole rate history.  Equal to filtering the full build."""
    filled, rows = gap_fill_sized(stg_fx, "date", "fx_rate", flag_col="is_published_rate",
                                  since=since)
    if since is not None:
        stg_weather = stg_weather.filter(F.col("date") >= F.lit(as_date(since)))
    return daily_conditions(stg_weather, filled, rows)


def mart_projection(df: DataFrame) -> DataFrame:
    """Ordered projection onto the mart contract."""
    return project(df, specs.MART.columns)


def register_views(raw_weather: DataFrame, raw_fx: DataFrame, prefix: str = "") -> dict:
    """Expose every model layer as a temporary view for SQL users.  Views are
    lazy: querying one hands Catalyst the composed plan."""
    stg_w, stg_fx = stage_weather(raw_weather), stage_fx(raw_fx)
    filled = fx_gap_filled(stg_fx)
    views = {
        "stg_weather_daily": stg_w,
        "stg_fx": stg_fx,
        "int_fx_gap_filled": filled,
        "int_daily_conditions": daily_conditions(stg_w, filled),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return views
