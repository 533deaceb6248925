"""Role mapping of the driver's tables onto the mart's two source shapes.

* weather-like (``wl``): per entity and day, max / min of a measure and a
  count — the shape of the raw weather table.
* rate-like (``rl``): one value per weekday, nothing on weekends — the shape
  of the raw FX table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import business_day


# Declared schemas of the tables that the queries read.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read with its declared schema (no inference job)."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def weather_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → entity = event_type."""
    ev = load(spark, sf_dir, "events")
    return (ev.groupBy(F.col("event_type").alias("location"),
                       F.col("ts").cast("date").alias("date"))
            .agg(F.max("value").alias("temp_max_c"), F.min("value").alias("temp_min_c"),
                 F.count(F.lit(1)).cast("double").alias("precipitation_mm")))


def weather_bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ supplier ⋈ nation → entity = supplier nation, day = ship date.

    The joins are left to the planner: ``nation`` is a fixed 25 rows and
    ``supplier`` grows with the scale factor, so only its measured size may
    turn it into a broadcast.  The aggregate is partial on the map side, so
    at most (#nations × #days) rows per task cross the shuffle."""
    li = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", "l_shipdate")
    su = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    na = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = (li.join(su, li.l_suppkey == su.s_suppkey)
              .join(na, F.col("s_nationkey") == na.n_nationkey))
    return (joined.groupBy(F.col("n_name").alias("location"),
                           F.col("l_shipdate").cast("date").alias("date"))
            .agg(F.max("l_extendedprice").alias("temp_max_c"),
                 F.min("l_extendedprice").alias("temp_min_c"),
                 F.count(F.lit(1)).cast("double").alias("precipitation_mm")))


def rate_bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → one rate per weekday (max total price of the day)."""
    o = load(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    d = F.col("o_orderdate").cast("date")
    return (o.filter(business_day(d)).groupBy(d.alias("date"))
            .agg(F.max("o_totalprice").alias("fx_rate")))


def rate_raw(spark: SparkSession, sf_dir: str, series: str = "fx_usd_mxn") -> DataFrame:
    """rate-like rows in the raw FX table layout (series, date, value)."""
    return rate_bench(spark, sf_dir).select(F.lit(series).alias("series"), "date",
                                            F.col("fx_rate").alias("value"))
