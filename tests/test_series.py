import pytest
from pyspark.sql import functions as F

from conftest import D, plan_text, rows
from tidemark.functions.dates import month_bucket
from tidemark.operators.enrich import enrich, gap_fill, gap_fill_sized
from tidemark.operators.series import (calendar_spine, carry_forward,
                                       carry_forward_increment)


@pytest.fixture
def rates(spark):
    # Thu NULL, Fri 17.0, Mon 17.2 (FIXTURES gap-fill golden case)
    return spark.createDataFrame(
        [(D("2024-01-04"), None), (D("2024-01-05"), 17.0), (D("2024-01-08"), 17.2)],
        "date date, fx_rate double")


def test_gap_fill_golden(rates):
    got = rows(gap_fill(rates, "date", "fx_rate"))
    assert got == [
        (D("2024-01-04"), None, False),   # leading NULL stays but starts the calendar
        (D("2024-01-05"), 17.0, True),
        (D("2024-01-06"), 17.0, False),
        (D("2024-01-07"), 17.0, False),
        (D("2024-01-08"), 17.2, True),
    ]


def test_gap_fill_sized_literal_bounds(rates):
    df, n = gap_fill_sized(rates, "date", "fx_rate")
    assert n == 5 and df.count() == 5
    assert rows(df) == rows(gap_fill(rates, "date", "fx_rate"))


def test_empty_input_gives_no_rows(spark):
    empty = spark.createDataFrame([], "date date, fx_rate double")
    assert gap_fill(empty, "date", "fx_rate").count() == 0
    assert calendar_spine(empty, "date").count() == 0
    df, n = gap_fill_sized(empty, "date", "fx_rate")
    assert n == 0 and df.count() == 0


def test_enrichment_golden(spark, rates):
    fx = gap_fill(rates, "date", "fx_rate")
    weather = spark.createDataFrame(
        [(d,) for d in ("2024-01-03", "2024-01-05", "2024-01-06", "2024-01-07", "2024-01-09")],
        "d string").select(F.col("d").cast("date").alias("date"))
    from tidemark.functions.dates import business_day
    out = enrich(weather, fx, "date", dim_rows=5).select(
        "date", "fx_rate", "is_published_rate", business_day("date").alias("bd"))
    assert rows(out) == [
        (D("2024-01-03"), None, None, True),    # before the calendar: NULL flag
        (D("2024-01-05"), 17.0, True, True),    # Friday is a business day
        (D("2024-01-06"), 17.0, False, False),  # Saturday
        (D("2024-01-07"), 17.0, False, False),  # Sunday
        (D("2024-01-09"), None, None, True),    # after the calendar
    ]
    assert "BroadcastHashJoin" in plan_text(out)


def _series(spark, n_keys=3, days=400):
    import random
    rnd = random.Random(7)
    data = []
    for k in range(n_keys):
        for i in range(days):
            v = None if rnd.random() < 0.6 else rnd.random()
            if i < 3:
                v = None
            data.append((f"k{k}", D("2023-01-01").fromordinal(D("2023-01-01").toordinal() + i), v))
    return spark.createDataFrame(data, "k string, date date, v double")


def test_locf_forms_agree(spark):
    df = _series(spark)
    keyed = rows(carry_forward(df, "date", ["v"], keys=["k"]))
    bucketed = rows(carry_forward(df, "date", ["v"], keys=["k"], bucket=month_bucket("date")))
    assert keyed == bucketed
    one = df.filter("k = 'k1'").drop("k")
    assert rows(carry_forward(one, "date", ["v"])) == \
        rows(carry_forward(one, "date", ["v"], bucket=month_bucket("date")))
    assert rows(carry_forward(one, "date", ["v"])) == \
        [(d, v) for k, d, v in keyed if k == "k1"]


def test_increment_equals_filtered_full(spark):
    df = _series(spark)
    since = D("2023-07-15")
    full = carry_forward(df, "date", ["v"], keys=["k"]).filter(F.col("date") >= since)
    assert rows(carry_forward_increment(df, "date", ["v"], since, keys=["k"])) == rows(full)
    one = df.filter("k = 'k2'").drop("k")
    full1 = carry_forward(one, "date", ["v"]).filter(F.col("date") >= since)
    assert rows(carry_forward_increment(one, "date", ["v"], since)) == rows(full1)


def test_keyed_locf_is_not_single_partition(spark):
    df = _series(spark)
    assert "SinglePartition" not in plan_text(carry_forward(df, "date", ["v"], keys=["k"]))
    assert "SinglePartition" in plan_text(carry_forward(df.drop("k"), "date", ["v"]))
    # bucketed global form: parallel local windows; only the bucket carries
    # (one row per month) are windowed in a single partition
    b = carry_forward(df.filter("k='k0'").drop("k"), "date", ["v"], bucket=month_bucket("date"))
    assert "hashpartitioning(__tm_bucket" in plan_text(b)


@pytest.mark.parametrize("since", ["2023-01-02", "2023-06-15", "2024-03-01", "2030-01-01"])
def test_gap_fill_since_equals_filtered(spark, since):
    df = _series(spark).filter("v is not null or date = '2023-01-02'")
    s = D(since)
    full = gap_fill(df, "date", "v", keys=["k"], flag_col="f").filter(F.col("date") >= s)
    assert rows(gap_fill(df, "date", "v", keys=["k"], flag_col="f", since=s)) == rows(full)
    one = df.filter("k = 'k0'").drop("k")
    full1 = gap_fill(one, "date", "v", flag_col="f").filter(F.col("date") >= s)
    sized, n = gap_fill_sized(one, "date", "v", flag_col="f", since=s)
    assert rows(sized) == rows(full1) and n >= len(rows(full1))


def test_sized_rows_are_exact_and_buckets_are_the_callers_choice(spark):
    one = _series(spark).filter("k = 'k0'").drop("k")
    filled, n = gap_fill_sized(one, "date", "v", flag_col="f")
    assert n == filled.count() == 400
    bucketed, n2 = gap_fill_sized(one, "date", "v", flag_col="f", bucket=month_bucket("date"))
    assert n2 == n and "__tm_bucket" in plan_text(bucketed)
    assert rows(bucketed) == rows(filled)


def test_single_scan_fill_keeps_nulls_gaps_and_repeats(spark):
    S_ = "k string, date date, v double"
    df = spark.createDataFrame([("a", D("2024-01-01"), None), ("a", D("2024-01-03"), 3.0),
                                ("a", D("2024-01-06"), None), ("b", D("2024-01-02"), 1.0),
                                ("b", None, 9.0)], S_)
    got = rows(gap_fill(df, "date", "v", keys=["k"], flag_col="f"))
    assert got == [("a", D("2024-01-01"), None, False), ("a", D("2024-01-02"), None, False),
                   ("a", D("2024-01-03"), 3.0, True), ("a", D("2024-01-04"), 3.0, False),
                   ("a", D("2024-01-05"), 3.0, False), ("a", D("2024-01-06"), 3.0, False),
                   ("b", D("2024-01-02"), 1.0, True)]
    assert gap_fill(df.limit(0), "date", "v", keys=["k"]).count() == 0
    assert gap_fill(df.limit(0).drop("k"), "date", "v").count() == 0


def test_model_views_for_sql_users(spark, rates):
    from tidemark.plans.models import register_views
    from tidemark.specs import FX_RAW, WEATHER_RAW
    weather = spark.createDataFrame([("cdmx", D("2024-01-06"), 20.0, 10.0, 0.0, None)],
                                    WEATHER_RAW.schema)
    fx = rates.select(F.lit("fx_usd_mxn").alias("series"), "date",
                      F.col("fx_rate").alias("value"),
                      F.lit(None).cast("timestamp_ntz").alias("extracted_at"))
    register_views(weather, fx, prefix="t_")
    got = spark.sql("SELECT location, fx_usd_mxn, fx_is_published_rate, is_business_day "
                    "FROM t_int_daily_conditions").collect()
    assert [tuple(r) for r in got] == [("cdmx", 17.0, False, False)]
    assert spark.sql("SELECT count(*) FROM t_int_fx_gap_filled").first()[0] == 5


def test_bucketed_carry_splits_a_hot_key(spark):
    """One key holds most rows: the keyed window puts them all in one task,
    the month-bucketed form spreads them over the cluster."""
    import datetime as dt
    hot = [("hot", dt.date(1970, 1, 1) + dt.timedelta(days=i), float(i) if i % 3 == 0 else None)
           for i in range(6000)]
    cold = [(f"c{j}", dt.date(2000, 1, 1) + dt.timedelta(days=i), 1.0)
            for j in range(3) for i in range(50)]
    df = spark.createDataFrame(hot + cold, "k string, date date, v double")
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def max_share(out):
            # consume the carried column so the window is not pruned away
            per_task = (out.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p"))
                        .agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("mx")).collect())
            return max(r["n"] for r in per_task) / 6000

        plain = carry_forward(df, "date", ["v"], keys=["k"])
        bucketed = carry_forward(df, "date", ["v"], keys=["k"], bucket=month_bucket("date"))
        assert max_share(plain) == 1.0
        assert max_share(bucketed) < 0.35
        assert rows(plain) == rows(bucketed)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
