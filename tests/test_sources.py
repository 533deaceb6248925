import json

import pytest

from conftest import D, rows
from tidemark.sources.landed import explode_parallel, explode_points, parse_documents
from tidemark.specs import FX_PAYLOAD, WEATHER_ARRAYS, WEATHER_PAYLOAD


def _weather(spark, daily):
    body = json.dumps({"location": "cdmx", **({"daily": daily} if daily is not None else {})})
    docs = parse_documents(spark.createDataFrame([(body,)], "body string"), "body", WEATHER_PAYLOAD)
    return explode_parallel(docs, WEATHER_ARRAYS, carry=["location"])


FULL = {"time": ["2024-01-01", "2024-01-02", "2024-01-03"],
        "temperature_2m_max": [1.0, 2.0, 3.0], "temperature_2m_min": [0.0, 1.0, 2.0],
        "precipitation_sum": [0.0, 0.5, 0.0]}


def test_parallel_arrays_cases(spark):
    assert _weather(spark, FULL).count() == 3
    short = dict(FULL, temperature_2m_min=[0.0, 1.0])
    got = rows(_weather(spark, short), "date", "temp_min_c")
    assert got == [("2024-01-01", 0.0), ("2024-01-02", 1.0)]       # stops at the shortest
    missing = {k: v for k, v in FULL.items() if k != "precipitation_sum"}
    assert _weather(spark, missing).count() == 0
    assert _weather(spark, None).count() == 0
    nulls = dict(FULL, time=["2024-01-01", "2024-01-02"], temperature_2m_max=[1.0, None])
    got = rows(_weather(spark, nulls), "date", "temp_max_c")
    assert got[1] == ("2024-01-02", None)


def _fx(spark, payload):
    docs = parse_documents(spark.createDataFrame([("fx_usd_mxn", json.dumps(payload))],
                                                 "series_name string, body string"),
                           "body", FX_PAYLOAD, carry=["series_name"])
    return explode_points(docs, carry=["series_name"])


def _series(*datos):
    return {"bmx": {"series": [{"idSerie": "S1",
                                "datos": [{"fecha": f, "dato": d} for f, d in datos]}]}}


def test_nested_points_cases(spark):
    got = rows(_fx(spark, _series(("02/01/2025", "20.5"), ("3/1/2025", "1,020.5"),
                                  ("04/01/2025", "N/E"), ("05/01/2025", ""))), "date", "value")
    assert got == [(D("2025-01-02"), 20.5), (D("2025-01-03"), 1020.5)]  # day first, dropped sentinels
    assert _fx(spark, {"bmx": {"series": [{"idSerie": "x"}]}}).count() == 0
    two = _series(("02/01/2025", "1.0"))
    two["bmx"]["series"].append({"idSerie": "y", "datos": [{"fecha": "03/01/2025", "dato": "2"}]})
    assert rows(_fx(spark, two), "value") == [(1.0,)]                 # only the first series


@pytest.mark.parametrize("payload", [
    {"other": 1},                                     # no bmx
    {"bmx": {"series": []}},                          # empty series
    _series(("02/01/2025", "abc")),                   # bad number
])
def test_nested_points_failures(spark, payload):
    with pytest.raises(Exception):
        _fx(spark, payload).collect()


def test_failures_do_not_depend_on_ansi(spark):
    from tidemark.operators.staging import stage
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            _fx(spark, _series(("2025-01-02", "1.0"))).collect()       # not day-first
        bad = spark.createDataFrame([("x",)], "v string")
        with pytest.raises(Exception):
            stage(bad, {"v": ("v", "double")}).collect()
        ok = spark.createDataFrame([("1.5",), (None,)], "v string")
        assert sorted(stage(ok, {"v": ("v", "double")}).collect(), key=str) == \
            sorted([(1.5,), (None,)], key=str)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)


def test_landing_files_to_raw_rows(spark, tmp_root):
    import datetime as dt
    from tidemark.sources.landed import read_fx_landing, read_weather_landing
    from tidemark.specs import FX_RAW, WEATHER_RAW

    with open(f"{tmp_root}/w.json", "w") as f:
        f.write(json.dumps({"location": "cdmx", "daily": FULL}) + "\n")
        f.write(json.dumps({"location": "monterrey", "daily": dict(FULL, time=FULL["time"][:1])}) + "\n")
    with open(f"{tmp_root}/fx.json", "w") as f:
        f.write(json.dumps(dict(_series(("02/01/2025", "20.5"), ("04/01/2025", "N/E")),
                                series_name="fx_usd_mxn")) + "\n")
    ts = dt.datetime(2025, 1, 5, 6)
    w = read_weather_landing(spark, f"{tmp_root}/w.json", ts)
    assert w.columns == WEATHER_RAW.columns and w.count() == 4
    fx = read_fx_landing(spark, f"{tmp_root}/fx.json", ts)
    assert fx.columns == FX_RAW.columns
    assert rows(fx, "series", "date", "value") == [("fx_usd_mxn", D("2025-01-02"), 20.5)]


def test_profile_extra_types(spark):
    from pyspark.sql import types as T
    from tidemark.operators.profile import profile
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    r = profile(df, extra_types=(T.StringType,)).collect()[0]
    assert (r.min_value, r.max_value, r.distinct_count) == ("a", "b", 2)


def test_load_stamp_ignores_session_time_zone(spark):
    import datetime as dt
    from tidemark.sources.landed import stamp
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = []
        for tz in ("UTC", "America/Mexico_City", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got.append(stamp(spark.range(1), dt.datetime(2025, 1, 5, 12, 0)).first().extracted_at)
        assert got == [dt.datetime(2025, 1, 5, 12, 0)] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


@pytest.mark.parametrize("line", [
    '{"location": "cdmx", "daily": {"time": ["2024-01-01"',                      # truncated
    '{"location": "cdmx", "daily": {"time": ["2024-01-01"], "temperature_2m_max": ["x"], '
    '"temperature_2m_min": [1.0], "precipitation_sum": [0.0]}}',                 # wrong type
])
def test_bad_documents_fail_the_load(spark, tmp_root, line):
    import datetime as dt
    from tidemark.sources.landed import read_weather_landing
    with open(f"{tmp_root}/w.json", "w") as f:
        f.write(json.dumps({"location": "cdmx", "daily": FULL}) + "\n" + line + "\n")
    with pytest.raises(Exception):
        read_weather_landing(spark, f"{tmp_root}/w.json", dt.datetime(2025, 1, 5)).collect()


@pytest.mark.parametrize("text", ["17.5d", "17.5f", "0x1p3", "1 2", "--1", "1e", ""])
def test_only_decimal_numbers_parse(spark, text):
    from tidemark.functions.values import parse_grouped_number
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(parse_grouped_number("v").alias("v")).first().v is None


def test_decimal_numbers_parse(spark):
    from tidemark.functions.values import parse_grouped_number
    good = {"1,020.5": 1020.5, " -3 ": -3.0, "+.5": 0.5, "2.": 2.0, "1e3": 1000.0}
    df = spark.createDataFrame([(k,) for k in good], "t string")
    assert {r.t: r.v for r in df.select("t", parse_grouped_number("t").alias("v")).collect()} == good


def test_a_day_in_two_files_is_read_from_the_newer(spark, tmp_root):
    import datetime as dt
    import os
    import time
    from tidemark.plans.build import Layout, load_source
    from tidemark.sources.landed import read_weather_landing
    from tidemark.sources.tables import read_table
    from tidemark.specs import WEATHER, WEATHER_RAW

    os.makedirs(f"{tmp_root}/land")

    def doc(name, days, tmax):
        with open(f"{tmp_root}/land/{name}.json", "w") as f:
            f.write(json.dumps({"location": "cdmx", "daily": {
                "time": days, "temperature_2m_max": [tmax] * len(days),
                "temperature_2m_min": [1.0] * len(days),
                "precipitation_sum": [0.0] * len(days)}}) + "\n")

    def run(today):
        landed = read_weather_landing(spark, f"{tmp_root}/land", dt.datetime(2024, 1, 9))
        return load_source(spark, lay, WEATHER, landed, today, reread_days=3)

    lay = Layout(f"{tmp_root}/wh")
    doc("a", ["2024-01-01", "2024-01-02"], 20.0)
    run(D("2024-01-07"))
    time.sleep(1.1)
    doc("b", ["2024-01-02", "2024-01-03"], 30.0)
    run(D("2024-01-08"))
    got = rows(read_table(spark, lay.raw_weather, WEATHER_RAW), "date", "temp_max_c")
    assert got == [(D("2024-01-01"), 20.0), (D("2024-01-02"), 30.0), (D("2024-01-03"), 30.0)]
    with open(f"{tmp_root}/land/c.json", "w") as f:    # one file names a day twice
        f.write(json.dumps({"location": "cdmx", "daily": dict(
            FULL, time=["2024-01-04", "2024-01-04", "2024-01-05"])}) + "\n")
    with pytest.raises(Exception, match="duplicate key"):
        run(D("2024-01-10"))
