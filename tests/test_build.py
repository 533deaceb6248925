import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import D, rows
from tidemark import specs
from tidemark.operators.quality import ContractViolation
from tidemark.operators.upsert import KeyViolation
from tidemark.plans import models
from tidemark.plans.build import Layout, build_mart, load_source
from tidemark.sources.landed import explode_parallel, explode_points, parse_documents, stamp
from tidemark.sources.state import load_state, watermark_of
from tidemark.sources.tables import read_table

START, DAYS = D("2024-12-01"), 92


def _weather_rows(spark, run_ts):
    docs = []
    for loc, base in (("cdmx", 20.0), ("monterrey", 28.0)):
        days = [START + dt.timedelta(days=i) for i in range(DAYS)]
        docs.append((json.dumps({"location": loc, "daily": {
            "time": [d.isoformat() for d in days],
            "temperature_2m_max": [base + (i % 5) for i in range(DAYS)],
            "temperature_2m_min": [base - 10 + (i % 3) for i in range(DAYS)],
            "precipitation_sum": [float(i % 2) for i in range(DAYS)]}}),))
    df = parse_documents(spark.createDataFrame(docs, "body string"), "body",
                         specs.WEATHER_PAYLOAD)
    return stamp(models.stage_weather_landed(explode_parallel(df, specs.WEATHER_ARRAYS,
                                                              carry=["location"])), run_ts)


def _fx_rows(spark, run_ts):
    pts = []
    for i in range(DAYS):
        d = START + dt.timedelta(days=i)
        pts.append({"fecha": d.strftime("%d/%m/%Y"),
                    "dato": "N/E" if d.weekday() >= 5 else f"{17 + i / 100:.4f}"})
    body = json.dumps({"bmx": {"series": [{"idSerie": "S1", "datos": pts}]}})
    df = parse_documents(spark.createDataFrame([("fx_usd_mxn", body)], "series_name string, body string"),
                         "body", specs.FX_PAYLOAD, carry=["series_name"])
    rows = explode_points(df, carry=["series_name"]).withColumnRenamed("series_name", "series")
    return stamp(rows, run_ts)


def test_backfill_and_incremental_runs(spark, tmp_root):
    lay = Layout(tmp_root)
    run_ts = dt.datetime(2025, 3, 1, 12)
    w = _weather_rows(spark, run_ts)
    # backfill one month: 31 days x 2 entities, watermark untouched
    r = load_source(spark, lay, specs.WEATHER, w, D("2025-03-01"), "backfill",
                    D("2025-01-01"), D("2025-01-31"))
    assert r.rows_loaded == 62
    assert watermark_of(load_state(spark, lay.state), "weather") is None
    # first incremental run: 30 days back from today - lag
    r1 = load_source(spark, lay, specs.WEATHER, w, D("2025-03-01"))
    assert (r1.window_start, r1.window_end) == (D("2025-01-25"), D("2025-02-24"))
    assert watermark_of(load_state(spark, lay.state), "weather") == D("2025-02-24")
    # second immediate run: nothing new, nothing loaded
    r2 = load_source(spark, lay, specs.WEATHER, w, D("2025-03-01"))
    assert r2.nothing_new and r2.rows_loaded == 0
    n = read_table(spark, lay.raw_weather, specs.WEATHER_RAW).count()
    assert n == 2 * (D("2025-02-24") - D("2025-01-01")).days + 2
    # reloading the same window (lost state) does not duplicate
    load_source(spark, lay, specs.WEATHER, w, D("2025-03-01"), "backfill",
                D("2025-01-01"), D("2025-02-24"))
    assert read_table(spark, lay.raw_weather, specs.WEATHER_RAW).count() == n


def test_build_twice_is_stable_and_checked(spark, tmp_root):
    lay = Layout(tmp_root)
    run_ts = dt.datetime(2025, 3, 1, 12)
    load_source(spark, lay, specs.WEATHER, _weather_rows(spark, run_ts), D("2025-03-01"),
                "backfill", START)
    load_source(spark, lay, specs.FX, _fx_rows(spark, run_ts), D("2025-03-01"), "backfill", START)
    rep1 = {r.check_name + ":" + r.column_name: r.failures for r in build_mart(spark, lay).collect()}
    n1 = read_table(spark, lay.mart, specs.MART).count()
    rep2 = {r.check_name + ":" + r.column_name: r.failures for r in build_mart(spark, lay).collect()}
    mart = read_table(spark, lay.mart, specs.MART)
    assert n1 == mart.count() == 2 * (D("2025-02-24") - START).days + 2
    assert rep1 == rep2 and all(v == 0 for v in rep2.values())
    sat = mart.filter((F.col("location") == "cdmx") & (F.col("date") == D("2024-12-07"))).first()
    assert sat.is_business_day is False and sat.fx_is_published_rate is False
    # full refresh gives the same table
    build_mart(spark, lay, full_refresh=True)
    assert read_table(spark, lay.mart, specs.MART).count() == n1


def test_schema_drift_fails_before_models(spark, tmp_root):
    lay = Layout(tmp_root)
    run_ts = dt.datetime(2025, 3, 1, 12)
    load_source(spark, lay, specs.WEATHER, _weather_rows(spark, run_ts), D("2025-03-01"),
                "backfill", START)
    drifted = _fx_rows(spark, run_ts).withColumnRenamed("value", "valor")
    drifted.withColumn("month", F.trunc("date", "month")).write.partitionBy("month").parquet(lay.raw_fx)
    with pytest.raises(ContractViolation, match="valor"):
        build_mart(spark, lay)


def test_injected_fault_fails_one_check_and_is_traced(spark, tmp_root):
    from tidemark.plans.build import diagnose, inject_business_rule_fault

    lay = Layout(tmp_root)
    run_ts = dt.datetime(2025, 3, 1, 12)
    load_source(spark, lay, specs.WEATHER, _weather_rows(spark, run_ts), D("2025-03-01"),
                "backfill", START)
    load_source(spark, lay, specs.FX, _fx_rows(spark, run_ts), D("2025-03-01"), "backfill", START)
    build_mart(spark, lay)
    assert inject_business_rule_fault(spark, lay, "cdmx", D("2025-02-20")) == 1
    report = {r.check_name: r.failures for r in build_mart(spark, lay).collect()}
    assert report["max_not_below_min"] == 1           # exactly one failure
    assert sum(report.values()) == 1
    got = diagnose(spark, lay).collect()
    assert len(got) == 1 and got[0].raw_temp_max_c == 5.0 and got[0].raw_temp_min_c == 25.0
    assert got[0].raw_extracted_at == run_ts
    assert got[0].check_name == "max_not_below_min"
    # a tighter FX range flags every row whose rate is outside it, in the same scan
    from tidemark.operators.quality import accepted_range
    tight = diagnose(spark, lay, [accepted_range("fx_usd_mxn", 17.0, 17.5)]).collect()
    assert tight and all(r.check_name == "accepted_range" for r in tight)
    assert all(not (17.0 <= r.fx_usd_mxn <= 17.5) for r in tight)


def test_build_window_replace_strategy(spark, tmp_root):
    lay = Layout(tmp_root)
    run_ts = dt.datetime(2025, 3, 1, 12)
    w = _weather_rows(spark, run_ts)
    load_source(spark, lay, specs.WEATHER, w, D("2025-03-01"), "backfill", START)
    load_source(spark, lay, specs.FX, _fx_rows(spark, run_ts), D("2025-03-01"), "backfill", START)
    build_mart(spark, lay)
    n = read_table(spark, lay.mart, specs.MART).count()
    # a raw key inside the lookback vanishes (rewrite its month without it)
    from tidemark.sources.tables import write_months
    feb = read_table(spark, lay.raw_weather, specs.WEATHER_RAW, [D("2025-02-01")])
    kept = feb.filter(~((F.col("location") == "cdmx") & (F.col("date") == D("2025-02-22"))))
    kept.write.parquet(f"{tmp_root}/stage")         # stage: never overwrite what is read
    write_months(spark.read.schema(specs.WEATHER_RAW.schema).parquet(f"{tmp_root}/stage"),
                 lay.raw_weather, specs.WEATHER_RAW)
    build_mart(spark, lay)                                         # delete+insert: key stays
    assert read_table(spark, lay.mart, specs.MART).count() == n
    build_mart(spark, lay, strategy="window_replace")              # window replace: gone
    assert read_table(spark, lay.mart, specs.MART).count() == n - 1


def test_reread_days_reloads_revised_days(spark, tmp_root):
    lay = Layout(tmp_root)
    run_ts = dt.datetime(2025, 3, 1, 12)
    w = _weather_rows(spark, run_ts)
    load_source(spark, lay, specs.WEATHER, w, D("2025-02-20"))          # watermark 2025-02-15
    revised = w.withColumn("temp_max_c", F.col("temp_max_c") + 100)
    r = load_source(spark, lay, specs.WEATHER, revised, D("2025-02-23"), reread_days=3)
    assert (r.window_start, r.window_end) == (D("2025-02-13"), D("2025-02-18"))
    got = {d: v for d, v in rows(read_table(spark, lay.raw_weather, specs.WEATHER_RAW).filter(
        F.col("location") == "cdmx"), "date", "temp_max_c")}
    assert got[D("2025-02-13")] > 100 and got[D("2025-02-12")] < 100


def test_lost_state_rerun_does_not_duplicate(spark, tmp_root):
    from tidemark.session import delete_path

    lay = Layout(tmp_root)
    w = _weather_rows(spark, dt.datetime(2025, 3, 1, 12))
    first = load_source(spark, lay, specs.WEATHER, w, D("2025-03-01"))
    n = read_table(spark, lay.raw_weather, specs.WEATHER_RAW).count()
    delete_path(spark, lay.state)                      # state lost after the data commit
    again = load_source(spark, lay, specs.WEATHER, w, D("2025-03-01"))
    assert (again.window_start, again.window_end) == (first.window_start, first.window_end)
    assert read_table(spark, lay.raw_weather, specs.WEATHER_RAW).count() == n
    assert watermark_of(load_state(spark, lay.state), "weather") == first.window_end


def _loaded(spark, tmp_root):
    lay, run_ts = Layout(tmp_root), dt.datetime(2025, 3, 1, 12)
    load_source(spark, lay, specs.WEATHER, _weather_rows(spark, run_ts), D("2025-03-01"),
                "backfill", START)
    load_source(spark, lay, specs.FX, _fx_rows(spark, run_ts), D("2025-03-01"), "backfill", START)
    return lay


@pytest.mark.parametrize("change", ["rename", "retype", "one_file_lacks_it"])
def test_drift_in_an_older_partition_fails_the_build(spark, tmp_root, change):
    lay = _loaded(spark, tmp_root)
    build_mart(spark, lay)
    part = f"{lay.raw_fx}/month=2025-01-01"
    old = spark.read.parquet(part)
    rows_ = old.collect()
    new = spark.createDataFrame(rows_, old.schema)
    if change == "rename":
        new.withColumnRenamed("value", "valor").write.mode("overwrite").parquet(part)
    elif change == "retype":
        new.withColumn("value", F.col("value").cast("string")).write.mode("overwrite").parquet(part)
    else:
        new.drop("value").limit(1).write.mode("append").parquet(part)
    with pytest.raises(ContractViolation, match="value"):
        build_mart(spark, lay)


@pytest.mark.parametrize("how", [{"full_refresh": True}, {"strategy": "window_replace"}, {}])
def test_a_missing_input_never_touches_the_mart(spark, tmp_root, how):
    from tidemark.session import delete_path

    lay = _loaded(spark, tmp_root)
    build_mart(spark, lay)
    before = rows(read_table(spark, lay.mart, specs.MART), "location", "date")
    delete_path(spark, lay.raw_fx)
    with pytest.raises(ContractViolation, match="absent or empty"):
        build_mart(spark, lay, **how)
    assert rows(read_table(spark, lay.mart, specs.MART), "location", "date") == before


def test_landed_rows_without_a_key_fail_the_load(spark, tmp_root):
    lay, run_ts = Layout(tmp_root), dt.datetime(2025, 3, 1, 12)
    w = _weather_rows(spark, run_ts)
    lost = w.withColumn("date", F.when(F.col("date") != D("2025-01-05"), F.col("date")))
    with pytest.raises(KeyViolation, match="NULL"):
        load_source(spark, lay, specs.WEATHER, lost, D("2025-03-01"), "backfill", START)
    body = json.dumps({"bmx": {"series": [{"idSerie": "S1", "datos": [
        {"fecha": "02/01/2025", "dato": "1.0"}, {"dato": "2.0"}]}]}})
    docs = parse_documents(spark.createDataFrame(
        [("fx_usd_mxn", body)], "series_name string, body string"), "body", specs.FX_PAYLOAD,
        carry=["series_name"])
    fx = stamp(explode_points(docs, carry=["series_name"]).withColumnRenamed(
        "series_name", "series"), run_ts)
    with pytest.raises(KeyViolation):
        load_source(spark, lay, specs.FX, fx, D("2025-03-01"), "backfill", START)


def test_rate_failures_are_traced_to_the_day_their_rate_is_from(spark, tmp_root):
    from tidemark.operators.quality import accepted_range
    from tidemark.plans.build import diagnose

    lay = _loaded(spark, tmp_root)
    build_mart(spark, lay)
    got = diagnose(spark, lay, [accepted_range("fx_usd_mxn", 17.0, 17.5)]).collect()
    assert len(got) > 20 and all(r.found and r.fx_found for r in got)
    assert all(r.raw_fx_value == r.fx_usd_mxn and r.raw_fx_extracted_at is not None for r in got)
    sunday = [r for r in got if r.date == D("2025-02-23")]
    assert sunday and all(r.fx_origin == D("2025-02-21") for r in sunday)


def test_inserted_fault_has_a_load_time_and_orphans_are_listed(spark, tmp_root):
    from tidemark.plans.build import inject_business_rule_fault
    from tidemark.operators.quality import trace

    lay = _loaded(spark, tmp_root)
    ts = dt.datetime(2025, 3, 2, 8)
    inject_business_rule_fault(spark, lay, "merida", D("2025-02-20"), ts)
    new = read_table(spark, lay.raw_weather, specs.WEATHER_RAW).filter("location = 'merida'").first()
    assert new.extracted_at == ts
    bad = spark.createDataFrame([("cdmx", D("2025-02-20")), ("nowhere", D("2025-02-20")),
                                 (None, None)], "location string, date date")
    out = trace(bad, read_table(spark, lay.raw_weather, specs.WEATHER_RAW), ["location", "date"],
                ["temp_max_c"]).collect()
    assert sorted((str(r.location), r.found) for r in out) == [
        ("None", False), ("cdmx", True), ("nowhere", False)]


def test_day_grain_layout_and_separate_watermarks(spark, tmp_root):
    import os
    lay = Layout(tmp_root, "day")
    run_ts = dt.datetime(2025, 3, 1, 12)
    load_source(spark, lay, specs.WEATHER, _weather_rows(spark, run_ts), D("2025-03-01"))
    load_source(spark, lay, specs.FX, _fx_rows(spark, run_ts), D("2025-03-01"))
    assert {r.status for r in build_mart(spark, lay).collect()} == {"pass"}
    assert os.path.exists(f"{lay.mart}/day=2025-02-20")
    state = load_state(spark, lay.state)
    assert state.count() == 2 and watermark_of(state, "fx") == D("2025-02-28")
    assert sorted(d for d in os.listdir(lay.state) if d.startswith("source")) == [
        "source=fx", "source=weather"]


def test_failed_rebuild_swap_puts_the_old_mart_back(spark, tmp_root, monkeypatch):
    from tidemark.plans import build

    lay = _loaded(spark, tmp_root)
    build_mart(spark, lay)
    before = rows(read_table(spark, lay.mart, specs.MART), "location", "date")
    real = build.rename_path

    def failing(spark_, src, dst):
        if ".rebuild-" in src:
            raise OSError("no rename")
        real(spark_, src, dst)

    monkeypatch.setattr(build, "rename_path", failing)
    with pytest.raises(OSError):
        build_mart(spark, lay, full_refresh=True)
    assert rows(read_table(spark, lay.mart, specs.MART), "location", "date") == before


def test_incremental_build_reads_rates_from_the_last_one_before_the_window(spark, tmp_root):
    from tidemark.plans.build import conditions, last_rate_day

    lay = _loaded(spark, tmp_root)
    assert last_rate_day(spark, lay, D("2025-02-24")) == D("2025-02-21")
    assert last_rate_day(spark, lay, D("2025-01-01")) == D("2024-12-31")
    assert last_rate_day(spark, lay, START) is None
    for since in ("2025-02-22", "2025-01-01", "2024-12-02"):
        full = conditions(spark, lay).filter(F.col("date") >= F.lit(D(since)))
        assert rows(conditions(spark, lay, D(since))) == rows(full)
