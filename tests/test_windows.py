import pytest

from conftest import D
from tidemark.plans.windows import advance_watermarks, plan_windows

TODAY = D("2024-02-10")


def _plan(spark, wm, mode="incremental", start=None, end=None):
    specs = spark.createDataFrame([("w", 5, 30)], "source string, lag_days int, default_days int")
    state = spark.createDataFrame([("w", wm)] if wm else [], "source string, last_watermark date")
    return plan_windows(specs, state, TODAY, mode, start, end)


@pytest.mark.parametrize("wm,mode,start,end,window,after", [
    (None, "incremental", None, None, ("2024-01-06", "2024-02-05"), "2024-02-05"),
    ("2024-02-01", "incremental", None, None, ("2024-02-02", "2024-02-05"), "2024-02-05"),
    ("2024-02-05", "incremental", None, None, None, "2024-02-05"),
    ("2024-02-01", "incremental", None, "2024-02-03", ("2024-02-02", "2024-02-03"), "2024-02-03"),
    ("2024-02-01", "incremental", "2024-01-01", None, ("2024-02-02", "2024-02-05"), "2024-02-05"),
    ("2024-02-01", "backfill", "2024-01-01", "2024-01-31", ("2024-01-01", "2024-01-31"), "2024-02-01"),
    ("2024-02-01", "backfill", "2024-01-01", None, ("2024-01-01", "2024-02-05"), "2024-02-01"),
])
def test_truth_table(spark, wm, mode, start, end, window, after):
    plan = _plan(spark, D(wm) if wm else None, mode, start, end)
    p = plan.first()
    if window is None:
        assert not p.has_work
    else:
        assert p.has_work and (p.window_start, p.window_end) == (D(window[0]), D(window[1]))
    loaded = spark.createDataFrame([("w", 5)], "source string, rows_loaded bigint")
    new = advance_watermarks(plan, loaded, mode).first()
    expected = D(after) if after else None
    assert new.last_watermark == (expected if window or wm else None)


def test_zero_rows_keeps_watermark(spark):
    plan = _plan(spark, D("2024-02-01"))
    empty = spark.createDataFrame([], "source string, rows_loaded bigint")
    assert advance_watermarks(plan, empty).first().last_watermark == D("2024-02-01")


def test_backfill_needs_start(spark):
    with pytest.raises(ValueError):
        _plan(spark, None, "backfill")


def test_reread_days_restarts_before_watermark(spark):
    specs = spark.createDataFrame([("w", 5, 30)], "source string, lag_days int, default_days int")
    state = spark.createDataFrame([("w", D("2024-02-01"))], "source string, last_watermark date")
    p = plan_windows(specs, state, TODAY, reread_days=3).first()
    assert (p.window_start, p.window_end) == (D("2024-01-30"), D("2024-02-05"))


def test_many_sources_planned_in_one_query(spark):
    from tidemark.plans.windows import windowed_batch
    specs = spark.createDataFrame([("a", 1, 30), ("b", 5, 30), ("c", 2, 3)],
                                  "source string, lag_days int, default_days int")
    state = spark.createDataFrame([("a", D("2024-02-07")), ("b", D("2024-02-05"))],
                                  "source string, last_watermark date")
    plan = plan_windows(specs, state, TODAY)
    got = {r.source: (r.window_start, r.window_end, r.has_work) for r in plan.collect()}
    assert got == {"a": (D("2024-02-08"), D("2024-02-09"), True),
                   "b": (D("2024-02-06"), D("2024-02-05"), False),
                   "c": (D("2024-02-05"), D("2024-02-08"), True)}
    landed = spark.createDataFrame(
        [(s, D("2024-02-01") + __import__("datetime").timedelta(days=i)) for s in "abc"
         for i in range(10)], "source string, date date")
    batch = windowed_batch(landed, plan)
    counts = {r.source: r["count"] for r in batch.groupBy("source").count().collect()}
    assert counts == {"a": 2, "c": 4}
    new = {r.source: (r.last_watermark, r.rows_loaded) for r in advance_watermarks(
        plan, batch.groupBy("source").count().withColumnRenamed("count", "rows_loaded")).collect()}
    assert new == {"a": (D("2024-02-09"), 2), "b": (D("2024-02-05"), 0), "c": (D("2024-02-08"), 4)}
