"""Corrections older than the lookback window reach the mart, and only its touched partitions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import D, rows
from tidemark import specs
from tidemark.operators.reach import OPEN_END, differing_rows, merge_spans, reach_spans
from tidemark.plans import build
from tidemark.plans.build import (Layout, build_mart, conditions, propagate_changes)
from tidemark.operators.upsert import upsert_path
from tidemark.session import write_text
from tidemark.sources.marks import load_marks, partition_marks, save_marks
from tidemark.sources.tables import read_table

RUN = dt.datetime(2025, 3, 1)
FIRST = D("2024-04-01")
DAYS = 275    # to 2024-12-31


def _fx(spark, data):
    return spark.createDataFrame([("fx_usd_mxn", d, v, RUN) for d, v in data], specs.FX_RAW.schema)


def _weather(spark, data):
    return spark.createDataFrame([(loc, d, hi, 1.0, 0.0, RUN) for loc, d, hi in data],
                                 specs.WEATHER_RAW.schema)


def _weekdays(first=FIRST, days=DAYS):
    every = [first + dt.timedelta(days=i) for i in range(days)]
    return [d for d in every if d.weekday() < 5]


@pytest.fixture
def lay(spark, tmp_root):
    lay = Layout(tmp_root)
    upsert_path(spark, lay.raw_fx, _fx(spark, [(d, 17.0) for d in _weekdays()]), specs.FX_RAW)
    upsert_path(spark, lay.raw_weather, _weather(
        spark, [(loc, FIRST + dt.timedelta(days=i), 20.0) for i in range(DAYS)
                for loc in ("a", "b")]), specs.WEATHER_RAW)
    build_mart(spark, lay)
    return lay


def _mart(spark, lay):
    return rows(read_table(spark, lay.mart, lay.spec(specs.MART)))


def _written(spark, lay, before):
    now = partition_marks(spark, lay.mart, lay.spec(specs.MART))
    return sorted(p for p in now if now[p] != before.get(p))


def test_rate_corrected_long_ago_gives_the_mart_of_a_full_rebuild(spark, lay):
    day = D("2024-05-31")    # a Friday: carried over the weekend into June
    upsert_path(spark, lay.raw_fx, _fx(spark, [(day, 19.0)]), specs.FX_RAW)
    before = partition_marks(spark, lay.mart, specs.MART)
    build_mart(spark, lay)    # the lookback window does not reach it
    assert _mart(spark, lay) != rows(conditions(spark, lay))
    before = partition_marks(spark, lay.mart, specs.MART)
    done = propagate_changes(spark, lay)
    assert done.rows == 2 * 3 and done.spans == [(D("2024-05-01"), D("2024-06-02"))]
    assert _mart(spark, lay) == rows(conditions(spark, lay))
    assert _written(spark, lay, before) == [D("2024-05-01"), D("2024-06-01")]


def test_nothing_changed_reads_and_writes_nothing(spark, lay, monkeypatch):
    monkeypatch.setattr(build, "check_inputs", lambda *a: pytest.fail("inputs read"))
    assert propagate_changes(spark, lay) == build.Propagation([], 0)


def test_rewritten_but_equal_partition_writes_nothing(spark, lay):
    before = partition_marks(spark, lay.mart, specs.MART)
    upsert_path(spark, lay.raw_fx, _fx(spark, [(D("2024-05-14"), 17.0)]), specs.FX_RAW)
    done = propagate_changes(spark, lay)
    assert done.rows == 0 and done.spans == [(D("2024-04-30") + dt.timedelta(days=1),
                                              D("2024-06-02"))]
    assert _written(spark, lay, before) == []
    assert propagate_changes(spark, lay).spans == []


def test_withdrawn_rates_reach_over_whole_partitions(spark, lay):
    """No rate in June to August: the last of May stands until September."""
    gone = [d for d in _weekdays() if D("2024-06-01") <= d <= D("2024-08-31")]
    upsert_path(spark, lay.raw_fx, _fx(spark, [(d, None) for d in gone]), specs.FX_RAW)
    propagate_changes(spark, lay)
    assert _mart(spark, lay) == rows(conditions(spark, lay))
    upsert_path(spark, lay.raw_fx, _fx(spark, [(D("2024-05-30"), 30.0), (D("2024-05-31"), 31.0)]),
                specs.FX_RAW)
    assert propagate_changes(spark, lay).spans == [(D("2024-05-01"), D("2024-09-01"))]
    assert _mart(spark, lay) == rows(conditions(spark, lay))


def test_late_rates_stretch_the_calendar(spark, lay):
    """Weather after the last rate has none until the next rate comes, a month on."""
    later = [D("2025-01-01") + dt.timedelta(days=i) for i in range(60)]
    upsert_path(spark, lay.raw_weather, _weather(spark, [("a", d, 9.0) for d in later]),
                specs.WEATHER_RAW)
    propagate_changes(spark, lay)
    assert _mart(spark, lay) == rows(conditions(spark, lay))
    upsert_path(spark, lay.raw_fx, _fx(spark, [(D("2025-02-10"), 18.0)]), specs.FX_RAW)
    assert propagate_changes(spark, lay).spans == [(D("2025-01-01"), OPEN_END)]
    assert _mart(spark, lay) == rows(conditions(spark, lay))


def test_late_weather_of_a_new_location(spark, lay):
    upsert_path(spark, lay.raw_weather, _weather(spark, [("c", D("2023-11-05"), 7.0),
                                                         ("c", D("2024-07-09"), 8.0)]),
                specs.WEATHER_RAW)
    before = partition_marks(spark, lay.mart, specs.MART)
    assert propagate_changes(spark, lay).rows == 2
    assert _written(spark, lay, before) == [D("2023-11-01"), D("2024-07-01")]
    assert _mart(spark, lay) == rows(conditions(spark, lay))


def test_a_crash_before_the_marks_repeats_the_work(spark, lay, monkeypatch):
    upsert_path(spark, lay.raw_fx, _fx(spark, [(D("2024-05-31"), 19.0)]), specs.FX_RAW)

    def crash(*args):
        raise KeyboardInterrupt
    monkeypatch.setattr(build, "upsert_path", crash)
    with pytest.raises(KeyboardInterrupt):
        propagate_changes(spark, lay)
    monkeypatch.undo()
    assert propagate_changes(spark, lay).rows == 6
    assert _mart(spark, lay) == rows(conditions(spark, lay))


def test_build_with_propagation_and_lost_marks(spark, lay):
    upsert_path(spark, lay.raw_fx, _fx(spark, [(D("2024-05-02"), 18.5)]), specs.FX_RAW)
    build_mart(spark, lay, propagate=True)
    assert _mart(spark, lay) == rows(conditions(spark, lay))
    save_marks(spark, lay.mart_inputs, {})
    upsert_path(spark, lay.raw_fx, _fx(spark, [(D("2024-06-03"), 18.5)]), specs.FX_RAW)
    assert propagate_changes(spark, lay).rows > 0    # everything compared
    assert _mart(spark, lay) == rows(conditions(spark, lay))
    write_text(spark, lay.mart_inputs, "{broken")
    assert load_marks(spark, lay.mart_inputs) == {}


def _brute_reach(spans, obs):
    out = set()
    for k, lo, hi in spans:
        mine = [(d, v) for kk, d, v in obs if kk == k and d is not None]
        before = [d for d, _ in mine if d < lo]
        after = [d for d, v in mine if d > hi and v is not None]
        out.add((k, max(before) + dt.timedelta(days=1) if before else lo,
                 min(after) - dt.timedelta(days=1) if after else OPEN_END))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_reach_and_merge_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    day = lambda: FIRST + dt.timedelta(days=rnd.randrange(120))
    obs = [(k, d, rnd.choice([None, 1.0])) for k, d in {(rnd.choice("abc"), day())
                                                       for _ in range(60)}] + [("a", None, 1.0)]
    spans = []
    for _ in range(12):
        lo = day()
        spans.append((rnd.choice("abcd"), lo, lo + dt.timedelta(days=rnd.randrange(9))))
    spans_df = spark.createDataFrame(spans, "k string, lo date, hi date")
    obs_df = spark.createDataFrame(obs, "k string, date date, v double")
    wide = {tuple(r) for r in reach_spans(spans_df, obs_df, "v", keys=["k"]).collect()}
    assert wide == _brute_reach(spans, obs)

    covered = {(k, lo + dt.timedelta(days=i)) for k, lo, hi in spans
               for i in range((hi - lo).days + 1)}
    merged = [tuple(r) for r in merge_spans(spans_df, ["k"]).collect()]
    days = [(k, lo + dt.timedelta(days=i)) for k, lo, hi in merged
            for i in range((hi - lo).days + 1)]
    assert len(days) == len(set(days)) and set(days) == covered
    assert not any((k, hi + dt.timedelta(days=1)) in covered for k, _, hi in merged)


def test_differing_rows(spark):
    s = "k int, a double, b string"
    old = spark.createDataFrame([(1, 1.0, None), (2, float("nan"), "x"), (3, 1.0, "x")], s)
    new = spark.createDataFrame([(1, 1.0, None), (2, float("nan"), "x"), (3, 1.0, None),
                                 (4, None, None)], s)
    assert sorted(r.k for r in differing_rows(new, old, ["k"]).collect()) == [3, 4]
