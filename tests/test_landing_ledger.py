"""Landed files loaded once each, whatever days they hold."""

import datetime as dt
import json
import os

import pytest

from conftest import D, rows
from tidemark import specs
from tidemark.plans import build
from tidemark.plans.build import Layout, load_landing
from tidemark.sources.landing_ledger import loaded_files, pending_files, reader_path
from tidemark.sources.state import load_state, watermark_of
from tidemark.sources.tables import read_table

TS = dt.datetime(2025, 3, 1, 12)


def land(folder, name, first, n, value, place="cdmx", mtime=None):
    days = [(D(first) + dt.timedelta(days=i)).isoformat() for i in range(n)]
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(json.dumps({"location": place, "daily": {
            "time": days, "temperature_2m_max": [value] * n, "temperature_2m_min": [1.0] * n,
            "precipitation_sum": [0.0] * n}}) + "\n")
    if mtime:
        os.utime(f"{folder}/{name}", (mtime, mtime))


def stored(spark, lay):
    return rows(read_table(spark, lay.raw_weather, specs.WEATHER_RAW), "date", "temp_max_c")


def days(first, n, value):
    return [(D(first) + dt.timedelta(days=i), value) for i in range(n)]


def test_late_old_files_and_none_twice(spark, tmp_root, monkeypatch):
    lay, folder = Layout(f"{tmp_root}/wh"), f"{tmp_root}/landing"
    land(folder, "a.json", "2025-02-01", 3, 20.0)
    land(folder, "odd {x} [1]*.json", "2025-02-04", 2, 21.0)
    r = load_landing(spark, lay, specs.WEATHER, folder, TS)
    assert (r.files, r.rows, r.watermark_before, r.watermark_after) == (2, 5, None, D("2025-02-05"))
    land(folder, "late.json", "2024-06-01", 2, 9.0, mtime=1_000_000_000)
    opened = []
    read = build.read_weather_landing
    monkeypatch.setattr(build, "read_weather_landing",
                        lambda s, paths, ts: opened.extend(paths) or read(s, paths, ts))
    r = load_landing(spark, lay, specs.WEATHER, folder, TS)
    assert [os.path.basename(p) for p in opened] == ["late.json"]
    assert (r.files, r.rows, r.watermark_after) == (1, 2, D("2025-02-05"))
    want = days("2024-06-01", 2, 9.0) + days("2025-02-01", 3, 20.0) + days("2025-02-04", 2, 21.0)
    assert stored(spark, lay) == want
    assert load_landing(spark, lay, specs.WEATHER, folder, TS).files == 0
    assert loaded_files(spark, lay.landed(specs.WEATHER)).count() == 3
    assert watermark_of(load_state(spark, lay.state), "weather") == D("2025-02-05")


def test_a_rewritten_file_is_loaded_again(spark, tmp_root):
    lay, folder = Layout(f"{tmp_root}/wh"), f"{tmp_root}/landing"
    land(folder, "a.json", "2025-02-01", 2, 20.0, mtime=1_700_000_000)
    load_landing(spark, lay, specs.WEATHER, folder, TS)
    land(folder, "a.json", "2025-02-01", 2, 30.0, mtime=1_700_000_060)
    assert load_landing(spark, lay, specs.WEATHER, folder, TS).files == 1
    assert stored(spark, lay) == days("2025-02-01", 2, 30.0)


@pytest.mark.parametrize("broken", ["record_files", "save_state"])
def test_a_crash_loses_nothing(spark, tmp_root, monkeypatch, broken):
    lay, folder = Layout(f"{tmp_root}/wh"), f"{tmp_root}/landing"
    land(folder, "a.json", "2025-02-01", 2, 20.0)
    with monkeypatch.context() as m:
        def crash(*_):
            raise KeyboardInterrupt
        m.setattr(build, broken, crash)
        with pytest.raises(KeyboardInterrupt):
            load_landing(spark, lay, specs.WEATHER, folder, TS)
    load_landing(spark, lay, specs.WEATHER, folder, TS)
    land(folder, "b.json", "2025-02-03", 1, 22.0)
    load_landing(spark, lay, specs.WEATHER, folder, TS)
    assert stored(spark, lay) == days("2025-02-01", 2, 20.0) + days("2025-02-03", 1, 22.0)
    assert watermark_of(load_state(spark, lay.state), "weather") == D("2025-02-03")


def test_broken_document_is_not_entered(spark, tmp_root):
    lay, folder = Layout(f"{tmp_root}/wh"), f"{tmp_root}/landing"
    land(folder, "a.json", "2025-02-01", 2, 20.0)
    with open(f"{folder}/b.json", "w") as f:
        f.write('{"location": "cdmx", "daily"')
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        load_landing(spark, lay, specs.WEATHER, folder, TS)
    assert len(pending_files(spark, folder, lay.landed(specs.WEATHER))) == 2
    assert reader_path("a[1]{b}*?\\") == r"a\[1\]\{b\}\*\?\\"
