"""Watermarks saved by version: of several loads of one source one saves."""

import threading

import pytest
from pyspark.sql import functions as F

from conftest import D
from tidemark import specs
from tidemark.plans import build
from tidemark.session import create_once, list_names, read_text
from tidemark.sources.state import (StaleState, load_state, save_state, state_version,
                                    watermark_of)


def state(spark, *rows):
    return spark.createDataFrame([(s, D(d) if d else None) for s, d in rows], specs.STATE.schema)


def test_one_of_many_writers_creates_the_file(spark, tmp_root):
    path, made, go = f"{tmp_root}/x/1.json", [], threading.Barrier(8)

    def write(i):
        go.wait()
        if create_once(spark, path, f"writer {i}"):
            made.append(i)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(made) == 1 and read_text(spark, path) == f"writer {made[0]}"
    assert [n for n in list_names(spark, f"{tmp_root}/x") if "draft" in n] == []


def test_a_save_from_an_old_version_raises_and_saves_nothing(spark, tmp_root):
    path = f"{tmp_root}/state"
    assert state_version(spark, path, "a b/c") == 0 and load_state(spark, path).isEmpty()
    save_state(spark, path, state(spark, ("a b/c", "2024-01-05"), ("other", None)),
               {"a b/c": 0, "other": 0})
    save_state(spark, path, state(spark, ("a b/c", "2024-01-09")), {"a b/c": 1})
    with pytest.raises(StaleState, match="version 1"):
        save_state(spark, path, state(spark, ("a b/c", "2024-01-07")), {"a b/c": 1})
    got = load_state(spark, path)
    assert watermark_of(got, "a b/c") == D("2024-01-09") and got.count() == 2
    save_state(spark, path, state(spark, ("a b/c", "2024-01-02")))    # set back on purpose
    assert watermark_of(load_state(spark, path), "a b/c") == D("2024-01-02")


def test_state_of_before_there_were_versions(spark, tmp_root):
    path = f"{tmp_root}/state"
    state(spark, ("w", "2024-01-05"), ("f", "2024-01-06")).write.partitionBy("source").parquet(path)
    assert watermark_of(load_state(spark, path), "w") == D("2024-01-05")
    save_state(spark, path, state(spark, ("w", "2024-01-08")), {"w": 0})
    got = load_state(spark, path)
    assert (watermark_of(got, "w"), watermark_of(got, "f")) == (D("2024-01-08"), D("2024-01-06"))


def test_two_loads_that_planned_together(spark, tmp_root, monkeypatch):
    """Both have written their rows when they come to save; the later plan saves first."""
    layout, meet = build.Layout(tmp_root), threading.Barrier(2)
    rows = spark.createDataFrame([], specs.WEATHER_RAW.schema)
    monkeypatch.setattr(build, "upsert_path", lambda *a: meet.wait(60) * 0 + 1)
    out = {}

    def load(today):
        try:
            out[today] = build.load_source(spark, layout, specs.WEATHER, rows, D(today))
        except StaleState as e:
            out[today] = e

    threads = [threading.Thread(target=load, args=(d,)) for d in ("2024-02-10", "2024-03-10")]
    [t.start() for t in threads], [t.join(120) for t in threads]
    lost = [d for d, r in out.items() if isinstance(r, StaleState)]
    won = [r for r in out.values() if not isinstance(r, StaleState)]
    assert len(lost) == 1 and len(won) == 1
    assert watermark_of(load_state(spark, layout.state), "weather") == won[0].watermark_after
