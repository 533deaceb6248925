"""A swap that is interrupted anywhere loses nothing."""

import shutil

import pytest
from pyspark.sql import types as T

from conftest import D, rows
from tidemark.operators.upsert import upsert_path, window_replace_path
from tidemark.plans.build import swap_in
from tidemark.session import list_names
from tidemark.sources import swap as swaps
from tidemark.sources import tables
from tidemark.sources.tables import read_table, stored_parts
from tidemark.specs import TableSpec

S = T.StructType([T.StructField("k", T.StringType()), T.StructField("date", T.DateType()),
                  T.StructField("v", T.DoubleType())])
SPEC = TableSpec("t", S, ("k", "date"))
FILE_STEPS = ("path_exists", "delete_path", "rename_path", "write_text")


def table(spark, path, value=1.0, months=(1, 2, 3)):
    batch = spark.createDataFrame([(f"k{i}", D(f"2024-0{m}-1{i}"), value) for m in months
                                   for i in range(5)], S)
    upsert_path(spark, path, batch, SPEC)
    return batch


class Killed(BaseException):
    """Like a kill: nothing catches it."""


def killed_at(monkeypatch, step):
    """From its ``step``-th file operation on, the swap can do nothing any more."""
    done = [0]

    def guarded(real):
        def run(*args, **kind):
            done[0] += 1
            if done[0] > step:
                raise Killed
            return real(*args, **kind)
        return run

    for name in FILE_STEPS:
        monkeypatch.setattr(swaps, name, guarded(getattr(swaps, name)))
    monkeypatch.setattr(tables, "rename_path", guarded(tables.rename_path))
    return done


def interrupted(spark, monkeypatch, work, check):
    """Run ``work`` killed at every step in turn; ``check`` what is there each time, until a
    run comes through."""
    for step in range(200):
        prepared = work(step)
        with monkeypatch.context() as m:
            killed_at(m, step)
            try:
                prepared()
                ended = True
            except Killed:
                ended = False
        check(step, ended)
        if ended:
            return step
    raise AssertionError("no run came through")


def test_upsert_killed_at_any_step_is_all_old_or_all_new(spark, tmp_root, monkeypatch):
    seen = set()

    base = f"{tmp_root}/base"
    table(spark, base)
    staged = tables.write_stage(spark.createDataFrame(
        [(f"k{i}", D(f"2024-0{m}-1{i}"), 2.0) for m in (1, 2, 4) for i in range(5)], S), base, SPEC)

    def work(step):
        path = shutil.copytree(base, f"{tmp_root}/u{step}")
        stage = f"{path}/{staged.rpartition('/')[2]}"
        parts = [D("2024-01-01"), D("2024-02-01"), D("2024-04-01")]
        return lambda: tables.swap_parts(spark, stage, path, SPEC, parts)

    def check(step, ended):
        path = f"{tmp_root}/u{step}"
        got = rows(read_table(spark, path, SPEC), "date", "v")
        new = sum(v == 2.0 for _, v in got)
        assert (len(got), new) in ((15, 0), (20, 15))
        seen.add(new)
        assert ended <= (new == 15)
        tables.clear_stages(spark, path)    # as the next writer does
        assert [n for n in list_names(spark, path) if n.startswith("_")
                and n != "_SUCCESS"] == []
        assert len(rows(read_table(spark, path, SPEC))) == len(got)
        assert f"_swap-u{step}.json" not in list_names(spark, tmp_root)

    assert interrupted(spark, monkeypatch, work, check) > 8
    assert seen == {0, 15}


def test_removed_partitions_stay_removed(spark, tmp_root, monkeypatch):
    source = table(spark, f"{tmp_root}/base").filter("date < '2024-02-12'")

    def work(step):
        path = shutil.copytree(f"{tmp_root}/base", f"{tmp_root}/w{step}")
        return lambda: window_replace_path(spark, path, source, SPEC, D("2024-02-01"))

    def check(step, ended):
        got = rows(read_table(spark, f"{tmp_root}/w{step}", SPEC), "date")
        assert len(got) in (7, 15) and ended <= (len(got) == 7)
        if ended:
            assert len(stored_parts(spark, f"{tmp_root}/w{step}", SPEC)) == 2

    interrupted(spark, monkeypatch, work, check)


def test_rebuild_killed_at_any_step_leaves_a_whole_mart(spark, tmp_root, monkeypatch):
    table(spark, f"{tmp_root}/base")

    def work(step):
        path = shutil.copytree(f"{tmp_root}/base", f"{tmp_root}/m{step}")
        fresh = spark.createDataFrame([("z", D("2024-06-01"), 9.0)], S)
        return lambda: swap_in(spark, fresh, path, SPEC)

    def check(step, ended):
        got = len(rows(read_table(spark, f"{tmp_root}/m{step}", SPEC)))
        assert got in (1, 15) and ended <= (got == 1)

    interrupted(spark, monkeypatch, work, check)


def test_failed_rename_whose_undoing_fails_too_is_finished_later(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/t"
    table(spark, path)
    real, count = tables.rename_path, [0]

    def failing(spark_, src, dst):
        count[0] += 1
        if count[0] > 1:
            raise OSError("no rename")
        real(spark_, src, dst)

    with monkeypatch.context() as m:
        m.setattr(tables, "rename_path", failing)
        with pytest.raises(OSError):
            table(spark, path, 2.0, (1,))
    got = rows(read_table(spark, path, SPEC), "v")
    assert (len(got), sum(v == 2.0 for v, in got)) == (15, 5)


def test_first_load_is_staged_too(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/t"
    with monkeypatch.context() as m:
        killed_at(m, 0)
        with pytest.raises(Killed):
            table(spark, path)
    table(spark, path, 2.0)
    assert {v for _, v in rows(read_table(spark, path, SPEC), "k", "v")} == {2.0}
