"""Loads carried from the kept state against the full carry."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from conftest import D, plan_text, rows
from tidemark.operators import carry_state as cs
from tidemark.operators.enrich import gap_fill
from tidemark.operators.upsert import KeyViolation
from tidemark.sources.tables import read_table
from tidemark.specs import TableSpec

OBS = T.StructType([T.StructField("k", T.StringType()), T.StructField("date", T.DateType()),
                    T.StructField("v", T.DoubleType())])
SPEC = TableSpec("filled", T.StructType([*OBS.fields, T.StructField("own", T.BooleanType())]),
                 ("k", "date"))


def full(spark, seen):
    obs = spark.createDataFrame([(k, d, v) for (k, d), v in seen.items()], OBS)
    return rows(gap_fill(obs, "date", "v", ["k"], "own"))


def loads(seed, n_loads=4):
    """Loads by time: some keys appear late, some pause over a load, some values are null."""
    rng, day = random.Random(seed), D("2024-01-25")
    for n in range(n_loads):
        load = {}
        for k in range(7):
            if (k == 6 and n < 2) or (k == 5 and n % 2):
                continue
            for d in rng.sample(range(12), rng.randint(1, 6)):
                load[f"k{k}", day + dt.timedelta(days=d)] = rng.choice([None, rng.random()])
        yield load
        day += dt.timedelta(days=rng.randint(12, 40))


def take(spark, path, load, history=None, **kind):
    batch = spark.createDataFrame([(k, d, v) for (k, d), v in load.items()], OBS)
    past = None if history is None else spark.createDataFrame(
        [(k, d, v) for (k, d), v in history.items()], OBS)
    return cs.carry_increment(spark, path, SPEC, batch, "v", "own", past, n_buckets=4, **kind)


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_equal_the_full_carry(spark, tmp_root, seed):
    path, seen = f"{tmp_root}/filled", {}
    for load in loads(seed):
        before = len(full(spark, seen)) if seen else 0
        written = take(spark, path, load)
        seen.update(load)
        want = full(spark, seen)
        assert rows(read_table(spark, path, SPEC)) == want
        assert written == len(want) - before    # only days that were not there


def test_late_rows_need_the_history(spark, tmp_root):
    path, seen = f"{tmp_root}/filled", {}
    for load in loads(3, 2):
        take(spark, path, load)
        seen.update(load)
    held = rows(read_table(spark, path, SPEC))
    first = min(d for k, d in seen if k == "k1")
    late = {("k1", first + dt.timedelta(days=1)): 70.0, ("k1", D("2024-06-01")): None,
            ("k2", first - dt.timedelta(days=3)): 80.0, ("k4", D("2024-06-03")): 5.0,
            ("new", D("2024-06-02")): 6.0}
    with pytest.raises(KeyViolation, match="history"):
        take(spark, path, late)
    assert rows(read_table(spark, path, SPEC)) == held
    take(spark, path, late, seen)
    want = full(spark, {**seen, **late})
    assert rows(read_table(spark, path, SPEC)) == want
    take(spark, path, late, {**seen, **late})    # given again
    assert rows(read_table(spark, path, SPEC)) == want
    more = {("k1", D("2024-06-20")): None, ("k2", D("2024-06-20")): 1.0}
    take(spark, path, more)    # the state moved along with the late load
    assert rows(read_table(spark, path, SPEC)) == full(spark, {**seen, **late, **more})


@pytest.mark.parametrize("broken", ["_write_state", "upsert_path"])
def test_a_crash_repeats_the_same_days(spark, tmp_root, monkeypatch, broken):
    path, (one, two) = f"{tmp_root}/filled", loads(4, 2)
    take(spark, path, one)
    with monkeypatch.context() as m:
        def crash(*_):
            raise KeyboardInterrupt
        m.setattr(cs, broken, crash)
        with pytest.raises(KeyboardInterrupt):
            take(spark, path, two)
    take(spark, path, two)
    assert rows(read_table(spark, path, SPEC)) == full(spark, {**one, **two})


def test_empty_load_null_key_and_no_date(spark, tmp_root):
    path = f"{tmp_root}/filled"
    assert take(spark, path, {}) == 0
    with pytest.raises(KeyViolation):
        take(spark, path, {(None, D("2024-01-01")): 1.0})
    assert take(spark, path, {("a", None): 1.0, ("a", D("2024-01-02")): 2.0}) == 1
    assert rows(read_table(spark, path, SPEC)) == [("a", D("2024-01-02"), 2.0, True)]


def test_plan_reads_state_buckets_and_no_history(spark, tmp_root):
    path, seen = f"{tmp_root}/filled", {}
    for load in loads(5, 2):
        take(spark, path, load)
        seen.update(load)
    bucket = spark.createDataFrame([("k1",)], "k string").select(
        F.pmod(F.hash("k"), F.lit(4))).first()[0]
    state = cs.read_state(spark, path, SPEC, "v", [bucket])
    batch = spark.createDataFrame([("k1", D("2024-07-01"), 1.0)], OBS)
    plan = plan_text(cs.carry_load(state, batch, ["k"], "date", "v", "own"))
    assert plan.count("FileScan") == 1 and "__carry" in plan and f"bucket#" in plan
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
