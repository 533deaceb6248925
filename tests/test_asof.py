"""As-of join: golden cases, and brute force over random rows in both forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tidemark.operators.asof import asof_join

L = "id int, k string, t timestamp_ntz"
R = "k string, t timestamp_ntz, v int, w string"
T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


def left_df(spark, data):
    return spark.createDataFrame([(i, k, at(h)) for i, k, h in data], L)


def right_df(spark, data):
    return spark.createDataFrame([(k, at(h), v, w) for k, h, v, w in data], R)


def brute(left, right, keyed=True, exact=True, within=None):
    out = []
    for i, k, h in left:
        ok = [(rh, v is not None, v or 0, w is not None, w or "", v, w) for rk, rh, v, w in right
              if h is not None and rh is not None and (not keyed or (k is not None and rk == k))
              and (rh <= h if exact else rh < h)]
        best = max(ok) if ok else None
        if best and within is not None and h - best[0] > within:
            best = None
        out.append((i, k, at(h), at(best[0]) if best else None,
                    best[5] if best else None, best[6] if best else None))
    return sorted(out, key=lambda t: t[0])


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: t[0])


def random_sides(seed):
    rnd = random.Random(seed)
    key = lambda: rnd.choice(["a"] * 6 + ["b", "c", None])    # one key holds most rows
    hour = lambda: rnd.choice([None] + list(range(200)))
    left = [(i, key(), hour()) for i in range(120)]
    right = [(key(), hour(), rnd.choice([None, 1, 2, 3]), rnd.choice([None, "x", "y"]))
             for _ in range(60)]
    return left, right


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("sliced", [False, True])
@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("exact", [True, False])
def test_against_brute_force(spark, seed, sliced, keyed, exact):
    left, right = random_sides(seed)
    df = asof_join(left_df(spark, left), right_df(spark, right), "t", "t",
                   ["k"] if keyed else [], ["v", "w"], exact=exact,
                   slice=(lambda t: t.cast("date")) if sliced else None)
    assert df.columns == ["id", "k", "t", "right_t", "right_v", "right_w"]
    assert got(df) == brute(left, right, keyed, exact)


@pytest.mark.parametrize("sliced", [False, True])
def test_tolerance_reaches_over_slices(spark, sliced):
    left, right = random_sides(9)
    df = asof_join(left_df(spark, left), right_df(spark, right), "t", "t", ["k"], ["v", "w"],
                   tolerance="INTERVAL 30 HOURS",
                   slice=(lambda t: t.cast("date")) if sliced else None)
    assert got(df) == brute(left, right, within=30)


def test_empty_sides_and_nulls(spark):
    left = [(1, "a", 5), (2, None, 5), (3, "a", None)]
    one = asof_join(left_df(spark, left), right_df(spark, []), "t", "t", ["k"], ["v"])
    assert [(r.id, r.right_t, r.right_v) for r in one.orderBy("id").collect()] == [
        (1, None, None), (2, None, None), (3, None, None)]
    assert asof_join(left_df(spark, []), right_df(spark, [("a", 1, 1, "x")]), "t", "t",
                     ["k"], ["v"]).count() == 0


def test_names_and_types_are_checked(spark):
    left, right = left_df(spark, [(1, "a", 5)]), right_df(spark, [("a", 1, 1, "x")])
    with pytest.raises(ValueError):
        asof_join(left, right, "t", "t", ["k"], ["v"], prefix="")
    with pytest.raises(TypeError):
        asof_join(left.withColumn("t", F.col("t").cast("date")), right, "t", "t", ["k"])
    odd = left.withColumnRenamed("id", "my id.x")
    assert asof_join(odd, right, "t", "t", ["k"], ["v"]).columns[0] == "my id.x"


def test_plans(spark, tmp_root):
    """One exchange on the key, no range join; slices split one key over tasks."""
    left = left_df(spark, [(i, "hot", i) for i in range(500)])
    right = right_df(spark, [("hot", 3 * i, i, "x") for i in range(160)])
    plan = plan_text(asof_join(left, right, "t", "t", ["k"], ["v"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sliced = asof_join(left, right, "t", "t", ["k"], ["v"], slice=lambda t: t.cast("date"))
        assert sliced.select(F.spark_partition_id()).distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert rows(sliced, "id", "right_v") == [(i, i // 3 if i // 3 < 160 else 159)
                                             for i in range(500)]
