import pytest
from pyspark.sql import functions as F

from conftest import D, rows
from tidemark.operators.upsert import KeyViolation, upsert, upsert_columns, upsert_path
from tidemark.sources.tables import read_table
from tidemark.specs import TableSpec
from pyspark.sql import types as T

SPEC = TableSpec("t", T.StructType([T.StructField("k", T.StringType()),
                                    T.StructField("date", T.DateType()),
                                    T.StructField("v", T.DoubleType())]), keys=("k", "date"))
S = "k string, date date, v double"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", D("2024-01-01"), 1.0), ("a", D("2024-01-02"), 2.0)], S)


def test_replace_and_insert_idempotent(spark, target):
    batch = spark.createDataFrame([("a", D("2024-01-02"), 9.0), ("b", D("2024-01-01"), 3.0)], S)
    once = upsert(target, batch, ["k", "date"])
    expected = [("a", D("2024-01-01"), 1.0), ("a", D("2024-01-02"), 9.0),
                ("b", D("2024-01-01"), 3.0)]
    assert rows(once) == expected
    assert rows(upsert(once, batch, ["k", "date"])) == expected
    empty = spark.createDataFrame([], S)
    assert rows(upsert(once, empty, ["k", "date"])) == expected


def test_by_name_columns(spark, target):
    batch = spark.createDataFrame([(9.0, D("2024-01-02"), "a")], "v double, date date, k string")
    assert rows(upsert(target, batch, ["k", "date"])) == [
        ("a", D("2024-01-01"), 1.0), ("a", D("2024-01-02"), 9.0)]


def test_null_target_key_survives(spark):
    t = spark.createDataFrame([(None, D("2024-01-01"), 1.0)], S)
    b = spark.createDataFrame([(None, D("2024-01-01"), 2.0)], S)
    assert len(rows(upsert(t, b, ["k", "date"]))) == 2   # NULL never equals NULL


def test_partial_update_null_wins(spark, target):
    t = target.withColumn("w", F.lit(5.0))
    b = spark.createDataFrame([("a", D("2024-01-02"), None, 7.0), ("c", D("2024-01-01"), 4.0, 8.0)],
                              "k string, date date, v double, w double")
    got = rows(upsert_columns(t, b, ["k", "date"], ["v"]))
    assert got == [("a", D("2024-01-01"), 1.0, 5.0), ("a", D("2024-01-02"), None, 5.0),
                   ("c", D("2024-01-01"), 4.0, 8.0)]


def test_path_upsert_protocol(spark, tmp_root):
    path = f"{tmp_root}/t"
    assert read_table(spark, path, SPEC).count() == 0            # absent ⇒ empty
    b1 = spark.createDataFrame([("a", D("2024-01-01"), 1.0), ("a", D("2024-02-01"), 2.0)], S)
    assert upsert_path(spark, path, b1, SPEC) == 2
    b2 = spark.createDataFrame([("a", D("2024-02-01"), 9.0), ("b", D("2024-02-03"), 3.0)], S)
    upsert_path(spark, path, b2, SPEC)
    upsert_path(spark, path, b2, SPEC)                            # same batch again
    assert rows(read_table(spark, path, SPEC)) == [
        ("a", D("2024-01-01"), 1.0), ("a", D("2024-02-01"), 9.0), ("b", D("2024-02-03"), 3.0)]
    # untouched month keeps its files
    before = {f for f in __import__("os").listdir(f"{path}/month=2024-01-01")}
    upsert_path(spark, path, b2, SPEC)
    assert before == set(__import__("os").listdir(f"{path}/month=2024-01-01"))
    assert upsert_path(spark, path, spark.createDataFrame([], S), SPEC) == 0


@pytest.mark.parametrize("bad", [
    [("a", "2024-01-02", 9.0), ("a", "2024-01-02", 8.0)],   # duplicate key
    [(None, "2024-01-01", 1.0)],                           # NULL key
])
def test_bad_batch_rejected_target_intact(spark, tmp_root, bad):
    path = f"{tmp_root}/t"
    upsert_path(spark, path, spark.createDataFrame([("a", D("2024-01-02"), 2.0)], S), SPEC)
    batch = spark.createDataFrame([(k, D(d), v) for k, d, v in bad], S)
    with pytest.raises(KeyViolation):
        upsert_path(spark, path, batch, SPEC)
    assert rows(read_table(spark, path, SPEC)) == [("a", D("2024-01-02"), 2.0)]


def test_touched_month_read_is_partition_pruned(spark, tmp_root):
    path = f"{tmp_root}/t"
    b = spark.createDataFrame([("a", D("2024-01-01"), 1.0), ("a", D("2024-03-01"), 2.0)], S)
    upsert_path(spark, path, b, SPEC)
    df = read_table(spark, path, SPEC, [D("2024-03-01")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "2024-03-01" in pruned
    assert rows(df) == [("a", D("2024-03-01"), 2.0)]


def test_history_bypasses_the_merge(spark, target):
    from conftest import plan_text
    from tidemark.operators.incremental import merge_incremental

    batch = spark.createDataFrame([("a", D("2024-01-02"), 9.0)], S)
    p = plan_text(upsert(target, batch, ["k", "date"]))
    assert "LeftAnti" in p
    merged = merge_incremental(target.withColumnRenamed("k", "location"),
                               batch.withColumnRenamed("k", "location"), ["location", "date"],
                               since="2024-01-02")
    assert rows(merged) == [("a", D("2024-01-01"), 1.0), ("a", D("2024-01-02"), 9.0)]
    assert "Union" in plan_text(merged)


def test_partial_update_applies_nulls_and_reads_the_target_once(spark, target):
    from conftest import plan_text
    t = target.withColumn("w", F.lit(5.0)).unionByName(
        spark.createDataFrame([(None, D("2024-01-01"), 3.0, 1.0)], "k string, date date, v double, w double"))
    b = spark.createDataFrame([("a", D("2024-01-02"), None, 7.0), ("c", D("2024-01-01"), 4.0, 8.0)],
                              "k string, date date, v double, w double")
    merged = upsert_columns(t, b, ["k", "date"], ["v"])
    got = {(k, d): (v, w) for k, d, v, w in rows(merged)}
    assert got[("a", D("2024-01-02"))] == (None, 5.0)
    assert got[("c", D("2024-01-01"))] == (4.0, 8.0)
    assert got[(None, D("2024-01-01"))] == (3.0, 1.0)
    assert "FullOuter" in plan_text(merged)


def test_a_key_without_the_date_moves_between_partitions(spark, tmp_root):
    import os
    from tidemark.specs import TableSpec
    spec = TableSpec("t", SPEC.schema, keys=("k",))
    path = f"{tmp_root}/t"
    upsert_path(spark, path, spark.createDataFrame(
        [("a", D("2024-01-10"), 1.0), ("b", D("2024-01-11"), 1.0), ("c", D("2024-03-01"), 1.0)], S),
        spec)
    upsert_path(spark, path, spark.createDataFrame(
        [("a", D("2024-02-01"), 2.0), ("c", D("2024-02-02"), 2.0)], S), spec)
    assert rows(read_table(spark, path, spec)) == [
        ("a", D("2024-02-01"), 2.0), ("b", D("2024-01-11"), 1.0), ("c", D("2024-02-02"), 2.0)]
    assert not os.path.exists(f"{path}/month=2024-03-01")
    assert not [f for f in os.listdir(path) if f.startswith("_")]


def test_failed_swap_restores_the_old_partition(spark, tmp_root, monkeypatch):
    from tidemark.sources import tables
    path = f"{tmp_root}/t"
    upsert_path(spark, path, spark.createDataFrame([("a", D("2024-01-10"), 1.0)], S), SPEC)
    before = rows(read_table(spark, path, SPEC))
    real = tables.rename_path

    def failing(spark_, src, dst):
        if "/_stage-" in src:
            raise OSError("no rename")
        real(spark_, src, dst)

    monkeypatch.setattr(tables, "rename_path", failing)
    with pytest.raises(OSError):
        upsert_path(spark, path, spark.createDataFrame([("a", D("2024-01-10"), 2.0)], S), SPEC)
    assert rows(read_table(spark, path, SPEC)) == before


def test_hot_month_is_written_by_several_tasks(spark, tmp_root):
    import datetime as dt
    import os
    from tidemark.sources.tables import write_months

    hot = spark.range(200_000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"),
        F.lit(D("2024-01-15")).alias("date"), F.rand(1).alias("v"))
    cold = spark.createDataFrame([("a", D("2024-02-01"), 1.0)], S)
    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(256 * 1024))
    try:
        write_months(hot.unionByName(cold), f"{tmp_root}/t", SPEC)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)
    files = [f for f in os.listdir(f"{tmp_root}/t/month=2024-01-01") if f.endswith(".parquet")]
    assert len(files) > 1
    assert read_table(spark, f"{tmp_root}/t", SPEC).count() == 200_001


def test_day_grain_rewrites_only_touched_days(spark, tmp_root):
    import os
    spec = SPEC.with_grain("day")
    path = f"{tmp_root}/t"
    b1 = spark.createDataFrame([("a", D("2024-01-01"), 1.0), ("a", D("2024-01-02"), 2.0)], S)
    upsert_path(spark, path, b1, spec)
    assert sorted(os.listdir(path))[:2] == ["day=2024-01-01", "day=2024-01-02"]
    untouched = set(os.listdir(f"{path}/day=2024-01-01"))
    upsert_path(spark, path, spark.createDataFrame([("a", D("2024-01-02"), 9.0)], S), spec)
    assert set(os.listdir(f"{path}/day=2024-01-01")) == untouched
    assert rows(read_table(spark, path, spec)) == [("a", D("2024-01-01"), 1.0),
                                                   ("a", D("2024-01-02"), 9.0)]
    assert rows(read_table(spark, path, spec, since=D("2024-01-02"))) == [("a", D("2024-01-02"), 9.0)]


def test_stored_window_replace_drops_vanished_keys_and_empty_partitions(spark, tmp_root):
    import os
    from tidemark.operators.upsert import window_replace_path
    path = f"{tmp_root}/t"
    days = ["2024-01-10", "2024-02-05", "2024-02-20", "2024-02-25", "2024-03-03"]
    upsert_path(spark, path, spark.createDataFrame([("a", D(d), 1.0) for d in days], S), SPEC)
    jan = set(os.listdir(f"{path}/month=2024-01-01"))
    # source inside the window: 02-20 updated, 02-25 and all of March gone
    source = spark.createDataFrame([("a", D("2024-02-20"), 2.0), ("a", D("2024-01-10"), 9.0)], S)
    assert window_replace_path(spark, path, source, SPEC, D("2024-02-15")) == 1
    assert rows(read_table(spark, path, SPEC)) == [
        ("a", D("2024-01-10"), 1.0), ("a", D("2024-02-05"), 1.0), ("a", D("2024-02-20"), 2.0)]
    assert not os.path.exists(f"{path}/month=2024-03-01")
    assert set(os.listdir(f"{path}/month=2024-01-01")) == jan


def test_stored_high_water_mark_reads_newest_partition(spark, tmp_root):
    from tidemark.sources.tables import stored_high_water_mark
    path = f"{tmp_root}/t"
    assert stored_high_water_mark(spark, path, SPEC) is None
    upsert_path(spark, path, spark.createDataFrame(
        [("a", D("2024-01-31"), 1.0), ("a", D("2024-03-02"), 1.0), ("b", D("2024-03-09"), 1.0)],
        S), SPEC)
    assert stored_high_water_mark(spark, path, SPEC) == D("2024-03-09")
