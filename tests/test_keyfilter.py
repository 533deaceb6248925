"""Key filters: an upsert whose date is no key reads the partitions that hold its keys."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F, types as T

from conftest import D, rows
from tidemark.operators import upsert as U
from tidemark.operators.upsert import parts_holding, upsert_path
from tidemark.sources import keyfilter
from tidemark.sources.tables import read_table, stored_parts
from tidemark.specs import TableSpec

S = T.StructType([T.StructField("id", T.LongType()), T.StructField("date", T.DateType()),
                  T.StructField("v", T.DoubleType())])
SPEC = TableSpec("t", S, ("id",))
N = 4800


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """200 keys in each of 24 months."""
    path = f"{tmp_path_factory.mktemp('filters')}/t"
    month = (F.col("id") / 200).cast("int")
    df = spark.range(N).select("id", F.add_months(F.lit(D("2020-01-05")), month).alias("date"),
                               F.lit(1.0).alias("v"))
    upsert_path(spark, path, df, SPEC)
    return path


def batch(spark, ids, day="2022-06-01"):
    return spark.createDataFrame([(i, D(day), 2.0) for i in ids], S)


def test_no_holder_is_missed_and_few_others_are_named(spark, base):
    parts = stored_parts(spark, base, SPEC)
    assert len(parts) == 24
    false = 0
    for ids in ([0], [199, 200], [4799, 17], [N + 5], list(range(N + 100, N + 120))):
        held, named = parts_holding(spark, base, batch(spark, ids), SPEC, parts)
        want = {parts[i // 200] for i in ids if i < N}
        assert held == want and want <= set(named)
        false += len(named) - len(want)
    assert false <= 24    # of 600 tests of a key against a partition, 1 % are expected


def test_upsert_reads_and_writes_few_partitions(spark, base, tmp_root, monkeypatch):
    path = shutil.copytree(base, f"{tmp_root}/t")
    read = []
    real = U.read_table

    def reading(spark_, path_, spec, parts=None, since=None):
        read.append(parts)
        return real(spark_, path_, spec, parts, since)

    monkeypatch.setattr(U, "read_table", reading)
    before = {p: os.stat(f"{path}/{p}").st_ino for p in os.listdir(path) if "month=" in p}
    upsert_path(spark, path, batch(spark, [3, 1003, N + 1], "2020-02-09"), SPEC)
    assert all(p is not None and len(p) <= 5 for p in read)
    after = {p: os.stat(f"{path}/{p}").st_ino for p in os.listdir(path) if "month=" in p}
    assert {p for p in before if before[p] != after[p]} == {
        "month=2020-01-01", "month=2020-02-01", "month=2020-06-01"}
    got = rows(read_table(spark, path, SPEC), "id", "date", "v")
    assert len(got) == N + 1 and {r for r in got if r[2] == 2.0} == {
        (i, D("2020-02-09"), 2.0) for i in (3, 1003, N + 1)}
    held, _ = parts_holding(spark, path, batch(spark, [1003]), SPEC,
                            stored_parts(spark, path, SPEC))
    assert held == {D("2020-02-01")}    # the swapped partitions have filters of their own


def test_partition_without_a_filter_is_read(spark, base, tmp_root):
    path = shutil.copytree(base, f"{tmp_root}/t")
    shutil.rmtree(f"{path}/month=2020-03-01/{keyfilter.FOLDER}")
    parts = stored_parts(spark, path, SPEC)
    held, named = parts_holding(spark, path, batch(spark, [401, 4000]), SPEC, parts)
    assert held == {D("2020-03-01"), D("2021-09-01")} and D("2020-03-01") in named
    assert parts_holding(spark, path, batch(spark, []), SPEC, parts)[0] == set()


def test_keys_of_several_columns_and_types(spark, tmp_root):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()),
                           T.StructField("date", T.DateType())])
    spec = TableSpec("t", schema, ("a", "b"), grain="day")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(9)]
    upsert_path(spark, f"{tmp_root}/t", spark.createDataFrame(
        [(f"k{i}", j, d) for i, d in enumerate(days) for j in range(3)], schema), spec)
    moved = spark.createDataFrame([("k4", 1, days[0])], schema)
    upsert_path(spark, f"{tmp_root}/t", moved, spec)
    got = rows(read_table(spark, f"{tmp_root}/t", spec))
    assert len(got) == 27 and ("k4", 1, days[0]) in got and ("k4", 1, days[4]) not in got
