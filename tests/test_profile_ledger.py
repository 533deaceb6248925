"""Profiles merged from kept partition rows against the profile of the whole table."""

import shutil

import pytest
from pyspark.sql import functions as F, types as T

from conftest import D, rows
from tidemark.operators import profile_ledger as pl
from tidemark.operators.profile import profile
from tidemark.operators.upsert import upsert_path, window_replace_path
from tidemark.sources.tables import read_table, stored_parts
from tidemark.specs import TableSpec

S = T.StructType([T.StructField("k", T.LongType()), T.StructField("date", T.DateType()),
                  T.StructField("v", T.DoubleType()), T.StructField("name", T.StringType()),
                  T.StructField("void", T.IntegerType()),
                  T.StructField("ts", T.TimestampNTZType())])
SPEC = TableSpec("t", S, ("k", "date"))
EXACT = ("column_name", "data_type", "row_count", "null_pct", "min_value", "max_value")


def made(spark, n, start="2024-01-01"):
    i = F.col("id")
    return spark.range(n).select(
        i.alias("k"), F.date_add(F.lit(D(start)), (i % 120).cast("int")).alias("date"),
        F.when(i % 17 == 0, None).when(i % 5 == 0, F.lit(-0.0)).when(i % 5 == 1, F.lit(0.0))
        .otherwise((i % 3001).cast("double") - 9).alias("v"),
        i.cast("string").alias("name"), F.lit(None).cast("int").alias("void"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("ts"))


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('profile')}/t"
    upsert_path(spark, path, made(spark, 30_000), SPEC)
    return path


def same(spark, path, **kind):
    full, kept = profile(read_table(spark, path, SPEC)), pl.kept_profile(spark, path, SPEC, **kind)
    assert rows(kept, *EXACT) == rows(full, *EXACT)
    exact = {r.column_name: r.distinct_count for r in full.collect()}
    got = {r.column_name: r.distinct_count for r in kept.collect()}
    assert {c for c in exact if exact[c] is None} == {c for c in got if got[c] is None}
    for c, d in exact.items():    # 4 standard errors of 2 ^ 12 registers: 6.5 %
        assert d is None or abs(got[c] - d) <= 0.065 * d, (c, d, got[c])
    return exact


def test_an_increment_reads_what_it_wrote(spark, base, tmp_root):
    path = shutil.copytree(base, f"{tmp_root}/t")
    before = same(spark, path)
    assert before["k"] == 30_000 and before["void"] == 0
    assert pl.refresh_profiles(spark, path, SPEC) == []
    upsert_path(spark, path, made(spark, 10, "2024-03-05").withColumn("v", F.lit(1e9)), SPEC)
    assert pl.refresh_profiles(spark, path, SPEC) == [D("2024-03-01")]
    same(spark, path)
    window_replace_path(spark, path, read_table(spark, path, SPEC).filter("date < '2024-04-02'"),
                        SPEC, D("2024-04-01"))
    assert pl.refresh_profiles(spark, path, SPEC) == [D("2024-04-01")]
    same(spark, path)


def test_other_columns_other_precision_and_recount(spark, base, tmp_root):
    path = shutil.copytree(base, f"{tmp_root}/t")
    same(spark, path)
    every = stored_parts(spark, path, SPEC)
    assert pl.refresh_profiles(spark, path, SPEC, lg_k=14) == every
    wider = TableSpec("t", T.StructType([*S.fields, T.StructField("new", T.LongType())]),
                      SPEC.keys)
    assert pl.refresh_profiles(spark, path, wider) == every
    got = {r.column_name: r for r in pl.kept_profile(spark, path, wider).collect()}
    assert (got["new"].null_pct, got["new"].distinct_count) == (100.0, 0)
    (read_table(spark, path, SPEC, [every[0]]).withColumn("k", F.col("k") + 100_000)    # behind its back
     .write.mode("append").parquet(f"{path}/month={every[0]}"))
    same(spark, path, recount=True)


def test_absent_table(spark, tmp_root):
    assert rows(pl.kept_profile(spark, f"{tmp_root}/none", SPEC, "t")) == rows(
        profile(spark.createDataFrame([], S), "t"))
