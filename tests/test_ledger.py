"""Check results kept per partition equal a report over the whole table."""

import shutil

import pytest
from pyspark.sql import functions as F, types as T

from conftest import D, rows
from tidemark.operators import ledger
from tidemark.operators.ledger import ledger_report, refresh
from tidemark.operators.quality import (accepted_range, check_report, not_null, row_rule,
                                        unique_combination)
from tidemark.operators.upsert import upsert_path, window_replace_path
from tidemark.sources.tables import read_table, stored_parts, swap_parts, write_stage
from tidemark.specs import TableSpec

S = T.StructType([T.StructField("k", T.StringType()), T.StructField("date", T.DateType()),
                  T.StructField("v", T.DoubleType())])
SPEC = TableSpec("t", S, ("k", "date"))


def some_checks():
    return [not_null("v"), accepted_range("v", 0, 50), unique_combination(["k", "date"]),
            unique_combination(["k"]), row_rule("odd", "v % 2 = 1", "v")]


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('ledger')}/t"
    df = spark.range(600).select(
        F.concat(F.lit("k"), F.col("id") % 50).alias("k"),
        F.date_add(F.lit(D("2024-01-01")), (F.col("id") / 5).cast("int")).alias("date"),
        F.when(F.col("id") % 17 != 0, F.col("id") % 60).cast("double").alias("v"))
    upsert_path(spark, path, df, SPEC)
    return path


def same(spark, path, checks=None, **kind):
    checks = checks or some_checks()
    full = rows(check_report(read_table(spark, path, SPEC), checks))
    assert rows(ledger_report(spark, path, SPEC, checks, **kind)) == full
    return full


def test_increment_is_counted_where_it_wrote(spark, base, tmp_root):
    path = shutil.copytree(base, f"{tmp_root}/t")
    by_part = [c for c in some_checks() if not ledger.whole_table(c, SPEC)]
    before = same(spark, path)
    assert {r[3] for r in before} == {"fail", "pass"}
    assert refresh(spark, path, SPEC, by_part) == []
    upsert_path(spark, path, spark.createDataFrame([("k1", D("2024-03-02"), 99.0)], S), SPEC)
    assert refresh(spark, path, SPEC, by_part) == [D("2024-03-01")]
    assert same(spark, path) != before
    window_replace_path(spark, path, read_table(spark, path, SPEC).filter("date < '2024-04-02'"),
                        SPEC, D("2024-04-01"))
    assert refresh(spark, path, SPEC, by_part) == [D("2024-04-01")]
    same(spark, path)


def test_duplicates_other_definitions_and_recount(spark, base, tmp_root):
    path = shutil.copytree(base, f"{tmp_root}/t")
    same(spark, path)
    twice = read_table(spark, path, SPEC, [D("2024-02-01")])
    stage = write_stage(twice.unionByName(twice), path, SPEC)
    swap_parts(spark, stage, path, SPEC, [D("2024-02-01")])
    found = {r[:2]: r[2] for r in same(spark, path)}
    assert found["unique_combination", "k,date"] == 145
    other = [accepted_range("v", 0, 40), *some_checks()[1:]]
    assert len(refresh(spark, path, SPEC, [other[0]])) == len(stored_parts(spark, path, SPEC))
    same(spark, path, other)
    (read_table(spark, path, SPEC, [D("2024-02-01")])    # behind its back
     .write.mode("append").parquet(f"{path}/month=2024-03-01"))
    same(spark, path, recount=True)


def test_empty_table_and_no_row_checks(spark, base, tmp_root):
    same(spark, f"{tmp_root}/absent")
    path = shutil.copytree(base, f"{tmp_root}/t")
    same(spark, path, [unique_combination(["k", "date"])])
    same(spark, path, [not_null("k")])
