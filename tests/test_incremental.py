import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import D, rows
from tidemark.operators.incremental import lookback_cutoff, merge_incremental, window_replace
from tidemark.operators.quality import ContractViolation, enforce_contract
from tidemark.specs import MART

S = "location string, date date, v double"
KEYS = ["location", "date"]


def _days(start, n):
    return [D(start) + dt.timedelta(days=i) for i in range(n)]


@pytest.fixture
def target(spark):
    # max date D = 2024-01-31
    return spark.createDataFrame([("a", d, 1.0) for d in _days("2024-01-01", 31)], S)


def test_cutoff_inclusive(target):
    assert lookback_cutoff(target, "date", 10) == D("2024-01-21")
    assert lookback_cutoff(None) == D("1969-12-22")


def test_absent_target_takes_everything(spark, target):
    assert rows(merge_incremental(None, target, KEYS)) == rows(target)


def test_unchanged_source_is_identity(target):
    assert rows(merge_incremental(target, target, KEYS)) == rows(target)


def test_lookback_edges(spark, target):
    src = target.withColumn("v", F.lit(2.0)).unionByName(
        target.sparkSession.createDataFrame([("a", D("2024-02-01"), 3.0)], S))
    got = dict(((loc, d), v) for loc, d, v in rows(merge_incremental(target, src, KEYS)))
    assert got[("a", D("2024-01-21"))] == 2.0      # D-10: updated
    assert got[("a", D("2024-01-20"))] == 1.0      # D-11: not updated
    assert got[("a", D("2024-02-01"))] == 3.0      # newer: inserted
    # ``since`` picks up older (backfilled) history
    got2 = dict(((loc, d), v) for loc, d, v in rows(
        merge_incremental(target, src, KEYS, since="2024-01-01")))
    assert got2[("a", D("2024-01-01"))] == 2.0


def test_vanished_key_stays_unless_window_replace(spark, target):
    src = target.filter(F.col("date") != F.lit(D("2024-01-25")))
    merged = rows(merge_incremental(target, src, KEYS))
    assert ("a", D("2024-01-25"), 1.0) in merged
    replaced = rows(window_replace(target, src, "date", 10))
    assert ("a", D("2024-01-25"), 1.0) not in replaced
    assert len(replaced) == 30
    # window replace keeps only source keys inside the window
    inside = [r for r in replaced if r[1] >= D("2024-01-21")]
    assert set(inside) <= set(rows(src))


def test_contract_checked_before_write(spark):
    good = spark.createDataFrame([], MART.schema)
    assert enforce_contract(good, MART.schema).columns == MART.columns
    for bad in (good.drop("is_business_day"), good.withColumn("extra", F.lit(1)),
                good.withColumn("temp_max_c", F.col("temp_max_c").cast("string"))):
        with pytest.raises(ContractViolation):
            enforce_contract(bad, MART.schema)


def test_scale_settings():
    from tidemark.session import scale_settings
    big = scale_settings(100 * 2**40, 8000)           # 100 TB on 1000 x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000       # 25 TB / 256 MiB, capped
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 * 2**20
    small = scale_settings(10 * 2**20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 16 * 2**20
