"""Drift verdicts kept per file: what is opened, and what is found."""

import pytest
from pyspark.sql import functions as F, types as T

from conftest import D
from tidemark.operators.upsert import upsert_path
from tidemark.plans import drift
from tidemark.plans.drift import stored_drift
from tidemark.sources.tables import read_table
from tidemark.specs import TableSpec

S = T.StructType([T.StructField("k", T.StringType()), T.StructField("date", T.DateType()),
                  T.StructField("v", T.DoubleType())])
SPEC = TableSpec("t", S, ("k", "date"))


@pytest.fixture
def opened(monkeypatch):
    """The partitions of the files that each run opened."""
    runs, check = [], drift._file_drift

    def spy(spark, path, spec, files, threads):
        runs.append(sorted({f.split("/")[0] for f in files}))
        return check(spark, path, spec, files, threads)

    monkeypatch.setattr(drift, "_file_drift", spy)
    return runs


def table(spark, path, n=90):
    upsert_path(spark, path, spark.range(n).select(
        F.lit("a").alias("k"), F.date_add(F.lit(D("2024-01-01")), F.col("id").cast("int"))
        .alias("date"), F.lit(None).cast("double").alias("v")), SPEC)


def test_only_new_files_are_opened(spark, tmp_root, opened):
    path = f"{tmp_root}/t"
    table(spark, path)
    assert stored_drift(spark, path, SPEC) == []    # every v is NULL, but there
    assert stored_drift(spark, path, SPEC) == []
    assert opened == [["month=2024-01-01", "month=2024-02-01", "month=2024-03-01"]]
    upsert_path(spark, path, spark.createDataFrame([("a", D("2024-02-03"), 1.0)], S), SPEC)
    assert stored_drift(spark, path, SPEC) == [] and opened[1:] == [["month=2024-02-01"]]
    assert read_table(spark, path, SPEC).count() == 90
    wider = TableSpec("t", T.StructType([*S.fields, T.StructField("w", T.LongType())]), SPEC.keys)
    found = stored_drift(spark, path, wider)
    assert {d[1:] for d in found} == {("w", "missing", "bigint", None)} and len(found) == 3
    assert len(opened[2]) == 3


def test_drift_is_kept_until_its_file_goes(spark, tmp_root, opened):
    path = f"{tmp_root}/t"
    table(spark, path)
    assert stored_drift(spark, path, SPEC, D("2024-03-01")) == []
    march = read_table(spark, path, SPEC, [D("2024-03-01")])
    (march.withColumnRenamed("v", "v_old").withColumn("date", F.date_add("date", 0))
     .write.mode("append").parquet(f"{path}/month=2024-03-01"))
    (march.drop("v").write.mode("append").parquet(f"{path}/month=2024-02-01"))
    (march.withColumn("v", F.lit("text")).write.mode("append").parquet(f"{path}/month=2024-01-01"))
    want = [(D("2024-01-01"), "v", "type_mismatch", "double", "string"),
            (D("2024-02-01"), "v", "missing", "double", None),
            (D("2024-03-01"), "v", "missing", "double", None),
            (D("2024-03-01"), "v_old", "extra", None, "double")]
    assert stored_drift(spark, path, SPEC) == want
    assert stored_drift(spark, path, SPEC) == want and len(opened) == 2    # from the verdicts
    assert stored_drift(spark, path, SPEC, D("2024-02-01")) == want[1:]
    clean = spark.createDataFrame([("a", D("2024-03-05"), 1.0)], S)
    clean.write.mode("overwrite").parquet(f"{path}/month=2024-03-01")
    assert stored_drift(spark, path, SPEC) == want[:2]
    assert opened[2:] == [["month=2024-03-01"]]


def test_absent_table(spark, tmp_root):
    assert stored_drift(spark, f"{tmp_root}/none", SPEC) == []
