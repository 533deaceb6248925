"""Every registered query equals its DuckDB oracle at sf0.01 (the driver's gate)."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT / "scripts"))
sys.path.insert(0, str(ROOT))

import __spark_entry__ as E  # noqa: E402
from tidemark.plans.catalog import QUERIES  # noqa: E402
from check_oracle import compare  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["location", "date", "temp_max_c", "temp_min_c", "temp_range_c",
                          "precipitation_mm", "fx_usd_mxn", "fx_is_published_rate",
                          "is_business_day"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not Path(SF).exists(), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, {name}, verbose=False)[name]
    assert res[0] == "ok", res


@pytest.mark.skipif(not Path(SF).exists(), reason="driver test data not present")
def test_queries_do_not_depend_on_session_time_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Mexico_City")
    try:
        for name in ("plan_windows", "src_parallel_arrays", "locf_minute", "freshness_report"):
            res = compare(spark, SF, {name}, verbose=False)[name]
            assert res[0] == "ok", (name, res)
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
