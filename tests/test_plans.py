"""Plan properties of registered queries that the scale design relies on."""

import re
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver test data not present")


def final_plan(spark, name):
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()      # AQE settles its final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_broadcasts_the_calendar_and_never_sorts_facts(spark):
    plan = final_plan(spark, "enrich_daily")
    assert "SortMergeJoin" not in plan
    assert re.search(r"BroadcastHashJoin \[[^\]]*date[^\]]*\], \[[^\]]*\], LeftOuter", plan)


def test_keyed_fill_is_one_scan_and_the_grid_fill_one_window_of_it(spark):
    plan = final_plan(spark, "locf_by_entity")
    assert plan.count("FileScan parquet [l_") == 1
    plan = final_plan(spark, "locf_minute")
    final = plan.split("Initial Plan")[0]
    assert len(re.findall(r"Window \[last\(value#", final)) == 1


def test_no_broadcast_hint_outside_the_calendar_join():
    hits = [p.name for p in (ROOT / "tidemark").rglob("*.py")
            if "llm" not in p.parts and "F.broadcast(" in p.read_text()]
    assert hits == ["joins.py"]


def test_stored_target_is_read_back_not_rebuilt(spark):
    assert final_plan(spark, "incremental_mart").count("FileScan parquet [l_") == 0
    assert final_plan(spark, "window_replace").count("FileScan parquet [l_") == 1


def test_window_replace_pushes_the_cutoff_into_the_scan(spark):
    plan = final_plan(spark, "window_replace")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan)


def test_staging_filter_reaches_parquet(spark):
    plan = final_plan(spark, "staging_cast")
    assert "EqualTo(event_type,click)" in plan
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>", plan)


def test_profile_is_one_aggregate_over_one_scan(spark):
    plan = final_plan(spark, "profile_table")
    assert plan.count("FileScan parquet") == 2          # orders and events, once each
    assert "Expand" in plan


def test_check_report_is_one_scan_of_the_mart_inputs(spark):
    plan = final_plan(spark, "dq_report")
    assert plan.count("FileScan parquet [l_") == 1


def test_keyed_carry_never_funnels_into_one_task(spark):
    for name in ("locf_by_entity", "locf_by_entity_bucketed"):
        assert "SinglePartition" not in final_plan(spark, name), name


def test_flagship_single_task_step_is_only_the_calendar_window(spark):
    plan = final_plan(spark, "enrich_daily")
    assert plan.count("Exchange SinglePartition") == 1
    # the single-partition exchange feeds the ordered calendar window (days, proven size)
    block = plan.split("Exchange SinglePartition")[0].rsplit("Window [", 1)
    assert len(block) == 2
