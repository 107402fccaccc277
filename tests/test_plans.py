"""Plan-shape guards for the scale design (checked on executed plans)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def full_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["stg_national", "mart_patterns", "upsert_regional",
                                 "dq_report", "bi_region_trend", "incremental_lookback"])
def test_no_python_udf(spark, key):
    plan = final_plan(E.queries()[key](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = final_plan(E.queries()["stg_regional"](spark, SF))
    assert re.search(r"WindowGroupLimit .*Partial", plan)
    assert re.search(r"WindowGroupLimit .*Final", plan)


def test_scans_read_only_needed_columns(spark):
    plan = full_plan(E.queries()["mart_patterns"](spark, SF))
    schemas = re.findall(r"lineitem\.parquet\].*?ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all(s.count(":") == 4 for s in schemas)


def test_upsert_shuffle_path_is_splittable(spark):
    plan = final_plan(E.queries()["upsert_national"](spark, SF))
    assert "FullOuter" not in plan
    assert "LeftOuter" in plan and "LeftAnti" in plan


def test_aggregations_are_partial(spark):
    plan = final_plan(E.queries()["mart_regional_monthly"](spark, SF))
    assert "partial_avg" in plan or "partial_sum" in plan


def test_high_water_mark_needs_no_deduplication(spark):
    """The mark is one aggregate over the readings: its subquery has no window."""
    plan = full_plan(E.queries()["incremental_filter"](spark, SF)).split("== Initial Plan ==")[0]
    assert "Subquery" in plan
    assert len(re.findall(r"WindowGroupLimit .*Final", plan)) == 1     # of the staging dedup itself


@pytest.mark.parametrize("key", ["mart_national_incremental", "incremental_lookback", "sync_columns"])
def test_incremental_builds_scan_the_lines_once_beside_the_stored_target(spark, key):
    plan = final_plan(E.queries()[key](spark, SF))
    assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", plan)) <= 2


def test_checks_read_the_stored_models_without_expanding_rows(spark):
    plan = final_plan(E.queries()["dq_report"](spark, SF))
    assert "Expand" not in plan and "lineitem" not in plan


def test_year_slice_prunes_the_orders_scan(spark):
    plan = full_plan(E.queries()["year_slice"](spark, SF))
    pushed = re.findall(r"orders\.parquet\].*?PushedFilters: \[([^\]]*)\]", plan)
    assert pushed and all("LessThan(o_orderdate" in p and "GreaterTh" in p for p in pushed)


def test_missing_text_column_is_one_projection(spark):
    plan = final_plan(E.queries()["nan_to_null"](spark, SF))
    assert len(re.findall(r"SortMergeJoin|BroadcastHashJoin", plan)) == 1   # that of the base readings
