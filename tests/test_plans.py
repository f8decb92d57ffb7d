"""Plan-shape checks for the scale claims in the README."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from tests.fixtures import AS_OF, raw_tables

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_nested_loop_or_cartesian_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_flagship_pushes_time_range_and_prunes_columns(spark):
    plan = _formatted(E.queries()["dense_daily_pivot"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan and "LessThan(ts,2024-01-31T00:00)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_matching_pre_aggregates_before_the_shuffle(spark):
    plan = _plan(E.queries()["cohort_event_count"](spark, SF))
    # the events side is reduced to (key, bucket) counts map-side
    assert "partial_count(1)" in plan


def test_text_time_bounds_reach_every_version_scan(spark, tmp_path):
    from tidemark.plans.reports import run_report
    from tidemark.sources.logical import logical_tables
    raw = raw_tables(spark)
    for n in [k for k in raw if k.startswith("MobileWebEditing")]:
        raw[n].write.parquet(str(tmp_path / n))
        raw[n] = spark.read.parquet(str(tmp_path / n))
    df = run_report(logical_tables(raw), "successful-edits-main", AS_OF)
    plan = _formatted(df)
    assert plan.count("GreaterThanOrEqual(timestamp,20140616000000)") >= 5


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", ["rolling_ratio", "rolling_active_cohort", "report_no_cats", "report_edits_new_active"])
def test_trailing_windows_copy_no_row(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "Generate" not in plan and "Expand" not in plan
