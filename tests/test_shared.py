"""All count reports from one scan of each table."""

from __future__ import annotations

import datetime as dt

import pytest

from tests.fixtures import AS_OF, raw_tables
from tidemark.plans.counts import daily_counts, part_of, series_of
from tidemark.plans.reports import REPORTS, params_for, run_all, run_report
from tidemark.plans.runner import refresh_all, refresh_report
from tidemark.sources.logical import logical_tables

STARTS = dt.date(2014, 6, 20)
COUNTS = [r.name for r in REPORTS.values() if r.counts]


@pytest.fixture(scope="module")
def stored_tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    raw = raw_tables(spark)
    for name, df in raw.items():
        df.write.parquet(str(root / name))
    return logical_tables({name: spark.read.parquet(str(root / name)) for name in raw})


def test_every_plain_count_report_is_shared():
    others = {"unique-uploaders", "unique-uploaders-day", "successful-edits-unique", "edits-monthly-unique-editors",
              "app-user-blocks-en", "uploaders-experience", "alltime-numbers", "no-cats", "deleted-uploads",
              "error-correction", "edits-monthly-new-active", "edits-monthly-active-2014"}
    assert set(REPORTS) - set(COUNTS) == others and len(COUNTS) == 23


def test_run_all_equals_single_reports(spark, stored_tables):
    out = run_all(stored_tables, AS_OF, starts=STARTS)
    assert list(out) == [r.name for r in REPORTS.values() if r.registered]
    for name in COUNTS:
        want = run_report(stored_tables, name, AS_OF, starts=STARTS if REPORTS[name].timeboxed else None)
        assert out[name].columns == want.columns and out[name].dtypes == want.dtypes, name
        assert sorted(out[name].collect(), key=str) == sorted(want.collect(), key=str), name
        # the series read the daily counts, no table
        assert all("/daily-" in f for f in out[name].inputFiles()) and out[name].inputFiles(), name
    labelled = run_all(stored_tables, AS_OF, names=["thanks-daily"], starts=STARTS, labelled=True)["thanks-daily"]
    assert labelled.columns == list(REPORTS["thanks-daily"].labels.values())


def test_each_table_is_scanned_once(spark, stored_tables):
    parts: dict = {}
    for name in COUNTS:
        for part in REPORTS[name].counts(params_for(REPORTS[name], AS_OF, STARTS)).parts:
            parts.setdefault(part.table, []).append(part)
    assert len(parts["edits_web"]) == 5 and len(parts["edits_app"]) == 7 and len(parts["click_tracking"]) == 3
    for name, own in parts.items():
        df = stored_tables[name]
        plan = daily_counts(df, own)._jdf.queryExecution().executedPlan().toString()
        versions = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
        assert plan.count("FileScan") == len(versions), name
        if all(p.start for p in own):
            assert plan.count("GreaterThanOrEqual(timestamp,") >= len(versions), name


def test_ranges_grains_and_conditions_of_parts(spark):
    """Parts that differ in everything, on rows with NULL times, midnights and NULL conditions."""
    from pyspark.sql import functions as F

    from tidemark.plans.counts import Part
    day = dt.datetime(2014, 1, 31)
    rows = [(None, "a", 1), (day, "a", 1), (day, None, 2), (day + dt.timedelta(hours=5), "a", None),
            (dt.datetime(2014, 2, 1), "b", 1), (dt.datetime(2014, 2, 1), "a", 3), (dt.datetime(2014, 3, 1), "a", 1),
            (dt.datetime(2014, 3, 1, 0, 0, 1), "b", 1)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, k string, v int")
    a, few = F.col("k") == "a", F.col("v") < 3
    jan, feb, mar = (dt.date(2014, m, 1) for m in (1, 2, 3))
    bounded = [Part("t", {"x": few}, a, "n", "day", dt.date(2014, 1, 31), feb), Part("t", {"x": few, "y": a}, None, None, "day", jan, mar, "both"),
               Part("t", {"x": a}, few, None, "month", jan, feb, "both"), Part("t", {"x": few}, a, "n", "month", feb, mar)]
    for parts in (bounded, [*bounded, Part("t", {"x": few}, a, "n"), Part("t", {}, None, "n", "month")]):
        daily = daily_counts(df, parts)
        for i, p in enumerate(parts):
            got, want = part_of(daily, i, p), series_of(df, p)
            assert got.dtypes == want.dtypes and sorted(got.collect(), key=str) == sorted(want.collect(), key=str), (i, p)


def test_refresh_all_equals_single_refreshes(spark, stored_tables, tmp_path):
    names = ["ui-daily", "app-edits-starts", "successful-uploads", "app-edit-funnel-ios", "app-user-blocks-en"]
    one, many, log = str(tmp_path / "one"), str(tmp_path / "many"), str(tmp_path / "log")
    now = dt.datetime(2014, 7, 16, 12)
    for as_of in (dt.date(2014, 7, 3), AS_OF):
        for name in names:
            refresh_report(spark, stored_tables, name, one, as_of, starts=STARTS)
        paths = refresh_all(spark, stored_tables, many, as_of, names=names, starts=STARTS, history=log, now=now)
        for name in names:
            a, b = (spark.read.option("header", True).csv(p) for p in (f"{one}/{name}/{paths[name].rsplit('/', 1)[1]}", paths[name]))
            assert a.columns == b.columns and sorted(a.collect(), key=str) == sorted(b.collect(), key=str), (name, as_of)
    assert paths["ui-daily"].endswith("v=2")
    # none of them is due again, the others are
    due = refresh_all(spark, {k: v for k, v in stored_tables.items()}, many, AS_OF, starts=STARTS, history=log, now=now)
    assert not set(due) & set(names) and "thanks-daily" in due


def test_incomplete_versions_go_once_a_newer_one_is_complete(spark, stored_tables, tmp_path):
    root = str(tmp_path)
    refresh_report(spark, stored_tables, "app-edits-starts", root, AS_OF, starts=STARTS)
    lost = tmp_path / "app-edits-starts" / "v=2"
    lost.mkdir()
    (lost / "part-0.csv").write_text("torn")
    assert refresh_report(spark, stored_tables, "app-edits-starts", root, AS_OF, starts=STARTS).endswith("v=3")
    assert lost.exists()  # the run may still be at work: only versions before a complete one go
    refresh_report(spark, stored_tables, "app-edits-starts", root, AS_OF, starts=STARTS)
    left = sorted(p.name for p in (tmp_path / "app-edits-starts").iterdir())
    assert left == ["v=3", "v=4"]
