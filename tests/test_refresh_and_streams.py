"""Rows that must not get lost, refreshes that read only what they must, versions and zones."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import subprocess
import sys
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.buckets import bucket_distinct
from tidemark.operators.series import append_history, read_history, write_series
from tidemark.plans.reports import REPORTS, run_report
from tidemark.plans.runner import due_now, latest_series, refresh_report
from tidemark.sources.logical import VERSIONS, LogicalCatalog, logical_tables
from tidemark.streaming.buckets import streaming_bucket_counts
from tests.fixtures import AS_OF, raw_tables

EVENTS = "/root/testdata/sf0.001/events.parquet"


def explained(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("form", ["folder", "file"])
def test_stream_counts_late_rows(spark, tmp_path, form):
    events = spark.read.parquet(EVENTS)
    if form == "folder":  # newest first, one file at a time
        days = events.withColumn("part", F.ntile(3).over(Window.orderBy(F.desc("ts"))))
        for part in (1, 2, 3):
            days.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            time.sleep(1.1)
    source = str(tmp_path / "in") if form == "folder" else EVENTS
    streaming_bucket_counts(spark, source, events.schema, "ts", {}, sink=str(tmp_path / "out"),
                            checkpoint=str(tmp_path / "ck"), max_files_per_trigger=1)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.agg(F.sum("total")).first()[0] == events.count()
    assert got.count() == events.select(F.to_date("ts")).distinct().count()


def test_missing_version_raises_unless_named(spark, tmp_path):
    raw = raw_tables(spark)
    names = VERSIONS["edits_web"]
    for name in names[1:]:
        raw[name].write.parquet(str(tmp_path / name))
    conf = {"sources": {"el": {"path": str(tmp_path)}, "commons": {"path": str(tmp_path)}, "enwiki": {"path": str(tmp_path)}}}
    with pytest.raises(AnalysisException):
        LogicalCatalog(spark, conf).for_source("enwiki")["edits_web"]
    lax = LogicalCatalog(spark, conf, may_be_absent=[names[0]]).for_source("enwiki")
    want = logical_tables({n: raw[n] for n in names[1:]})["edits_web"]
    assert lax["edits_web"].count() == want.count()


def test_refresh_pushes_its_bound(spark, tmp_path):
    raw = raw_tables(spark)
    for name in VERSIONS["edits_app"]:
        raw[name].write.parquet(str(tmp_path / name))
    t = logical_tables({n: spark.read.parquet(str(tmp_path / n)) for n in VERSIONS["edits_app"]})
    full = run_report(t, "app-edits-starts", "2014-07-15")
    rows = full.collect()
    spine = [dt.date(2014, 6, 25) + dt.timedelta(days=i) for i in range(21)]
    have = {r["bucket"]: r for r in rows}
    stored = spark.createDataFrame([tuple(have.get(d, (d, 0, 0, 0))) for d in spine if d < dt.date(2014, 7, 10)], full.schema)
    out = run_report(t, "app-edits-starts", "2014-07-15", stored=stored, cutoff="2014-07-08")
    assert "GreaterThanOrEqual(timestamp,20140707000000)" in explained(out)


def test_every_refresh_equals_a_full_run(spark, tables):
    for name in ("app-edits-starts", "ui-daily", "thanks-daily", "edits-monthly-new-active", "edits-monthly-active-2014"):
        rep = REPORTS[name]
        kw = {"starts": "2014-05-01"}
        full = run_report(tables, name, AS_OF, **kw)
        rows = sorted(full.collect(), key=lambda r: r["bucket"])
        stored = spark.createDataFrame(rows[:len(rows) // 2], full.schema)
        got = run_report(tables, name, AS_OF, stored=stored, cutoff="2014-07-01", **kw)
        assert sorted(got.collect(), key=lambda r: r["bucket"]) == rows, rep.name


def test_versions_need_success_and_are_not_written_twice(spark, tables, tmp_path):
    root = str(tmp_path / "s")
    name = "app-edits-starts"
    schema = run_report(tables, name, AS_OF).schema
    for k in (1, 2, 3):
        assert refresh_report(spark, tables, name, root, AS_OF).endswith(f"v={k}")
    folder = os.path.join(root, name)
    assert sorted(os.listdir(folder)) == ["v=2", "v=3"]
    os.makedirs(os.path.join(folder, "v=4"))  # an incomplete write
    assert latest_series(spark, folder, schema)[1] == 3
    assert refresh_report(spark, tables, name, root, AS_OF).endswith("v=5")
    header = spark.read.option("header", True).csv(os.path.join(folder, "v=5")).columns
    assert header == [REPORTS[name].labels[c] for c in schema.names]
    with pytest.raises(AnalysisException):
        write_series(run_report(tables, name, AS_OF), os.path.join(folder, "v=5"), replace=False)


def test_writers_leave_the_session_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "bucket date, n int")
    for day in (1, 2):
        write_series(df.withColumn("bucket", F.lit(dt.date(2024, 1, day))), str(tmp_path / "p"), fmt="parquet", partitioned=True)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    with pytest.raises(ValueError):
        write_series(spark.read.parquet(str(tmp_path / "p")), str(tmp_path / "p"), fmt="parquet")


def test_history_does_not_depend_on_the_process_zone(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setenv("TZ", "America/Los_Angeles")
    time.tzset()
    try:
        hist, noon = str(tmp_path / "h"), dt.datetime(2014, 7, 15, 12)
        refresh_report(spark, tables, "app-edits-starts", str(tmp_path / "s"), AS_OF, now=noon, history=hist)
        due = {h: {r["report"]: r["due"] for r in due_now(spark, hist, noon + dt.timedelta(hours=h)).collect()} for h in (0, 2)}
        assert due[0]["app-edits-starts"] is False and due[2]["app-edits-starts"] is True
    finally:
        monkeypatch.undo()
        time.tzset()


def test_damaged_history_is_an_error(spark, tmp_path):
    append_history(spark.createDataFrame([("r", dt.datetime(2024, 1, 1))], "report string, last_run timestamp"), str(tmp_path / "h"))
    (tmp_path / "h" / "part-bad.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        read_history(spark, str(tmp_path / "h")).collect()


def test_distinct_plan_copies_no_row(spark):
    df = spark.read.parquet(EVENTS)
    out = bucket_distinct(df, "ts", "day", "user_id", {"a": F.col("event_type") == "click", "b": F.lit(True)})
    assert "Expand" not in explained(out)
    want = {r[0]: (r[1], r[2]) for r in df.groupBy(F.to_date("ts")).agg(
        F.count_distinct(F.when(F.col("event_type") == "click", F.col("user_id"))), F.count_distinct("user_id")).collect()}
    assert {r["bucket"]: (r["a"], r["b"]) for r in out.collect()} == want


def test_cohort_scans_push_the_window(spark, tmp_path):
    raw = raw_tables(spark)
    disk = {}
    for name, df in raw.items():
        df.write.parquet(str(tmp_path / name))
        disk[name] = spark.read.parquet(str(tmp_path / name))
    plan = explained(run_report(logical_tables(disk), "edits-monthly-new-active", AS_OF, starts="2014-05-01"))
    for column in ("rev_timestamp", "ar_timestamp", "log_timestamp"):
        assert f"GreaterThanOrEqual({column},2014" in plan, column


def test_alltime_numbers_always_have_three_rows(tables):
    less = dict(tables)
    less["upload_attempts"] = tables["upload_attempts"].where(F.lit(False))
    rows = {r["source"]: r["total"] for r in run_report(less, "alltime-numbers", AS_OF).collect()}
    assert set(rows) == {"Android", "iOS", "Web"}


def test_two_decimal_and_scratch_folder_elsewhere(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession, functions as F
from tidemark.functions.arith import two_decimal
from tidemark.session import shared_dir
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
print([r[0] for r in s.range(1).select(two_decimal(F.lit(0.125))).collect()])
try:
    shared_dir(s)
except RuntimeError as e:
    print("clear:", e)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SPARK_CONF_DIR": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "['0.12']" in out.stdout and "clear: set spark.checkpoint.dir" in out.stdout, out.stdout + out.stderr[-2000:]
