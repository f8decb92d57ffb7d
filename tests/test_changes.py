"""Refresh of what changed: manifests, partition lists, late rows and holes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_plans import _formatted
from tidemark.operators.changes import content_manifest, days_of_buckets, in_days, look, runs_of, touched_buckets
from tidemark.plans import runner
from tidemark.plans.reports import REPORTS, run_report
from tidemark.sources.logical import logical_tables

D = dt.date
RAW = "MobileWikiAppEdit_9003125"


def edits(spark, path):
    return logical_tables({RAW: spark.read.parquet(path)}, day_partition="day")["edits_app"]


def put(spark, path, rows, mode="append"):
    df = spark.createDataFrame(rows, "timestamp string, wiki string, userAgent string, event_action string")
    df = df.withColumn("day", F.to_date(F.substring("timestamp", 1, 8), "yyyyMMdd"))
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def row(day, action="start", agent="Android", hour=10):
    return (f"2014{day}{hour:02d}0000", "enwiki", agent, action)


def test_fingerprints_are_order_free_and_count_repeats(spark):
    rows = [(D(2014, 1, 1), "a", 1), (D(2014, 1, 1), "b", None), (D(2014, 1, 2), None, 1)]
    schema = "day date, x string, y int"

    def prints(r, n=1):
        df = spark.createDataFrame(r, schema).repartition(n)
        return {tuple(m) for m in content_manifest(df, "day").collect()}

    assert prints(rows) == prints(rows[::-1], 3)
    one, two = rows[0], (D(2014, 1, 1), "a", 1)
    # repeated rows cancel in the exclusive-or, not in the sum
    assert len({next(iter(prints([*[one] * k]))) for k in (1, 2, 3, 4)}) == 4 and prints([one]) == prints([two])
    assert prints([(D(2014, 1, 1), "1", None)]) != prints([(D(2014, 1, 1), None, 1)])
    assert prints([]) == set()


def test_look_reads_only_partitions_whose_files_differ(spark, tmp_path, monkeypatch):
    path, kept = str(tmp_path / "t"), str(tmp_path / "m")
    put(spark, path, [row("0701"), row("0702"), row("0703"), row("0704")])
    first, days = look(edits(spark, path), [path])
    first.write.parquet(kept)
    old = spark.read.parquet(kept)
    assert days == [D(2014, 7, k) for k in (1, 2, 3, 4)] and first.count() == 4
    put(spark, path, [row("0702", "saved")])  # a late row
    put(spark, path, [row("0703")], "overwrite")  # other files, the same rows
    put(spark, path, [row("0709")])  # a new day
    import shutil
    shutil.rmtree(tmp_path / "t" / "day=2014-07-04")
    asked = []
    real = in_days
    monkeypatch.setattr("tidemark.operators.changes.in_days", lambda df, ts, d: asked.append(sorted(d)) or real(df, ts, d))
    now, days = look(edits(spark, path), [path], old)
    assert asked == [[D(2014, 7, k) for k in (2, 3, 4, 9)]]
    assert days == [D(2014, 7, k) for k in (2, 4, 9)]
    want, _ = look(edits(spark, path), [path])
    assert sorted(map(tuple, now.collect())) == sorted(map(tuple, want.collect()))


def test_partition_list_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [row(f"07{k:02d}") for k in range(1, 20)])
    df = in_days(edits(spark, path), "ts", [D(2014, 7, 3), D(2014, 7, 9)])
    assert len(df.inputFiles()) == len(edits(spark, path).inputFiles())  # listed all, ...
    plan = _formatted(df)
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "2014-07-03" in line and "2014-07-09" in line and df.count() == 2  # ... read two
    # without partitions: runs of days as ranges of the text
    plain = logical_tables({RAW: spark.read.parquet(path).drop("day")})["edits_app"]
    plan = _formatted(in_days(plain, "ts", [D(2014, 7, 3), D(2014, 7, 4), D(2014, 7, 9)]))
    assert "20140703000000" in plan and "20140705000000" in plan and "20140709000000" in plan
    assert in_days(plain, "ts", []).count() == 0
    assert runs_of([D(2014, 7, 4), D(2014, 7, 3), D(2014, 7, 9)]) == [(D(2014, 7, 3), D(2014, 7, 5)), (D(2014, 7, 9), D(2014, 7, 10))]


def test_buckets_of_days(spark):
    def touched(*a):
        return sorted(r[0] for r in touched_buckets(spark, *a).collect())

    assert touched([D(2014, 7, 1), D(2014, 7, 3)], "day", "both") == [D(2014, 6, 30), D(2014, 7, 1), D(2014, 7, 2), D(2014, 7, 3)]
    assert touched([D(2014, 7, 1), D(2014, 8, 3)], "month", "both") == [D(2014, 6, 1), D(2014, 7, 1), D(2014, 8, 1)]
    assert touched([], "day") == []
    assert days_of_buckets([D(2014, 7, 1)], "day", "both") == [D(2014, 7, 1), D(2014, 7, 2)]
    assert len(days_of_buckets([D(2014, 2, 1), D(2014, 3, 1)], "month")) == 59


@pytest.mark.parametrize("name", ["app-edits-starts", "app-edit-funnel-total"])
def test_late_rows_and_holes_are_refreshed(spark, tmp_path, monkeypatch, name):
    path, root = str(tmp_path / "t"), str(tmp_path / "series")
    put(spark, path, [row(f"07{k:02d}", a) for k in range(1, 16) for a in ("start", "saved", "preview")])
    asked = []
    real = in_days
    monkeypatch.setattr(runner, "in_days", lambda df, ts, d: asked.append(sorted(d)) or real(df, ts, d))

    def refresh():
        tables = {"edits_app": edits(spark, path)}
        out = runner.refresh_changed(spark, tables, {"edits_app": [path]}, name, root, D(2014, 7, 15), cutoff=D(2014, 7, 15), starts=D(2014, 7, 1))
        want = run_report(tables, name, D(2014, 7, 15), starts=D(2014, 7, 1), labelled=True)
        got = spark.read.option("header", True).schema(want.schema).csv(out)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        return out

    refresh()
    assert asked == []  # no series yet: all is read
    v2 = refresh()
    assert asked.pop() == [D(2014, 7, 14), D(2014, 7, 15)]  # open buckets only
    # a hole: an early bucket of the stored series is lost
    lines = [p for p in (tmp_path / "series" / name / v2.rsplit("/", 1)[1]).glob("*.csv")]
    for p in lines:
        p.write_text("\n".join(x for x in p.read_text().split("\n") if not x.startswith("2014-07-04")))
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    put(spark, path, [row("0708", "start", "iPhone OS")])  # a late row
    refresh()
    assert asked.pop() == [D(2014, 7, k) for k in (4, 8, 14, 15)]
    # rows taken away, and a day without any left
    put(spark, path, [row("0705")], "overwrite")
    import shutil
    shutil.rmtree(tmp_path / "t" / "day=2014-07-06")
    refresh()
    assert asked.pop() == [D(2014, 7, k) for k in (5, 6, 14, 15)]
    kept = sorted(p.name for p in (tmp_path / "series" / name).iterdir())
    assert kept == ["m=3", "m=4", "v=3", "v=4"]


def test_closed_windows_read_the_next_midnight(spark, tmp_path, monkeypatch):
    path, root = str(tmp_path / "t"), str(tmp_path / "series")

    def put_clicks(rows, mode="append"):
        df = spark.createDataFrame(rows, "timestamp string, event_name string").withColumn(
            "day", F.to_date(F.substring("timestamp", 1, 8), "yyyyMMdd"))
        df.write.mode(mode).partitionBy("day").parquet(path)

    def refresh():
        tables = logical_tables({"MobileWebClickTracking_5929948": spark.read.parquet(path)}, day_partition="day")
        out = runner.refresh_changed(spark, tables, {"click_tracking": [path]}, "diff-activity", root, D(2014, 7, 9),
                                     cutoff=D(2014, 7, 9), starts=D(2014, 7, 1))
        want = run_report(tables, "diff-activity", D(2014, 7, 9), starts=D(2014, 7, 1), labelled=True)
        got = spark.read.option("header", True).schema(want.schema).csv(out)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)

    put_clicks([(f"201407{k:02d}{h}0000", "diff-thank") for k in range(1, 10) for h in ("00", "12")])
    refresh()
    put_clicks([("20140705000000", "diff-user")])  # ends the 4th, starts the 5th
    refresh()
    assert REPORTS["diff-activity"].closed == "both"


def test_only_time_boxed_counts(spark, tmp_path):
    with pytest.raises(ValueError):
        runner.refresh_changed(spark, {}, {}, "no-cats", str(tmp_path), D(2014, 7, 1))


def test_a_hole_does_not_reopen_the_range(spark, tmp_path):
    """A stored series with an early hole: its day and the open ones are read, not all between."""
    path = str(tmp_path / "t")
    put(spark, path, [row(f"07{k:02d}") for k in range(1, 16)])
    df = edits(spark, path)
    full = run_report({"edits_app": df}, "app-edits-starts", D(2014, 7, 15), starts=D(2014, 7, 1))
    stored = spark.createDataFrame([r for r in full.collect() if r["bucket"] != D(2014, 7, 4)], full.schema)
    out = run_report({"edits_app": df}, "app-edits-starts", D(2014, 7, 15), starts=D(2014, 7, 1), stored=stored, cutoff=D(2014, 7, 15))
    line = next(x for x in _formatted(out).splitlines() if "PartitionFilters" in x)
    assert "2014-07-04" in line and "2014-07-14" in line and "2014-07-08" not in line
    assert sorted(out.collect()) == sorted(full.collect())
