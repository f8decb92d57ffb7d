"""Reports over named Parquet sources, materialised unions and run history."""

from __future__ import annotations

import datetime as dt

from tidemark.operators.series import append_history, read_history
from tidemark.operators.timebox import due_reports
from tidemark.plans.reports import REPORTS, run_report
from tidemark.sources.logical import VERSIONS, LogicalCatalog
from tests.fixtures import AS_OF, raw_tables


def test_catalog_from_sources_matches_in_memory(spark, tables, tmp_path):
    raw = raw_tables(spark)
    el, commons, enwiki = tmp_path / "el", tmp_path / "commons", tmp_path / "enwiki"
    event_names = {v for vs in VERSIONS.values() for v in vs}
    for name, df in raw.items():
        base = el if name in event_names else commons
        df.write.parquet(str(base / name))
        if name not in event_names:
            df.write.parquet(str(enwiki / name))
    conf = {"sources": {"el": {"path": str(el)}, "commons": {"path": str(commons)},
                        "enwiki": {"path": str(enwiki)}}}
    for materialize in (False, True):
        cat = LogicalCatalog(spark, conf, materialize=materialize)
        for name in ("successful-edits-main", "deleted-uploads", "edits-monthly-new-active", "uploaders-experience"):
            rep = REPORTS[name]
            kw = {"starts": "2014-05-01"} if rep.timeboxed else {}
            a = sorted(run_report(cat, name, AS_OF, **kw).collect())
            b = sorted(run_report(tables, name, AS_OF, **kw).collect())
            assert a == b, name


def test_history_round_trip_and_due(spark, tmp_path):
    root = str(tmp_path / "history")
    assert read_history(spark, root).count() == 0  # missing folder: empty history
    now = dt.datetime(2014, 7, 1, 12)
    runs = spark.createDataFrame([("ui-daily", dt.datetime(2014, 7, 1, 11, 30))], "report string, last_run timestamp")
    append_history(runs, root)
    append_history(spark.createDataFrame([("ui-daily", dt.datetime(2014, 7, 1, 10))], "report string, last_run timestamp"), root)
    hist = read_history(spark, root)
    assert hist.first()["last_run"] == dt.datetime(2014, 7, 1, 11, 30)
    reg = spark.createDataFrame([(r.name, r.frequency) for r in REPORTS.values() if r.registered],
                                "report string, frequency string")
    due = {r["report"]: r["due"] for r in due_reports(reg, hist, now).collect()}
    assert due["ui-daily"] is False and due["month-uploads"] is True
    assert len(due) == 33


def test_refresh_report_versions_and_drift(spark, tables, tmp_path):
    from tidemark.plans.runner import latest_series, refresh_report
    from tidemark.operators.series import read_history
    root, hist = str(tmp_path / "series"), str(tmp_path / "hist")
    p1 = refresh_report(spark, tables, "app-edits-starts", root, AS_OF, now=dt.datetime(2014, 7, 15), history=hist)
    p2 = refresh_report(spark, tables, "app-edits-starts", root, AS_OF, cutoff="2014-07-01", history=hist)
    assert p1.endswith("v=1") and p2.endswith("v=2")
    fresh = run_report(tables, "app-edits-starts", AS_OF)
    stored, v = latest_series(spark, root + "/app-edits-starts", fresh.schema)
    assert v == 2 and sorted(stored.collect()) == sorted(fresh.collect())
    assert read_history(spark, hist).count() == 1
    p3 = refresh_report(spark, tables, "ui-daily", root, AS_OF)
    assert p3.endswith("ui-daily/v=1")


def test_day_partitions_are_pruned(spark, tables, tmp_path):
    import contextlib
    import io
    from pyspark.sql import functions as F
    from tidemark.sources.logical import logical_tables
    raw = raw_tables(spark)
    names = ["MobileWebClickTracking_5929948", "MobileWebEditing_5644223", "MobileWebEditing_6077315",
             "MobileWebEditing_6637866", "MobileWebEditing_7675117", "MobileWebEditing_8599025"]
    parted = {}
    for n in names:
        day = F.date_format(F.try_to_timestamp("timestamp", F.lit("yyyyMMddHHmmss")), "yyyy-MM-dd")
        raw[n].withColumn("dt", day).write.partitionBy("dt").parquet(str(tmp_path / n))
        parted[n] = spark.read.parquet(str(tmp_path / n))
    t = logical_tables(parted, day_partition="dt")
    for name, kw in (("ui-daily", {"starts": "2014-05-01"}), ("successful-edits-main", {})):
        got = run_report(t, name, AS_OF, **kw)
        assert sorted(got.collect()) == sorted(run_report(tables, name, AS_OF, **kw).collect()), name
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            got.explain("formatted")
        assert "PartitionFilters: [isnotnull(dt#" in buf.getvalue() and "(dt#" in buf.getvalue()


def test_history_is_compacted_without_loss(spark, tmp_path):
    import datetime as dt

    from tidemark.operators.series import append_history, compact_history, read_history
    root = str(tmp_path / "a history")

    def run(name, hour):
        row = spark.createDataFrame([(name, dt.datetime(2014, 7, 1, hour))], "report string, last_run timestamp")
        append_history(row.coalesce(1), root)

    assert compact_history(spark, str(tmp_path / "none")) is False
    for hour in range(6):
        run("ab"[hour % 2], hour)
    before = sorted(read_history(spark, root).collect())
    assert compact_history(spark, root, files=50) is False and compact_history(spark, root, files=6) is True
    assert sorted(read_history(spark, root).collect()) == before
    assert len(list((tmp_path / "a history").glob("part-*.parquet"))) == 1
    run("b", 9)
    assert {r["report"]: r["last_run"].hour for r in read_history(spark, root).collect()} == {"a": 4, "b": 9}
