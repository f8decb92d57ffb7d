"""Rows accounted for in the report's own scan."""

from __future__ import annotations

import datetime as dt

from tests.fixtures import AS_OF, raw_tables
from tidemark.plans.reports import run_report
from tidemark.sources.accounting import Accounting, append_accounts, counted_tables, read_accounts
from tidemark.sources.logical import logical_tables

V = ["MobileAppUploadAttempts_5257716", "MobileAppUploadAttempts_5334329"]


def test_figures_equal_brute_force_and_the_series_is_the_same(spark, tmp_path):
    raw = raw_tables(spark)
    raw[V[0]] = raw[V[0]].unionAll(raw[V[0]].limit(3)).unionAll(raw[V[0]].limit(1).selectExpr(
        *[f"'201407' AS {c}" if c == "timestamp" else c for c in raw[V[0]].columns])).unionAll(
        raw[V[0]].limit(1).selectExpr(*[f"CAST(NULL AS STRING) AS {c}" if c == "timestamp" else c for c in raw[V[0]].columns]))
    starts, ends = AS_OF - dt.timedelta(days=29), AS_OF
    account = Accounting(starts, ends)
    out = run_report(counted_tables(raw, account), "cancelled-uploads", AS_OF)
    want = run_report(logical_tables(raw), "cancelled-uploads", AS_OF)
    assert sorted(out.collect(), key=str) == sorted(want.collect(), key=str)
    got = {(t, v): tuple(f) for t, v, *f in account.figures(out)}
    # the report reads one logical table: the others have no figures
    assert set(got) == {("upload_attempts", V[0]), ("upload_attempts", V[1]), ("upload_attempts", None)}

    def is_time(text):
        try:
            return len(text) == 14 and text.isdigit() and bool(dt.datetime.strptime(text, "%Y%m%d%H%M%S"))
        except ValueError:
            return False

    total = 0
    for v in V:
        texts = [r["timestamp"] for r in raw[v].collect()]
        total += len(texts)
        assert got["upload_attempts", v] == (len(texts), sum(t is None for t in texts),
                                             sum(t is not None and not is_time(t) for t in texts), None, None)
    rows = logical_tables(raw)["upload_attempts"].collect()
    outside = sum(r["ts"] is not None and not starts <= r["ts"].date() <= ends for r in rows)
    assert got["upload_attempts", None] == (len(rows), None, None, outside, total - len(rows))
    assert got["upload_attempts", V[0]][1:3] >= (1, 1) and total > len(rows)
    # beside the history, a run after another
    log, now = str(tmp_path / "rows"), dt.datetime(2014, 7, 16, 1)
    append_accounts(spark, account, out, "cancelled-uploads", now, log)
    append_accounts(spark, account, out, "cancelled-uploads", now + dt.timedelta(hours=1), log)
    kept = read_accounts(spark, log)
    assert kept.count() == 6 and kept.select("run").distinct().count() == 2
    assert kept.where("version is null").first()["removed"] == total - len(rows)


def test_no_scan_is_added(spark, tmp_path):
    raw = {}
    for name, df in raw_tables(spark).items():
        if name in V:
            df.write.parquet(str(tmp_path / name))
            raw[name] = spark.read.parquet(str(tmp_path / name))
    out = run_report(counted_tables(raw, Accounting(AS_OF, AS_OF)), "cancelled-uploads", AS_OF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("CollectMetrics") == 3


def test_tables_without_time_or_versions(spark):
    users = spark.createDataFrame([("A", 1)], "user_name string, user_editcount long")
    log = spark.createDataFrame([("20140701000000",), (None,)], "log_timestamp string")
    account = Accounting()
    tables = counted_tables({"user": users, "logging": log, "unknown": users}, account)
    joined = tables["user"].select("user_name").unionAll(tables["logging"].select("log_timestamp"))
    assert len(joined.collect()) == 3
    got = {(t, v): f for t, v, *f in account.figures(joined)}
    assert got["user", "user"] == [1, None, None, None, None] and got["logging", "logging"] == [2, 1, 0, None, None]
    assert got["logging", None] == [2, None, None, None, 0]
    empty = Accounting(AS_OF, AS_OF)
    none = counted_tables({"logging": log.limit(0)}, empty)["logging"]
    assert none.collect() == [] and empty.figures(none)[0][2:5] == (0, 0, 0)
