"""Reports from a folder: SQL first, modules by path, errors before anything runs."""

from __future__ import annotations

import datetime as dt

import pytest

from tidemark.plans.files import load_reports, with_files
from tidemark.plans.q_files import FOLDER
from tidemark.plans.reports import REPORTS, run_all, run_report
from tidemark.plans.runner import due_now, refresh_all, refresh_report


def put(folder, config, **files):
    folder.mkdir(exist_ok=True)
    (folder / "reports.toml").write_text(config)
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_text(text)
    return folder


def events(spark):
    return spark.createDataFrame([(dt.datetime(2014, 7, d, 5), d % 3) for d in range(1, 11)], "ts timestamp_ntz, user_id int")


def test_sample_folder():
    found = load_reports(FOLDER)
    assert list(found) == ["value-by-type", "busy-users"] and found["value-by-type"].timeboxed and not found["busy-users"].timeboxed
    assert set(with_files(FOLDER)) == set(REPORTS) | set(found)


def test_sql_goes_first_and_binds_parameters(spark, tmp_path):
    put(tmp_path, '[reports.a]\nstarts = "2014-07-03"\n[reports.a.labels]\nbucket = "Day"\n[reports.b]\n',
        a__sql="-- :nothing here\nSELECT to_date(ts) AS bucket, count(*) AS n, ':n' AS t FROM events WHERE ts >= CAST(:starts AS TIMESTAMP_NTZ) "
               "AND to_date(ts) <= :ends GROUP BY 1",
        a__py="raise RuntimeError('never loaded')",
        b__sql="SELECT max(to_date(ts)) AS bucket, CAST(:n AS INT) AS n FROM events WHERE to_date(ts) <= :as_of")
    found = with_files(tmp_path)
    t = {"events": events(spark)}
    a = run_report(t, "a", dt.date(2014, 7, 8), registry=found, labelled=True)
    assert a.columns == ["Day", "n", "t"] and sorted(r["Day"].day for r in a.collect()) == [3, 4, 5, 6, 7, 8]
    assert run_report(t, "b", "2014-07-08", registry=found, n=4).collect() == [(dt.date(2014, 7, 8), 4)]
    with pytest.raises(ValueError):
        run_report(t, "b", "2014-07-08")


def test_a_module_runs_in_the_tasks(spark, tmp_path):
    put(tmp_path, "[reports.sizes]\n", sizes__py='''
from pyspark.sql import functions as F
FACTOR = 3

def scaled(values):
    return values * FACTOR  # a global of the module: it travels by value

def build(tables, params):
    times = F.pandas_udf(scaled, "long")
    return tables["events"].groupBy(F.to_date("ts").alias("bucket")).agg(F.sum("user_id").alias("n")).select("bucket", times("n").alias("n"))
''')
    out = run_report({"events": events(spark)}, "sizes", "2014-07-10", registry=with_files(tmp_path))
    assert {r["bucket"].day: r["n"] for r in out.collect()} == {d: 3 * (d % 3) for d in range(1, 11)}


@pytest.mark.parametrize("config, files, error", [
    ("[reports.x]\n", {}, "neither"), ("[reports.x]\n", {"x__py": "y = 1"}, "no build"),
    ("[reports.ui-daily]\n", {}, "already"), ("[reports.x]\ncolour = 1\n", {"x__sql": "SELECT 1"}, "colour"),
    ('[reports.x]\nfrequency = "never"\n', {"x__sql": "SELECT 1"}, "never"), ("[reports.x]\n", {"x__sql": "SELECT :what FROM events"}, "what"),
    ('[reports."../x"]\n', {}, "characters")])
def test_errors_come_first(tmp_path, config, files, error):
    with pytest.raises(ValueError, match=error):
        load_reports(put(tmp_path / "r", config, **files))


def test_missing_folder_and_empty_configuration(tmp_path):
    with pytest.raises(FileNotFoundError):
        load_reports(tmp_path / "none")
    assert load_reports(put(tmp_path / "r", "")) == {}


def test_runner_refreshes_file_reports(spark, tmp_path):
    put(tmp_path / "r", '[reports.daily]\nfrequency = "hourly"\nstarts = "2014-07-01"\n[reports.daily.labels]\nbucket = "Day"\n',
        daily__sql="SELECT to_date(ts) AS bucket, count(*) AS n FROM events WHERE to_date(ts) BETWEEN :starts AND :ends GROUP BY 1")
    registry, t = load_reports(tmp_path / "r"), {"events": events(spark)}
    root, log, now = str(tmp_path / "series"), str(tmp_path / "log"), dt.datetime(2014, 7, 11)
    refresh_report(spark, t, "daily", root, "2014-07-05", registry=registry)
    paths = refresh_all(spark, t, root, "2014-07-10", cutoff="2014-07-04", registry=registry, history=log, now=now)
    got = spark.read.option("header", True).csv(paths["daily"])
    assert paths["daily"].endswith("v=2") and got.columns == ["Day", "n"] and got.count() == 10
    assert [r["due"] for r in due_now(spark, log, now, registry=registry).collect()] == [False]
    assert list(run_all(t, "2014-07-10", registry=registry)) == ["daily"]
