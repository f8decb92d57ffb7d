"""Versions found by suffix, wider types, and partition predicates of database reads."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.fixtures import AS_OF, raw_tables
from tidemark.plans.reports import run_report
from tidemark.sources import tables as sources
from tidemark.sources.discovery import VersionConflict, common_schema, find_versions, tables_in, unify_wider, version_report, wider
from tidemark.sources.logical import VERSIONS, LogicalCatalog
from tidemark.sources.tables import id_predicates, load_source, time_predicates


def test_versions_are_sorted_by_revision():
    names = ["Log_900", "Log_10000", "Log_x", "Logs_1", "Log_", "MyLog_1", "Log_12", "Log_1_2"]
    assert find_versions(names, "Log") == ["Log_12", "Log_900", "Log_10000"] and find_versions(names, "L.g") == []


def test_lattice():
    i, l, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    dec = T.DecimalType
    cases = [(i, l, l), (T.ByteType(), T.ShortType(), T.ShortType()), (i, dec(5, 2), dec(12, 2)), (l, dec(30, 4), dec(30, 4)),
             (dec(10, 5), dec(8, 1), dec(12, 5)), (l, dec(38, 20), None), (i, d, d), (l, d, None), (T.FloatType(), d, d),
             (T.FloatType(), i, None), (T.ByteType(), T.FloatType(), T.FloatType()), (s, i, None), (T.NullType(), s, s),
             (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.BooleanType(), i, None), (s, s, s)]
    for a, b, want in cases:
        assert wider(a, b) == want and wider(b, a) == want, (a, b)


def test_unify_wider(spark):
    one = spark.createDataFrame([(1, "a"), (2, None)], "n int, x string")
    two = spark.createDataFrame([(1, "a"), (2**40, "b")], "n long, x string")
    three = spark.createDataFrame([(Decimal("1.00"), 5), (Decimal("1.50"), None)], "n decimal(6,2), y int")
    out = unify_wider({"v1": one, "v2": two, "v3": three}, fill={"x": "none"})
    assert out.schema["n"].dataType == T.DecimalType(22, 2) and out.columns == ["n", "x", "y"]
    rows = sorted(((str(r["n"]), r["x"], r["y"]) for r in out.collect()), key=str)
    # 1 of the first two versions is one row; the third's has another x
    assert rows == sorted([("1.00", "a", None), ("2.00", None, None), (f"{2**40}.00", "b", None), ("1.00", "none", 5), ("1.50", "none", None)], key=str)
    assert unify_wider({"v1": one, "v2": two}, dedup=False).count() == 4
    assert unify_wider({"v1": one}, columns=["x", "z"]).orderBy("x").collect() == [(None, None), ("a", None)]
    with pytest.raises(ValueError):
        unify_wider({})


def test_conflicts_name_every_column_and_version():
    schemas = {"v1": T.StructType.fromDDL("a int, b string, c long"), "v2": T.StructType.fromDDL("a string, b string, c double")}
    with pytest.raises(VersionConflict) as e:
        common_schema(schemas)
    assert e.value.conflicts == {"a": {"v1": "int", "v2": "string"}, "c": {"v1": "bigint", "v2": "double"}}
    assert "a: int in v1, string in v2" in str(e.value)
    assert common_schema(schemas, ["b", "gone"]) == {"b": T.StringType(), "gone": T.NullType()}
    report = version_report({**schemas, "v3": T.StructType.fromDDL("b string")})
    assert ("a", "v1", "int", None) in report and ("b", "v3", "string", "string") in report and ("c", "v3", None, None) in report


@pytest.mark.parametrize("suffix", ["", "/{table}", "/log-{table}.parquet"])
def test_catalogue_discovers_versions(spark, tmp_path, suffix):
    raw = raw_tables(spark)
    for name, df in raw.items():
        path = f"{tmp_path}{suffix}".format(table=name) if "{table}" in suffix else f"{tmp_path}/{name}"
        df.write.parquet(path)
    conf = {"sources": {s: {"path": f"{tmp_path}{suffix}"} for s in ("el", "commons", "enwiki")}}
    assert set(tables_in(spark, conf, "el")) == set(raw)
    found, fixed = LogicalCatalog(spark, {**conf, "discover": True}), LogicalCatalog(spark, conf)
    assert found.versions("edits_web") == VERSIONS["edits_web"]
    for name in ("successful-edits-main", "successful-uploads"):
        assert sorted(run_report(found, name, AS_OF).collect()) == sorted(run_report(fixed, name, AS_OF).collect())
    if not suffix:  # a version that no list has
        raw["MobileWebEditing_8599025"].withColumn("event_namespace", F.col("event_namespace").cast("decimal(9,1)")).withColumn(
            "timestamp", F.lit("20140710120000")).write.parquet(f"{tmp_path}/MobileWebEditing_9999999")
        more = LogicalCatalog(spark, {**conf, "discover": True})
        assert more.versions("edits_web")[-1] == "MobileWebEditing_9999999"
        assert more["edits_web"].count() > fixed["edits_web"].count()
    with pytest.raises(ValueError):
        tables_in(spark, conf, "nowhere")


def test_catalogue_database_as_a_source(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS versions_db")
    try:
        spark.range(3).write.mode("overwrite").saveAsTable("versions_db.Log_7")
        conf = {"sources": {"db": {"format": "catalog", "database": "versions_db"}}}
        assert [n.lower() for n in tables_in(spark, conf, "db")] == ["log_7"]
        assert load_source(spark, conf, "db", "Log_7").count() == 3
    finally:
        spark.sql("DROP DATABASE versions_db CASCADE")


def test_temporary_views_are_no_tables_of_a_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS views_db")
    spark.range(1).createOrReplaceTempView("Log_8")
    try:
        assert tables_in(spark, {"sources": {"db": {"format": "catalog", "database": "views_db"}}}, "db") == []
    finally:
        spark.catalog.dropTempView("Log_8")
        spark.sql("DROP DATABASE views_db CASCADE")


def test_time_predicates_cut_a_range_once(spark):
    stamps = ["20140630235959", "20140701000000", "20140702120000", "20140703235959", "20140704000000", "20140705000000", None, "bad"]
    df = spark.createDataFrame([(s,) for s in stamps], "timestamp string")
    for days, parts in ((1, 4), (2, 2), (3, 2), (99, 1)):
        cuts = time_predicates("timestamp", "2014-07-01", "2014-07-04", days)
        assert len(cuts) == parts
        met = [sum(df.where(c).where(F.col("timestamp").eqNullSafe(s)).count() for c in cuts) for s in stamps]
        assert met == [0, 1, 1, 1, 1, 0, 0, 0]
    assert time_predicates("ts", dt.date(2014, 7, 1), dt.date(2014, 7, 1), text14=False) == [
        "ts >= TIMESTAMP '2014-07-01 00:00:00' AND ts < TIMESTAMP '2014-07-02 00:00:00'"]
    assert time_predicates("ts", "2014-07-02", "2014-07-01") == []
    with pytest.raises(ValueError):
        time_predicates("ts", "2014-07-01", "2014-07-01", 0)


def test_id_predicates_meet_every_row_once(spark):
    df = spark.createDataFrame([(i,) for i in [None, -50, *range(0, 40), 1000]], "id long")
    for first, last, parts, want in ((0, 39, 4, 4), (0, 2, 10, 3), (5, 5, 3, 1), (0, 39, 1, 1)):
        cuts = id_predicates("id", first, last, parts)
        assert len(cuts) == want
        total = sum(df.where(c).count() for c in cuts)
        assert total == df.count() and all(df.where(c).count() < df.count() for c in cuts if want > 1)
    with pytest.raises(ValueError):
        id_predicates("id", 3, 2, 1)


def test_database_reads_are_partitioned(spark, monkeypatch):
    """No database is started: what reaches Spark's reader is looked at."""
    asked = []

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            asked.append((url, table, predicates, properties))
            return spark.createDataFrame([], "timestamp string, wiki string, userAgent string, event_action string")

    class Session:
        read = Reader()

    conf = {"sources": {"el": {"format": "jdbc", "url": "jdbc:x", "options": {"user": "u", "fetchsize": 1000}}}, "jdbc_days": 7}
    real = sources.load_source
    monkeypatch.setattr(sources, "load_source", lambda s, *a, **k: real(Session(), *a, **k))
    LogicalCatalog(spark, conf, days=("2014-07-01", "2014-07-30"))["edits_app"]
    (url, table, predicates, properties), = asked
    assert (url, table, properties) == ("jdbc:x", "MobileWikiAppEdit_9003125", {"user": "u", "fetchsize": "1000"})
    assert len(predicates) == 5 and predicates[0] == "timestamp >= '20140701000000' AND timestamp < '20140708000000'"
    with pytest.raises(ValueError):
        tables_in(spark, conf, "el")
