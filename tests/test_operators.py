"""Operator-level tests: edge rows and properties."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.arith import count_when, row_total, safe_ratio, two_decimal
from tidemark.functions.text import classify_prefix, normalise_title, normalise_user
from tidemark.functions.time import format_ts14, parse_ts
from tidemark.operators.buckets import (
    bucket_distinct,
    bucket_pivot,
    date_spine,
    dense_pivot,
    funnel_counts,
    latest_buckets,
)
from tidemark.operators.cohorts import cohort_event_count, rolling_active_cohort, rolling_ratio, threshold_groups
from tidemark.operators.matching import enrich_counts, match_keys, retention_summary, source_reconciliation
from tidemark.operators.series import describe_series, read_series, write_series
from tidemark.operators.timebox import (
    due_reports,
    has_drift,
    incremental_refresh,
    record_runs,
    refresh_with_drift,
    schema_drift,
    time_boxed,
)
from tidemark.session import shared_dir
from tidemark.sources.tables import load_source
from tidemark.sources.versions import unify_versions

D = dt.date
T = dt.datetime


def ev(spark, rows, schema="ts timestamp_ntz, user bigint, kind string"):
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------ functions ---

def test_parse_ts_round_trip_and_bad_text(spark):
    df = spark.createDataFrame([("20140625123045",), ("2014x6",), (None,), ("20141399000000",)], "s string")
    out = [r[0] for r in df.select(parse_ts("s")).collect()]
    assert out == [T(2014, 6, 25, 12, 30, 45), None, None, None]
    back = df.select(format_ts14(parse_ts("s"))).first()[0]
    assert back == "20140625123045"


def test_normalise_title_order_and_edges(spark):
    df = spark.createDataFrame([("file:a b",), ("File:A b",), ("a",), ("",), (None,), ("été x",)], "t string")
    assert [r[0] for r in df.select(normalise_title("t")).collect()] == ["a_b", "A_b", "A", None, None, "Été_x"]


def test_normalise_user(spark):
    df = spark.createDataFrame([("  alice ",), ("Bob",), ("   ",), ("ünal",)], "u string")
    assert [r[0] for r in df.select(normalise_user("u")).collect()] == ["Alice", "Bob", None, "Ünal"]


def test_classify_prefix_and_arith(spark):
    df = spark.createDataFrame([("Android 4", 1, None), ("iOS 7", None, None), ("web", 2, 3)],
                               "p string, a int, b int")
    cls = classify_prefix("p", {"Android": "Android", "iOS": "iOS"}, default="other")
    rows = df.select(cls, row_total(["a", "b"]), safe_ratio("a", "b"), two_decimal(F.lit(0.125)),
                     two_decimal(F.lit(0.615)), two_decimal(F.lit(None).cast("double"))).collect()
    assert [r[0] for r in rows] == ["Android", "iOS", "other"]
    assert [r[1] for r in rows] == [1, 0, 5]
    assert rows[2][2] == pytest.approx(2 / 3) and rows[0][2] is None
    assert (rows[0][3], rows[0][4], rows[0][5]) == ("%.2f" % 0.125, "%.2f" % 0.615, None) == ("0.12", "0.61", None)


def test_count_when_null_predicate_counts_zero(spark):
    df = spark.createDataFrame([(None,), ("x",)], "v string")
    assert df.agg(count_when(F.col("v") == "x")).first()[0] == 1


# -------------------------------------------------------------- buckets ---

def test_spines(spark):
    days = [r[0] for r in date_spine(spark, "2014-03-01", 30).collect()]
    assert len(days) == 30 and days[0] == D(2014, 1, 31) and days[-1] == D(2014, 3, 1)
    months = [r[0] for r in date_spine(spark, "2014-01-31", 12, "month", order="desc").collect()]
    assert months[0] == D(2014, 1, 1) and months[-1] == D(2013, 2, 1) and len(months) == 12


def test_dense_has_n_rows_and_sums_match(spark):
    rows = [(T(2014, 1, d, h), d % 3, "a" if h % 2 else "b") for d in range(1, 29, 2) for h in range(0, 24, 5)]
    df = ev(spark, rows)
    out = dense_pivot(df, "ts", "day", "2014-01-30", 30, {"a": F.col("kind") == "a"}, total="n")
    got = out.collect()
    assert len(got) == 30
    assert sum(r["n"] for r in got) == len(rows)
    assert sum(1 for r in got if r["n"] == 0) == 16


def test_distinct_ignores_null_keys(spark):
    df = ev(spark, [(T(2014, 1, 1, 1), 1, "a"), (T(2014, 1, 1, 2), 1, "a"), (T(2014, 1, 1, 3), None, "a"),
                    (T(2014, 1, 1, 4), 2, "b")])
    r = bucket_distinct(df, "ts", "day", "user", {"a": F.col("kind") == "a", "all": F.lit(True)}).first()
    assert (r["a"], r["all"]) == (1, 2)


def test_latest_and_funnel(spark):
    df = ev(spark, [(T(2014, m, 1, 5), 1, k) for m in range(1, 13) for k in ("start", "saved", "x")])
    last = [r["bucket"] for r in latest_buckets(bucket_pivot(df, "ts", "month", {}, total="n"), 3).collect()]
    assert last == [D(2014, 12, 1), D(2014, 11, 1), D(2014, 10, 1)]
    f = funnel_counts(df, "ts", "kind", ["start", "preview", "saved"]).collect()
    assert all((r["start"], r["preview"], r["saved"]) == (1, 0, 1) for r in f) and len(f) == 12


# -------------------------------------------------------------- timebox ---

def test_closed_both_equals_left_plus_midnight_rows(spark):
    rows = [(T(2014, 1, 2), 1, "a"), (T(2014, 1, 2, 5), 1, "a"), (T(2014, 1, 4), 1, "b"), (T(2014, 1, 1), 2, "a")]
    df = ev(spark, rows)
    left = {r[0]: r[1] for r in time_boxed(df, "ts", "2014-01-01", "2014-01-04",
                                           aggs={"n": F.count(F.lit(1))}, empty="zero").collect()}
    both = {r[0]: r[1] for r in time_boxed(df, "ts", "2014-01-01", "2014-01-04",
                                           aggs={"n": F.count(F.lit(1))}, closed="both", empty="null").collect()}
    assert left == {D(2014, 1, 1): 1, D(2014, 1, 2): 2, D(2014, 1, 3): 0, D(2014, 1, 4): 1}
    # midnight rows also count in the bucket they end
    assert both == {D(2014, 1, 1): 2, D(2014, 1, 2): 2, D(2014, 1, 3): 1, D(2014, 1, 4): 1}


def test_empty_policies(spark):
    df = ev(spark, [(T(2014, 1, 1, 3), 1, "a")])
    m = {"a": F.col("kind") == "a"}
    get = lambda e: {r[0]: r[1] for r in time_boxed(df, "ts", "2014-01-01", "2014-01-02", metrics=m,
                                                     empty=e).collect()}
    assert get("zero") == {D(2014, 1, 1): 1, D(2014, 1, 2): 0}
    assert get("null") == {D(2014, 1, 1): 1, D(2014, 1, 2): None}
    assert get("omit") == {D(2014, 1, 1): 1}


def _series(spark, rows):
    return spark.createDataFrame(rows, "bucket date, a bigint, b bigint")


def test_incremental_refresh_rules(spark):
    stored = _series(spark, [(D(2013, 12, 1), 5, 5), (D(2014, 1, 1), 1, 1), (D(2014, 1, 2), None, None),
                             (D(2014, 1, 3), 9, 9), (D(2014, 1, 4), 7, 7)])
    fresh = _series(spark, [(D(2014, 1, d), 10 * d, d) for d in range(1, 6)])
    out = {r[0]: r[1] for r in incremental_refresh(stored, fresh, "2014-01-04", "2014-01-01", "2014-01-05").collect()}
    # outside range kept; all-NULL recomputed; closed before cutoff kept;
    # a bucket ending on the cutoff is recomputed
    assert out == {D(2013, 12, 1): 5, D(2014, 1, 1): 1, D(2014, 1, 2): 20, D(2014, 1, 3): 30,
                   D(2014, 1, 4): 40, D(2014, 1, 5): 50}


def test_refresh_equals_rebuild_when_inputs_agree(spark):
    fresh = _series(spark, [(D(2014, 1, d), d, 2 * d) for d in range(1, 20)])
    out = incremental_refresh(fresh.where("bucket < '2014-01-10'"), fresh, "2014-01-15", "2014-01-01", "2014-01-19")
    assert sorted(out.collect()) == sorted(fresh.collect())


def test_drift(spark):
    a = _series(spark, [(D(2014, 1, 1), 1, 1)])
    b = a.drop("b")
    assert not has_drift(a, a) and has_drift(b, a)
    assert ("b", None, "bigint", "added") in schema_drift(b, a)
    assert refresh_with_drift(b, a, "2014-02-01").columns == a.columns


def test_due_reports_and_history(spark):
    reg = spark.createDataFrame([("a", "hourly"), ("b", "daily"), ("c", "hourly"), ("d", "weird")],
                                "report string, frequency string")
    now = T(2014, 7, 1, 12)
    hist = spark.createDataFrame([("a", T(2014, 7, 1, 11, 30)), ("b", T(2014, 6, 30, 13))],
                                 "report string, last_run timestamp")
    due = {r["report"]: r["due"] for r in due_reports(reg, hist, now).collect()}
    assert due == {"a": False, "b": False, "c": True, "d": True}
    assert all(r["due"] for r in due_reports(reg, hist, now, force=True).collect())
    h2 = record_runs(hist, spark.createDataFrame([("c",)], "report string"), now)
    assert {r["report"] for r in h2.collect()} == {"a", "b", "c"}


# -------------------------------------------------------------- cohorts ---

def test_rolling_ratio_windows_and_nulls(spark):
    df = spark.createDataFrame([(T(2014, 1, 1, 5), 2.0, True), (T(2014, 1, 2, 5), 2.0, False),
                                (T(2014, 1, 5, 5), 0.0, False)], "ts timestamp_ntz, v double, hit boolean")
    out = {r[0]: r[1] for r in rolling_ratio(df, "ts", "v", F.col("hit"), 2, "2014-01-01", "2014-01-07").collect()}
    assert out[D(2014, 1, 1)] is None
    assert out[D(2014, 1, 2)] == 1.0 and out[D(2014, 1, 3)] == 0.5
    assert out[D(2014, 1, 4)] is None        # numerator has no rows -> NULL
    assert out[D(2014, 1, 6)] is None        # zero denominator -> NULL


def test_threshold_groups_4_5_6(spark):
    rows = [(u, m) for u, n, m in [(1, 4, 1), (2, 5, 1), (3, 6, 0), (4, 6, 1)] for _ in range(n)]
    df = spark.createDataFrame(rows, "u bigint, m int")
    split = {"mob": F.col("m") == 1, "desk": F.col("m") == 0}
    gt = threshold_groups(df, ["u", "m"], split, min_exclusive=5).first()
    ge = threshold_groups(df, ["u", "m"], split, min_inclusive=5).first()
    assert (gt["mob"], gt["desk"]) == (1, 1) and (ge["mob"], ge["desk"]) == (2, 1)
    none = threshold_groups(df, ["u", "m"], split, min_exclusive=50).first()
    assert (none["mob"], none["desk"]) == (None, None)


def test_rolling_active_cohort_revision_archive_split(spark):
    s = "user bigint, ts timestamp_ntz"
    signups = spark.createDataFrame([(1, T(2014, 1, 1, 10)), (2, T(2014, 1, 1, 10))], s)
    revs = spark.createDataFrame([(1, T(2014, 1, 2, h)) for h in range(3)] + [(2, T(2014, 1, 2, 1))], s)
    arch = spark.createDataFrame([(1, T(2014, 1, 3, h)) for h in range(2)] + [(2, T(2014, 1, 3, 1))], s)
    acc = spark.createDataFrame([(1, T(2014, 1, 1, 9), 1), (1, T(2014, 1, 1, 9), 0), (2, T(2014, 1, 1, 9), 1)],
                                "user bigint, ts timestamp_ntz, flag int")
    out = {r[0]: (r[1], r[2]) for r in rolling_active_cohort(signups, [revs, arch], acc, "2014-01-01",
                                                             "2014-01-05", n=30, min_edits=5).collect()}
    assert out[D(2014, 1, 1)] == (None, None)          # edits not yet made
    assert out[D(2014, 1, 3)] == (1, 1)                 # 3 + 2 edits, repeated account row fans out
    assert out[D(2014, 1, 5)] == (1, 1)


def test_cohort_count_fans_out(spark):
    ev_ = spark.createDataFrame([(1, T(2014, 1, 1, 1)), (1, T(2014, 1, 1, 2)), (2, T(2014, 1, 1, 3))],
                                "k bigint, ts timestamp_ntz")
    cohort = spark.createDataFrame([(1,), (1,), (3,)], "k bigint")
    assert cohort_event_count(ev_, cohort, "k", "k", "ts").first()["n"] == 4


# ------------------------------------------------------------- matching ---

def test_match_is_semi_join(spark):
    log = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), (None, 4)], "t string, id int")
    keys = spark.createDataFrame([("x", "A"), ("x", "A"), ("y", "A"), ("y", "B"), ("x", None)], "tag string, key string")
    got = {r["tag"]: r["n"] for r in match_keys(log, keys, "t").collect()}
    assert got == {"x": 2, "y": 3}


def test_enrich_and_retention_and_reconciliation(spark):
    df = spark.createDataFrame([("a", 3), ("z", 1)], "k string, n bigint")
    look = spark.createDataFrame([("a", 7)], "k string, v bigint")
    assert {r["k"]: r["v"] for r in enrich_counts(df, "k", look, "k", "v").collect()} == {"a": 7, "z": 0}
    tot = spark.createDataFrame([("x", 5), ("y", 3)], "source string, total bigint")
    ret = spark.createDataFrame([("x", 4)], "source string, undeleted bigint")
    cor = spark.createDataFrame([("y", 3)], "source string, correction bigint")
    r = {x["source"]: x for x in retention_summary(tot, ret, cor, as_text=True).collect()}
    assert r["x"]["deleted_fraction"] == pytest.approx(0.2) and r["x"]["deletion_percentage"] == "0.20"
    assert r["y"]["total"] == 0 and r["y"]["deleted_fraction"] is None  # zero denominator
    claimed = spark.createDataFrame([("p", "A"), ("p", "A"), ("q", "B")], "source string, key string")
    log = spark.createDataFrame([("A",), ("C",)], "t string")
    rec = {x["label"]: (x["p"], x["q"]) for x in source_reconciliation(claimed, log, ["p", "q"], "t").collect()}
    assert rec == {"claimed": (2, 1), "found": (1, 0), "difference": (1, 1)}


# -------------------------------------------------------------- sources ---

def test_unify_versions_fill_and_distinct(spark):
    v1 = spark.createDataFrame([("t1", "a"), ("t1", "a")], "timestamp string, x string")
    v2 = spark.createDataFrame([("t1", "a", 0), ("t2", "b", 1)], "timestamp string, x string, m int")
    assert unify_versions([v1, v2], columns=["timestamp", "x", "m"], fill={"m": 0}).count() == 2
    assert unify_versions([v1, v2], columns=["timestamp", "x", "m"], fill={"m": 0}, dedup=False).count() == 4


def test_load_source(spark, tmp_path):
    with pytest.raises(ValueError):
        load_source(spark, {"sources": {}}, "nope")
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert load_source(spark, {"sources": {"el": {"path": str(tmp_path)}}}, "el", "t").count() == 3


# --------------------------------------------------------------- series ---

def test_write_read_describe(spark):
    s = _series(spark, [(D(2014, 1, 2), 1, 2), (D(2014, 1, 1), 3, None)])
    path = shared_dir(spark, "test-series")
    write_series(s, path + "/x")
    back = read_series(spark, path + "/x", "bucket date, a bigint, b bigint")
    assert sorted(back.collect()) == sorted(s.collect())
    with pytest.raises(ValueError):
        write_series(back, path + "/x")  # never overwrite what is being read
    desc = describe_series(s, "r", {"bucket": "Day"})
    assert desc[0] == ("r", 0, "bucket", "date", "Day") and desc[1][3] == "int"


def test_empty_range_gives_empty_series(spark):
    df = ev(spark, [(T(2014, 1, 1, 3), 1, "a")])
    out = time_boxed(df, "ts", "2014-02-01", "2014-01-01", aggs={"n": F.count(F.lit(1))}, empty="zero")
    assert out.count() == 0


def test_approx_distinct_close_to_exact(spark):
    rows = [(T(2014, 1, 1 + (i % 3), 1), i % 500, "a") for i in range(3000)]
    df = ev(spark, rows)
    exact = {r[0]: r[1] for r in bucket_distinct(df, "ts", "day", "user", {"u": F.lit(True)}).collect()}
    approx = {r[0]: r[1] for r in bucket_distinct(df, "ts", "day", "user", {"u": F.lit(True)}, approx=True).collect()}
    assert set(exact) == set(approx)
    assert all(abs(approx[d] - exact[d]) <= 0.05 * exact[d] for d in exact)


def test_pivot_tags_long_to_wide(spark):
    from tidemark.operators.matching import match_keys_wide, pivot_tags
    log = spark.createDataFrame([("A", T(2014, 1, 1, 1)), ("A", T(2014, 1, 2, 1)), ("B", T(2014, 1, 2, 2))],
                                "t string, ts timestamp_ntz")
    keys = spark.createDataFrame([("x", "A"), ("y", "B"), ("y", "A")], "tag string, key string")
    long = match_keys(log, keys, "t", ts="ts")
    wide = {r[0]: (r[1], r[2]) for r in pivot_tags(long, ["x", "y"]).collect()}
    assert wide == {D(2014, 1, 1): (1, 1), D(2014, 1, 2): (1, 2)}
    direct = {r[0]: (r[1], r[2]) for r in match_keys_wide(log, keys, "t", ["x", "y"], ts="ts").collect()}
    assert direct == wide


def test_parse_ts_edge_fields(spark):
    df = spark.createDataFrame([("20140230120000",), ("20140101246000",), ("20140101235960",),
                                ("20140309023000",), ("2014010112000",)], "s string")
    out = [r[0] for r in df.select(parse_ts("s")).collect()]
    # 30 Feb, hour 24, second 60 and 13 digits are invalid; 02:30 on a
    # daylight-saving day exists as a wall-clock value.
    assert out == [None, None, None, T(2014, 3, 9, 2, 30), None]
