"""Randomised properties: each checked against plain Python."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.cohorts import rolling_active_cohort, rolling_ratio
from tidemark.operators.timebox import incremental_refresh, time_boxed

BASE = dt.datetime(2014, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

# Offsets in hours from BASE; multiples of 24 are midnight rows.
rows_st = st.lists(st.tuples(st.integers(0, 24 * 12), st.booleans()), min_size=0, max_size=40)


def _df(spark, rows):
    data = [(BASE + dt.timedelta(hours=h), flag) for h, flag in rows]
    return spark.createDataFrame(data, "ts timestamp_ntz, flag boolean")


@SETTINGS
@given(rows_st)
def test_closed_equals_half_open_plus_midnight(spark, rows):
    df = _df(spark, rows)
    start, end = dt.date(2014, 1, 2), dt.date(2014, 1, 10)
    both = {r[0]: r[1] for r in time_boxed(df, "ts", start, end, aggs={"n": F.count(F.lit(1))},
                                           closed="both", empty="zero").collect()}
    left = {r[0]: r[1] for r in time_boxed(df, "ts", start, end, aggs={"n": F.count(F.lit(1))},
                                           empty="zero").collect()}
    midnights = Counter((BASE + dt.timedelta(hours=h)).date() - dt.timedelta(days=1)
                        for h, _ in rows if h % 24 == 0)
    for d in both:
        assert both[d] == left[d] + midnights.get(d, 0)


@SETTINGS
@given(rows_st, st.integers(1, 5), st.integers(0, 12))
def test_refresh_equals_rebuild(spark, rows, keep_days, cutoff_day):
    df = _df(spark, rows)
    start, end = dt.date(2014, 1, 1), dt.date(2014, 1, 12)
    full = time_boxed(df, "ts", start, end, metrics={"hits": F.col("flag")}, aggs={"n": F.count(F.lit(1))},
                      empty="zero")
    stored = full.where(F.col("bucket") < F.lit(start + dt.timedelta(days=keep_days)))
    cutoff = start + dt.timedelta(days=cutoff_day)
    out = incremental_refresh(stored, full, cutoff, start, end)
    assert sorted(out.collect()) == sorted(full.collect())


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 24 * 12), st.booleans(), st.integers(0, 5)), max_size=40),
       st.integers(1, 4))
def test_rolling_ratio_equals_brute_force(spark, rows, n):
    data = [(BASE + dt.timedelta(hours=h), flag, float(v)) for h, flag, v in rows]
    df = spark.createDataFrame(data, "ts timestamp_ntz, flag boolean, v double")
    start, end = dt.date(2014, 1, 3), dt.date(2014, 1, 12)
    got = {r[0]: r[1] for r in rolling_ratio(df, "ts", "v", F.col("flag"), n, start, end).collect()}
    d = start
    while d <= end:
        win = [(f, v) for t, f, v in data if d - dt.timedelta(days=n) <= t.date() < d]
        num = [v for f, v in win if f]
        den = sum(v for _, v in win)
        want = (sum(num) / den) if num and den else None
        assert (got[d] is None and want is None) or abs(got[d] - want) < 1e-9, (d, got[d], want)
        d += dt.timedelta(days=1)


hours = st.integers(0, 24 * 14)
user_rows = st.lists(st.tuples(st.integers(0, 3), hours), max_size=25)


@SETTINGS
@given(user_rows, user_rows, user_rows, st.lists(st.tuples(st.integers(0, 3), hours, st.sampled_from([0, 1, None])), max_size=20),
       st.integers(1, 4), st.integers(1, 3))
def test_rolling_cohort_equals_brute_force(spark, signed, first, second, acc, n, least):
    def when(rows):
        return [(r[0] or None, BASE + dt.timedelta(hours=r[1]), *r[2:]) for r in rows]

    signed, first, second, acc = map(when, (signed, first, second, acc))
    frames = [spark.createDataFrame(r, "user int, ts timestamp_ntz") for r in (signed, first, second)]
    accounts = spark.createDataFrame(acc, "user int, ts timestamp_ntz, flag int")
    start, end = dt.date(2014, 1, 4), dt.date(2014, 1, 11)
    out = rolling_active_cohort(frames[0], frames[1:], accounts, start, end, n=n, min_edits=least)
    got = {r["bucket"]: (r["mobile"], r["desktop"]) for r in out.collect()}
    day = dt.timedelta(days=1)
    for k in range((end - start).days + 1):
        to = dt.datetime.combine(start, dt.time()) + (k + 1) * day
        new = {u for u, t in signed if u and to - n * day <= t <= to}
        edits = Counter(u for u, t in first + second if to - n * day <= t <= to)
        flags = [f for u, t, f in acc if u in new and edits[u] >= least and to - (n + 1) * day <= t <= to + day]
        want = (sum(f == 1 for f in flags), sum(f == 0 for f in flags)) if flags else (None, None)
        assert got[start + k * day] == want
    assert len(got) == (end - start).days + 1
