"""One key holding a third of all rows: results stay exact (brute force)."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from tidemark.operators.cohorts import cohort_event_count, rolling_active_cohort
from tidemark.operators.matching import enrich_counts, match_keys

BASE = dt.datetime(2014, 1, 1)


def _rows(n=3000, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        user = 7 if i % 3 == 0 else rng.randrange(1, 60)  # user 7 holds a third
        out.append((user, BASE + dt.timedelta(hours=rng.randrange(0, 24 * 20))))
    return out


def test_hot_key_match_and_cohort_count(spark):
    rows = _rows()
    log = spark.createDataFrame(rows, "user bigint, ts timestamp_ntz")
    keys = spark.createDataFrame([("a", 7), ("a", 7), ("b", 7), ("b", 3)], "tag string, key bigint")
    got = {(r["bucket"], r["tag"]): r["n"] for r in match_keys(log, keys, "user", ts="ts").collect()}
    want = Counter()
    for u, t in rows:
        for tag, ks in (("a", {7}), ("b", {7, 3})):
            if u in ks:
                want[(t.date(), tag)] += 1
    assert got == dict(want)
    cohort = spark.createDataFrame([(7,), (7,), (3,)], "k bigint")
    got2 = {r["bucket"]: r["n"] for r in cohort_event_count(log, cohort, "user", "k", "ts").collect()}
    mult = {7: 2, 3: 1}
    want2 = Counter()
    for u, t in rows:
        want2[t.date()] += mult.get(u, 0)
    assert got2 == {d: c for d, c in want2.items() if c}


def test_hot_key_lookup_and_rolling_cohort(spark):
    rows = _rows()
    df = (spark.createDataFrame(rows, "user bigint, ts timestamp_ntz")
          .groupBy("user").agg(F.count(F.lit(1)).alias("n")))
    look = spark.createDataFrame([(7, 100), (7, 5)], "user bigint, v bigint")
    got = {r["user"]: (r["n"], r["v"]) for r in enrich_counts(df, "user", look, "user", "v").collect()}
    assert got[7] == (sum(1 for u, _ in rows if u == 7), 100) and all(v == 0 for k, (_, v) in got.items() if k != 7)

    s = "user bigint, ts timestamp_ntz"
    signups = spark.createDataFrame([(7, BASE), (3, BASE)], s)
    edits = spark.createDataFrame(rows, s)
    acc = spark.createDataFrame([(7, BASE, 1)] * 50 + [(3, BASE, 0)], "user bigint, ts timestamp_ntz, flag int")
    out = {r[0]: (r[1], r[2]) for r in rolling_active_cohort(signups, [edits], acc, "2014-01-01", "2014-01-10",
                                                             n=30, min_edits=5).collect()}
    for d, (mob, desk) in out.items():
        to = dt.datetime.combine(d, dt.time()) + dt.timedelta(days=1)
        active = {u for u in (7, 3) if sum(1 for x, t in rows if x == u and to - dt.timedelta(days=30) <= t <= to) >= 5}
        want_m = 50 if 7 in active else 0
        want_d = 1 if 3 in active else 0
        assert (mob, desk) == ((want_m, want_d) if active else (None, None)), d
