"""Day bitmaps of distinct users, merged into months and trailing windows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.time import with_parsed_ts
from tidemark.operators.changes import near_days
from tidemark.operators.users import DistinctSeries, dense_numbers, trailing_counts

D = dt.date
METRICS = {"a": lambda: F.col("k") == "a", "b": lambda: F.col("k") == "b"}


def series(spark, root, **kw):
    return DistinctSeries(spark, str(root), "user", {m: f() for m, f in METRICS.items()}, **kw)


def events(seed, n=400):
    rnd = random.Random(seed)
    return [(dt.datetime(2014, 1, 20) + dt.timedelta(hours=rnd.randrange(24 * 30)), rnd.choice([None, *"uvwxyz", *map(str, range(20))]),
             rnd.choice(["a", "b", "c", None])) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, user string, k string")


def brute(rows, lo, hi):
    return tuple(len({u for t, u, k in rows if u and k == m and lo <= t.date() <= hi}) for m in METRICS)


ALL = [D(2014, 1, 20) + dt.timedelta(days=k) for k in range(30)]


def test_days_months_and_windows_equal_brute_force(spark, tmp_path):
    rows = events(1)
    s = series(spark, tmp_path)
    s.refresh(frame(spark, rows), ALL)
    assert s.computed_days() == ALL
    days = {r["bucket"]: (r["a"], r["b"]) for r in s.counts().collect()}
    assert days == {d: brute(rows, d, d) for d in ALL}
    months = {r["bucket"]: (r["a"], r["b"]) for r in s.counts("month").collect()}
    assert months == {D(2014, 1, 1): brute(rows, D(2014, 1, 1), D(2014, 1, 31)), D(2014, 2, 1): brute(rows, D(2014, 2, 1), D(2014, 2, 28))}
    assert [r["bucket"] for r in s.counts("month", D(2014, 2, 1), D(2014, 2, 1)).collect()] == [D(2014, 2, 1)]
    for n in (1, 2, 5, 7, 40):
        # windows that reach before the first stored day and past the last one too
        start, end = D(2014, 1, 15), D(2014, 2, 25)
        got = {r["bucket"]: (r["a"], r["b"]) for r in s.trailing(n, start, end).collect()}
        want = {start + dt.timedelta(days=k): brute(rows, start + dt.timedelta(days=k - n + 1), start + dt.timedelta(days=k)) for k in range(42)}
        assert got == want, n
    assert s.trailing(3, D(2014, 2, 2), D(2014, 2, 1)).count() == 0
    with pytest.raises(ValueError):
        trailing_counts(s.bitmaps(), ["a"], 0, D(2014, 1, 1), D(2014, 1, 2))


def test_refresh_replaces_days_and_keeps_numbers(spark, tmp_path):
    old, new = events(2), events(3)
    s = series(spark, tmp_path)
    s.refresh(frame(spark, old), ALL[:20])
    numbers = {r["user"]: r["number"] for r in s.numbers().collect()}
    assert sorted(numbers.values()) == list(range(1, len(numbers) + 1))
    # the days from the 10th on have other rows now, the 12th none, and there are new users
    gone = ALL[12]
    now = [r for r in old if r[0].date() < ALL[10]] + [r for r in new if r[0].date() >= ALL[10] and r[0].date() != gone]
    now += [(dt.datetime.combine(ALL[25], dt.time(5)), f"late{i}", "a") for i in range(9)]
    s.refresh(frame(spark, now), ALL[10:])
    again = {r["user"]: r["number"] for r in s.numbers().collect()}
    assert {u: again[u] for u in numbers} == numbers and sorted(again.values()) == list(range(1, len(again) + 1))
    assert {r["bucket"]: (r["a"], r["b"]) for r in s.counts().collect()} == {d: brute(now, d, d) for d in ALL}
    s.refresh(frame(spark, now), [])
    # a run of numbers that was lost is not read
    lost = tmp_path / "users" / "run-99999999999999999999-lost"
    lost.mkdir()
    (lost / "part-0.parquet").write_bytes(b"torn")
    assert s.numbers().count() == len(again)


def test_many_users_take_several_parts(spark, tmp_path):
    day = "timestamp_ntz'2014-01-0{} 12:00:00'"
    df = spark.range(100_000).select(
        F.expr(f"if(id % 3 = 0, {day.format(1)}, {day.format(2)})").alias("ts"), F.col("id").cast("string").alias("user"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("k")).unionAll(
        spark.range(50_000).select(F.expr(day.format(2)).alias("ts"), F.col("id").cast("string").alias("user"), F.lit("a").alias("k")))
    s = series(spark, tmp_path)
    s.refresh(df, [D(2014, 1, 1), D(2014, 1, 2)])
    assert s.bitmaps().where("part > 0").select("part").distinct().count() == 4
    want = df.groupBy(F.to_date("ts").alias("bucket")).agg(*[F.count_distinct(F.when(f(), F.col("user"))).alias(m) for m, f in METRICS.items()])
    assert sorted(s.counts().collect()) == sorted(want.collect())
    month = s.counts("month").first()
    assert (month["a"], month["b"]) == df.agg(*[F.count_distinct(F.when(f(), F.col("user"))) for f in METRICS.values()]).first()


def test_counts_read_no_event_and_prune_days(spark, tmp_path):
    s = series(spark, tmp_path)
    s.refresh(frame(spark, events(4)), ALL)
    df = s.counts("month", D(2014, 2, 1), D(2014, 2, 1))
    assert all("/days/" in f for f in df.inputFiles())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "2014-02-01" in plan


def test_numbers_are_dense_over_tasks(spark):
    out = dense_numbers(spark.range(0, 1000, 1, 7).where("id % 7 != 3").select(F.col("id").cast("string").alias("user")), 11)
    got = sorted(r["number"] for r in out.collect())
    assert got == list(range(11, 11 + len(got)))
    assert dense_numbers(spark.range(0), 1).count() == 0


def test_a_refresh_reads_the_events_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(row):
        read.add(1)
        return row

    rows = events(5, 200)
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(seen), "ts timestamp_ntz, user string, k string")
    s = series(spark, tmp_path, where=F.col("k").isNotNull())
    s.refresh(df, ALL)
    assert read.value == len(rows)
    assert {r["bucket"]: (r["a"], r["b"]) for r in s.counts().collect()} == {d: brute(rows, d, d) for d in ALL}


def test_text_times_are_not_parsed_for_the_bounds(spark, tmp_path):
    rows = events(6)
    # texts within the range that are no time, and times just outside of it; only `in` and its days count
    odd = [("2014012x000000", "bad"), ("20140132000000", "bad"), ("20140121000060", "bad"), ("201401210000001", "bad"), ("", "bad"), (None, "bad"),
           ("20140119235959", "out"), ("20140219000000", "out"), ("20140120000000", "in"), ("20140218235959", "in")]
    texts = [(t.strftime("%Y%m%d%H%M%S"), u, k) for t, u, k in rows] + [(t, u, "a") for t, u in odd]
    df = with_parsed_ts(spark.createDataFrame(texts, "timestamp string, user string, k string"), "timestamp")
    near, parsed = near_days(df, "ts", ALL)
    plan = near.select("user")._jdf.queryExecution().optimizedPlan().toString()
    assert not parsed and "20140120000000" in plan and "make_timestamp" not in plan
    s = series(spark, tmp_path)
    s.refresh(df, ALL)
    now = rows + [(dt.datetime(2014, 1, 20), "in", "a"), (dt.datetime(2014, 2, 18, 23, 59, 59), "in", "a")]
    assert {r["bucket"]: (r["a"], r["b"]) for r in s.counts().collect()} == {d: brute(now, d, d) for d in ALL}
    assert {r["user"] for r in s.numbers().collect()} == {u for _, u, _ in now if u}
    # runs of days that do not touch, and a table by day: its partitions are read
    near, _ = near_days(df, "ts", [ALL[0], ALL[29]])
    assert {r["timestamp"][:8] for r in near.where("ts IS NOT NULL").collect()} == {"20140120", "20140218"}
    by_day = with_parsed_ts(df.drop("ts").withColumn("day", F.lit("2014-01-20")), "timestamp", day_partition="day")
    near, parsed = near_days(by_day, "ts", ALL[:1])
    assert parsed and near.count() == len(texts) and near_days(df, "ts", [])[0].count() == 0
