"""Queries for rolling ratios, rolling cohorts, thresholds and cohort counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.buckets import BUCKET
from ..operators.cohorts import (
    cohort_event_count,
    rolling_active_cohort,
    rolling_ratio,
    threshold_groups,
)
from .catalog import register, table
from .q_buckets import EVENT_TYPES, STATUSES

RATIO_DAYS = 7
COHORT_N = 3
COHORT_MIN = 3
COHORT_FIRST, COHORT_LAST = "2024-01-01", "2024-01-30"  # window ends 01-02 .. 01-31


@register("rolling_ratio", covers="rolling_ratio R-24 A-10 W-03 J-N12 F-11", oracle=f"""
WITH spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) t(d))
SELECT s.bucket, ROUND(
  (SELECT SUM(value) FROM events e WHERE e.event_type = 'error'
     AND CAST(e.ts AS DATE) < s.bucket AND CAST(e.ts AS DATE) >= s.bucket - {RATIO_DAYS})
  / NULLIF((SELECT SUM(value) FROM events e
     WHERE CAST(e.ts AS DATE) < s.bucket AND CAST(e.ts AS DATE) >= s.bucket - {RATIO_DAYS}), 0), 6) AS ratio
FROM spine s
""")
def rolling_ratio_query(spark, sf_dir):
    """Share of event value coming from errors over the 7 whole days before
    each day of the month (NULL while the window is empty)."""
    out = rolling_ratio(table(spark, sf_dir, "events"), "ts", "value", F.col("event_type") == "error",
                        RATIO_DAYS, "2024-01-01", "2024-01-30")
    return out.select(BUCKET, F.round("ratio", 6).alias("ratio"))


def _account_flag():
    v = F.col("value")
    return F.when(v > 50, 1).when(v > 40, None).otherwise(0)


@register("rolling_active_cohort", covers="rolling_active_cohort R-28 A-11 F-09 F-10 F-15 F-16 U-02 J-N5 J-N8",
          oracle=f"""
WITH ends AS (
  SELECT CAST(d AS TIMESTAMP) AS t, CAST(d AS DATE) - 1 AS bucket
  FROM generate_series(DATE '2024-01-02', DATE '2024-01-31', INTERVAL 1 DAY) g(d)),
u AS (
  SELECT DISTINCT e.bucket, s.user_id FROM ends e JOIN events s
    ON s.event_type = 'signup' AND s.ts BETWEEN e.t - INTERVAL {COHORT_N} DAY AND e.t),
per_table AS (
  SELECT e.bucket, x.user_id, COUNT(*) AS c FROM ends e JOIN events x
    ON x.event_type = 'click' AND x.ts BETWEEN e.t - INTERVAL {COHORT_N} DAY AND e.t
  WHERE (e.bucket, x.user_id) IN (SELECT bucket, user_id FROM u) GROUP BY 1, 2
  UNION ALL
  SELECT e.bucket, x.user_id, COUNT(*) AS c FROM ends e JOIN events x
    ON x.event_type = 'purchase' AND x.ts BETWEEN e.t - INTERVAL {COHORT_N} DAY AND e.t
  WHERE (e.bucket, x.user_id) IN (SELECT bucket, user_id FROM u) GROUP BY 1, 2),
active AS (SELECT bucket, user_id FROM per_table GROUP BY 1, 2 HAVING SUM(c) >= {COHORT_MIN}),
acc AS (
  SELECT user_id, ts, CASE WHEN value > 50 THEN 1 WHEN value > 40 THEN NULL ELSE 0 END AS flag
  FROM events WHERE event_type = 'signup'),
j AS (
  SELECT x.bucket, a.flag FROM active x JOIN ends e ON e.bucket = x.bucket
  JOIN acc a ON a.user_id = x.user_id
   AND a.ts BETWEEN e.t - INTERVAL {COHORT_N + 1} DAY AND e.t + INTERVAL 1 DAY),
agg AS (
  SELECT bucket, SUM(CASE WHEN flag = 1 THEN 1 ELSE 0 END) AS mobile,
         SUM(CASE WHEN flag <> 1 THEN 1 ELSE 0 END) AS desktop
  FROM j GROUP BY 1)
SELECT e.bucket, CAST(a.mobile AS BIGINT) AS mobile, CAST(a.desktop AS BIGINT) AS desktop
FROM ends e LEFT JOIN agg a ON e.bucket = a.bucket
""")
def rolling_active_cohort_query(spark, sf_dir):
    """Users who signed up in the trailing 3 days and made at least 3 clicks
    and purchases together in that window, counted over their signup rows
    (the account log) by a mobile flag."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("user"), "ts", "event_type", "value")
    signups = events.where(F.col("event_type") == "signup")
    clicks = events.where(F.col("event_type") == "click")
    purchases = events.where(F.col("event_type") == "purchase")
    accounts = signups.withColumn("flag", _account_flag())
    return rolling_active_cohort(signups, [clicks, purchases], accounts, COHORT_FIRST, COHORT_LAST,
                                 n=COHORT_N, min_edits=COHORT_MIN)


@register("threshold_groups", covers="threshold_groups R-34 F-14 A-09", oracle=f"""
SELECT {', '.join(f"CAST(SUM(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS {t}" for t in EVENT_TYPES)}
FROM (SELECT user_id, event_type, COUNT(*) AS c FROM events GROUP BY 1, 2) g
WHERE c > 15
""")
def threshold_groups_query(spark, sf_dir):
    """Users with more than 15 events of a type, counted per type."""
    split = {t: F.col("event_type") == t for t in EVENT_TYPES}
    return threshold_groups(table(spark, sf_dir, "events"), ["user_id", "event_type"], split,
                            min_exclusive=15)


@register("threshold_groups_monthly", covers="threshold_groups F-12 F-15 (per bucket, inclusive)", oracle=f"""
SELECT bucket,
  {', '.join(f"CAST(SUM(CASE WHEN o_orderstatus = '{s}' THEN 1 ELSE 0 END) AS BIGINT) AS status_{s.lower()}" for s in STATUSES)}
FROM (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS bucket, o_custkey, o_orderstatus, COUNT(*) AS c
  FROM orders WHERE o_totalprice <= 400000 GROUP BY 1, 2, 3) g
WHERE c >= 2
GROUP BY bucket
""")
def threshold_groups_monthly(spark, sf_dir):
    """Per month: customers with at least 2 orders of one status."""
    split = {f"status_{s.lower()}": F.col("o_orderstatus") == s for s in STATUSES}
    return threshold_groups(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"], split,
                            min_inclusive=2, ts="o_orderdate", grain="month",
                            where=F.col("o_totalprice") <= 400000)


@register("cohort_event_count", covers="cohort_event_count R-18 J-N4", oracle="""
SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS bucket, COUNT(*) AS n
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'BUILDING'
GROUP BY 1
""")
def cohort_event_count_query(spark, sf_dir):
    """Orders per month of one market segment's customers."""
    return cohort_event_count(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"),
                              "o_custkey", "c_custkey", "o_orderdate", "month",
                              cohort_where=F.col("c_mktsegment") == "BUILDING")
