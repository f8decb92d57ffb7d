"""Queries for spines, bucketed counts, pivots, distincts and densification."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arith import row_total
from ..operators.buckets import (
    BUCKET,
    bucket_counts,
    bucket_distinct,
    bucket_pivot,
    data_spine,
    dense_distinct,
    dense_pivot,
    latest_buckets,
)
from .catalog import register, table

# Fixed evaluation dates of the test-data queries.
EVENTS_AS_OF = "2024-01-30"
ORDERS_AS_OF = "2001-08-01"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
STATUSES = ("F", "O", "P")


def _type_metrics():
    return {t: F.col("event_type") == t for t in EVENT_TYPES}


def _sum_cases(col: str, values, alias_prefix: str = "") -> str:
    return ",\n  ".join(
        f"CAST(SUM(CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS {alias_prefix}{v.lower()}"
        for v in values)


# -- flagship: R-20 shape ---------------------------------------------------

@register("dense_daily_pivot", covers="date_spine densify bucket_pivot row_total R-20", oracle=f"""
WITH spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2024-01-01', DATE '{EVENTS_AS_OF}', INTERVAL 1 DAY) t(d)),
agg AS (
  SELECT CAST(ts AS DATE) AS bucket,
  {_sum_cases('event_type', EVENT_TYPES)}
  FROM events
  WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'
  GROUP BY 1)
SELECT s.bucket,
  CAST({' + '.join(f'COALESCE(a.{t}, 0)' for t in EVENT_TYPES)} AS BIGINT) AS total,
  {', '.join(f'CAST(COALESCE(a.{t}, 0) AS BIGINT) AS {t}' for t in EVENT_TYPES)}
FROM spine s LEFT JOIN agg a ON s.bucket = a.bucket
""")
def dense_daily_pivot(spark, sf_dir):
    """30-day dense series of events per type with a row total (R-20)."""
    events = table(spark, sf_dir, "events")
    dense = dense_pivot(events, "ts", "day", EVENTS_AS_OF, 30, _type_metrics())
    return dense.select(BUCKET, row_total(list(EVENT_TYPES)).alias("total"), *EVENT_TYPES)


# -- bucket_counts ------------------------------------------------------------

@register("bucket_counts_daily", covers="bucket_counts A-01 A-07 X-03", oracle="""
SELECT CAST(ts AS DATE) AS bucket, COUNT(*) AS n FROM events GROUP BY 1
""")
def bucket_counts_daily(spark, sf_dir):
    return bucket_counts(table(spark, sf_dir, "events"), "ts", "day")


@register("bucket_counts_monthly", covers="bucket_counts A-08 X-05", oracle="""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS bucket, COUNT(*) AS n
FROM orders GROUP BY 1
""")
def bucket_counts_monthly(spark, sf_dir):
    return bucket_counts(table(spark, sf_dir, "orders"), "o_orderdate", "month")


# -- bucket_pivot -------------------------------------------------------------

@register("bucket_pivot_daily", covers="bucket_pivot A-03 A-04 R-04 R-19 R-21", oracle=f"""
SELECT CAST(ts AS DATE) AS bucket, COUNT(*) AS total,
  {_sum_cases('event_type', EVENT_TYPES)}
FROM events GROUP BY 1
""")
def bucket_pivot_daily(spark, sf_dir):
    return bucket_pivot(table(spark, sf_dir, "events"), "ts", "day", _type_metrics(), total="total")


@register("bucket_pivot_monthly_status", covers="bucket_pivot A-08 F-01 F-02", oracle=f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS bucket, COUNT(*) AS total,
  {_sum_cases('o_orderstatus', STATUSES, 'status_')},
  CAST(SUM(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) AS BIGINT) AS not_final
FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1
""")
def bucket_pivot_monthly_status(spark, sf_dir):
    metrics = {f"status_{s.lower()}": F.col("o_orderstatus") == s for s in STATUSES}
    metrics["not_final"] = F.col("o_orderstatus") != "F"
    return bucket_pivot(table(spark, sf_dir, "orders"), "o_orderdate", "month", metrics,
                        total="total", where=F.col("o_orderpriority") != "5-LOW")


# -- bucket_distinct ----------------------------------------------------------

@register("bucket_distinct_daily", covers="bucket_distinct A-06 R-09", oracle=f"""
SELECT CAST(ts AS DATE) AS bucket,
  COUNT(DISTINCT user_id) AS users,
  {', '.join(f"COUNT(DISTINCT CASE WHEN event_type = '{t}' THEN user_id END) AS {t}" for t in EVENT_TYPES)}
FROM events GROUP BY 1
""")
def bucket_distinct_daily(spark, sf_dir):
    metrics = {"users": F.lit(True), **_type_metrics()}
    return bucket_distinct(table(spark, sf_dir, "events"), "ts", "day", "user_id", metrics)


@register("bucket_distinct_monthly", covers="bucket_distinct A-06 A-08 R-01 R-26", oracle="""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS bucket,
  COUNT(DISTINCT CASE WHEN o_orderpriority LIKE '1%' THEN o_custkey END) AS urgent,
  COUNT(DISTINCT CASE WHEN o_orderpriority LIKE '2%' THEN o_custkey END) AS high,
  COUNT(DISTINCT o_custkey) AS customers
FROM orders GROUP BY 1
""")
def bucket_distinct_monthly(spark, sf_dir):
    p = F.col("o_orderpriority")
    metrics = {"urgent": p.startswith("1"), "high": p.startswith("2"), "customers": F.lit(True)}
    return bucket_distinct(table(spark, sf_dir, "orders"), "o_orderdate", "month", "o_custkey", metrics)


# -- spines and densify ---------------------------------------------------------

@register("date_spine_span", covers="date_spine D-04 W-02 X-08", oracle="""
SELECT CAST(d AS DATE) AS bucket
FROM generate_series(
  (SELECT CAST(date_trunc('month', MIN(o_orderdate)) AS DATE) FROM orders),
  (SELECT CAST(date_trunc('month', MAX(o_orderdate)) AS DATE) FROM orders),
  INTERVAL 1 MONTH) t(d)
""")
def date_spine_span(spark, sf_dir):
    """Every month from the first to the last order month, bounds computed
    on the cluster."""
    return data_spine(table(spark, sf_dir, "orders"), "o_orderdate", "month")


@register("densify_errors", covers="densify date_spine J-N1 X-01 D-02 R-10", oracle=f"""
WITH spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2024-01-01', DATE '{EVENTS_AS_OF}', INTERVAL 1 DAY) t(d)),
agg AS (
  SELECT CAST(ts AS DATE) AS bucket, COUNT(*) AS errors
  FROM events WHERE event_type = 'error' AND value > 200 GROUP BY 1)
SELECT s.bucket, CAST(COALESCE(a.errors, 0) AS BIGINT) AS errors
FROM spine s LEFT JOIN agg a ON s.bucket = a.bucket
""")
def densify_errors(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return dense_pivot(events, "ts", "day", EVENTS_AS_OF, 30, {}, total="errors",
                       where=(F.col("event_type") == "error") & (F.col("value") > 200))


@register("dense_monthly_platforms", covers="densify date_spine D-01 J-N3 R-03", oracle=f"""
WITH spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2000-09-01', DATE '{ORDERS_AS_OF}', INTERVAL 1 MONTH) t(d)),
agg AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS bucket,
    SUM(CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END) AS urgent,
    SUM(CASE WHEN o_orderpriority LIKE '2%' THEN 1 ELSE 0 END) AS high,
    SUM(CASE WHEN o_orderpriority LIKE '3%' THEN 1 ELSE 0 END) AS medium
  FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT s.bucket,
  CAST(COALESCE(a.urgent, 0) AS BIGINT) AS urgent,
  CAST(COALESCE(a.high, 0) AS BIGINT) AS high,
  CAST(COALESCE(a.medium, 0) AS BIGINT) AS medium
FROM spine s LEFT JOIN agg a ON s.bucket = a.bucket
""")
def dense_monthly_platforms(spark, sf_dir):
    """12-month calendar ending at as_of, counts per priority class (R-03)."""
    p = F.col("o_orderpriority")
    metrics = {"urgent": p.startswith("1"), "high": p.startswith("2"), "medium": p.startswith("3")}
    return dense_pivot(table(spark, sf_dir, "orders"), "o_orderdate", "month", ORDERS_AS_OF, 12,
                       metrics, where=F.col("o_orderstatus") == "O")


@register("row_total", covers="row_total P-05 R-02", oracle="""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS bucket,
  CAST(COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END)
     + COUNT(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END)
     + COUNT(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_custkey END) AS BIGINT) AS total,
  COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS status_f,
  COUNT(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS status_o,
  COUNT(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_custkey END) AS status_p
FROM orders GROUP BY 1
""")
def row_total_query(spark, sf_dir):
    """Sum of per-class distinct counts, not a distinct over all (R-02)."""
    metrics = {f"status_{s.lower()}": F.col("o_orderstatus") == s for s in STATUSES}
    agg = bucket_distinct(table(spark, sf_dir, "orders"), "o_orderdate", "month", "o_custkey", metrics)
    cols = list(metrics)
    return agg.select(BUCKET, row_total(cols).alias("total"), *cols)


@register("latest_buckets", covers="latest_buckets W-04", oracle="""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS bucket, COUNT(*) AS n
FROM orders GROUP BY 1 ORDER BY bucket DESC LIMIT 12
""")
def latest_buckets_query(spark, sf_dir):
    series = bucket_counts(table(spark, sf_dir, "orders"), "o_orderdate", "month")
    return latest_buckets(series, 12)


@register("dense_distinct_daily", covers="dense_distinct bucket_distinct densify R-02 R-09", oracle=f"""
WITH spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2024-01-01', DATE '{EVENTS_AS_OF}', INTERVAL 1 DAY) t(d)),
agg AS (
  SELECT CAST(ts AS DATE) AS bucket,
    COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers,
    COUNT(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) AS failing
  FROM events WHERE value > 90
    AND ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'
  GROUP BY 1)
SELECT s.bucket, CAST(COALESCE(a.buyers, 0) AS BIGINT) AS buyers,
  CAST(COALESCE(a.failing, 0) AS BIGINT) AS failing
FROM spine s LEFT JOIN agg a ON s.bucket = a.bucket
""")
def dense_distinct_daily(spark, sf_dir):
    """30-day calendar of distinct users per class (the unique-uploaders-day
    shape), zeros on days without any."""
    t = F.col("event_type")
    return dense_distinct(table(spark, sf_dir, "events"), "ts", "day", EVENTS_AS_OF, 30, "user_id",
                          {"buyers": t == "purchase", "failing": t == "error"},
                          where=F.col("value") > 90)
