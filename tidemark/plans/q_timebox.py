"""Queries for time-boxed series, funnels and incremental refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arith import count_rows
from ..operators.buckets import BUCKET, bucket_pivot, funnel_counts
from ..operators.timebox import refresh_series, refresh_with_drift, incremental_refresh, time_boxed
from .catalog import register, table
from .q_buckets import ORDERS_AS_OF, STATUSES

ORDERS_START = "1995-01-01"
EVENTS_START = "2024-01-01"
EVENTS_END = "2024-01-30"
FUNNEL = ("view", "click", "signup", "purchase")
REFRESH_CUTOFF = "2024-01-18"
REFRESH_METRICS = ("error", "view")


# -- time_boxed ---------------------------------------------------------------

@register("time_boxed_monthly", covers="time_boxed J-01 J-02 J-08 P-07 F-07", oracle=f"""
WITH spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{ORDERS_START}', DATE '{ORDERS_AS_OF}', INTERVAL 1 MONTH) t(d))
SELECT s.bucket,
  COALESCE(COUNT(o.o_orderkey), 0) AS total,
  {', '.join(f"CAST(COALESCE(SUM(CASE WHEN o.o_orderstatus = '{x}' THEN 1 ELSE 0 END), 0) AS BIGINT) AS status_{x.lower()}" for x in STATUSES)}
FROM spine s LEFT JOIN orders o
  ON o.o_orderdate >= s.bucket AND o.o_orderdate < s.bucket + INTERVAL 1 MONTH
GROUP BY s.bucket
""")
def time_boxed_monthly(spark, sf_dir):
    """Month buckets from the first order month to as_of, half-open
    windows, empty months as zeros."""
    metrics = {f"status_{x.lower()}": F.col("o_orderstatus") == x for x in STATUSES}
    out = time_boxed(table(spark, sf_dir, "orders"), "o_orderdate", ORDERS_START, ORDERS_AS_OF,
                     "month", metrics=metrics, aggs={"total": count_rows()}, empty="zero")
    return out.select(BUCKET, "total", *metrics)


@register("time_boxed_closed_daily", covers="time_boxed J-03 F-08 R-29 R-30", oracle=f"""
WITH spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{ORDERS_START}', DATE '{ORDERS_AS_OF}', INTERVAL 1 DAY) t(d))
SELECT s.bucket,
  CAST(SUM(CASE WHEN o.o_orderkey IS NULL THEN NULL ELSE 1 END) AS BIGINT) AS total,
  CAST(SUM(CASE WHEN o.o_orderkey IS NULL THEN NULL
                WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS urgent
FROM spine s LEFT JOIN orders o
  ON o.o_orderdate >= s.bucket AND o.o_orderdate <= s.bucket + INTERVAL 1 DAY
GROUP BY s.bucket
""")
def time_boxed_closed_daily(spark, sf_dir):
    """Closed daily windows ``[d, d+1]``: every order (all at midnight)
    counts in two days; empty days are NULL as in an ungrouped SUM."""
    out = time_boxed(table(spark, sf_dir, "orders"), "o_orderdate", ORDERS_START, ORDERS_AS_OF,
                     "day", metrics={"urgent": F.col("o_orderpriority") == "1-URGENT"},
                     aggs={"total": count_rows()}, closed="both", empty="null")
    return out.select(BUCKET, "total", "urgent")


@register("time_boxed_closed_monthly", covers="time_boxed J-03 month grain", oracle=f"""
WITH spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{ORDERS_START}', DATE '{ORDERS_AS_OF}', INTERVAL 1 MONTH) t(d))
SELECT s.bucket, COUNT(o.o_orderkey) AS total
FROM spine s LEFT JOIN orders o
  ON o.o_orderdate >= s.bucket AND o.o_orderdate <= s.bucket + INTERVAL 1 MONTH
GROUP BY s.bucket
""")
def time_boxed_closed_monthly(spark, sf_dir):
    out = time_boxed(table(spark, sf_dir, "orders"), "o_orderdate", ORDERS_START, ORDERS_AS_OF,
                     "month", aggs={"total": count_rows()}, closed="both", empty="zero")
    return out.select(BUCKET, "total")


# -- funnels ------------------------------------------------------------------

@register("funnel_daily", covers="funnel_counts A-05 R-11", oracle=f"""
SELECT CAST(ts AS DATE) AS bucket,
  {', '.join(f"CAST(COALESCE(SUM(CASE WHEN event_type = '{s}' THEN 1 ELSE 0 END), 0) AS BIGINT) AS {s}" for s in FUNNEL)}
FROM events WHERE value > 10 GROUP BY 1
""")
def funnel_daily(spark, sf_dir):
    return funnel_counts(table(spark, sf_dir, "events"), "ts", "event_type", FUNNEL,
                         where=F.col("value") > 10)


@register("funnel_time_boxed", covers="funnel_counts time_boxed R-11 R-12 R-13 F-05", oracle=f"""
WITH spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{EVENTS_START}', DATE '{EVENTS_END}', INTERVAL 1 DAY) t(d)),
agg AS (
  SELECT CAST(ts AS DATE) AS bucket,
  {', '.join(f"SUM(CASE WHEN event_type = '{s}' THEN 1 ELSE 0 END) AS {s}" for s in FUNNEL)}
  FROM events WHERE (props LIKE '%1%' OR props LIKE '%7%')
    AND ts >= TIMESTAMP '{EVENTS_START} 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'
  GROUP BY 1)
SELECT s.bucket, {', '.join(f"CAST(COALESCE(a.{x}, 0) AS BIGINT) AS {x}" for x in FUNNEL)}
FROM spine s LEFT JOIN agg a ON s.bucket = a.bucket
""")
def funnel_time_boxed(spark, sf_dir):
    """Funnel per day over a time box, rows selected by a disjunction of
    substring tests (the iOS user-agent rule), empty days as zeros."""
    from ..functions.text import contains_any
    metrics = {s: F.col("event_type") == s for s in FUNNEL}
    out = time_boxed(table(spark, sf_dir, "events"), "ts", EVENTS_START, EVENTS_END, "day",
                     metrics=metrics, empty="zero", where=contains_any("props", ["1", "7"]))
    return out.select(BUCKET, *FUNNEL)


# -- refresh ------------------------------------------------------------------

def _daily(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return bucket_pivot(events, "ts", "day", {m: F.col("event_type") == m for m in REFRESH_METRICS},
                        total="total")


def _stored(fresh):
    """Stored series derived from the data: days 1-20 with values x10 and
    day 5 left all-empty (it counts as not stored)."""
    blank = F.col(BUCKET) == F.lit("2024-01-05").cast("date")
    cols = ["total", *REFRESH_METRICS]
    return (fresh.where(F.col(BUCKET) <= F.lit("2024-01-20").cast("date"))
            .select(BUCKET, *[F.when(~blank, F.col(c) * 10).alias(c) for c in cols]))


_REFRESH_ORACLE = f"""
WITH fresh AS (
  SELECT CAST(ts AS DATE) AS bucket, COUNT(*) AS total,
    {', '.join(f"CAST(SUM(CASE WHEN event_type = '{m}' THEN 1 ELSE 0 END) AS BIGINT) AS {m}" for m in REFRESH_METRICS)}
  FROM events GROUP BY 1),
stored AS (
  SELECT bucket,
    {', '.join(f"CASE WHEN bucket = DATE '2024-01-05' THEN NULL ELSE {c} * 10 END AS {c}" for c in ('total',) + REFRESH_METRICS)}
  FROM fresh WHERE bucket <= DATE '2024-01-20'),
kept AS (
  SELECT * FROM stored
  WHERE NOT ({' AND '.join(f'{c} IS NULL' for c in ('total',) + REFRESH_METRICS)})
    AND (bucket < DATE '{EVENTS_START}' OR bucket > DATE '{EVENTS_END}'
         OR bucket + INTERVAL 1 DAY < DATE '{REFRESH_CUTOFF}'))
SELECT * FROM kept
UNION ALL
SELECT * FROM fresh WHERE bucket NOT IN (SELECT bucket FROM kept)
"""


@register("incremental_refresh", covers="incremental_refresh J-04 J-05 J-06 S-13",
          oracle=_REFRESH_ORACLE)
def incremental_refresh_query(spark, sf_dir):
    fresh = _daily(spark, sf_dir)
    return incremental_refresh(_stored(fresh), fresh, REFRESH_CUTOFF, EVENTS_START, EVENTS_END)


@register("refresh_series", covers="incremental_refresh time_boxed J-02 J-04 (only open buckets aggregated)",
          oracle=_REFRESH_ORACLE)
def refresh_series_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stored = _stored(_daily(spark, sf_dir))
    return refresh_series(stored, events, "ts", EVENTS_START, EVENTS_END, REFRESH_CUTOFF, "day",
                          metrics={m: F.col("event_type") == m for m in REFRESH_METRICS},
                          aggs={"total": count_rows()})


@register("schema_drift", covers="schema_drift J-07", oracle=f"""
SELECT CAST(ts AS DATE) AS bucket, COUNT(*) AS total,
  {', '.join(f"CAST(SUM(CASE WHEN event_type = '{m}' THEN 1 ELSE 0 END) AS BIGINT) AS {m}" for m in REFRESH_METRICS)}
FROM events GROUP BY 1
""")
def schema_drift_query(spark, sf_dir):
    """The stored series lacks a column, so the refresh rebuilds everything."""
    fresh = _daily(spark, sf_dir)
    stored = _stored(fresh).drop("view")
    return refresh_with_drift(stored, fresh, REFRESH_CUTOFF, EVENTS_START, EVENTS_END)
