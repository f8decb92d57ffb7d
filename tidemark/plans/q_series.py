"""Queries for sources, parsing, classifiers, sinks, deltas and streaming."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions.text import classify_contains, classify_prefix
from ..functions.time import format_ts14, parse_ts
from ..operators.buckets import BUCKET, bucket_counts
from ..operators.series import period_delta, read_series, write_series
from ..session import scratch_dir
from ..sources.versions import unify_versions
from ..streaming.buckets import streaming_bucket_counts
from .catalog import register, table
from .q_buckets import EVENT_TYPES, dense_daily_pivot, _sum_cases
from .catalog import REGISTRY

SPLIT_OLD_BEFORE = "2024-01-20"   # older schema version: events before this
SPLIT_NEW_FROM = "2024-01-10"     # newer schema version: events from this on


def _versions(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    t = F.col("ts")
    old = events.where(t < F.lit(f"{SPLIT_OLD_BEFORE} 00:00:00").cast("timestamp_ntz"))
    new = events.where(t >= F.lit(f"{SPLIT_NEW_FROM} 00:00:00").cast("timestamp_ntz"))
    return old, new


@register("unify_versions", covers="unify_versions S-04 U-01 P-04 (literal fill)", oracle=f"""
SELECT event_id, ts, user_id, event_type, CAST(0 AS DOUBLE) AS value
FROM events WHERE ts < TIMESTAMP '{SPLIT_OLD_BEFORE} 00:00:00'
UNION
SELECT event_id, ts, user_id, event_type, value
FROM events WHERE ts >= TIMESTAMP '{SPLIT_NEW_FROM} 00:00:00'
""")
def unify_versions_query(spark, sf_dir):
    """Two overlapping schema versions; the older lacks ``value`` (filled
    with 0), so overlapping rows differ and both stay."""
    old, new = _versions(spark, sf_dir)
    cols = ["event_id", "ts", "user_id", "event_type", "value"]
    return unify_versions([old.drop("value"), new], columns=cols, fill={"value": 0.0})


@register("unify_versions_dedup", covers="unify_versions S-06 S-07 U-01 (distinct collapse)", oracle=f"""
SELECT ts, user_id, event_type FROM events WHERE ts < TIMESTAMP '{SPLIT_OLD_BEFORE} 00:00:00'
UNION
SELECT ts, user_id, event_type FROM events WHERE ts >= TIMESTAMP '{SPLIT_NEW_FROM} 00:00:00'
""")
def unify_versions_dedup(spark, sf_dir):
    """Same versions projected without ids: overlapping rows collapse."""
    old, new = _versions(spark, sf_dir)
    return unify_versions([old, new], columns=["ts", "user_id", "event_type"])


@register("parse_ts", covers="parse_ts X-06 X-17 S-12 (14-digit text both ways)", oracle="""
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS ts14,
  strptime(strftime(ts, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') AS parsed
FROM events
""")
def parse_ts_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = format_ts14("ts")
    return events.select("event_id", text.alias("ts14"), parse_ts(text).alias("parsed"))


@register("classify_prefix", covers="classify_prefix F-03 X-09", oracle="""
SELECT o_orderkey,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent'
       WHEN o_orderpriority LIKE '2%' THEN 'high' ELSE 'other' END AS priority_class
FROM orders
""")
def classify_prefix_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cls = classify_prefix("o_orderpriority", {"urgent": "1", "high": "2"}, default="other")
    return orders.select("o_orderkey", cls.alias("priority_class"))


@register("classify_contains", covers="classify_contains F-04 F-05 F-06", oracle="""
SELECT page_id,
  CASE WHEN url LIKE '%://m.%' THEN 'mobile'
       WHEN url LIKE '%blog.%' OR url LIKE '%/blog/%' THEN 'blog' ELSE 'web' END AS site_class,
  (url IS NULL OR url NOT LIKE '%#top%') AS no_anchor
FROM pages
""")
def classify_contains_query(spark, sf_dir):
    from ..functions.text import lacks_or_null
    pages = table(spark, sf_dir, "pages")
    cls = classify_contains("url", {"mobile": "://m.", "blog": ["blog.", "/blog/"]}, default="web")
    return pages.select("page_id", cls.alias("site_class"), lacks_or_null("url", "#top").alias("no_anchor"))


@register("write_series", covers="write_series read_series S-13 S-14 W-06", oracle=REGISTRY["dense_daily_pivot"].oracle)
def write_series_query(spark, sf_dir):
    """The flagship series written as CSV to the shared folder and read back
    with its schema (a fresh path per run; the written files are the result)."""
    series = dense_daily_pivot(spark, sf_dir)
    path = scratch_dir(spark, "dense-daily-pivot")
    write_series(series, path, fmt="csv")
    schema = "bucket date, total bigint, " + ", ".join(f"{t} bigint" for t in EVENT_TYPES)
    return read_series(spark, path, schema, fmt="csv")


@register("period_delta", covers="period_delta (chart callout: 1 month and 1 year back)", oracle="""
WITH m AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS bucket, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT a.bucket, a.n AS value,
  b.n AS value_1m, ROUND(CAST(a.n - b.n AS DOUBLE) / NULLIF(b.n, 0), 6) AS change_1m,
  c.n AS value_1y, ROUND(CAST(a.n - c.n AS DOUBLE) / NULLIF(c.n, 0), 6) AS change_1y
FROM m a
LEFT JOIN m b ON b.bucket = a.bucket - INTERVAL 1 MONTH
LEFT JOIN m c ON c.bucket = a.bucket - INTERVAL 12 MONTH
""")
def period_delta_query(spark, sf_dir):
    series = bucket_counts(table(spark, sf_dir, "orders"), "o_orderdate", "month")
    out = period_delta(series, "n", {"1m": 1, "1y": 12})
    return out.select(BUCKET, "value", "value_1m", F.round("change_1m", 6).alias("change_1m"),
                      "value_1y", F.round("change_1y", 6).alias("change_1y"))


@register("streaming_bucket_counts", covers="streaming_bucket_counts (Structured Streaming, availableNow)",
          oracle=f"""
SELECT CAST(ts AS DATE) AS bucket, COUNT(*) AS total,
  {_sum_cases('event_type', EVENT_TYPES)}
FROM events GROUP BY 1
""")
def streaming_bucket_counts_query(spark, sf_dir):
    """Daily counts per type computed by a streaming query over the events
    file, upserted by bucket into a Parquet series, then read back."""
    src = table(spark, sf_dir, "events")
    run = scratch_dir(spark, "events-daily")
    metrics = {t: F.col("event_type") == t for t in EVENT_TYPES}
    streaming_bucket_counts(spark, f"{sf_dir.rstrip('/')}/events.parquet", src.schema, "ts", metrics,
                            sink=f"{run}/series", checkpoint=f"{run}/checkpoint")
    schema = "total bigint, " + ", ".join(f"{t} bigint" for t in EVENT_TYPES) + ", bucket date"
    out = spark.read.schema(schema).parquet(f"{run}/series")
    return out.select(BUCKET, "total", *EVENT_TYPES)
