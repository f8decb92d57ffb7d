"""Distinct users merged from stored day bitmaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.buckets import BUCKET, densify, spine_between, spine_bounds
from ..operators.users import DistinctSeries
from ..session import scratch_dir
from .catalog import REGISTRY, register, table
from .q_buckets import EVENT_TYPES
from .q_reports import AS_OF, STARTS, derived_uploads
from .reports import MONTHS, android, app_uploads_ok, ios, web_uploads_ok

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(30)]
TRAILING = 7


def _by_type() -> dict:
    return {t: F.col("event_type") == t for t in EVENT_TYPES}


@register("distinct_users_trailing", covers="mergeable distinct A-06 F-09 W-03: users of the 7 days ending with each day", oracle=f"""
WITH spine AS (SELECT CAST(d AS DATE) AS bucket FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d))
SELECT s.bucket, {', '.join(f"CAST(COUNT(DISTINCT CASE WHEN e.event_type = '{t}' THEN e.user_id END) AS BIGINT) AS {t}" for t in EVENT_TYPES)}
FROM spine s LEFT JOIN events e ON CAST(e.ts AS DATE) <= s.bucket AND CAST(e.ts AS DATE) > s.bucket - {TRAILING}
GROUP BY s.bucket
""")
def distinct_users_trailing(spark, sf_dir):
    """Day bitmaps of the month's events, merged into trailing weeks."""
    series = DistinctSeries(spark, scratch_dir(spark, "users"), "user_id", _by_type())
    series.refresh(table(spark, sf_dir, "events"), DAYS)
    return series.trailing(TRAILING, STARTS, AS_OF)


@register("distinct_uploaders_merged", covers="mergeable distinct A-06 D-01 R-01: months from day bitmaps, refreshed twice",
          oracle=REGISTRY["report_unique_uploaders"].oracle)
def distinct_uploaders_merged(spark, sf_dir):
    """The monthly uploader report from day bitmaps: days up to the 20th first, then the
    rest and three of the first again. App and web uploaders share the users' numbers."""
    tables = derived_uploads(spark, sf_dir)
    root = scratch_dir(spark, "uploaders")
    apps = DistinctSeries(spark, root, "event_username", {"android": android(), "ios": ios()}, app_uploads_ok(), name="apps")
    web = DistinctSeries(spark, root, "event_username", {"web": F.lit(True)}, web_uploads_ok(), name="web")
    for days in (DAYS[:20], DAYS[17:]):
        apps.refresh(tables["upload_attempts"], days)
        web.refresh(tables["upload_web"], days)
    start, end = spine_bounds(AS_OF, MONTHS, "month")
    return densify(spine_between(spark, start, end, "month"), apps.counts("month", start, end),
                   web.counts("month", start, end)).select(BUCKET, "android", "ios", "web")
