"""All schema versions of the web logs, found in their source, and streams over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import format_ts14
from ..session import scratch_dir
from ..sources.logical import PROJECTIONS, LogicalCatalog
from ..streaming.distinct import streaming_distinct_users, streaming_version_counts
from .catalog import register, table
from .q_reports import _EDITS_CTE, _TEXT, derived_raw

# Days (from, before) of each version; the next one overlaps it.
EDIT_DAYS = {"MobileWebEditing_5644223": (1, 10), "MobileWebEditing_6077315": (7, 14), "MobileWebEditing_6637866": (12, 20),
             "MobileWebEditing_7675117": (18, 26), "MobileWebEditing_8599025": (24, 32)}
UPLOAD_DAYS = {"MobileWebUploads_5281063": (1, 12), "MobileWebUploads_5383883": (9, 18), "MobileWebUploads_7967082": (16, 25),
               "MobileWebUploads_8209043": (22, 32)}
# Type of the edit count in each version; the fourth lacks it.
EDIT_COUNT = dict(zip(EDIT_DAYS, ("int", "bigint", "decimal(12,0)", None, "smallint")))


def _between(days) -> str:
    return f"day(ts) >= {days[0]} AND day(ts) < {days[1]}"


def edit_versions(spark, sf_dir) -> dict:
    """Five overlapping versions of the edit log, the edit count in another type in each."""
    ev = table(spark, sf_dir, "events")
    v, t = F.col("value"), F.col("event_type")
    rows = ev.select(
        "ts", format_ts14("ts").alias("timestamp"), F.when(v >= 400, "testwiki").otherwise("enwiki").alias("wiki"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("event_username"), t.alias("event_action"),
        F.when(v < 30, 0).when(v < 60, 1).otherwise(2).alias("event_namespace"),
        F.floor(v / 10).alias("event_userEditCount"))
    out = {}
    for name, days in EDIT_DAYS.items():
        part, kind = rows.where(_between(days)).drop("ts"), EDIT_COUNT[name]
        count = F.col("event_userEditCount")
        out[name] = part.withColumn("event_userEditCount", count.cast(kind)) if kind else part.drop("event_userEditCount")
    return out


def upload_versions(spark, sf_dir) -> dict:
    """Four overlapping versions of the upload log; the last has a funnel number that was text never."""
    ev = table(spark, sf_dir, "events")
    rows = ev.select("ts", format_ts14("ts").alias("timestamp"), F.when(F.col("value") >= 450, "testwiki").otherwise("commonswiki").alias("wiki"),
                     F.col("event_type").alias("event_action"), (F.col("user_id") % 7).alias("event_funnel"),
                     F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("event_username"))
    kinds = dict(zip(UPLOAD_DAYS, ("int", "bigint", "decimal(5,2)", "smallint")))
    return {name: rows.where(_between(days)).drop("ts").withColumn("event_funnel", F.col("event_funnel").cast(kinds[name]))
            for name, days in UPLOAD_DAYS.items()}


def discovered(spark, raw: dict) -> LogicalCatalog:
    root = scratch_dir(spark, "versions")
    for name, df in raw.items():
        df.write.parquet(f"{root}/{name}")
    return LogicalCatalog(spark, {"sources": {"el": {"path": root}, "commons": {"path": root}}, "discover": True})


_EDIT_UNION = " UNION ".join(
    f"""SELECT {_TEXT} AS timestamp, CASE WHEN value >= 400 THEN 'testwiki' ELSE 'enwiki' END AS wiki,
      'user' || CAST(user_id AS VARCHAR) AS event_username, event_type AS event_action,
      CASE WHEN value < 30 THEN 0 WHEN value < 60 THEN 1 ELSE 2 END AS event_namespace,
      {'CAST(floor(value / 10) AS BIGINT)' if EDIT_COUNT[name] else 'NULL::BIGINT'} AS edits
    FROM events WHERE {_between(days)}""" for name, days in EDIT_DAYS.items())


@register("edits_five_versions", covers="S-06 S-04 U-01 J-07: all five edit versions found by suffix, widened, distinct", oracle=f"""
SELECT CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE) AS bucket, COUNT(*) AS total,
  CAST(SUM(edits) AS BIGINT) AS edits, COUNT(edits) AS known, COUNT(DISTINCT event_username) AS users
FROM ({_EDIT_UNION}) WHERE wiki <> 'testwiki' GROUP BY 1
""")
def edits_five_versions(spark, sf_dir):
    rows = discovered(spark, edit_versions(spark, sf_dir))["edits_web"].where(F.col("wiki") != "testwiki")
    return rows.groupBy(F.to_date("ts").alias("bucket")).agg(
        F.count(F.lit(1)).alias("total"), F.sum("event_userEditCount").cast("bigint").alias("edits"),
        F.count("event_userEditCount").alias("known"), F.count_distinct("event_username").alias("users"))


_UPLOAD_UNION = " UNION ".join(
    f"""SELECT {_TEXT} AS timestamp, CASE WHEN value >= 450 THEN 'testwiki' ELSE 'commonswiki' END AS wiki,
      event_type AS event_action, user_id % 7 AS funnel, 'user' || CAST(user_id AS VARCHAR) AS event_username
    FROM events WHERE {_between(days)}""" for days in UPLOAD_DAYS.values())


@register("uploads_four_versions", covers="S-07 U-01 J-07: all four web upload versions found by suffix, widened, distinct", oracle=f"""
SELECT CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE) AS bucket, COUNT(*) AS total,
  CAST(SUM(funnel) AS BIGINT) AS funnel, COUNT(DISTINCT event_username) AS users
FROM ({_UPLOAD_UNION}) WHERE wiki <> 'testwiki' GROUP BY 1
""")
def uploads_four_versions(spark, sf_dir):
    rows = discovered(spark, upload_versions(spark, sf_dir))["upload_web"].where(F.col("wiki") != "testwiki")
    return rows.groupBy(F.to_date("ts").alias("bucket")).agg(
        F.count(F.lit(1)).alias("total"), F.sum("event_funnel").cast("bigint").alias("funnel"),
        F.count_distinct("event_username").alias("users"))


def _streamed(spark, sf_dir):
    """Folder and schema of the two overlapping edit versions derived from events."""
    root = scratch_dir(spark, "edit-log")
    raw = {n: df for n, df in derived_raw(spark, sf_dir).items() if n.startswith("MobileWebEditing")}
    for name, df in raw.items():
        df.write.parquet(f"{root}/{name}")
    return [(f"{root}/{name}", spark.read.parquet(f"{root}/{name}").schema) for name in raw]


_SUCCESS = "event_action = 'success' AND wiki <> 'testwiki'"


@register("streaming_edit_versions", covers="streaming U-01 S-06: repeated rows of two versions removed before they are counted", oracle=f"""
WITH {_EDITS_CTE}
SELECT day AS bucket, COUNT(*) AS total, CAST(SUM(CASE WHEN event_namespace = 0 THEN 1 ELSE 0 END) AS BIGINT) AS main
FROM parsed WHERE {_SUCCESS} GROUP BY 1
""")
def streaming_edit_versions(spark, sf_dir):
    sink = scratch_dir(spark, "stream")
    streaming_version_counts(spark, _streamed(spark, sf_dir), PROJECTIONS["edits_web"], {"main": F.col("event_namespace") == 0},
                             sink, scratch_dir(spark, "stream-log"), where=F.expr(_SUCCESS))
    return spark.read.parquet(sink).select("bucket", "total", "main")


@register("streaming_distinct_editors", covers="streaming A-06: distinct editors per day over two versions", oracle=f"""
WITH {_EDITS_CTE}
SELECT day AS bucket, COUNT(DISTINCT CASE WHEN event_namespace = 0 THEN event_username END) AS main,
  COUNT(DISTINCT CASE WHEN event_namespace <> 0 THEN event_username END) AS other
FROM parsed WHERE {_SUCCESS} GROUP BY 1
""")
def streaming_distinct_editors(spark, sf_dir):
    sink, ns = scratch_dir(spark, "stream"), F.col("event_namespace")
    streaming_distinct_users(spark, _streamed(spark, sf_dir), PROJECTIONS["edits_web"], "event_username", {"main": ns == 0, "other": ns != 0},
                             sink, scratch_dir(spark, "stream-log"), where=F.expr(_SUCCESS))
    return spark.read.parquet(sink).select("bucket", "main", "other")
