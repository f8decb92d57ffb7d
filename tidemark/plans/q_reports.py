"""Reports of the catalogue run on raw tables that Spark derives from the
driver's ``events`` table.

The derived tables have the reports' raw shape: 14-digit text timestamps,
several overlapping schema versions (so the ``UNION`` dedup is exercised),
hyphenated columns. Each registered query then runs the report itself --
logical tables, parsing, pushed text ranges, the report's operators -- over
the whole event table, and its DuckDB twin derives the same tables in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import format_ts14
from ..sources.logical import logical_tables
from .catalog import register, table
from .reports import DIFF_EVENTS, OPTIONS, UI_EVENTS, WATCHLIST_EVENTS, _key, run_report

AS_OF = "2024-01-30"
STARTS = "2024-01-01"
OLD_BEFORE, NEW_FROM = "2024-01-20", "2024-01-10"   # overlapping edit-log versions

# Fixed mapping used to derive click names from event types.
CLICK_NAMES = {"click": "hamburger", "view": "search", "signup": "hamburger-login",
               "error": "diff-thank", "purchase": "page-toc-link"}


def _case(col: str, mapping: dict, default=None):
    out = None
    for k, v in mapping.items():
        cond = F.col(col) == k
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def _sql_case(col: str, mapping: dict) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def derived_raw(spark, sf_dir) -> dict:
    ev = table(spark, sf_dir, "events")
    text = format_ts14("ts").alias("timestamp")
    v, t = F.col("value"), F.col("event_type")
    raw = {"MobileWebClickTracking_5929948": ev.select(text, _case("event_type", CLICK_NAMES).alias("event_name"))}
    edits = ev.select(
        "ts", text,
        F.when(v >= 400, "testwiki").otherwise("enwiki").alias("wiki"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("event_username"),
        F.when(t.isin("click", "view", "purchase"), "success").when(t == "error", "error")
         .otherwise("init").alias("event_action"),
        F.when(v < 30, 0).when(v < 60, 1).otherwise(2).alias("event_namespace"),
        F.when(t == "view", 0).otherwise(3).cast("bigint").alias("event_userEditCount"))
    old = edits.where(F.col("ts") < F.lit(f"{OLD_BEFORE} 00:00:00").cast("timestamp_ntz")).drop("ts")
    new = edits.where(F.col("ts") >= F.lit(f"{NEW_FROM} 00:00:00").cast("timestamp_ntz")).drop("ts")
    raw["MobileWebEditing_5644223"], raw["MobileWebEditing_6077315"] = old, new
    raw["MobileAppCategorizationAttempts_5359208"] = ev.select(
        text, F.lit("commonswiki").alias("wiki"),
        F.when(t.isin("click", "view"), "Android 4.4").when(t == "purchase", "iOS 7").alias("event_platform"),
        (F.floor(v / 50) + 1).cast("bigint").alias("event_files-count"),
        F.when(t.isin("view", "error"), 0).otherwise(1).cast("bigint").alias("event_categories-count"))
    return raw


def derived_tables(spark, sf_dir) -> dict:
    return logical_tables(derived_raw(spark, sf_dir))


_TEXT = "strftime(ts, '%Y%m%d%H%M%S')"
_PARSED = f"strptime({_TEXT}, '%Y%m%d%H%M%S')"

_EDITS_CTE = f"""
e AS (
  SELECT ts, {_TEXT} AS timestamp,
    CASE WHEN value >= 400 THEN 'testwiki' ELSE 'enwiki' END AS wiki,
    'user' || CAST(user_id AS VARCHAR) AS event_username,
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'success'
         WHEN event_type = 'error' THEN 'error' ELSE 'init' END AS event_action,
    CASE WHEN value < 30 THEN 0 WHEN value < 60 THEN 1 ELSE 2 END AS event_namespace,
    CAST(CASE WHEN event_type = 'view' THEN 0 ELSE 3 END AS BIGINT) AS event_userEditCount
  FROM events),
edits_web AS (
  SELECT DISTINCT * FROM (
    SELECT timestamp, wiki, event_username, event_action, event_namespace, event_userEditCount
    FROM e WHERE ts < TIMESTAMP '{OLD_BEFORE} 00:00:00'
    UNION
    SELECT timestamp, wiki, event_username, event_action, event_namespace, event_userEditCount
    FROM e WHERE ts >= TIMESTAMP '{NEW_FROM} 00:00:00')),
parsed AS (SELECT *, CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE) AS day FROM edits_web),
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d))"""


_UI_METRICS = [(_key(label), name) for label, name in UI_EVENTS]


@register("report_ui_daily", covers="R-30 via run_report: closed day windows over 14-digit text, 20 names",
          oracle=f"""
WITH clicks AS (
  SELECT {_PARSED} AS t, {_sql_case('event_type', CLICK_NAMES)} AS event_name FROM events),
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d))
SELECT s.bucket,
  {', '.join(f"CAST(SUM(CASE WHEN c.t IS NULL THEN NULL WHEN c.event_name = '{n}' THEN 1 ELSE 0 END) AS BIGINT) AS {k}" for k, n in _UI_METRICS)}
FROM spine s LEFT JOIN clicks c ON c.t >= s.bucket AND c.t <= s.bucket + INTERVAL 1 DAY
GROUP BY s.bucket
""")
def report_ui_daily(spark, sf_dir):
    return run_report(derived_tables(spark, sf_dir), "ui-daily", AS_OF, starts=STARTS)


@register("report_successful_edits_main", covers="R-07 via run_report: union distinct of edit-log versions",
          oracle=f"""
WITH {_EDITS_CTE}
SELECT s.bucket, CAST(COUNT(p.day) AS BIGINT) AS web
FROM spine s LEFT JOIN parsed p ON p.day = s.bucket
  AND p.event_action = 'success' AND p.event_namespace = 0 AND p.wiki <> 'testwiki'
GROUP BY s.bucket
""")
def report_successful_edits_main(spark, sf_dir):
    return run_report(derived_tables(spark, sf_dir), "successful-edits-main", AS_OF)


@register("report_successful_edits_unique", covers="R-09 via run_report: distinct editors per day",
          oracle=f"""
WITH {_EDITS_CTE}
SELECT s.bucket, CAST(COUNT(DISTINCT p.event_username) AS BIGINT) AS web
FROM spine s LEFT JOIN parsed p ON p.day = s.bucket
  AND p.event_action = 'success' AND p.event_namespace = 0 AND p.wiki <> 'testwiki'
GROUP BY s.bucket
""")
def report_successful_edits_unique(spark, sf_dir):
    return run_report(derived_tables(spark, sf_dir), "successful-edits-unique", AS_OF)


@register("report_no_cats", covers="R-24 via run_report: trailing 30-day share of files without category",
          oracle=f"""
WITH c AS (
  SELECT CAST({_PARSED} AS DATE) AS day,
    CASE WHEN event_type IN ('click', 'view') THEN 'Android 4.4'
         WHEN event_type = 'purchase' THEN 'iOS 7' END AS event_platform,
    CAST(floor(value / 50) + 1 AS BIGINT) AS files,
    CAST(CASE WHEN event_type IN ('view', 'error') THEN 0 ELSE 1 END AS BIGINT) AS cats
  FROM events),
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d))
SELECT s.bucket, ROUND(
  (SELECT SUM(files) FROM c WHERE event_platform LIKE 'Android%' AND cats = 0
     AND c.day < s.bucket AND c.day >= s.bucket - 30)
  / NULLIF((SELECT SUM(files) FROM c WHERE event_platform LIKE 'Android%'
     AND c.day < s.bucket AND c.day >= s.bucket - 30), 0), 6) AS android
FROM spine s
""")
def report_no_cats(spark, sf_dir):
    out = run_report(derived_tables(spark, sf_dir), "no-cats", AS_OF)
    return out.select("bucket", F.round("android", 6).alias("android"))


def derived_wiki(spark, sf_dir) -> dict:
    """Wiki-side tables from events: signups are the user-creation log and
    the account-creation events, clicks the revisions, purchases the archive."""
    ev = table(spark, sf_dir, "events")
    text = format_ts14("ts")
    t, v = F.col("event_type"), F.col("value")
    signups = ev.where(t == "signup")
    raw = {
        "logging": signups.select(
            F.col("event_id").alias("log_id"), F.lit("newusers").alias("log_type"),
            F.lit("create").alias("log_action"), F.lit(2).alias("log_namespace"),
            F.concat(F.lit("User"), F.col("user_id").cast("string")).alias("log_title"),
            F.col("user_id").alias("log_user"), text.alias("log_timestamp")),
        "revision": ev.where(t == "click").select(F.col("user_id").alias("rev_user"), text.alias("rev_timestamp")),
        "archive": ev.where(t == "purchase").select(F.col("user_id").alias("ar_user"), text.alias("ar_timestamp")),
        "ServerSideAccountCreation_5487345": signups.select(
            text.alias("timestamp"), F.lit("enwiki").alias("wiki"), F.col("props").alias("useragent"),
            F.col("user_id").alias("event_userId"),
            F.when(v > 50, 1).when(v > 40, None).otherwise(0).alias("event_displaymobile")),
    }
    return logical_tables(raw)


@register("report_edits_new_active", covers="R-28 via run_report: rolling 30-day new-and-active cohort",
          oracle=f"""
WITH ends AS (
  SELECT CAST(d AS TIMESTAMP) + INTERVAL 1 DAY AS t, CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) g(d)),
ev AS (SELECT user_id, {_PARSED} AS t, event_type, value, props FROM events),
u AS (
  SELECT DISTINCT e.bucket, x.user_id FROM ends e JOIN ev x
    ON x.event_type = 'signup' AND x.t BETWEEN e.t - INTERVAL 30 DAY AND e.t),
per_table AS (
  SELECT e.bucket, x.user_id, COUNT(*) AS c FROM ends e JOIN ev x
    ON x.event_type = 'click' AND x.t BETWEEN e.t - INTERVAL 30 DAY AND e.t
  WHERE (e.bucket, x.user_id) IN (SELECT bucket, user_id FROM u) GROUP BY 1, 2
  UNION ALL
  SELECT e.bucket, x.user_id, COUNT(*) AS c FROM ends e JOIN ev x
    ON x.event_type = 'purchase' AND x.t BETWEEN e.t - INTERVAL 30 DAY AND e.t
  WHERE (e.bucket, x.user_id) IN (SELECT bucket, user_id FROM u) GROUP BY 1, 2),
active AS (SELECT bucket, user_id FROM per_table GROUP BY 1, 2 HAVING SUM(c) >= 5),
acc AS (
  SELECT user_id, t, CASE WHEN value > 50 THEN 1 WHEN value > 40 THEN NULL ELSE 0 END AS flag
  FROM ev WHERE event_type = 'signup' AND (props IS NULL OR props NOT LIKE '%WikipediaApp%')),
j AS (
  SELECT x.bucket, a.flag FROM active x JOIN ends e ON e.bucket = x.bucket
  JOIN acc a ON a.user_id = x.user_id
   AND a.t BETWEEN e.t - INTERVAL 31 DAY AND e.t + INTERVAL 1 DAY),
agg AS (
  SELECT bucket, SUM(CASE WHEN flag = 1 THEN 1 ELSE 0 END) AS mobile,
         SUM(CASE WHEN flag <> 1 THEN 1 ELSE 0 END) AS desktop
  FROM j GROUP BY 1)
SELECT e.bucket, CAST(a.mobile AS BIGINT) AS mobile, CAST(a.desktop AS BIGINT) AS desktop
FROM ends e LEFT JOIN agg a ON e.bucket = a.bucket
""")
def report_edits_new_active(spark, sf_dir):
    return run_report(derived_wiki(spark, sf_dir), "edits-monthly-new-active", AS_OF, starts=STARTS)


# -- uploads, app edits, deletions ------------------------------------------

def _item(v):
    return F.floor(v).cast("bigint").cast("string")


def derived_uploads(spark, sf_dir) -> dict:
    """Upload logs in two overlapping versions (the older lacks
    ``event_multiple``), web uploads in two versions, app edits, and the
    upload/delete log with its tags -- all from events."""
    ev = table(spark, sf_dir, "events")
    text = format_ts14("ts").alias("timestamp")
    t, v = F.col("event_type"), F.col("value")
    old = F.col("ts") < F.lit(f"{OLD_BEFORE} 00:00:00").cast("timestamp_ntz")
    new = F.col("ts") >= F.lit(f"{NEW_FROM} 00:00:00").cast("timestamp_ntz")
    wiki = F.when(v >= 450, "testwiki").otherwise("commonswiki").alias("wiki")
    up = ev.select(
        "ts", F.col("event_id").alias("id"), F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("uuid"),
        F.lit("ip").alias("clientIp"), F.lit(0).alias("isTruncated"), F.lit(1).alias("clientValidated"),
        text, F.lit("h").alias("webHost"), wiki, F.lit("1").alias("event_appversion"),
        F.lit("d").alias("event_device"),
        F.concat(F.when(v < 200, F.lit("Item ")).otherwise(F.lit("File:Item ")), _item(v)).alias("event_filename"),
        F.when(v > 100, 1).otherwise(0).alias("event_multiple"),
        _case("event_type", {"click": "Android 4.4", "view": "iOS 7", "purchase": "Android 2.3"}, "web")
        .alias("event_platform"),
        F.when(t == "error", "error").when(v < 20, "cancelled").otherwise("success").alias("event_result"),
        F.lit("s").alias("event_source"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("event_username"))
    web = ev.select(
        "ts", text, wiki,
        F.when(t == "signup", "success").when(t == "error", "error").otherwise("start").alias("event_action"),
        F.lit("f").alias("event_funnel"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("event_username"))
    app = ev.select(
        text, F.when(v >= 450, "testwiki").otherwise("enwiki").alias("wiki"),
        F.when(v < 15, "Darwin/13").when(v < 30, "iPhone OS 7").when(v < 45, None)
        .otherwise("Mozilla Android").alias("userAgent"),
        _case("event_type", {"view": "start", "click": "preview", "purchase": "saveAttempt",
                             "signup": "saved"}, "other").alias("event_action"))
    log_up = ev.where(t == "signup").select(
        F.col("event_id").alias("log_id"), F.lit("upload").alias("log_type"), F.lit("upload").alias("log_action"),
        F.lit(6).alias("log_namespace"), F.concat(F.lit("Item_"), _item(v)).alias("log_title"),
        F.col("user_id").alias("log_user"), format_ts14("ts").alias("log_timestamp"))
    log_del = ev.where(t == "error").select(
        F.col("event_id").alias("log_id"), F.lit("delete").alias("log_type"), F.lit("delete").alias("log_action"),
        F.lit(6).alias("log_namespace"), F.concat(F.lit("Item_"), _item(v)).alias("log_title"),
        F.col("user_id").alias("log_user"), format_ts14("ts").alias("log_timestamp"))
    tags = ev.where(t == "signup").select(
        F.col("event_id").alias("ts_log_id"),
        F.when(v < 100, "mobile edit").otherwise("other").alias("ts_tags"))
    raw = {
        "MobileAppUploadAttempts_5257716": up.where(old).drop("ts", "event_multiple"),
        "MobileAppUploadAttempts_5334329": up.where(new).drop("ts"),
        "MobileWebUploads_5281063": web.where(old).drop("ts"),
        "MobileWebUploads_5383883": web.where(new).drop("ts"),
        "MobileWikiAppEdit_9003125": app,
        "logging": log_up.unionByName(log_del),
        "tag_summary": tags,
    }
    return logical_tables(raw)


_UPLOADS_CTE = f"""
up AS (
  SELECT ts, event_id AS id, 'u' || CAST(event_id AS VARCHAR) AS uuid, {_TEXT} AS timestamp,
    CASE WHEN value >= 450 THEN 'testwiki' ELSE 'commonswiki' END AS wiki,
    CASE WHEN value < 200 THEN 'Item ' ELSE 'File:Item ' END || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS event_filename,
    CASE WHEN value > 100 THEN 1 ELSE 0 END AS event_multiple,
    CASE event_type WHEN 'click' THEN 'Android 4.4' WHEN 'view' THEN 'iOS 7'
                    WHEN 'purchase' THEN 'Android 2.3' ELSE 'web' END AS event_platform,
    CASE WHEN event_type = 'error' THEN 'error' WHEN value < 20 THEN 'cancelled' ELSE 'success' END AS event_result,
    'user' || CAST(user_id AS VARCHAR) AS event_username
  FROM events),
upload_attempts AS (
  SELECT id, uuid, timestamp, wiki, event_filename, 0 AS event_multiple, event_platform, event_result, event_username
  FROM up WHERE ts < TIMESTAMP '{OLD_BEFORE} 00:00:00'
  UNION
  SELECT id, uuid, timestamp, wiki, event_filename, event_multiple, event_platform, event_result, event_username
  FROM up WHERE ts >= TIMESTAMP '{NEW_FROM} 00:00:00'),
w AS (
  SELECT ts, {_TEXT} AS timestamp, CASE WHEN value >= 450 THEN 'testwiki' ELSE 'commonswiki' END AS wiki,
    CASE WHEN event_type = 'signup' THEN 'success' WHEN event_type = 'error' THEN 'error' ELSE 'start' END AS event_action,
    'user' || CAST(user_id AS VARCHAR) AS event_username
  FROM events),
upload_web AS (
  SELECT timestamp, wiki, event_action, event_username FROM w WHERE ts < TIMESTAMP '{OLD_BEFORE} 00:00:00'
  UNION
  SELECT timestamp, wiki, event_action, event_username FROM w WHERE ts >= TIMESTAMP '{NEW_FROM} 00:00:00')"""


@register("report_successful_uploads", covers="R-20 via run_report: two logical tables, version fill + dedup, dense total",
          oracle=f"""
WITH {_UPLOADS_CTE},
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d)),
apps AS (
  SELECT CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE) AS bucket,
    SUM(CASE WHEN event_platform LIKE 'Android%' THEN 1 ELSE 0 END) AS android,
    SUM(CASE WHEN event_platform LIKE 'iOS%' THEN 1 ELSE 0 END) AS ios
  FROM upload_attempts WHERE event_result = 'success' AND wiki = 'commonswiki' GROUP BY 1),
web AS (
  SELECT CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE) AS bucket, COUNT(*) AS web
  FROM upload_web WHERE event_action = 'success' AND wiki <> 'testwiki' GROUP BY 1)
SELECT s.bucket,
  CAST(COALESCE(a.android, 0) + COALESCE(a.ios, 0) + COALESCE(w.web, 0) AS BIGINT) AS total,
  CAST(COALESCE(a.android, 0) AS BIGINT) AS android, CAST(COALESCE(a.ios, 0) AS BIGINT) AS ios,
  CAST(COALESCE(w.web, 0) AS BIGINT) AS web
FROM spine s LEFT JOIN apps a ON s.bucket = a.bucket LEFT JOIN web w ON s.bucket = w.bucket
""")
def report_successful_uploads(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "successful-uploads", AS_OF)


@register("report_app_edit_funnel_ios", covers="R-13 via run_report: user-agent rule, time-boxed funnel, zeros",
          oracle=f"""
WITH a AS (
  SELECT CAST({_PARSED} AS DATE) AS day,
    CASE WHEN value >= 450 THEN 'testwiki' ELSE 'enwiki' END AS wiki,
    CASE WHEN value < 15 THEN 'Darwin/13' WHEN value < 30 THEN 'iPhone OS 7' WHEN value < 45 THEN NULL
         ELSE 'Mozilla Android' END AS useragent,
    CASE event_type WHEN 'view' THEN 'start' WHEN 'click' THEN 'preview' WHEN 'purchase' THEN 'saveAttempt'
                    WHEN 'signup' THEN 'saved' ELSE 'other' END AS event_action
  FROM events),
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d)),
agg AS (
  SELECT day AS bucket,
    SUM(CASE WHEN event_action = 'start' THEN 1 ELSE 0 END) AS start,
    SUM(CASE WHEN event_action = 'preview' THEN 1 ELSE 0 END) AS preview,
    SUM(CASE WHEN event_action = 'saveAttempt' THEN 1 ELSE 0 END) AS saveattempt,
    SUM(CASE WHEN event_action = 'saved' THEN 1 ELSE 0 END) AS saved
  FROM a WHERE (useragent LIKE '%Darwin%' OR useragent LIKE '%iPhone OS%') AND wiki <> 'testwiki'
  GROUP BY 1)
SELECT s.bucket, CAST(COALESCE(g.start, 0) AS BIGINT) AS start, CAST(COALESCE(g.preview, 0) AS BIGINT) AS preview,
  CAST(COALESCE(g.saveattempt, 0) AS BIGINT) AS saveattempt, CAST(COALESCE(g.saved, 0) AS BIGINT) AS saved
FROM spine s LEFT JOIN agg g ON s.bucket = g.bucket
""")
def report_app_edit_funnel_ios(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "app-edit-funnel-ios", AS_OF, starts=STARTS)


_NORM = ("CASE WHEN length({x}) > 0 THEN replace(replace(upper(substr({x}, 1, 1)) || substr({x}, 2), "
         "'File:', ''), ' ', '_') END")


@register("report_deleted_uploads", covers="R-25 via run_report: titles normalised across sources, semi-joined deletes",
          oracle=f"""
WITH {_UPLOADS_CTE},
logging AS (
  SELECT event_id AS log_id, CASE WHEN event_type = 'signup' THEN 'upload' ELSE 'delete' END AS log_action,
    6 AS log_namespace, 'Item_' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS log_title,
    CAST({_PARSED} AS DATE) AS day, value
  FROM events WHERE event_type IN ('signup', 'error')),
titles AS (
  SELECT DISTINCT CASE WHEN event_platform LIKE 'Android%' THEN 'Android' ELSE 'iOS' END AS tag,
    {_NORM.format(x='event_filename')} AS key
  FROM upload_attempts
  WHERE event_result = 'success' AND wiki = 'commonswiki'
    AND (event_platform LIKE 'Android%' OR event_platform LIKE 'iOS%')
  UNION
  SELECT 'Web' AS tag, {_NORM.format(x='log_title')} AS key
  FROM logging WHERE log_action = 'upload' AND value < 100),
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2023-02-01', DATE '2024-01-01', INTERVAL 1 MONTH) t(d)),
agg AS (
  SELECT CAST(date_trunc('month', l.day) AS DATE) AS bucket,
    SUM(CASE WHEN t.tag = 'Android' THEN 1 ELSE 0 END) AS android,
    SUM(CASE WHEN t.tag = 'iOS' THEN 1 ELSE 0 END) AS ios,
    SUM(CASE WHEN t.tag = 'Web' THEN 1 ELSE 0 END) AS web
  FROM logging l JOIN titles t ON l.log_title = t.key
  WHERE l.log_namespace = 6 AND l.log_action = 'delete' GROUP BY 1)
SELECT s.bucket, CAST(COALESCE(a.android, 0) AS BIGINT) AS android, CAST(COALESCE(a.ios, 0) AS BIGINT) AS ios,
  CAST(COALESCE(a.web, 0) AS BIGINT) AS web
FROM spine s LEFT JOIN agg a ON s.bucket = a.bucket
""")
def report_deleted_uploads(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "deleted-uploads", AS_OF)


# -- summaries, thresholds, blocks -------------------------------------------

def derived_summaries(spark, sf_dir) -> dict:
    """``derived_uploads`` plus category links (click/view/signup events as
    members of the three upload categories), new-editor edits, blocks (error
    events) and account creations (signup events, two wikis)."""
    tables = derived_uploads(spark, sf_dir)
    ev = table(spark, sf_dir, "events")
    t, v = F.col("event_type"), F.col("value")
    cats = {"click": "Uploaded_with_Mobile/Android", "view": "Uploaded_with_Mobile/iOS",
            "signup": "Uploaded_with_Mobile/Web"}
    raw = {
        "categorylinks": ev.where(v < 300).select(F.col("event_id").alias("cl_from"),
                                                  _case("event_type", cats, "Other").alias("cl_to")),
        "NewEditorEdit_6792669": ev.select(
            format_ts14("ts").alias("timestamp"), F.col("user_id").alias("event_userID"),
            F.when(t.isin("click", "view"), 1).otherwise(0).alias("event_isMobile"),
            (v * 10000).cast("bigint").alias("event_userAge")),
        "ipblocks": ev.where(t == "error").select(F.col("user_id").alias("ipb_user"),
                                                  format_ts14("ts").alias("ipb_timestamp")),
        "ServerSideAccountCreation_5487345": ev.where(t == "signup").select(
            format_ts14("ts").alias("timestamp"), F.when(v < 250, "enwiki").otherwise("dewiki").alias("wiki"),
            F.col("props").alias("useragent"), F.col("user_id").alias("event_userId"),
            F.lit(0).alias("event_displaymobile")),
    }
    tables.update(logical_tables(raw))
    return tables


@register("report_alltime_numbers", covers="R-23 via run_report: totals less fixed corrections, category members, '%.2f'",
          oracle=f"""
WITH {_UPLOADS_CTE},
totals AS (
  SELECT CASE WHEN event_platform LIKE 'Android%' THEN 'Android' ELSE 'iOS' END AS source, COUNT(*) AS n
  FROM upload_attempts WHERE event_result = 'success' AND wiki = 'commonswiki'
    AND (event_platform LIKE 'Android%' OR event_platform LIKE 'iOS%') GROUP BY 1
  UNION ALL
  SELECT 'Web', COUNT(*) FROM upload_web WHERE event_action = 'success' AND wiki <> 'testwiki'),
cats AS (
  SELECT CASE event_type WHEN 'click' THEN 'Android' WHEN 'view' THEN 'iOS' WHEN 'signup' THEN 'Web' END AS source,
    COUNT(*) AS undeleted
  FROM events WHERE value < 300 AND event_type IN ('click', 'view', 'signup') GROUP BY 1),
corr AS (SELECT * FROM (VALUES ('Android', 105), ('iOS', 47), ('Web', 0)) c(source, correction)),
r AS (
  SELECT t.source, t.n - COALESCE(c.correction, 0) AS total, COALESCE(k.undeleted, 0) AS undeleted
  FROM totals t LEFT JOIN corr c ON t.source = c.source LEFT JOIN cats k ON t.source = k.source)
SELECT source, CAST(total AS BIGINT) AS total, CAST(undeleted AS BIGINT) AS undeleted,
  printf('%.2f', CAST(total - undeleted AS DOUBLE) / NULLIF(total, 0)) AS deletion_percentage
FROM r
""")
def report_alltime_numbers(spark, sf_dir):
    return run_report(derived_summaries(spark, sf_dir), "alltime-numbers", AS_OF)


@register("report_error_correction", covers="R-35 via run_report: titles claimed vs uploads found, three rows",
          oracle=f"""
WITH {_UPLOADS_CTE},
claimed AS (
  SELECT CASE WHEN event_platform LIKE 'Android%' THEN 'Android' ELSE 'iOS' END AS source,
    {_NORM.format(x='event_filename')} AS key
  FROM upload_attempts WHERE event_result = 'success' AND wiki = 'commonswiki'
    AND (event_platform LIKE 'Android%' OR event_platform LIKE 'iOS%')),
uploads AS (
  SELECT 'Item_' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS log_title FROM events WHERE event_type = 'signup'),
c AS (SELECT source, COUNT(*) AS v FROM claimed WHERE key IS NOT NULL GROUP BY 1),
f AS (
  SELECT k.source, COUNT(*) AS v FROM uploads u
  JOIN (SELECT DISTINCT source, key FROM claimed WHERE key IS NOT NULL) k ON u.log_title = k.key GROUP BY 1),
rows AS (
  SELECT 'Total on EL' AS label, source, v FROM c
  UNION ALL SELECT 'Uploaded on Commons', source, v FROM f
  UNION ALL SELECT 'Difference', c.source, c.v - COALESCE(f.v, 0) FROM c LEFT JOIN f ON c.source = f.source)
SELECT label,
  CAST(COALESCE(SUM(CASE WHEN source = 'Android' THEN v END), 0) AS BIGINT) AS android,
  CAST(COALESCE(SUM(CASE WHEN source = 'iOS' THEN v END), 0) AS BIGINT) AS ios
FROM rows GROUP BY label
""")
def report_error_correction(spark, sf_dir):
    return run_report(derived_summaries(spark, sf_dir), "error-correction", AS_OF)


@register("report_active_2014", covers="R-34 via run_report: (user, flag) groups with more than 5 edits, per month",
          oracle=f"""
WITH n AS (
  SELECT CAST(date_trunc('month', {_PARSED}) AS DATE) AS bucket, user_id,
    CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS mobile, COUNT(*) AS c
  FROM events WHERE CAST(value * 10000 AS BIGINT) <= 2592000
  GROUP BY 1, 2, 3),
spine AS (SELECT DATE '2024-01-01' AS bucket)
SELECT s.bucket,
  CAST(SUM(CASE WHEN n.mobile = 1 THEN 1 ELSE 0 END) AS BIGINT) AS mobileedits,
  CAST(SUM(CASE WHEN n.mobile = 0 THEN 1 ELSE 0 END) AS BIGINT) AS desktopedits
FROM spine s LEFT JOIN n ON n.bucket = s.bucket AND n.c > 5
GROUP BY s.bucket
""")
def report_active_2014(spark, sf_dir):
    return run_report(derived_summaries(spark, sf_dir), "edits-monthly-active-2014", AS_OF, starts=STARTS)


@register("report_app_user_blocks", covers="R-18 via run_report: blocks x enwiki account rows, fan-out kept",
          oracle=f"""
WITH b AS (SELECT user_id, CAST({_PARSED} AS DATE) AS day FROM events WHERE event_type = 'error'),
a AS (SELECT user_id FROM events WHERE event_type = 'signup' AND value < 250)
SELECT b.day AS bucket, COUNT(*) AS numblocks
FROM b JOIN a ON b.user_id = a.user_id
WHERE b.day BETWEEN DATE '{STARTS}' AND DATE '{AS_OF}'
GROUP BY 1
""")
def report_app_user_blocks(spark, sf_dir):
    return run_report(derived_summaries(spark, sf_dir), "app-user-blocks-en", AS_OF, starts=STARTS)


# -- thanks, app-edit counts, error uploads, uploader experience -------------

def derived_more(spark, sf_dir) -> dict:
    """``derived_uploads`` plus thanks notifications and a user table (users
    with signups of value < 5, edit count = those signups; the others are
    missing from it, as unknown users are)."""
    tables = derived_uploads(spark, sf_dir)
    ev = table(spark, sf_dir, "events")
    t, v = F.col("event_type"), F.col("value")
    raw = {
        "Echo_7731316": ev.select(
            format_ts14("ts").alias("timestamp"),
            F.when(t.isin("click", "view", "purchase"), "edit-thank").otherwise("mention")
            .alias("event_notificationType"),
            F.when(v < 30, "history").when(v < 60, "diff").when(v < 90, "mobilediff").otherwise("other")
            .alias("event_eventSource")),
        "user": ev.where((t == "signup") & (v < 5))
        .groupBy(F.concat(F.lit("User"), F.col("user_id").cast("string")).alias("user_name"))
        .agg(F.count(F.lit(1)).alias("user_editcount")),
    }
    tables.update(logical_tables(raw))
    return tables


_THANKS = {"desktophistory": "history", "desktopdiffthanks": "diff", "mobilediffthanks": "mobilediff"}


@register("report_thanks_daily", covers="R-29 via run_report: closed windows, COALESCE to zero", oracle=f"""
WITH th AS (
  SELECT {_PARSED} AS t,
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'edit-thank' ELSE 'mention' END AS kind,
    CASE WHEN value < 30 THEN 'history' WHEN value < 60 THEN 'diff' WHEN value < 90 THEN 'mobilediff'
         ELSE 'other' END AS src
  FROM events),
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d))
SELECT s.bucket,
  {', '.join(f"CAST(COALESCE(SUM(CASE WHEN th.t IS NULL THEN NULL WHEN th.src = '{v}' THEN 1 ELSE 0 END), 0) AS BIGINT) AS {k}" for k, v in _THANKS.items())}
FROM spine s LEFT JOIN th ON th.kind = 'edit-thank'
  AND th.t >= s.bucket AND th.t <= s.bucket + INTERVAL 1 DAY
GROUP BY s.bucket
""")
def report_thanks_daily(spark, sf_dir):
    return run_report(derived_more(spark, sf_dir), "thanks-daily", AS_OF, starts=STARTS)


@register("report_app_edits_starts", covers="R-14 via run_report: time-boxed, empty days omitted", oracle=f"""
WITH a AS (
  SELECT CAST({_PARSED} AS DATE) AS day,
    CASE WHEN value >= 450 THEN 'testwiki' ELSE 'enwiki' END AS wiki,
    CASE WHEN value < 15 THEN 'Darwin/13' WHEN value < 30 THEN 'iPhone OS 7' WHEN value < 45 THEN NULL
         ELSE 'Mozilla Android' END AS useragent,
    CASE event_type WHEN 'view' THEN 'start' WHEN 'click' THEN 'preview' WHEN 'purchase' THEN 'saveAttempt'
                    WHEN 'signup' THEN 'saved' ELSE 'other' END AS event_action
  FROM events)
SELECT day AS bucket, COUNT(*) AS total,
  CAST(SUM(CASE WHEN useragent LIKE '%Android%' THEN 1 ELSE 0 END) AS BIGINT) AS android,
  CAST(SUM(CASE WHEN useragent LIKE '%Darwin%' OR useragent LIKE '%iPhone OS%' THEN 1 ELSE 0 END) AS BIGINT) AS ios
FROM a WHERE event_action = 'start' AND wiki <> 'testwiki'
  AND day BETWEEN DATE '{STARTS}' AND DATE '{AS_OF}'
GROUP BY 1
""")
def report_app_edits_starts(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "app-edits-starts", AS_OF, starts=STARTS)


@register("report_error_uploads", covers="R-05 via run_report: result <> cancelled and <> success, two tables",
          oracle=f"""
WITH {_UPLOADS_CTE},
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d)),
apps AS (
  SELECT CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE) AS bucket,
    SUM(CASE WHEN event_platform LIKE 'Android%' THEN 1 ELSE 0 END) AS android,
    SUM(CASE WHEN event_platform LIKE 'iOS%' THEN 1 ELSE 0 END) AS ios
  FROM upload_attempts
  WHERE event_result <> 'cancelled' AND event_result <> 'success' AND wiki = 'commonswiki' GROUP BY 1),
web AS (
  SELECT CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE) AS bucket, COUNT(*) AS web
  FROM upload_web WHERE event_action = 'error' AND wiki <> 'testwiki' GROUP BY 1)
SELECT s.bucket,
  CAST(COALESCE(a.android, 0) + COALESCE(a.ios, 0) + COALESCE(w.web, 0) AS BIGINT) AS total,
  CAST(COALESCE(a.android, 0) AS BIGINT) AS android, CAST(COALESCE(a.ios, 0) AS BIGINT) AS ios,
  CAST(COALESCE(w.web, 0) AS BIGINT) AS web
FROM spine s LEFT JOIN apps a ON s.bucket = a.bucket LEFT JOIN web w ON s.bucket = w.bucket
""")
def report_error_uploads(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "error-uploads", AS_OF)


@register("report_uploaders_experience", covers="R-22 via run_report: uploads per normalised user, edit count or 0",
          oracle=f"""
WITH {_UPLOADS_CTE},
per_user AS (
  SELECT CASE WHEN event_platform LIKE 'iOS%' THEN 'iOS' ELSE 'Android' END AS source,
    upper(substr(trim(event_username), 1, 1)) || substr(trim(event_username), 2) AS user_key, COUNT(*) AS uploads
  FROM upload_attempts WHERE event_result = 'success' AND wiki = 'commonswiki'
    AND (event_platform LIKE 'iOS%' OR event_platform LIKE 'Android%')
  GROUP BY 1, 2),
users AS (
  SELECT 'User' || CAST(user_id AS VARCHAR) AS user_key, COUNT(*) AS edits
  FROM events WHERE event_type = 'signup' AND value < 5 GROUP BY 1)
SELECT p.source, p.uploads, CAST(COALESCE(u.edits, 0) AS BIGINT) AS edits
FROM per_user p LEFT JOIN users u ON p.user_key = u.user_key
""")
def report_uploaders_experience(spark, sf_dir):
    return run_report(derived_more(spark, sf_dir), "uploaders-experience", AS_OF)


_APPS_OK = "event_result = 'success' AND wiki = 'commonswiki'"
_WEB_OK = "event_action = 'success' AND wiki <> 'testwiki'"
_DAY = "CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE)"
_MONTH = "CAST(date_trunc('month', strptime(timestamp, '%Y%m%d%H%M%S')) AS DATE)"


@register("report_unique_uploaders_day", covers="R-02 via run_report: distinct uploaders per platform, total = sum",
          oracle=f"""
WITH {_UPLOADS_CTE},
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d)),
apps AS (
  SELECT {_DAY} AS bucket,
    COUNT(DISTINCT CASE WHEN event_platform LIKE 'Android%' THEN event_username END) AS android,
    COUNT(DISTINCT CASE WHEN event_platform LIKE 'iOS%' THEN event_username END) AS ios
  FROM upload_attempts WHERE {_APPS_OK} GROUP BY 1),
web AS (SELECT {_DAY} AS bucket, COUNT(DISTINCT event_username) AS web FROM upload_web WHERE {_WEB_OK} GROUP BY 1)
SELECT s.bucket,
  CAST(COALESCE(a.android, 0) + COALESCE(a.ios, 0) + COALESCE(w.web, 0) AS BIGINT) AS total,
  CAST(COALESCE(a.android, 0) AS BIGINT) AS android, CAST(COALESCE(a.ios, 0) AS BIGINT) AS ios,
  CAST(COALESCE(w.web, 0) AS BIGINT) AS web
FROM spine s LEFT JOIN apps a ON s.bucket = a.bucket LEFT JOIN web w ON s.bucket = w.bucket
""")
def report_unique_uploaders_day(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "unique-uploaders-day", AS_OF)


@register("report_month_uploads", covers="R-03 via run_report: 12-month calendar of uploads per platform",
          oracle=f"""
WITH {_UPLOADS_CTE},
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2023-02-01', DATE '2024-01-01', INTERVAL 1 MONTH) t(d)),
apps AS (
  SELECT {_MONTH} AS bucket,
    SUM(CASE WHEN event_platform LIKE 'Android%' THEN 1 ELSE 0 END) AS android,
    SUM(CASE WHEN event_platform LIKE 'iOS%' THEN 1 ELSE 0 END) AS ios
  FROM upload_attempts WHERE {_APPS_OK} GROUP BY 1),
web AS (SELECT {_MONTH} AS bucket, COUNT(*) AS web FROM upload_web WHERE {_WEB_OK} GROUP BY 1)
SELECT s.bucket, CAST(COALESCE(a.android, 0) AS BIGINT) AS android, CAST(COALESCE(a.ios, 0) AS BIGINT) AS ios,
  CAST(COALESCE(w.web, 0) AS BIGINT) AS web
FROM spine s LEFT JOIN apps a ON s.bucket = a.bucket LEFT JOIN web w ON s.bucket = w.bucket
""")
def report_month_uploads(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "month-uploads", AS_OF)


@register("report_cancelled_uploads", covers="R-04 via run_report: sparse daily counts, total over all platforms",
          oracle=f"""
WITH {_UPLOADS_CTE}
SELECT {_DAY} AS bucket, COUNT(*) AS total,
  CAST(SUM(CASE WHEN event_platform LIKE 'Android%' THEN 1 ELSE 0 END) AS BIGINT) AS android,
  CAST(SUM(CASE WHEN event_platform LIKE 'iOS%' THEN 1 ELSE 0 END) AS BIGINT) AS ios
FROM upload_attempts WHERE event_result = 'cancelled' AND wiki = 'commonswiki'
GROUP BY 1
""")
def report_cancelled_uploads(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "cancelled-uploads", AS_OF)


@register("report_monthly_unique_editors", covers="R-26 via run_report: distinct editors per month, main vs other",
          oracle=f"""
WITH {_EDITS_CTE},
months AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2023-02-01', DATE '2024-01-01', INTERVAL 1 MONTH) t(d)),
agg AS (
  SELECT CAST(date_trunc('month', day) AS DATE) AS bucket,
    COUNT(DISTINCT CASE WHEN event_namespace = 0 THEN event_username END) AS main,
    COUNT(DISTINCT CASE WHEN event_namespace <> 0 THEN event_username END) AS other
  FROM parsed WHERE event_action = 'success' AND wiki <> 'testwiki' GROUP BY 1)
SELECT m.bucket, CAST(COALESCE(a.main, 0) AS BIGINT) AS main, CAST(COALESCE(a.other, 0) AS BIGINT) AS other
FROM months m LEFT JOIN agg a ON m.bucket = a.bucket
""")
def report_monthly_unique_editors(spark, sf_dir):
    return run_report(derived_tables(spark, sf_dir), "edits-monthly-unique-editors", AS_OF)


# -- the remaining web-edit reports (R-06, R-08, R-10, R-27) -----------------

def _web_daily_sql(where: str) -> str:
    return f"""
WITH {_EDITS_CTE}
SELECT s.bucket, CAST(COUNT(p.day) AS BIGINT) AS web
FROM spine s LEFT JOIN parsed p ON p.day = s.bucket AND {where}
GROUP BY s.bucket
"""


_OK_WEB = "p.event_action = 'success' AND p.wiki <> 'testwiki'"


@register("report_successful_edits_newbie", covers="R-06 via run_report: first-time editors (edit count 0)",
          oracle=_web_daily_sql(f"{_OK_WEB} AND p.event_userEditCount = 0"))
def report_successful_edits_newbie(spark, sf_dir):
    return run_report(derived_tables(spark, sf_dir), "successful-edits-newbie", AS_OF)


@register("report_successful_edits_other", covers="R-08 via run_report: namespace <> 0 (NULL excluded)",
          oracle=_web_daily_sql(f"{_OK_WEB} AND p.event_namespace <> 0"))
def report_successful_edits_other(spark, sf_dir):
    return run_report(derived_tables(spark, sf_dir), "successful-edits-other", AS_OF)


@register("report_error_edits", covers="R-10 via run_report: failed edits per day",
          oracle=_web_daily_sql("p.event_action = 'error' AND p.wiki <> 'testwiki'"))
def report_error_edits(spark, sf_dir):
    return run_report(derived_tables(spark, sf_dir), "error-edits", AS_OF)


@register("report_monthly_successful_edits", covers="R-27 via run_report: monthly counts, main vs other",
          oracle=f"""
WITH {_EDITS_CTE},
months AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2023-02-01', DATE '2024-01-01', INTERVAL 1 MONTH) t(d)),
agg AS (
  SELECT CAST(date_trunc('month', day) AS DATE) AS bucket,
    SUM(CASE WHEN event_namespace = 0 THEN 1 ELSE 0 END) AS main,
    SUM(CASE WHEN event_namespace <> 0 THEN 1 ELSE 0 END) AS other
  FROM parsed WHERE event_action = 'success' AND wiki <> 'testwiki' GROUP BY 1)
SELECT m.bucket, CAST(COALESCE(a.main, 0) AS BIGINT) AS main, CAST(COALESCE(a.other, 0) AS BIGINT) AS other
FROM months m LEFT JOIN agg a ON m.bucket = a.bucket
""")
def report_monthly_successful_edits(spark, sf_dir):
    return run_report(derived_tables(spark, sf_dir), "edits-monthly-successful", AS_OF)


# -- the remaining app-edit reports (R-11, R-12, R-15, R-16, R-17) -----------

_APP_CTE = f"""
a AS (
  SELECT CAST({_PARSED} AS DATE) AS day,
    CASE WHEN value >= 450 THEN 'testwiki' ELSE 'enwiki' END AS wiki,
    CASE WHEN value < 15 THEN 'Darwin/13' WHEN value < 30 THEN 'iPhone OS 7' WHEN value < 45 THEN NULL
         ELSE 'Mozilla Android' END AS useragent,
    CASE event_type WHEN 'view' THEN 'start' WHEN 'click' THEN 'preview' WHEN 'purchase' THEN 'saveAttempt'
                    WHEN 'signup' THEN 'saved' ELSE 'other' END AS event_action
  FROM events)"""


def _funnel_sql(rule: str) -> str:
    return f"""
WITH {_APP_CTE},
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d)),
agg AS (
  SELECT day AS bucket,
    SUM(CASE WHEN event_action = 'start' THEN 1 ELSE 0 END) AS start,
    SUM(CASE WHEN event_action = 'preview' THEN 1 ELSE 0 END) AS preview,
    SUM(CASE WHEN event_action = 'saveAttempt' THEN 1 ELSE 0 END) AS saveattempt,
    SUM(CASE WHEN event_action = 'saved' THEN 1 ELSE 0 END) AS saved
  FROM a WHERE {rule} wiki <> 'testwiki' GROUP BY 1)
SELECT s.bucket, CAST(COALESCE(g.start, 0) AS BIGINT) AS start, CAST(COALESCE(g.preview, 0) AS BIGINT) AS preview,
  CAST(COALESCE(g.saveattempt, 0) AS BIGINT) AS saveattempt, CAST(COALESCE(g.saved, 0) AS BIGINT) AS saved
FROM spine s LEFT JOIN agg g ON s.bucket = g.bucket
"""


def _app_action_sql(action: str) -> str:
    return f"""
WITH {_APP_CTE}
SELECT day AS bucket, COUNT(*) AS total,
  CAST(SUM(CASE WHEN useragent LIKE '%Android%' THEN 1 ELSE 0 END) AS BIGINT) AS android,
  CAST(SUM(CASE WHEN useragent LIKE '%Darwin%' OR useragent LIKE '%iPhone OS%' THEN 1 ELSE 0 END) AS BIGINT) AS ios
FROM a WHERE event_action = '{action}' AND wiki <> 'testwiki'
  AND day BETWEEN DATE '{STARTS}' AND DATE '{AS_OF}'
GROUP BY 1
"""


@register("report_app_edit_funnel_total", covers="R-11 via run_report: all-apps funnel", oracle=_funnel_sql(""))
def report_app_edit_funnel_total(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "app-edit-funnel-total", AS_OF, starts=STARTS)


@register("report_app_edit_funnel_android", covers="R-12 via run_report: Android funnel",
          oracle=_funnel_sql("useragent LIKE '%Android%' AND"))
def report_app_edit_funnel_android(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "app-edit-funnel-android", AS_OF, starts=STARTS)


@register("report_app_edits_preview", covers="R-15 via run_report", oracle=_app_action_sql("preview"))
def report_app_edits_preview(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "app-edits-preview", AS_OF, starts=STARTS)


@register("report_app_edits_save_attempt", covers="R-16 via run_report", oracle=_app_action_sql("saveAttempt"))
def report_app_edits_save_attempt(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "app-edits-save-attempt", AS_OF, starts=STARTS)


@register("report_app_edits_success", covers="R-17 via run_report", oracle=_app_action_sql("saved"))
def report_app_edits_success(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "app-edits-success", AS_OF, starts=STARTS)


# -- the remaining click, option, login and share reports --------------------
# (R-31, R-33, R-32, R-19, R-21)

_CLICK2_SQL = """CASE
    WHEN event_type = 'purchase' AND value < 20 THEN 'watchlist-a-z-more'
    WHEN event_type = 'purchase' AND value < 40 THEN 'watchlist-feed-view'
    WHEN event_type = 'purchase' AND value < 60 THEN 'watchlist-a-z-unwatch'
    WHEN event_type = 'error' AND value < 30 THEN 'diff-thank'
    WHEN event_type = 'error' AND value < 60 THEN 'diff-view'
    WHEN event_type = 'error' THEN 'diff-user'
    WHEN event_type = 'click' THEN 'watchlist-feed-filter'
    ELSE 'unknown-event' END"""
_PLATFORM_SQL = ("CASE event_type WHEN 'click' THEN 'Android 4.4' WHEN 'view' THEN 'iOS 7' "
                 "WHEN 'purchase' THEN 'Android 2.3' ELSE 'web' END")


def derived_tracking(spark, sf_dir) -> dict:
    ev = table(spark, sf_dir, "events")
    text = format_ts14("ts").alias("timestamp")
    t, v = F.col("event_type"), F.col("value")
    name = (F.when((t == "purchase") & (v < 20), "watchlist-a-z-more")
            .when((t == "purchase") & (v < 40), "watchlist-feed-view")
            .when((t == "purchase") & (v < 60), "watchlist-a-z-unwatch")
            .when((t == "error") & (v < 30), "diff-thank")
            .when((t == "error") & (v < 60), "diff-view")
            .when(t == "error", "diff-user")
            .when(t == "click", "watchlist-feed-filter")
            .otherwise("unknown-event"))
    platform = _case("event_type", {"click": "Android 4.4", "view": "iOS 7", "purchase": "Android 2.3"}, "web")
    raw = {
        "MobileWebClickTracking_5929948": ev.select(text, name.alias("event_name")),
        "MobileOptionsTracking_8101982": ev.select(
            text, F.when(v < 30, "on").when(v < 60, "off").alias("event_beta"),
            _case("event_type", {"click": "on", "view": "off"}, "x").alias("event_alpha"),
            F.when(v < 50, "on").otherwise("off").alias("event_images")),
        "MobileAppLoginAttempts_5257721": ev.select(
            text, F.when(v >= 450, "testwiki").otherwise("commonswiki").alias("wiki"),
            platform.alias("event_platform"),
            F.when(t == "error", "failure").otherwise("success").alias("event_result")),
        "MobileAppShareAttempts_5346170": ev.select(
            text, F.when(v >= 400, "enwiki").otherwise("commonswiki").alias("wiki"), platform.alias("event_platform")),
    }
    return logical_tables(raw)


def _closed_sql(src: str, metrics: list[tuple[str, str]]) -> str:
    """Closed day windows over a derived table ``src`` (columns t, ...);
    ``metrics`` are (output name, SQL predicate)."""
    return f"""
WITH x AS ({src}),
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '{STARTS}', DATE '{AS_OF}', INTERVAL 1 DAY) t(d))
SELECT s.bucket,
  {', '.join(f"CAST(SUM(CASE WHEN x.t IS NULL THEN NULL WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT) AS {k}" for k, pred in metrics)}
FROM spine s LEFT JOIN x ON x.t >= s.bucket AND x.t <= s.bucket + INTERVAL 1 DAY
GROUP BY s.bucket
"""


_CLICKS2 = f"SELECT {_PARSED} AS t, {_CLICK2_SQL} AS event_name FROM events"


@register("report_watchlist_activity", covers="R-31 via run_report: closed windows, NULL on empty days",
          oracle=_closed_sql(_CLICKS2, [(_key(label), f"x.event_name = '{n}'") for label, n in WATCHLIST_EVENTS]))
def report_watchlist_activity(spark, sf_dir):
    return run_report(derived_tracking(spark, sf_dir), "watchlist-activity", AS_OF, starts=STARTS)


@register("report_diff_activity", covers="R-33 via run_report: closed windows, NULL on empty days",
          oracle=_closed_sql(_CLICKS2, [(_key(label), f"x.event_name = '{n}'") for label, n in DIFF_EVENTS]))
def report_diff_activity(spark, sf_dir):
    return run_report(derived_tracking(spark, sf_dir), "diff-activity", AS_OF, starts=STARTS)


_OPTIONS_SRC = f"""SELECT {_PARSED} AS t,
    CASE WHEN value < 30 THEN 'on' WHEN value < 60 THEN 'off' END AS event_beta,
    CASE event_type WHEN 'click' THEN 'on' WHEN 'view' THEN 'off' ELSE 'x' END AS event_alpha,
    CASE WHEN value < 50 THEN 'on' ELSE 'off' END AS event_images
  FROM events"""


@register("report_mobile_options", covers="R-32 via run_report: on/off counts of three columns, closed windows",
          oracle=_closed_sql(_OPTIONS_SRC, [(_key(label), f"x.{col} = '{val}'") for label, col, val in OPTIONS]))
def report_mobile_options(spark, sf_dir):
    return run_report(derived_tracking(spark, sf_dir), "mobile-options", AS_OF, starts=STARTS)


def _sparse_platform_sql(src: str, where: str) -> str:
    return f"""
WITH x AS ({src})
SELECT day AS bucket, COUNT(*) AS total,
  CAST(SUM(CASE WHEN event_platform LIKE 'Android%' THEN 1 ELSE 0 END) AS BIGINT) AS android,
  CAST(SUM(CASE WHEN event_platform LIKE 'iOS%' THEN 1 ELSE 0 END) AS BIGINT) AS ios
FROM x WHERE {where} GROUP BY 1
"""


@register("report_successful_logins", covers="R-19 via run_report: sparse daily logins per platform",
          oracle=_sparse_platform_sql(
              f"""SELECT CAST({_PARSED} AS DATE) AS day,
                    CASE WHEN value >= 450 THEN 'testwiki' ELSE 'commonswiki' END AS wiki,
                    {_PLATFORM_SQL} AS event_platform,
                    CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS event_result
                  FROM events""",
              "event_result = 'success' AND wiki = 'commonswiki'"))
def report_successful_logins(spark, sf_dir):
    return run_report(derived_tracking(spark, sf_dir), "successful-logins", AS_OF)


@register("report_share_attempts", covers="R-21 via run_report: sparse daily shares on one wiki",
          oracle=_sparse_platform_sql(
              f"""SELECT CAST({_PARSED} AS DATE) AS day,
                    CASE WHEN value >= 400 THEN 'enwiki' ELSE 'commonswiki' END AS wiki,
                    {_PLATFORM_SQL} AS event_platform
                  FROM events""",
              "wiki = 'commonswiki'"))
def report_share_attempts(spark, sf_dir):
    return run_report(derived_tracking(spark, sf_dir), "share-attempts", AS_OF)


@register("report_unique_uploaders", covers="R-01 via run_report: monthly distinct uploaders per platform",
          oracle=f"""
WITH {_UPLOADS_CTE},
spine AS (
  SELECT CAST(d AS DATE) AS bucket
  FROM generate_series(DATE '2023-02-01', DATE '2024-01-01', INTERVAL 1 MONTH) t(d)),
apps AS (
  SELECT {_MONTH} AS bucket,
    COUNT(DISTINCT CASE WHEN event_platform LIKE 'Android%' THEN event_username END) AS android,
    COUNT(DISTINCT CASE WHEN event_platform LIKE 'iOS%' THEN event_username END) AS ios
  FROM upload_attempts WHERE {_APPS_OK} GROUP BY 1),
web AS (SELECT {_MONTH} AS bucket, COUNT(DISTINCT event_username) AS web FROM upload_web WHERE {_WEB_OK} GROUP BY 1)
SELECT s.bucket, CAST(COALESCE(a.android, 0) AS BIGINT) AS android, CAST(COALESCE(a.ios, 0) AS BIGINT) AS ios,
  CAST(COALESCE(w.web, 0) AS BIGINT) AS web
FROM spine s LEFT JOIN apps a ON s.bucket = a.bucket LEFT JOIN web w ON s.bucket = w.bucket
""")
def report_unique_uploaders(spark, sf_dir):
    return run_report(derived_uploads(spark, sf_dir), "unique-uploaders", AS_OF)
