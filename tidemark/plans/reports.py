"""The report catalogue: every contribution-metrics report as a DataFrame plan.

Each report reads the logical tables of :mod:`tidemark.sources.logical`
(``tables['edits_web']`` ...) and returns a series whose first column is
``bucket``; ``labels`` gives the display names of the original CSV headers.
Time-boxed reports are computed over their whole range in one grouped scan
and can be refreshed incrementally against a stored series.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arith import row_total
from ..functions.text import contains_any, lacks_or_null, normalise_title, normalise_user, prefix_match
from ..functions.time import to_date_value
from ..operators.buckets import (
    BUCKET,
    bucket_distinct,
    densify,
    in_range,
    spine_between,
    spine_bounds,
)
from ..operators.changes import days_of_buckets, in_days
from ..operators.cohorts import cohort_event_count, rolling_active_cohort, rolling_ratio, threshold_groups
from ..operators.matching import (
    category_counts,
    enrich_counts,
    match_keys_wide,
    retention_summary,
    source_reconciliation,
)
from ..operators.timebox import buckets_to_refresh, first_open_bucket, has_drift, incremental_refresh
from .counts import CountPlan, Part, run_counts, shared_series

Tables = Mapping[str, DataFrame]

# Fixed values of the report configuration.
RUNNING_AVERAGE = 30          # days in daily calendars and rolling windows
MONTHS = 12                   # months in monthly calendars
NEW_ACTIVE_MIN_EDITS = 5      # "reached 5 edits" (at least)
ACTIVE_2014_MORE_THAN = 5     # "more than 5 edits"
NEW_EDITOR_MAX_AGE = 2592000  # 30 days in seconds
# Known miscounts (uploads recorded on commons that went elsewhere), per source.
ALLTIME_MODIFIERS = {"Android": 105, "iOS": 47, "Web": 0}
ALLTIME_CATEGORIES = {"Android": "Uploaded_with_Mobile/Android", "iOS": "Uploaded_with_Mobile/iOS",
                      "Web": "Uploaded_with_Mobile/Web"}


@dataclass(frozen=True)
class Params:
    as_of: _dt.date
    starts: _dt.date | None = None
    ends: _dt.date | None = None
    n: int = RUNNING_AVERAGE


@dataclass(frozen=True)
class Report:
    name: str
    title: str
    frequency: str
    build: Callable[[Tables, Params], DataFrame]
    labels: dict = field(default_factory=dict)
    timeboxed: bool = False
    starts: str | None = None
    source: str = "el"
    registered: bool = True
    closed: str = "left"
    #: What a count report counts; others have none.
    counts: Callable[[Params], CountPlan] | None = None

    @property
    def grain(self) -> str:
        return "day" if self.frequency == "hourly" else "month"


REPORTS: dict[str, Report] = {}


def report(name: str, title: str, frequency: str = "hourly", labels: dict | None = None, **kw):
    def deco(fn):
        REPORTS[name] = Report(name, title, frequency, fn, dict(labels or {}), **kw)
        return fn
    return deco


def count_report(name: str, title: str, frequency: str = "hourly", **kw):
    """A report made of counts alone: the function gives their :class:`CountPlan`."""
    def deco(fn):
        report(name, title, frequency, counts=fn, **kw)(lambda t, p: run_counts(t, fn(p)))
        return fn
    return deco


# ------------------------------------------------------------------ rules ---

def android(col: str = "event_platform") -> Column:
    return prefix_match(col, "Android")


def ios(col: str = "event_platform") -> Column:
    return prefix_match(col, "iOS")


def ua_android() -> Column:
    return contains_any("userAgent", "Android")


def ua_ios() -> Column:
    return contains_any("userAgent", ["Darwin", "iPhone OS"])


def on_commons() -> Column:
    return F.col("wiki") == "commonswiki"


def not_test() -> Column:
    return F.col("wiki") != "testwiki"


def app_uploads_ok() -> Column:
    return (F.col("event_result") == "success") & on_commons()


def web_uploads_ok() -> Column:
    return (F.col("event_action") == "success") & not_test()


def _dense(spark, p: Params, grain: str, n: int, *series: DataFrame, fill=0) -> DataFrame:
    start, end = spine_bounds(p.as_of, n, grain)
    return densify(spine_between(spark, start, end, grain), *series, fill=fill)


def _range(p: Params, grain: str, n: int):
    return spine_bounds(p.as_of, n, grain)


def _calendar(p: Params, grain: str, n: int, *parts: Part, total: str | None = None) -> CountPlan:
    """The ``n`` last buckets, zeros filled in; ``total`` of all metrics before them."""
    start, end = _range(p, grain, n)
    parts = tuple(replace(part, grain=grain, start=start, end=end) for part in parts)

    def finish(spark, series):
        dense = _dense(spark, p, grain, n, *series)
        names = dense.columns[1:]
        return dense.select(BUCKET, row_total(names).alias(total), *names) if total else dense

    return CountPlan(parts, finish)


def _box(p: Params, part: Part, fill: int | None) -> CountPlan:
    """Every day of a time box; one without rows is ``fill``."""
    return CountPlan((replace(part, start=p.starts, end=p.ends),), lambda spark, series: densify(
        spine_between(spark, p.starts, p.ends, "day"), *series, fill=fill))


def _sparse(part: Part) -> CountPlan:
    return CountPlan((part,), lambda spark, series: series[0])


# ----------------------------------------------------- uploads (R-01..R-05) ---

@report("unique-uploaders", "Unique uploaders (per month)",
        labels={BUCKET: "Month", "android": "Android", "ios": "iOS", "web": "Web"})
def unique_uploaders(t: Tables, p: Params) -> DataFrame:
    s, e = _range(p, "month", MONTHS)
    apps = bucket_distinct(t["upload_attempts"], "ts", "month", "event_username",
                           {"android": android(), "ios": ios()}, where=app_uploads_ok(), start=s, end=e)
    web = bucket_distinct(t["upload_web"], "ts", "month", "event_username", {"web": F.lit(True)},
                          where=web_uploads_ok(), start=s, end=e)
    return _dense(apps.sparkSession, p, "month", MONTHS, apps, web)


@report("unique-uploaders-day", "Unique uploaders (per day)",
        labels={BUCKET: "date", "total": "Total", "android": "Android", "ios": "iOS", "web": "Web"})
def unique_uploaders_day(t: Tables, p: Params) -> DataFrame:
    s, e = _range(p, "day", p.n)
    apps = bucket_distinct(t["upload_attempts"], "ts", "day", "event_username",
                           {"android": android(), "ios": ios()}, where=app_uploads_ok(), start=s, end=e)
    web = bucket_distinct(t["upload_web"], "ts", "day", "event_username", {"web": F.lit(True)},
                          where=web_uploads_ok(), start=s, end=e)
    dense = _dense(apps.sparkSession, p, "day", p.n, apps, web)
    # Total is the sum of the per-platform distincts, not a distinct overall.
    return dense.select(BUCKET, row_total(["android", "ios", "web"]).alias("total"), "android", "ios", "web")


def _app_uploads(where: Column) -> Part:
    return Part("upload_attempts", {"android": android(), "ios": ios()}, where)


def _web_uploads(where: Column) -> Part:
    return Part("upload_web", {}, where, total="web")


@count_report("month-uploads", "Uploads (per month)", frequency="daily",
              labels={BUCKET: "Month", "android": "Android", "ios": "iOS", "web": "Web"})
def month_uploads(p: Params) -> CountPlan:
    return _calendar(p, "month", MONTHS, _app_uploads(app_uploads_ok()), _web_uploads(web_uploads_ok()))


@count_report("cancelled-uploads", "Uploads cancelled by user (per day)",
              labels={BUCKET: "Date", "total": "Total", "android": "Android", "ios": "iOS"})
def cancelled_uploads(p: Params) -> CountPlan:
    return _sparse(replace(_app_uploads((F.col("event_result") == "cancelled") & on_commons()), total="total"))


_UPLOAD_LABELS = {BUCKET: "Date", "total": "Total", "android": "Android", "ios": "iOS", "web": "Web"}


@count_report("error-uploads", "Uploads failed because of an upload error (per day)", labels=_UPLOAD_LABELS)
def error_uploads(p: Params) -> CountPlan:
    r = F.col("event_result")
    app_where = (r != "cancelled") & (r != "success") & on_commons()
    web_where = (F.col("event_action") == "error") & not_test()
    return _calendar(p, "day", p.n, _app_uploads(app_where), _web_uploads(web_where), total="total")


@count_report("successful-uploads", "Successful Uploads (per day)", labels=_UPLOAD_LABELS)
def successful_uploads(p: Params) -> CountPlan:
    return _calendar(p, "day", p.n, _app_uploads(app_uploads_ok()), _web_uploads(web_uploads_ok()), total="total")


# ------------------------------------------------------- web edits (R-06..) ---

def web_edits_ok() -> Column:
    return (F.col("event_action") == "success") & not_test()


def _web_edits(p: Params, where: Column) -> CountPlan:
    return _calendar(p, "day", p.n, Part("edits_web", {}, where, total="web"))


@count_report("successful-edits-newbie", "Successful edits by first time users (per day)",
              labels={BUCKET: "Date", "web": "Web"})
def successful_edits_newbie(p: Params) -> CountPlan:
    return _web_edits(p, web_edits_ok() & (F.col("event_userEditCount") == 0))


@count_report("successful-edits-main", "Successful Main namespace edits (per day)",
              labels={BUCKET: "Date", "web": "Web"})
def successful_edits_main(p: Params) -> CountPlan:
    return _web_edits(p, web_edits_ok() & (F.col("event_namespace") == 0))


@count_report("successful-edits-other", "Successful other namespace edits (per day)",
              labels={BUCKET: "Date", "web": "Web"})
def successful_edits_other(p: Params) -> CountPlan:
    return _web_edits(p, web_edits_ok() & (F.col("event_namespace") != 0))


@report("successful-edits-unique", "Successful unique user edits (per day)",
        labels={BUCKET: "Date", "web": "Web"})
def successful_edits_unique(t: Tables, p: Params) -> DataFrame:
    s, e = _range(p, "day", p.n)
    agg = bucket_distinct(t["edits_web"], "ts", "day", "event_username", {"web": F.lit(True)},
                          where=web_edits_ok() & (F.col("event_namespace") == 0), start=s, end=e)
    return _dense(agg.sparkSession, p, "day", p.n, agg)


@count_report("error-edits", "Edits failed because of an error (per day)", labels={BUCKET: "Date", "web": "Web"})
def error_edits(p: Params) -> CountPlan:
    return _web_edits(p, (F.col("event_action") == "error") & not_test())


def by_namespace() -> dict[str, Column]:
    ns = F.col("event_namespace")
    return {"main": ns == 0, "other": ns != 0}


@report("edits-monthly-unique-editors", "Unique editors (per month)", frequency="daily",
        labels={BUCKET: "Month", "main": "Main", "other": "Other"})
def edits_monthly_unique_editors(t: Tables, p: Params) -> DataFrame:
    s, e = _range(p, "month", MONTHS)
    agg = bucket_distinct(t["edits_web"], "ts", "month", "event_username", by_namespace(), where=web_edits_ok(), start=s, end=e)
    return _dense(agg.sparkSession, p, "month", MONTHS, agg)


@count_report("edits-monthly-successful", "Successful edits (per month)", frequency="daily",
              labels={BUCKET: "Month", "main": "Main", "other": "Other"})
def edits_monthly_successful(p: Params) -> CountPlan:
    return _calendar(p, "month", MONTHS, Part("edits_web", by_namespace(), web_edits_ok()))


# ------------------------------------------------ app edits (R-11..R-17) ---

FUNNEL_STEPS = ("start", "preview", "saveAttempt", "saved")


def _funnel(p: Params, rule: Column | None) -> CountPlan:
    where = not_test() if rule is None else (rule & not_test())
    return _box(p, Part("edits_app", {s.lower(): F.col("event_action") == s for s in FUNNEL_STEPS}, where), fill=0)


_FUNNEL_LABELS = {BUCKET: "Day", "start": "start", "preview": "preview", "saveattempt": "saveAttempt",
                  "saved": "saved"}


@count_report("app-edit-funnel-total", "App Edits - all apps (per day)", labels=_FUNNEL_LABELS,
              timeboxed=True, starts="2014-06-25")
def app_edit_funnel_total(p: Params) -> CountPlan:
    return _funnel(p, None)


@count_report("app-edit-funnel-android", "App Edits - Android (per day)", labels=_FUNNEL_LABELS,
              timeboxed=True, starts="2014-06-25")
def app_edit_funnel_android(p: Params) -> CountPlan:
    return _funnel(p, ua_android())


@count_report("app-edit-funnel-ios", "App Edits - iOS (per day)", labels=_FUNNEL_LABELS,
              timeboxed=True, starts="2014-08-01")
def app_edit_funnel_ios(p: Params) -> CountPlan:
    return _funnel(p, ua_ios())


def _app_action(p: Params, action: str) -> CountPlan:
    where = (F.col("event_action") == action) & not_test()
    return _sparse(Part("edits_app", {"android": ua_android(), "ios": ua_ios()}, where, total="total",
                        start=p.starts, end=p.ends))


_APP_LABELS = {BUCKET: "Day", "total": "Total", "android": "Android", "ios": "iOS"}


@count_report("app-edits-starts", "Apps - Impressions on edit pencil (per day)", labels=_APP_LABELS,
              timeboxed=True, starts="2014-06-25")
def app_edits_starts(p: Params) -> CountPlan:
    return _app_action(p, "start")


@count_report("app-edits-preview", "Apps - Impressions on edit summary and preview page (per day)",
              labels=_APP_LABELS, timeboxed=True, starts="2014-06-25")
def app_edits_preview(p: Params) -> CountPlan:
    return _app_action(p, "preview")


@count_report("app-edits-save-attempt", "Apps - Impressions on Save button (number of save attempts per day)",
              labels=_APP_LABELS, timeboxed=True, starts="2014-06-25")
def app_edits_save_attempt(p: Params) -> CountPlan:
    return _app_action(p, "saveAttempt")


@count_report("app-edits-success", "Apps - Number of successfully saved edits (per day)", labels=_APP_LABELS,
              timeboxed=True, starts="2014-06-25")
def app_edits_success(p: Params) -> CountPlan:
    return _app_action(p, "saved")


@report("app-user-blocks-en", "Number of blocked 'app users' on enwiki (per day)",
        labels={BUCKET: "Day", "numblocks": "NumBlocks"}, timeboxed=True, starts="2014-06-25",
        source="enwiki")
def app_user_blocks_en(t: Tables, p: Params) -> DataFrame:
    # Blocks are bucketed by their own day (half-open): the closed window of
    # the original would put a midnight block in two buckets, of which only
    # the first row was kept.
    blocks = in_range(t["ipblocks"], "ts", p.starts, p.ends, "day")
    return cohort_event_count(blocks, t["account_creation"], "ipb_user", "event_userId", "ts", "day",
                              cohort_where=F.col("wiki") == "enwiki", name="numblocks")


# ---------------------------------------------------- logins, shares ---

@count_report("successful-logins", "Successful logins (per day)",
              labels={BUCKET: "Date", "total": "Total", "android": "Android", "ios": "iOS"})
def successful_logins(p: Params) -> CountPlan:
    where = (F.col("event_result") == "success") & on_commons()
    return _sparse(Part("login_attempts", {"android": android(), "ios": ios()}, where, total="total"))


@count_report("share-attempts", "Share Attempts (per day)",
              labels={BUCKET: "Date", "total": "Total", "android": "Android", "ios": "iOS"})
def share_attempts(p: Params) -> CountPlan:
    return _sparse(Part("share_attempts", {"android": android(), "ios": ios()}, on_commons(), total="total"))


# ------------------------------------------------- cross-source reports ---

@report("uploaders-experience", "Mobile Uploads vs Commons Edit count",
        labels={"source": "source", "uploads": "uploads", "edits": "edits"}, source="commons")
def uploaders_experience(t: Tables, p: Params) -> DataFrame:
    ups = t["upload_attempts"].where(app_uploads_ok())
    src = F.when(ios(), F.lit("iOS")).when(android(), F.lit("Android"))
    # Uploaders are normalised; stored names match as they are.
    per_user = (ups.select(src.alias("source"), normalise_user("event_username").alias("user_key"))
                .where(F.col("source").isNotNull() & F.col("user_key").isNotNull())
                .groupBy("source", "user_key").agg(F.count(F.lit(1)).alias("uploads")))
    users = t["user"].select(F.col("user_name").cast("string").alias("user_key"), "user_editcount")
    out = enrich_counts(per_user, "user_key", users, "user_key", "user_editcount", name="edits", default=0)
    return out.select("source", "uploads", F.col("edits").cast("bigint").alias("edits"))


@report("alltime-numbers", "All time numbers",
        labels={"source": "source", "total": "total", "undeleted": "undeleted",
                "deletion_percentage": "deletion percentage"}, source="commons")
def alltime_numbers(t: Tables, p: Params) -> DataFrame:
    spark = t["upload_attempts"].sparkSession
    ups = t["upload_attempts"].where(app_uploads_ok())
    app_src = F.when(android(), F.lit("Android")).when(ios(), F.lit("iOS"))
    apps = (ups.select(app_src.alias("source")).where(F.col("source").isNotNull())
            .groupBy("source").agg(F.count(F.lit(1)).alias("total")))
    web = (t["upload_web"].where(web_uploads_ok())
           .agg(F.count(F.lit(1)).alias("total")).select(F.lit("Web").alias("source"), "total"))
    # Every source has its row, also one without uploads.
    named = spark.createDataFrame([(s,) for s in ALLTIME_MODIFIERS], "source string")
    totals = named.join(apps.unionByName(web), "source", "left").select("source", F.coalesce("total", F.lit(0)).alias("total"))
    retained = category_counts(t["categorylinks"], ALLTIME_CATEGORIES).withColumnRenamed("n", "undeleted")
    corrections = spark.createDataFrame(list(ALLTIME_MODIFIERS.items()), "source string, correction bigint")
    out = retention_summary(totals, retained, F.broadcast(corrections), as_text=True)
    return out.select("source", "total", "undeleted", "deletion_percentage")


@report("no-cats", "Percentage of files with a category added", labels={BUCKET: "Date", "android": "Android"})
def no_cats(t: Tables, p: Params) -> DataFrame:
    s, e = _range(p, "day", p.n)
    where = android() & on_commons()
    return rolling_ratio(t["cat_attempts"], "ts", "event_files_count",
                         F.col("event_categories_count") == 0, p.n, s, e, where=where, name="android")


def _upload_titles(t: Tables) -> DataFrame:
    """(platform, canonical title) of successful app uploads and of web
    uploads (upload log rows tagged as mobile edits)."""
    ups = t["upload_attempts"].where(app_uploads_ok())
    src = F.when(android(), F.lit("Android")).when(ios(), F.lit("iOS"))
    apps = ups.select(src.alias("tag"), normalise_title("event_filename").alias("key"))
    log = t["logging"].where(F.col("log_action") == "upload")
    tags = t["tag_summary"].where(prefix_match("ts_tags", "mobile edit"))
    web = (log.join(tags, log["log_id"] == tags["ts_log_id"])
           .select(F.lit("Web").alias("tag"), normalise_title("log_title").alias("key")))
    return apps.where(F.col("tag").isNotNull()).unionByName(web)


@report("deleted-uploads", "Uploads deleted (per month)",
        labels={BUCKET: "date", "android": "Android", "ios": "iOS", "web": "Web"}, source="commons")
def deleted_uploads(t: Tables, p: Params) -> DataFrame:
    s, e = _range(p, "month", MONTHS)
    deletes = in_range(t["logging"].where((F.col("log_namespace") == 6) & (F.col("log_action") == "delete")),
                       "ts", s, e, "month")
    wide = match_keys_wide(deletes, _upload_titles(t), "log_title", ["Android", "iOS", "Web"],
                           ["android", "ios", "web"], ts="ts", grain="month")
    return _dense(deletes.sparkSession, p, "month", MONTHS, wide)


@report("error-correction", "Uploads recorded on EL vs found on Commons",
        labels={"label": "", "android": "Android", "ios": "iOS"}, registered=False, source="commons")
def error_correction(t: Tables, p: Params) -> DataFrame:
    claimed = _upload_titles(t).where(F.col("tag").isin("Android", "iOS")).select(
        F.col("tag").alias("source"), "key")
    uploads = t["logging"].where((F.col("log_namespace") == 6) & (F.col("log_action") == "upload"))
    return source_reconciliation(claimed, uploads, ["Android", "iOS"], "log_title",
                                 labels=("Total on EL", "Uploaded on Commons", "Difference"),
                                 names=["android", "ios"])


# ------------------------------------------------- rolling cohorts ---

@report("edits-monthly-new-active",
        "Editors who reached 5 mobile edits on enwiki within 30 days of registering",
        labels={BUCKET: "Day", "mobile": "mobile", "desktop": "desktop"}, timeboxed=True,
        starts="2014-01-01", source="enwiki", closed="both")
def edits_monthly_new_active(t: Tables, p: Params) -> DataFrame:
    lg = t["logging"]
    # The text time column stays: its bounds are the ones that reach the scan.
    signups = lg.where((F.col("log_type") == "newusers") & (F.col("log_action") == "create")).withColumn(
        "user", F.col("log_user"))
    revs = t["revision"].withColumn("user", F.col("rev_user"))
    arch = t["archive"].withColumn("user", F.col("ar_user"))
    acc = t["account_creation"].withColumns({"user": F.col("event_userId"), "flag": F.col("event_displaymobile")})
    rule = lacks_or_null("useragent", "WikipediaApp") & (F.col("wiki") == "enwiki")
    return rolling_active_cohort(signups, [revs, arch], acc, p.starts, p.ends, n=RUNNING_AVERAGE,
                                 min_edits=NEW_ACTIVE_MIN_EDITS, account_where=rule)


@report("edits-monthly-active-2014", "Newly active editors by platform",
        frequency="monthly", labels={BUCKET: "Month", "mobileedits": "mobileEdits",
                                     "desktopedits": "desktopEdits"},
        timeboxed=True, starts="2014-01-01", registered=False)
def edits_monthly_active_2014(t: Tables, p: Params) -> DataFrame:
    rows = in_range(t["new_editor_edits"].where(F.col("event_userAge") <= NEW_EDITOR_MAX_AGE),
                    "ts", p.starts, p.ends, "month")
    split = {"mobileedits": F.col("event_isMobile") == 1, "desktopedits": F.col("event_isMobile") == 0}
    out = threshold_groups(rows, ["event_userID", "event_isMobile"], split,
                           min_exclusive=ACTIVE_2014_MORE_THAN, ts="ts", grain="month")
    start, end = p.starts, p.ends
    return densify(spine_between(rows.sparkSession, start, end, "month"), out, fill=None)


# --------------------------------------------- event-name pivots (closed) ---

THANKS = {"desktophistory": "history", "desktopdiffthanks": "diff", "mobilediffthanks": "mobilediff"}


@count_report("thanks-daily", "Thanks", labels={BUCKET: "Day", "desktophistory": "desktopHistory",
                                                 "desktopdiffthanks": "desktopDiffThanks",
                                                 "mobilediffthanks": "mobileDiffThanks"},
              timeboxed=True, starts="2013-11-01", closed="both")
def thanks_daily(p: Params) -> CountPlan:
    src = F.col("event_eventSource")
    return _box(p, Part("thanks", {k: src == v for k, v in THANKS.items()}, F.col("event_notificationType") == "edit-thank",
                        closed="both"), fill=0)


# Fixed values: (label, event name) of the click-tracking reports.
UI_EVENTS = [
    ("Hamburger", "hamburger"), ("Home", "hamburger-home"), ("Random", "hamburger-random"),
    ("Uploads", "hamburger-uploads"), ("Watchlist", "hamburger-watchlist"), ("Nearby", "hamburger-nearby"),
    ("Settings", "hamburger-settings"), ("Login", "hamburger-login"), ("Logout", "hamburger-logout"),
    ("Profile", "hamburger-profile"), ("Search", "search"), ("Notifications", "notifications"),
    ("Reference", "reference"), ("Languages", "languages"), ("Last modified history", "lastmodified-history"),
    ("Last modified profile", "lastmodified-profile"), ("Page TOC toggle", "page-toc-toggle"),
    ("Page TOC link", "page-toc-link"), ("Category Overlay link", "category-button"),
    ("Nearby link", "nearby-button"),
]
WATCHLIST_EVENTS = [
    ("More link on A-Z view", "watchlist-a-z-more"), ("Switched to feed", "watchlist-a-z-switch"),
    ("Switched to list", "watchlist-feed-switch"), ("Unwatch page", "watchlist-a-z-unwatch"),
    ("View page (A-Z)", "watchlist-a-z-view"), ("View diff (feed)", "watchlist-feed-view"),
    ("Filtered feed (feed)", "watchlist-feed-filter"),
]
DIFF_EVENTS = [
    ("Thanks", "diff-thank"), ("User page link", "diff-user"), ("Navigate to subject page", "diff-view"),
    ("Clicks previous or next (beta only)", "diff-prev-or-next"),
]
OPTIONS = [
    ("Beta opt in", "event_beta", "on"), ("Beta opt out", "event_beta", "off"),
    ("Alpha opt in", "event_alpha", "on"), ("Alpha opt out", "event_alpha", "off"),
    ("Images turned on", "event_images", "on"), ("Images turned off", "event_images", "off"),
]


def _key(label: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in label.lower()).strip("_")


def _clicks(p: Params, events) -> CountPlan:
    metrics = {_key(label): F.col("event_name") == name for label, name in events}
    return _box(p, Part("click_tracking", metrics, closed="both"), fill=None)


def _labels(pairs) -> dict:
    return {BUCKET: "Day", **{_key(p[0]): p[0] for p in pairs}}


@count_report("ui-daily", "UI activity", labels=_labels(UI_EVENTS), timeboxed=True, starts="2014-01-01",
              closed="both")
def ui_daily(p: Params) -> CountPlan:
    return _clicks(p, UI_EVENTS)


@count_report("watchlist-activity", "Watchlist activity", labels=_labels(WATCHLIST_EVENTS), timeboxed=True,
              starts="2014-01-01", closed="both")
def watchlist_activity(p: Params) -> CountPlan:
    return _clicks(p, WATCHLIST_EVENTS)


@count_report("diff-activity", "Special:MobileDiff page activity", labels=_labels(DIFF_EVENTS), timeboxed=True,
              starts="2014-01-01", closed="both")
def diff_activity(p: Params) -> CountPlan:
    return _clicks(p, DIFF_EVENTS)


@count_report("mobile-options", "Special:MobileOptions page activity", labels=_labels(OPTIONS), timeboxed=True,
              starts="2014-04-16", closed="both")
def mobile_options(p: Params) -> CountPlan:
    metrics = {_key(label): F.col(col) == value for label, col, value in OPTIONS}
    return _box(p, Part("option_tracking", metrics, closed="both"), fill=None)


# -------------------------------------------------------------- running ---

def params_for(rep: Report, as_of, starts=None, ends=None, n: int = RUNNING_AVERAGE) -> Params:
    as_of = to_date_value(as_of)
    if not rep.timeboxed:
        return Params(as_of=as_of, n=n)
    s = to_date_value(starts or rep.starts)
    e = to_date_value(ends) if ends else as_of
    if rep.grain == "month":
        s, e = s.replace(day=1), e.replace(day=1)
    return Params(as_of=as_of, starts=s, ends=e, n=n)


def run_report(tables: Tables, name: str, as_of, starts=None, ends=None,
               stored: DataFrame | None = None, cutoff=None, force: bool = False,
               labelled: bool = False, n: int = RUNNING_AVERAGE, explain: bool = False,
               registry: Mapping[str, Report] | None = None) -> DataFrame:
    """Build one report.

    For a time-boxed report with a ``stored`` series, buckets stored and
    closed before ``cutoff`` (default: the first of ``as_of``'s month) are
    kept and the rest recomputed: count reports read the days of those buckets alone,
    others from the first of them on (rolling reports widen that by their window); if the stored series has another
    shape it is rebuilt whole unless ``force``. ``labelled`` renames columns to the
    original headers. ``tables`` may be a plain mapping or a
    :class:`~tidemark.sources.logical.LogicalCatalog`, in which case the
    report's own source supplies the wiki tables. ``explain`` prints the
    formatted physical plan. ``registry``: the reports to choose from (default: the catalogue;
    see :mod:`tidemark.plans.files`).
    """
    registry = REPORTS if registry is None else registry
    if name not in registry:
        raise ValueError(f"Can not find report {name!r}")
    rep = registry[name]
    if hasattr(tables, "for_source"):
        tables = tables.for_source(rep.source)
    p = params_for(rep, as_of, starts, ends, n)
    if not rep.timeboxed or stored is None:
        out = rep.build(tables, p)
    else:
        cut = to_date_value(cutoff) if cutoff else p.as_of.replace(day=1)
        if rep.counts:  # a bucket's rows are those of its days: only these are read
            todo = buckets_to_refresh(stored, p.starts, p.ends, cut, rep.grain)
            days = days_of_buckets([r[0] for r in todo.collect()], rep.grain, rep.closed)
            fresh = rep.build({part.table: in_days(tables[part.table], "ts", days) for part in rep.counts(p).parts}, p)
        else:
            fresh = rep.build(tables, replace(p, starts=first_open_bucket(stored, p.starts, p.ends, cut, rep.grain)))
        if not has_drift(stored, fresh) or force:
            out = incremental_refresh(stored, fresh, cut, p.starts, p.ends, rep.grain)
        else:  # the shape changed: the whole range anew
            out = rep.build(tables, p)
    if labelled:
        out = with_labels(out, rep)
    if explain:
        out.explain("formatted")
    return out


def run_all(tables: Tables, as_of, registered_only: bool = True, names=None, starts=None, ends=None,
            n: int = RUNNING_AVERAGE, labelled: bool = False,
            registry: Mapping[str, Report] | None = None) -> dict[str, DataFrame]:
    """Every report (or those called ``names``): ``{name: DataFrame}``.

    The count reports (:data:`Report.counts`) scan each logical table once, now and for all of
    them together (see :func:`~tidemark.plans.counts.shared_series`); the others
    are built lazily, each by itself. ``starts`` and ``ends`` bound the time-boxed ones.
    """
    registry = REPORTS if registry is None else registry
    chosen = [registry[k] for k in names] if names is not None else [
        r for r in registry.values() if r.registered or not registered_only]
    plans = {r.name: r.counts(params_for(r, as_of, starts, ends, n)) for r in chosen if r.counts}
    events = tables.for_source("el") if hasattr(tables, "for_source") else tables
    shared = shared_series(events, plans) if plans else {}
    out = {}
    for r in chosen:
        df = shared[r.name] if r.counts else run_report(tables, r.name, as_of, starts=starts, ends=ends, n=n, registry=registry)
        out[r.name] = with_labels(df, r) if labelled else df
    return out


def with_labels(df: DataFrame, rep: Report) -> DataFrame:
    """``df`` with the report's original headers."""
    return df.select(*[F.col(c).alias(rep.labels.get(c, c)) for c in df.columns])


def run_sql_report(spark, tables: Tables, sql: str, args: Mapping | None = None,
                   views: list[str] | None = None) -> DataFrame:
    """Run a report written in Spark SQL against the logical tables.

    Each logical table (``views``, default: every table the SQL mentions) is
    a temporary view under its own name; settings are named parameters
    (``:as_of``, ``:n`` ...) bound by ``spark.sql(sql, args=...)`` -- values
    are never pasted into the text.
    """
    import re
    names = views if views is not None else [
        n for n in tables if re.search(rf"\b{re.escape(n)}\b", sql)]
    for n in names:
        tables[n].createOrReplaceTempView(n)
    return spark.sql(sql, args=dict(args or {}))
