"""Every report over the fixture tables, several checked against brute force
computed in plain Python from the same raw rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict

import pytest

from tidemark.plans.reports import REPORTS, run_report
from tests.fixtures import AS_OF, raw_rows

STARTS = "2014-05-01"


def _parse(s):
    try:
        return dt.datetime.strptime(s, "%Y%m%d%H%M%S")
    except (TypeError, ValueError):
        return None


def _dicts(name):
    ddl, rows = raw_rows()[name]
    cols = [c.strip().split(" ")[0].strip("`") for c in ddl.split(",")]
    return [dict(zip(cols, r)) for r in rows]


def _union(names, cols, fill=None, distinct=True):
    seen, out = set(), []
    for n in names:
        for r in _dicts(n):
            row = tuple(r.get(c, (fill or {}).get(c)) for c in cols)
            if distinct and row in seen:
                continue
            seen.add(row)
            out.append(dict(zip(cols, row)))
    for r in out:
        r["ts"] = _parse(r["timestamp"])
    return out


UP_COLS = ["id", "uuid", "clientIp", "isTruncated", "clientValidated", "timestamp", "webHost", "wiki",
           "event_appversion", "event_device", "event_filename", "event_multiple", "event_platform",
           "event_result", "event_source", "event_username"]


def uploads():
    return _union(["MobileAppUploadAttempts_5257716", "MobileAppUploadAttempts_5334329"], UP_COLS,
                  {"event_multiple": 0})


def web_uploads():
    return _union(["MobileWebUploads_5281063", "MobileWebUploads_5383883", "MobileWebUploads_7967082",
                   "MobileWebUploads_8209043"],
                  ["timestamp", "wiki", "event_action", "event_funnel", "event_username"])


def days(n=30):
    return [AS_OF - dt.timedelta(days=n - 1 - i) for i in range(n)]


def startswith(v, p):
    return v is not None and v.startswith(p)


def norm_title(s):
    if not s:
        return None
    return (s[0].upper() + s[1:]).replace("File:", "").replace(" ", "_")


def as_dict(df, key="bucket"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_runs_with_labelled_columns(tables, name):
    rep = REPORTS[name]
    df = run_report(tables, name, AS_OF, starts=STARTS if rep.timeboxed else None)
    rows = df.collect()
    assert set(df.columns) <= set(rep.labels) | {"bucket"}, (df.columns, rep.labels)
    labelled = run_report(tables, name, AS_OF, starts=STARTS if rep.timeboxed else None, labelled=True)
    assert labelled.columns == [rep.labels.get(c, c) for c in df.columns]
    if df.columns[0] == "bucket":
        keys = [r["bucket"] for r in rows]
        assert len(keys) == len(set(keys)), "one row per bucket"


def test_successful_uploads_matches_brute_force(tables):
    got = as_dict(run_report(tables, "successful-uploads", AS_OF))
    assert len(got) == 30
    apps = [r for r in uploads() if r["ts"] and r["event_result"] == "success" and r["wiki"] == "commonswiki"]
    web = [r for r in web_uploads() if r["ts"] and r["event_action"] == "success"
           and r["wiki"] is not None and r["wiki"] != "testwiki"]
    for d in days():
        a = sum(1 for r in apps if r["ts"].date() == d and startswith(r["event_platform"], "Android"))
        i = sum(1 for r in apps if r["ts"].date() == d and startswith(r["event_platform"], "iOS"))
        w = sum(1 for r in web if r["ts"].date() == d)
        assert (got[d]["android"], got[d]["ios"], got[d]["web"], got[d]["total"]) == (a, i, w, a + i + w), d


def test_unique_uploaders_day_total_is_sum_of_distincts(tables):
    got = as_dict(run_report(tables, "unique-uploaders-day", AS_OF))
    apps = [r for r in uploads() if r["ts"] and r["event_result"] == "success" and r["wiki"] == "commonswiki"]
    for d in days():
        a = {r["event_username"] for r in apps if r["ts"].date() == d
             and startswith(r["event_platform"], "Android") and r["event_username"] is not None}
        assert got[d]["android"] == len(a)
        assert got[d]["total"] == got[d]["android"] + got[d]["ios"] + got[d]["web"]


def test_cancelled_uploads_sparse(tables):
    got = as_dict(run_report(tables, "cancelled-uploads", AS_OF))
    rows = [r for r in uploads() if r["ts"] and r["event_result"] == "cancelled" and r["wiki"] == "commonswiki"]
    want = Counter(r["ts"].date() for r in rows)
    assert {d: v["total"] for d, v in got.items()} == dict(want)


def test_web_edit_versions_collapse(tables):
    edits = _union([f"MobileWebEditing_{v}" for v in ("5644223", "6077315", "6637866", "7675117", "8599025")],
                   ["timestamp", "wiki", "event_username", "event_action", "event_namespace",
                    "event_userEditCount"])
    assert tables["edits_web"].count() == len(edits)
    got = as_dict(run_report(tables, "successful-edits-main", AS_OF))
    for d in days():
        want = sum(1 for r in edits if r["ts"] and r["ts"].date() == d and r["event_action"] == "success"
                   and r["event_namespace"] == 0 and r["wiki"] is not None and r["wiki"] != "testwiki")
        assert got[d]["web"] == want


def test_closed_window_counts_midnight_twice(tables):
    got = as_dict(run_report(tables, "ui-daily", AS_OF, starts=STARTS))
    clicks = [dict(timestamp=t, event_name=n, ts=_parse(t)) for t, n in raw_rows()["MobileWebClickTracking_5929948"][1]]
    d = dt.date(2014, 5, 1)
    while d <= AS_OF:
        lo = dt.datetime.combine(d, dt.time())
        hi = lo + dt.timedelta(days=1)
        inside = [r for r in clicks if lo <= r["ts"] <= hi]
        want = sum(1 for r in inside if r["event_name"] == "hamburger") if inside else None
        assert got[d]["hamburger"] == want, d
        d += dt.timedelta(days=1)


def test_new_active_cohort_matches_brute_force(tables):
    got = as_dict(run_report(tables, "edits-monthly-new-active", AS_OF, starts=STARTS))
    log = [dict(r, ts=_parse(r["log_timestamp"])) for r in _dicts("logging")]
    rev = [(r["rev_user"], _parse(r["rev_timestamp"])) for r in _dicts("revision")]
    arc = [(r["ar_user"], _parse(r["ar_timestamp"])) for r in _dicts("archive")]
    acc = [dict(r, ts=_parse(r["timestamp"])) for r in _dicts("ServerSideAccountCreation_5487345")]
    nonnull = 0
    d = dt.date(2014, 5, 1)
    while d <= AS_OF:
        to = dt.datetime.combine(d, dt.time()) + dt.timedelta(days=1)
        lo = to - dt.timedelta(days=30)
        new = {r["log_user"] for r in log if r["log_type"] == "newusers" and r["log_action"] == "create"
               and lo <= r["ts"] <= to}
        counts = Counter(u for u, t in rev + arc if u in new and lo <= t <= to)
        active = {u for u, c in counts.items() if c >= 5}
        rows = [a for a in acc if a["event_userId"] in active and a["wiki"] == "enwiki"
                and (a["useragent"] is None or "WikipediaApp" not in a["useragent"])
                and to - dt.timedelta(days=31) <= a["ts"] <= to + dt.timedelta(days=1)]
        want_m = sum(1 for a in rows if a["event_displaymobile"] == 1) if rows else None
        want_d = sum(1 for a in rows if a["event_displaymobile"] is not None and a["event_displaymobile"] != 1) \
            if rows else None
        assert (got[d]["mobile"], got[d]["desktop"]) == (want_m, want_d), d
        nonnull += rows != []
        d += dt.timedelta(days=1)
    assert nonnull > 5, "fixture must exercise the cohort"


def test_deleted_uploads_semi_join(tables):
    got = as_dict(run_report(tables, "deleted-uploads", AS_OF))
    apps = [r for r in uploads() if r["event_result"] == "success" and r["wiki"] == "commonswiki"]
    titles = defaultdict(set)
    for r in apps:
        t = norm_title(r["event_filename"])
        if t is None:
            continue
        if startswith(r["event_platform"], "Android"):
            titles["android"].add(t)
        elif startswith(r["event_platform"], "iOS"):
            titles["ios"].add(t)
    log = _dicts("logging")
    tags = {r["ts_log_id"] for r in _dicts("tag_summary") if r["ts_tags"].startswith("mobile edit")}
    titles["web"] = {norm_title(r["log_title"]) for r in log if r["log_action"] == "upload" and r["log_id"] in tags}
    dels = [r for r in log if r["log_namespace"] == 6 and r["log_action"] == "delete"]
    total = 0
    for month, row in got.items():
        for src in ("android", "ios", "web"):
            want = sum(1 for r in dels if r["log_title"] in titles[src]
                       and _parse(r["log_timestamp"]).date().replace(day=1) == month)
            assert row[src] == want, (month, src)
            total += want
    assert total > 0


def test_error_correction_rows(tables):
    got = {r["label"]: r for r in run_report(tables, "error-correction", AS_OF).collect()}
    assert set(got) == {"Total on EL", "Uploaded on Commons", "Difference"}
    for c in ("android", "ios"):
        assert got["Difference"][c] == got["Total on EL"][c] - got["Uploaded on Commons"][c]
    apps = [r for r in uploads() if r["event_result"] == "success" and r["wiki"] == "commonswiki"]
    uploaded = [r["log_title"] for r in _dicts("logging") if r["log_namespace"] == 6 and r["log_action"] == "upload"]
    for c, prefix in (("android", "Android"), ("ios", "iOS")):
        titles = [norm_title(r["event_filename"]) for r in apps if startswith(r["event_platform"], prefix)]
        titles = [x for x in titles if x is not None]
        assert got["Total on EL"][c] == len(titles)                        # duplicates kept
        assert got["Uploaded on Commons"][c] == sum(1 for x in uploaded if x in set(titles))


def test_alltime_numbers(tables):
    got = {r["source"]: r for r in run_report(tables, "alltime-numbers", AS_OF).collect()}
    apps = [r for r in uploads() if r["event_result"] == "success" and r["wiki"] == "commonswiki"]
    android = sum(1 for r in apps if startswith(r["event_platform"], "Android")) - 105
    assert got["Android"]["total"] == android
    assert got["Android"]["undeleted"] == 5
    assert got["Android"]["deletion_percentage"] == "%.2f" % ((android - 5) / android)


def test_uploaders_experience_defaults_to_zero(tables):
    rows = run_report(tables, "uploaders-experience", AS_OF).collect()
    assert {r["source"] for r in rows} <= {"iOS", "Android"}
    assert any(r["edits"] == 0 for r in rows)  # users missing from ``user``
    apps = [r for r in uploads() if r["event_result"] == "success" and r["wiki"] == "commonswiki"
            and (startswith(r["event_platform"], "iOS") or startswith(r["event_platform"], "Android"))
            and r["event_username"] is not None and r["event_username"].strip()]
    assert sum(r["uploads"] for r in rows) == len(apps)


def test_no_cats_ratio(tables):
    got = as_dict(run_report(tables, "no-cats", AS_OF))
    rows = [r for r in _dicts("MobileAppCategorizationAttempts_5359208")
            if startswith(r["event_platform"], "Android") and r["wiki"] == "commonswiki"]
    for d in days():
        win = [r for r in rows if d - dt.timedelta(days=30) <= _parse(r["timestamp"]).date() < d]
        den = sum(r["event_files-count"] for r in win)
        num = [r["event_files-count"] for r in win if r["event_categories-count"] == 0]
        want = (sum(num) / den) if num and den else None
        assert got[d]["android"] == pytest.approx(want) if want is not None else got[d]["android"] is None


def test_active_2014_threshold_is_exclusive(tables):
    got = as_dict(run_report(tables, "edits-monthly-active-2014", AS_OF, starts=STARTS))
    rows = [r for r in _dicts("NewEditorEdit_6792669") if r["event_userAge"] <= 2592000]
    for month, row in got.items():
        c = Counter((r["event_userID"], r["event_isMobile"]) for r in rows
                    if _parse(r["timestamp"]).date().replace(day=1) == month)
        mob = sum(1 for (u, m), n in c.items() if n > 5 and m == 1)
        desk = sum(1 for (u, m), n in c.items() if n > 5 and m == 0)
        qualifying = sum(1 for n in c.values() if n > 5)
        assert (row["mobileedits"], row["desktopedits"]) == ((mob, desk) if qualifying else (None, None))


def test_time_boxed_refresh_keeps_closed_buckets(tables):
    full = run_report(tables, "app-edits-starts", AS_OF, starts=STARTS)
    from pyspark.sql import functions as F
    stored = full.withColumn("total", F.col("total") + 1000)
    out = as_dict(run_report(tables, "app-edits-starts", AS_OF, starts=STARTS, stored=stored,
                             cutoff="2014-07-01"))
    fresh = as_dict(full)
    for d, row in out.items():
        if d + dt.timedelta(days=1) < dt.date(2014, 7, 1):
            assert row["total"] == fresh[d]["total"] + 1000
        else:
            assert row["total"] == fresh[d]["total"]


def test_unknown_report_raises(tables):
    with pytest.raises(ValueError):
        run_report(tables, "no-such-report", AS_OF)


def test_sql_report_matches_dataframe_report(spark, tables):
    from tidemark.plans.reports import run_sql_report
    sql = """
        SELECT to_date(ts) AS bucket, COUNT(*) AS total,
               SUM(IF(event_platform LIKE 'Android%', 1, 0)) AS android,
               SUM(IF(event_platform LIKE 'iOS%', 1, 0)) AS ios
        FROM upload_attempts
        WHERE event_result = :result AND wiki = 'commonswiki'
        GROUP BY to_date(ts)"""
    got = run_sql_report(spark, tables, sql, {"result": "cancelled"})
    want = run_report(tables, "cancelled-uploads", AS_OF)
    assert sorted(got.collect()) == sorted(want.collect())


def test_run_all_builds_every_scheduled_report(tables):
    from tidemark.plans.reports import run_all
    out = run_all(tables, AS_OF, starts=None)
    assert len(out) == 33 and "error-correction" not in out and "edits-monthly-active-2014" not in out
    assert out["ui-daily"].columns[0] == "bucket"
