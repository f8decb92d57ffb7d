"""Small raw tables for the report tests (schemas from FIXTURES.md).

Rows are generated from a fixed seed and carry the edge cases listed there:
duplicate rows across versions, rows at exactly midnight, empty days,
rows after ``AS_OF`` and before the calendars, NULLs, malformed timestamps,
awkward titles and user names, 4/5/6-edit users, revision + archive splits,
repeated account rows.
"""

from __future__ import annotations

import datetime as dt
import random

AS_OF = dt.date(2014, 7, 15)
START = dt.datetime(2014, 5, 1)
DAYS = 80  # 2014-05-01 .. 2014-07-19 (a few rows after AS_OF)

PLATFORMS = ["Android 4.4", "iOS 7.1", "Android 2.3", "iOS 8", "web", None]
RESULTS = ["success", "success", "cancelled", "error", "failure", None]
WIKIS = ["commonswiki", "commonswiki", "commonswiki", "testwiki", "enwiki", None]
TITLES = ["file:a b", "File:A b", "a", "", None, "été x", "Foo bar.jpg", "File:Foo bar.jpg", "x y z"]
USERS = ["alice", " Alice", "bob ", "Bob", "carol", "dave", None, "Ünal"]
UAS = ["Mozilla Android 4", "Darwin/13", "iPhone OS 7", "WikipediaApp/2 Android", "Mozilla desktop", None]
APP_ACTIONS = ["start", "preview", "saveAttempt", "saved", "other"]
CLICKS = ["hamburger", "hamburger-home", "search", "watchlist-a-z-more", "watchlist-feed-view",
          "diff-thank", "diff-view", "unknown-event", "page-toc-link", "nearby-button"]


def ts14(t: dt.datetime) -> str:
    return t.strftime("%Y%m%d%H%M%S")


def _times(rng: random.Random, n: int, midnight_every: int = 7):
    out = []
    for i in range(n):
        day = rng.randrange(DAYS)
        if day in (20, 41):  # two empty days
            day += 1
        if i % midnight_every == 0:
            t = START + dt.timedelta(days=day)  # exactly midnight
        else:
            t = START + dt.timedelta(days=day, seconds=rng.randrange(1, 86400))
        out.append(t)
    return out


def raw_rows(seed: int = 7) -> dict[str, tuple[str, list[tuple]]]:
    """``{table: (ddl_schema, rows)}``; timestamps are 14-digit text."""
    rng = random.Random(seed)
    tables: dict[str, tuple[str, list[tuple]]] = {}

    up_cols = ("id bigint, uuid string, clientIp string, isTruncated int, clientValidated int, "
               "timestamp string, webHost string, wiki string, event_appversion string, "
               "event_device string, event_filename string, {mult}event_platform string, "
               "event_result string, event_source string, event_username string")
    v1, v2 = [], []
    for i, t in enumerate(_times(rng, 400)):
        row = dict(id=i, uuid=f"u{i}", clientIp="ip", isTruncated=0, clientValidated=1,
                   timestamp=ts14(t), webHost="h", wiki=rng.choice(WIKIS), event_appversion="1",
                   event_device="d", event_filename=rng.choice(TITLES), event_multiple=rng.choice([0, 1]),
                   event_platform=rng.choice(PLATFORMS), event_result=rng.choice(RESULTS),
                   event_source="s", event_username=rng.choice(USERS))
        if i < 150:
            row["event_multiple"] = 0
            v1.append(row)
            if i % 10 == 0:  # the same event recorded in both versions: collapses
                v2.append(dict(row))
        else:
            v2.append(row)
    v1.append(dict(v1[0], id=999, uuid="u999", timestamp="2014x7"))  # malformed time
    order1 = ["id", "uuid", "clientIp", "isTruncated", "clientValidated", "timestamp", "webHost", "wiki",
              "event_appversion", "event_device", "event_filename", "event_platform", "event_result",
              "event_source", "event_username"]
    order2 = order1[:11] + ["event_multiple"] + order1[11:]
    tables["MobileAppUploadAttempts_5257716"] = (up_cols.format(mult=""), [tuple(r[c] for c in order1) for r in v1])
    tables["MobileAppUploadAttempts_5334329"] = (up_cols.format(mult="event_multiple int, "),
                                                 [tuple(r[c] for c in order2) for r in v2])

    tables["MobileWikiAppEdit_9003125"] = (
        "timestamp string, wiki string, userAgent string, event_action string",
        [(ts14(t), rng.choice(WIKIS), rng.choice(UAS), rng.choice(APP_ACTIONS)) for t in _times(rng, 300)])

    web_cols = ("timestamp string, wiki string, event_username string, event_action string, "
                "event_namespace int, event_userEditCount bigint")
    names = ["MobileWebEditing_5644223", "MobileWebEditing_6077315", "MobileWebEditing_6637866",
             "MobileWebEditing_7675117", "MobileWebEditing_8599025"]
    web = {n: [] for n in names}
    for i, t in enumerate(_times(rng, 400)):
        row = (ts14(t), rng.choice(WIKIS), rng.choice(USERS), rng.choice(["success", "success", "error", "init"]),
               rng.choice([0, 0, 1, 2, None]), rng.choice([0, 0, 3, 10]))
        web[names[i % 5]].append(row)
        if i % 13 == 0:
            web[names[(i + 1) % 5]].append(row)  # duplicate in another version
        if i % 17 == 0:
            web[names[i % 5]].append(row)  # duplicate within one version
    for n in names:
        tables[n] = (web_cols, web[n])

    tables["MobileAppLoginAttempts_5257721"] = (
        "timestamp string, wiki string, event_platform string, event_result string",
        [(ts14(t), rng.choice(WIKIS), rng.choice(PLATFORMS), rng.choice(RESULTS)) for t in _times(rng, 150)])
    tables["MobileAppShareAttempts_5346170"] = (
        "timestamp string, wiki string, event_platform string",
        [(ts14(t), rng.choice(WIKIS), rng.choice(PLATFORMS)) for t in _times(rng, 150)])

    uw_names = ["MobileWebUploads_5281063", "MobileWebUploads_5383883", "MobileWebUploads_7967082",
                "MobileWebUploads_8209043"]
    uw = {n: [] for n in uw_names}
    for i, t in enumerate(_times(rng, 200)):
        row = (ts14(t), rng.choice(WIKIS), rng.choice(["success", "error", "start"]), "f", rng.choice(USERS))
        uw[uw_names[i % 4]].append(row)
        if i % 9 == 0:
            uw[uw_names[(i + 2) % 4]].append(row)
    for n in uw_names:
        tables[n] = ("timestamp string, wiki string, event_action string, event_funnel string, "
                     "event_username string", uw[n])

    tables["MobileAppCategorizationAttempts_5359208"] = (
        "timestamp string, wiki string, event_platform string, `event_files-count` bigint, "
        "`event_categories-count` bigint",
        [(ts14(t), rng.choice(WIKIS), rng.choice(PLATFORMS), rng.choice([1, 2, 5]), rng.choice([0, 0, 1, 3]))
         for t in _times(rng, 300)])

    clicks = [(ts14(t), rng.choice(CLICKS)) for t in _times(rng, 500, midnight_every=5)]
    tables["MobileWebClickTracking_5929948"] = ("timestamp string, event_name string", clicks)
    tables["MobileOptionsTracking_8101982"] = (
        "timestamp string, event_beta string, event_alpha string, event_images string",
        [(ts14(t), rng.choice(["on", "off", None]), rng.choice(["on", "off", "x"]), rng.choice(["on", "off"]))
         for t in _times(rng, 200)])
    tables["Echo_7731316"] = (
        "timestamp string, event_notificationType string, event_eventSource string",
        [(ts14(t), rng.choice(["edit-thank", "edit-thank", "mention"]),
          rng.choice(["history", "diff", "mobilediff", "other"])) for t in _times(rng, 200)])
    tables["NewEditorEdit_6792669"] = (
        "timestamp string, event_userID bigint, event_isMobile int, event_userAge bigint",
        [(ts14(t), rng.randrange(8), rng.choice([0, 1]), rng.choice([100, 2592000, 2592001]))
         for t in _times(rng, 400)])

    # Wiki side: users 1..12 register; edits split between revision/archive.
    logging_rows, revision, archive, accounts = [], [], [], []
    log_id = 1
    for u in range(1, 13):
        reg = START + dt.timedelta(days=20 + 3 * u, hours=(u * 5) % 24)
        if u == 3:
            reg = START + dt.timedelta(days=30)  # exactly midnight
        logging_rows.append((log_id, "newusers", "create", 2, f"User{u}", u, ts14(reg)))
        log_id += 1
        n_edits = [4, 5, 6, 3, 7, 5, 0, 9, 5, 6, 4, 8][u - 1]
        for k in range(n_edits):
            t = reg + dt.timedelta(days=k * 4 % 29, hours=k)
            (revision if k % 2 == 0 else archive).append((u, ts14(t)))
        if u == 5:  # an edit exactly 30 days after registration
            revision.append((u, ts14(reg + dt.timedelta(days=30))))
        acc_t = reg - dt.timedelta(hours=1)
        ua = "WikipediaApp/1" if u == 8 else ("Mozilla" if u % 3 else None)
        accounts.append((ts14(acc_t), "enwiki" if u != 9 else "dewiki", ua, u, [1, 0, None][u % 3]))
        if u == 2:
            accounts.append((ts14(acc_t), "enwiki", ua, u, 1))  # repeated creation row
    # Upload / delete / move log rows on commons, matched by title.
    for i, title in enumerate(["A_b", "A_b", "Foo_bar.jpg", "Été_x", "X_y_z", "Other.png", "A"]):
        t = START + dt.timedelta(days=10 + 9 * i)
        logging_rows.append((log_id, "upload", "upload", 6, title, 50, ts14(t))); log_id += 1
        logging_rows.append((log_id, "delete", "delete", 6, title, 51, ts14(t + dt.timedelta(days=3))))
        log_id += 1
        if i % 3 == 0:
            logging_rows.append((log_id, "move", "move", 6, title, 52, ts14(t))); log_id += 1
    logging_rows.append((log_id, "delete", "delete", 0, "A_b", 51, ts14(START + dt.timedelta(days=40))))
    tables["logging"] = ("log_id bigint, log_type string, log_action string, log_namespace int, "
                         "log_title string, log_user bigint, log_timestamp string", logging_rows)
    tables["tag_summary"] = ("ts_log_id bigint, ts_tags string",
                             [(r[0], "mobile edit,mobile web edit" if r[0] % 2 else "visualeditor")
                              for r in logging_rows if r[2] == "upload"])
    tables["revision"] = ("rev_user bigint, rev_timestamp string", revision)
    tables["archive"] = ("ar_user bigint, ar_timestamp string", archive)
    tables["ServerSideAccountCreation_5487345"] = (
        "timestamp string, wiki string, useragent string, event_userId bigint, event_displaymobile int",
        accounts)
    tables["ipblocks"] = ("ipb_user bigint, ipb_timestamp string",
                          [(u, ts14(START + dt.timedelta(days=56 + u, hours=u))) for u in (1, 2, 2, 5, 8, 13)]
                          + [(4, ts14(START + dt.timedelta(days=60)))])
    tables["categorylinks"] = ("cl_from bigint, cl_to string",
                               [(i, c) for i, c in enumerate(["Uploaded_with_Mobile/Android"] * 5
                                                              + ["Uploaded_with_Mobile/iOS"] * 3
                                                              + ["Uploaded_with_Mobile/Web", "Other"])])
    tables["page"] = ("page_id bigint, page_title string", [(i, f"P{i}") for i in range(10)])
    tables["user"] = ("user_name string, user_editcount bigint",
                      [("Alice", 10), ("Bob", 3), ("carol", 7), ("Ünal", 1)])
    return tables


def raw_tables(spark, seed: int = 7):
    return {name: spark.createDataFrame(rows, ddl) for name, (ddl, rows) in raw_rows(seed).items()}
