import re
from itertools import combinations

from tidemark.llm import url_rules
from tidemark.llm.queries import URL_RULES, op7_url_rules

URLS = ["http://A.COM/x", "https://example.com/en/1?q=2", "http://www.example.com/en/2#t", "http://a.www.example.com/en/", "http://x.net/es/1",
        "http://net/es/", "http://snet/es/", "http://x.net/es", "http://x.org/a?b=c", "nothing", None, "", "http://", "://h.com/",
        "http://com", "http://h.com?x", "a://b.net/fr/c://d.com/", "http://é.COM/É/", "http://x.com:80/a", "http://a.com/\n/b"]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fits = [r for r in URL_RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0]))
            and path.startswith("/" + r.split("/", 1)[1])]
    rule = max(fits, key=len, default=None)
    return host, path, rule, URL_RULES.get(rule)


def test_given_rules(spark):
    df = spark.createDataFrame([(i, u, "mine", 3) for i, u in enumerate(URLS)], "page_id int, url string, rule string, tokens int")
    none = url_rules.mine(df.selectExpr("url", "'neither' verdict"))
    out = url_rules.judge(df, URL_RULES, none)
    assert out.columns == ["page_id", "url", "tokens", "host", "path", "rule", "verdict"]
    for r in out.collect():
        host, path, rule, verdict = brute(r["url"])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), r
    assert url_rules.judge(df.limit(0), URL_RULES, none).count() == 0


def test_mined_rules_match_brute_force(spark):
    rows = [(f"http://{h}.example.{t}/{p}/{i}", "block" if h == "spam" or (t == "org" and p == "ads") else "allow")
            for i in range(6) for h in ("spam", "good", "fine") for t in ("org", "info") for p in ("ads", "news")]
    df = spark.createDataFrame(rows, "url string, verdict string")
    rules = url_rules.mine(df, support=0.05, confidence=0.9, least=1)
    sets = {u: frozenset(r["t"]) for u, r in zip([u for u, _ in rows], df.select(url_rules.tokens(df["url"]).alias("t")).collect())}
    found = {(frozenset(r["items"]), r["verdict"]): (r["confidence"], r["support"]) for r in rules.collect()}
    every = {frozenset(c) for s in sets.values() for k in range(1, len(s) + 1) for c in combinations(sorted(s - {"host example"}), k)}
    want, n = {}, len(rows)
    for items in every:
        hit = [v for u, v in rows if items <= sets[u]]
        for v in ("allow", "block"):
            share = sum(x == v for x in hit) / len(hit) if hit else 0
            if sum(x == v for x in hit) / n >= 0.05 and share >= 0.9 and share > sum(x == v for _, x in rows) / n:
                want[items, v] = (share, sum(x == v for x in hit) / n)
    assert found.keys() == want.keys()
    assert all(abs(found[k][0] - want[k][0]) < 1e-9 and abs(found[k][1] - want[k][1]) < 1e-9 for k in want)
    new = spark.createDataFrame([("http://spam.example.info/x",), ("http://good.example.org/ads/1",), ("http://good.example.org/news/",)], "url string")
    assert [r["verdict"] for r in url_rules.judge(new, {}, rules).collect()] == ["block", "block", "allow"]


def test_a_hosts_verdict_does_not_depend_on_other_rows(spark):
    for others in (5_000, 60_000):
        rows = [(f"http://bad.example.org/p/{i}", "block") for i in range(30)]
        rows += [(f"http://h{chr(97 + i % 20)}.example.com/p/{i}", "block" if i % 10 == 0 else "allow") for i in range(others)]
        rules = url_rules.mine(spark.createDataFrame(rows, "url string, verdict string"))
        new = spark.createDataFrame([("http://bad.example.org/q/7",), ("http://hb.example.com/q/7",)], "url string")
        assert [r["verdict"] for r in url_rules.judge(new, {}, rules).collect()] == ["block", "allow"], others


def test_alike_urls_take_seconds_and_any_token_fits(spark):
    import time
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    rows = [("http://one.example.org/" + "/".join(words) + f"/{i}", "block") for i in range(25)]
    rows += [(f"http://two.example.org/{'/'.join(words[:2])}x/{i}", "allow") for i in range(60)]
    begun = time.time()
    rules = url_rules.mine(spark.createDataFrame(rows, "url string, verdict string"))
    new = [f"http://z.net/{w}" for w in words] + ["http://z.net/none", "http://one.example.org/none", "http://two.example.org/wab"]
    got = [r["verdict"] for r in url_rules.judge(spark.createDataFrame([(u,) for u in new], "url string"), {}, rules).collect()]
    assert time.time() - begun < 90 and rules.count() < 20
    # what FP-growth over single tokens would say: every token of the alike urls alone blocks, but the one that others have
    assert got == ["allow" if w == words[0] else "block" for w in words] + ["allow", "block", "allow"]


def test_a_late_token_counts_whatever_the_other_rows(spark):
    late = "/".join(f"c{chr(97 + i)}" for i in range(20)) + "/bad"
    for others in (9_000, 90_000):
        rows = [(f"http://{chr(97 + i % 5)}.example.org/{late if i % 5 == 0 else late[:-4]}/{i}", "block" if i % 5 == 0 else "allow") for i in range(150)]
        rows += [(f"http://h{chr(97 + i % 20)}.example.com/p/{i}", "block" if i % 10 == 0 else "allow") for i in range(others)]
        rules = url_rules.mine(spark.createDataFrame(rows, "url string, verdict string"))
        new = spark.createDataFrame([(f"http://x.example.net/{late}/7",), ("http://hb.example.com/q/7",)], "url string")
        assert [r["verdict"] for r in url_rules.judge(new, {}, rules).collect()] == ["block", "allow"], others


def test_registered_query(spark):
    out = op7_url_rules(spark, "/root/testdata/sf0.001")
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"] and out.count() == 50
