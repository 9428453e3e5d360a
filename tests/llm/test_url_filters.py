from canopy.llm import url_filters
from canopy.llm.queries import URL_RULES

URLS = ["http://a.example.net/en/x?y#z", "http://EXAMPLE.NET/en", "http://example.net", "http://notexample.com/de/",
        "https://x.example.com/de/1", "https://example.com/de", "ftp://q.org/fr/", "org/fr/", None, "", "://org/fr/x",
        "http://org?x=/fr/", "http://net/", "http://a..net/", "x://y://net/", "http://é.net/en/\nq", "HTTP://ORG/FR/",
        "http://u@b.org:80/fr/", "http://b.org/fr/" + "p/" * 5000]


def judged(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        k = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:k])
        rest = rest[k:]
        path = rest[:min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_against_plain_rules(spark):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)] + [(0, URLS[0], "x"), (None, URLS[4], "x")],
                                  "page_id long, url string, host string")
    got = url_filters.judge(pages, url_filters.rule_table(spark, URL_RULES)).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = URLS[4] if r["id"] is None else URLS[r["id"]]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(url)


def test_rules_that_repeat_or_conflict(spark):
    rules = url_filters.rule_table(spark, [("allow", "A.com", "/x"), ("block", "a.com", "/x"), ("block", None, "/"),
                                           ("block", "b.com", None), ("block", "c.com", "")])
    pages = spark.createDataFrame([(1, "http://a.com/xyz"), (2, "http://b.com/"), (3, "http://s.c.com")],
                                  "page_id long, url string")
    got = {r["id"]: (r["rule"], r["verdict"]) for r in url_filters.judge(pages, rules).collect()}
    assert got == {1: ("a.com/x", "block"), 2: (None, "allow"), 3: ("c.com", "block")}


def test_empty_tables(spark):
    rules = url_filters.rule_table(spark, URL_RULES)
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.judge(none, rules).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert url_filters.judge(one, rules.limit(0)).collect()[0]["verdict"] == "allow"
