import re

from thalweg.llm import registry, urlfilter

URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Net", "http://a.net/", "http://Example.NET/en/1?x=http://b.net/", "http://xexample.net/en/",
    "http://example.net/EN/", "https://m.example.com/de/", "https://m.example.com/de", "ftp://a.org/fr/x#y", "http://a.org:80/fr/", "x://y://z.net/q",
    "http://casino-win.example.com/", "http://mycasino.example.com/", "http://a.com?b=casino-x", "http://a.com#net/", "http://a.com/casino/", "http://spam:1/",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    rule, action = None, None
    for a, r in registry.STATED_RULES:
        h, p = r.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(r) > len(rule or ""):
            rule, action = r, a
    if action is None:
        action = "block" if set(re.split("[.:-]", host)) & set(urlfilter.UNWANTED) else "allow"
    return host, path, rule, action


def test_judge(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS * 2)] + [(None, URLS[5], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, subject string")
    stated = [urlfilter.domain_rule(a, r) for a, r in registry.STATED_RULES]
    own = [urlfilter.word_rule("block", w) for w in urlfilter.UNWANTED]
    got = urlfilter.judge(pages, urlfilter.rules(spark, stated + own)).collect()
    mine = [(x.page_id, x.host, x.path, x.rule if (x.priority or 0) > 0 else None, x.action or "allow") for x in got]
    assert sorted(mine, key=str) == sorted(((i, *brute(u)) for i, u, *_ in rows), key=str)
    assert urlfilter.judge(pages.limit(0), urlfilter.rules(spark, stated)).count() == 0


def test_rule_without_token_and_ties(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    rows = [("any", "allow", 5, "^a", []), ("b", "allow", 9, "c$", ["c"]), ("a", "block", 9, "c$", ["a", "c"]), ("a", "block", 9, "c$", ["a", "c"])]
    got = urlfilter.judge(pages, urlfilter.rules(spark, rows)).first()
    assert (got.rule, got.action) == ("a", "block")
    assert urlfilter.judge(pages, urlfilter.rules(spark, rows[:1])).first().rule == "any"
    assert urlfilter.judge(pages, urlfilter.rules(spark, [])).first().rule is None
