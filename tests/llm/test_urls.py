import random

from tests.llm.support import folder, given, rows
from wardflow.llm import urls
from wardflow.llm.queries import QUERIES, URL_RULES


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    return lower(rest[:end]), path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]


def longest(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if host and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]), default=None)


URLS = [
    None, "", "no scheme", "http://", "http:///en/", "http://net", "http://NET/", "https://a.Example.NET/en/x?y#z",
    "http://example.net/en", "http://xexample.net/en/", "http://example.com/de/", "http://www.example.com/de/1",
    "http://org/fr/", "http://a.org/fr/x", "http://net./", "http://.net/", "http://user@b.net:80/", "http://b.net:80/",
    "http://x.net?q=/", "http://x.net#/en/", "x://a://b.net/", "http://é.net/é", "http://" + "a." * 2000 + "net/" + "p/" * 3000,
]


def pages(spark, found):
    return spark.createDataFrame(list(enumerate(found)), "page_id bigint, url string")


def test_query_matches_brute_force(spark):
    found = URLS + [p["url"] for p in given("pages", "sf0.01")] + ["http://hot.net/en/"] * 400
    place = folder(spark, pages=pages(spark, found).selectExpr("*", "'h' AS host", "1 AS rule"))
    got = rows(QUERIES["op9_urls"](spark, place))
    assert sorted(r["page_id"] for r in got) == list(range(len(found)))
    for row in got:
        url = found[row["page_id"]]
        rule = longest(url, URL_RULES)
        assert (row["host"], row["path"]) == parts(url)
        assert row["rule"] == (rule[0] + rule[1] if rule else None), (url, row)
        assert row["verdict"] == (rule[2] if rule else "allow" if row["host"] else "block")


def test_many_nested_rules(spark):
    random.seed(8)
    hosts = [".".join(random.choice("abc") for _ in range(random.randint(1, 4))) for _ in range(60)]
    paths = ["/" + "".join(random.choice("xy/") for _ in range(random.randint(0, 4))) for _ in range(30)] + [""]
    rules = [(random.choice(hosts), random.choice(paths), random.choice(urls.VERDICTS)) for _ in range(300)]
    found = [f"http://{random.choice(hosts)}{random.choice(paths)}{random.choice(['', 'x', '?q'])}" for _ in range(800)]
    df = urls.match_rules(pages(spark, found), spark.createDataFrame(rules, "host string, path string, verdict string"))
    got = rows(df)
    assert len(got) == len(found)
    for row in got:
        rule = longest(row["url"], rules)
        assert (row["rule"], row["rule_verdict"]) == ((rule[0] + rule[1], rule[2]) if rule else (None, None)), row


def test_ranges_dealt_into_parts_give_the_same(spark, monkeypatch):
    found = [f"http://a{i % 7}.net/{i % 11}" for i in range(300)] + ["http://example.net/en/x"] * 100
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    monkeypatch.setattr(urls, "MOST_RANGES", 3)
    monkeypatch.setattr(urls, "RANGE_ROWS", 20)
    got = rows(urls.match_rules(pages(spark, found), rules))
    assert len(got) == 400 and all(r["rule"] == "".join(longest(r["url"], URL_RULES)[:2]) for r in got)


def test_no_pages_and_no_rules(spark):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    some = pages(spark, ["http://a.net/"])
    assert urls.match_rules(some.limit(0), rules).count() == 0
    assert [r["rule"] for r in rows(urls.match_rules(some, rules.limit(0)))] == [None]
