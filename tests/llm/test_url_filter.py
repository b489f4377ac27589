"""URL verdicts against the rules read out loop by loop."""

import random
import re

import pytest
from fixtures import LOWER_AZ

from stockflow.llm import url_filter
from stockflow.llm.queries import URL_RULES

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("b.c", "", "block")]


def split(url):
    """(host, path) read character by character."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.split("[/?#]", rest)[0]
    return host.translate(LOWER_AZ), re.split("[?#]", rest[len(host) :])[0]


def brute(url, rules, default="allow"):
    host, path = split(url)
    fits = [
        (len(h) + len(p), len(h), h + p, verdict)
        for h, p, verdict in rules
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def rules_of(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.ORG", "http://example.org/", "http://example.org/en/1",
    "http://example.org/en/12?x=://b.c/", "http://example.org/en/2#/en/1", "http://badexample.org/en/1", "x://a://org/",
    "http://deep.er.example.org/es/", "http://example.org/es", "http://org/", "http://org?/", "http://.org/", "http://a..org/x",
    "http://org./", "http://user@example.org:80/en/1", "http://B.C", "http://a.b.c/any", "http://É.org/é", "http:///org/",
    "\nhttp://example.org\n/en/1", "http://" + "a." * 3000 + "org/", "http://org/" + "x" * 100_000, "http://example.org/en/1",
]


def test_odd_urls(spark):
    found = url_filter.judged(pages(spark, ODD_URLS), rules_of(spark, RULES), ["page_id"]).collect()
    assert sorted(map(tuple, found)) == [(k, *brute(u, RULES)) for k, u in enumerate(ODD_URLS)]


def test_random_rules_and_urls(spark):
    rng = random.Random(12)
    name = lambda n: ".".join(rng.choice("abc") for _ in range(rng.randint(1, n)))
    path = lambda n: "".join(rng.choice("/ab") for _ in range(rng.randint(0, n)))
    rules = list({(name(3), p and "/" + p): rng.choice(["allow", "block"]) for p in (path(3) for _ in range(60))}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{name(4)}/{path(5)}{rng.choice(['', '?a', '#b'])}" for _ in range(400)]
    for default in ("allow", "block"):
        found = url_filter.judged(pages(spark, urls), rules_of(spark, rules), ["page_id"], default=default).collect()
        assert sorted(map(tuple, found)) == [(k, *brute(u, rules, default)) for k, u in enumerate(urls)]


def test_rules_without_a_host_count_for_nothing_and_block_wins(spark):
    rules = [(None, "/", "block"), ("", "/", "block"), ("A.B", None, "allow"), ("a.b", "", "block"), ("c.d", "/x", None)]
    urls = ["http:///", "http://x.a.b/q", "http://c.d/xy", None]
    found = sorted(map(tuple, url_filter.judged(pages(spark, urls), rules_of(spark, rules), ["page_id"]).collect()))
    assert [r[3:] for r in found] == [(None, "allow"), ("a.b", "block"), ("c.d/x", "allow"), (None, "allow")]


@pytest.mark.parametrize("rules", [[], [("", "", "block")]])
def test_no_rules_or_no_pages(spark, rules):
    found = url_filter.judged(pages(spark, ["http://a/b"]), rules_of(spark, rules), ["page_id"]).collect()
    assert [tuple(r) for r in found] == [(0, "a", "/b", None, "allow")]
    assert url_filter.judged(pages(spark, []), rules_of(spark, RULES), ["page_id"]).collect() == []


def test_rows_stay_whole_whatever_their_columns_are_called(spark):
    names = ["host", "path", "rule", "verdict", "_kept", "row", "short", "labels", "best"]
    rows = pages(spark, ["http://example.org/es/a", "http://org/", None, "http://org/"])
    for k, name in enumerate(names):
        rows = rows.selectExpr("*", f"{k} AS `{name}`")
    kept = url_filter.allowed(rows, rules_of(spark, RULES))
    assert kept.columns == rows.columns
    assert sorted(map(tuple, kept.select("page_id", "url", *names).collect()), key=lambda r: r[0]) == [
        (1, "http://org/", *range(9)), (2, None, *range(9)), (3, "http://org/", *range(9))
    ]


def test_rules_of_any_number_are_joined_by_the_short_hash(spark):
    rules = rules_of(spark, URL_RULES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = url_filter.judged(pages(spark, ["http://a/b"]), rules, ["page_id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"Join \[short#\d+\], \[short#\d+\], Inner", text) and "NestedLoop" not in text and "Cartesian" not in text
