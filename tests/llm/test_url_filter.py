"""Verdicts against plain Python; the cascade's exactness."""

from __future__ import annotations

import random

import pytest
from helpers import SF, read, rows, word

from spendlake.llm.queries import ALLOWED_URLS, BAD_LABELS, BLOCKED_URLS
from spendlake.llm.url_filter import cascade, judge_urls

ODD = [
    None, "", "no scheme", "http://", "http:///x", "HTTPS://WWW.Example.COM/en/1?x", "http://example.com", "http://example.com/en",
    "http://example.com/en/", "http://badexample.com/en/", "x://y.net/fr/://z", "http://a.net?/es/", "http://net/es/1", "http://net/es/1#a",
    "ftp://u:p@spam-farm.example.com:80/", "http://a.spam-farm.org/", "http://spam-farm/", "http://example.com./en/", "http://..com//",
    "http://www.example.com/en/en/", "http://com/", "http://m.example.com/en/\n", "http://é.com/", "http://example.com/EN/", "http://" + "a." * 500 + "net/es/",
]


def judged(url: str | None) -> tuple:
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = []
    for rule in ALLOWED_URLS + BLOCKED_URLS:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    rule = max(fits, key=len, default=None)
    bad = any(label in BAD_LABELS for label in host.split("."))
    verdict = ("allow" if rule in ALLOWED_URLS else "block") if rule else "block" if bad else "allow"
    return host, path, rule, verdict


@pytest.mark.parametrize("most_bits", [1 << 26, 0])
def test_verdicts_equal_plain_python(spark, most_bits):
    """With the cascade, and with the join that long lists take."""
    urls = ODD + [r["url"] for r in rows(read(spark, "pages"))] + ODD[:3]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' as host", "'y' as keys", "true as allow")
    got = judge_urls(pages, ALLOWED_URLS, BLOCKED_URLS, BAD_LABELS, most_bits)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows(got)}
    assert found == {i: judged(u) for i, u in enumerate(urls)}
    assert SF


def test_cascade_is_exact_on_its_universe(spark):
    rng = random.Random(1)
    keys = sorted({word(rng) + str(rng.randint(0, 99)) for _ in range(20_000)})
    for share in (0.0, 0.01, 0.3, 1.0):
        rows_ = [(k, rng.random() < share) for k in keys]
        universe = spark.createDataFrame(rows_, "key string, listed boolean").cache()
        found = cascade(universe)
        assert universe.withColumn("member", found.has(universe["key"])).where("member <> listed").count() == 0
        if 0 < share < 1:
            assert len(found.levels) > 1


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert rows(judge_urls(pages, ALLOWED_URLS, BLOCKED_URLS, BAD_LABELS)) == []
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert rows(judge_urls(one, [], [], []))[0]["verdict"] == "allow"
