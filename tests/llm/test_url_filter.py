"""URL verdicts against a plain Python version, with small and large rule lists."""

import pytest

from graphweave.llm import url_filter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.b.example.com", "", "block"), ("b.example.com", "/x", "allow"), ("Example.com", "/xy", "block"), ("same.io", "/", "allow"),
         ("same.io", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("nopath.io", None, "block")]
URLS = [None, "", "no scheme", "http://", "http:///", "://net/", "http://net", "http://NET/", "http://a.net?x=/", "http://a.net/?q#f",
        "https://EXAMPLE.net/en/1", "https://sub.example.net/en", "https://xexample.net/en/1", "http://example.com/de/a?b", "http://example.com/DE/a",
        "http://a.b.example.com", "http://z.a.b.example.com/xyz", "http://b.example.com/xyz", "http://c.example.com/xyz#://net/",
        "ftp://u@org:80/fr/", "http://org/fr/é", "http://same.io/", "http://nopath.io", "http://nopath.io/any", "http://..net/", "x://y://net/",
        "http://" + "l." * 3000 + "net/" + "p/" * 5000, "http://a\nb.net/\n"]


def judged(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for h, p, v in rules:
        if not h:
            continue
        h, p = h.lower(), p or ""
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0,), (len(h) + len(p), len(h), v == "block", h + p, v))
    return host, path, best[3] if best else None, best[4] if best else default


@pytest.mark.parametrize("small", [True, False])
def test_equals_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(url_filter, "fits_broadcast", lambda df: small)
    rules = RULES + [(f"h{i}.example.org", f"/p{i % 7}/", "block") for i in range(200)]
    urls = URLS + [f"http://w.h{i}.example.org/p{i % 5}/x" for i in range(100)] + ["http://hot.net/"] * 500
    pages = spark.createDataFrame([(None if i == 3 else i // 2, u, "k", 1) for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, uid int").repartition(4)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    out = url_filter.judge(pages, table).collect()
    want = [(None if i == 3 else i // 2, *judged(u, rules)) for i, u in enumerate(urls)]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_empty(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge(pages, rules, default="block").collect()] == [(1, "a.net", "/", None, "block")]
    some = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_filter.judge(pages.limit(0), some).count() == 0
