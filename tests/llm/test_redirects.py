"""Url rules, links in pages, and decisions that reach aliases."""

from __future__ import annotations

import itertools
from urllib.parse import urldefrag, urljoin, urlsplit, urlunsplit

import pytest

from llm import redirects
from llm.redirects import rules
from llm_fixtures import tuned  # noqa: F401

RULES = rules(("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"))


def verdicts(tuned, rows, listed=RULES, more=None):
    pages = tuned.createDataFrame(rows, "page_id long, url string, html string, host string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in redirects.judge(pages, listed, more).collect()}


def test_hosts_paths_and_longest_rule(tuned):
    urls = [
        "http://Example.COM/en/a?x#y", "https://www.example.com/en/", "https://m.example.com/en", "http://badexample.com/en/",
        "http://x.net/es/1", "http://x.net?/es/", "http://x.org#://y/", "no scheme", None, "://a.com", "http://a.com:80/p", "a://b://c/d",
    ]
    found = verdicts(tuned, [(k, u, None, "clash") for k, u in enumerate(urls)])
    assert found[0] == ("example.com", "/en/a", "example.com/en/", "block")
    assert found[1] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert found[2] == ("m.example.com", "/en", "com/", "allow")
    assert found[3] == ("badexample.com", "/en/", "com/", "allow")
    assert found[4] == ("x.net", "/es/1", "net/es/", "block")
    assert found[5] == ("x.net", "", None, "allow")
    assert found[6] == ("x.org", "", None, "allow")
    assert found[7] == found[8] == ("", "", None, "allow")
    assert found[9] == ("a.com", "", None, "allow")
    assert found[10] == ("a.com:80", "/p", None, "allow")
    assert found[11] == ("b:", "//c/d", None, "allow")


def canonical(url):
    return f'<html><head><LINK href="{url}" rel="canonical"></head>'


def test_blocks_reach_aliases(tuned):
    rows = [
        (1, "http://a.org/", canonical("http://b.org/")),
        (2, "http://b.org/", "<meta http-equiv=\"refresh\" content=\"0; url=http://x.net/es/1\">"),
        (3, "http://c.org/", canonical("http://b.org/")),
        (4, "http://ok.com/1", canonical("http://a.org/")),  # its own rule allows it
        (5, "http://d.org/", canonical("/e")),
        (6, "http://d.org/e", None),
        (7, "http://free.org/", "canonical, but no link"),
        (1, "http://a.org/", canonical("http://b.org/")),
    ]
    found = verdicts(tuned, [(*r, None) for r in rows])
    assert {k: v[3] for k, v in found.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow"}


def test_more_links(tuned):
    more = tuned.createDataFrame([("http://d.org/", "http://x.net/es/2"), (None, "http://d.org/")], "a string, b string")
    found = verdicts(tuned, [(1, "http://d.org/", None, None), (2, None, None, None)], more=more)
    assert (found[1][3], found[2][3]) == ("block", "allow")


@pytest.mark.parametrize("listed", [RULES, []])
def test_empty_table(tuned, listed):
    assert verdicts(tuned, [], listed) == {}


def test_targets_against_urljoin(tuned):
    pages = ["http://h.org/a/b/c.html?x=1#f", "HTTP://H.org", "https://h.org:8080/a/", "http://h.org/a;p?q=/z/", "http://h.org?y"]
    targets = [
        "page.html", "./page.html", "../a", "../../../a", "..", ".", "a/./b/../c/", "?id=2", "#top", "page#top", "/r/../s?t=../u", "/", "//other.net/x",
        "http://Other.net/x#y", "go?to=http://other.net/", "HTTPS://other.net", "x/y:z", "?a#b",
    ]
    both = tuned.createDataFrame(list(itertools.product(pages, targets)), "a string, t string")
    for r in both.select("a", "t", redirects.node(redirects.resolved(redirects.F.col("a"), redirects.F.col("t"))).alias("b")).collect():
        want = urlsplit(urldefrag(urljoin(r.a, r.t))[0])
        assert r.b == urlunsplit(want._replace(netloc=want.netloc.lower())), (r.a, r.t)
    odd = tuned.createDataFrame([("http://h.org/", "mailto:a@h.org"), ("http://h.org/", "javascript:void(0)"), ("no host", "x")], "a string, t string")
    assert {r.b for r in odd.select(redirects.resolved(redirects.F.col("a"), redirects.F.col("t")).alias("b")).collect()} == {None}


@pytest.mark.parametrize("target", ["../es/1", "1", "./1", "/es/1", "//x.net/es/1", "HTTP://X.net/es/1", "http://x.net/es/1#top", "1#top"])
def test_blocks_follow_every_form(tuned, target):
    page, bad = "http://x.net/ok/p", "http://x.net/es/1"
    listed = rules(("block", "y.org/"))
    for html in (canonical(target), f'<meta http-equiv="refresh" content="0; url={target}">', canonical("http://first.org/") + canonical(target)):
        own = page if "es/" in target else "http://x.net/es/p"
        rows = [(1, own, html, None), (2, bad, canonical("http://Y.org/"), None), (3, bad + "#part", None, None), (4, "http://x.net/es/", None, None)]
        assert {k: v[3] for k, v in verdicts(tuned, rows, listed).items()} == {1: "block", 2: "block", 3: "block", 4: "allow"}


def test_query_only_and_second_refresh(tuned):
    html = '<meta http-equiv=refresh content="5; url=http://first.org/"><META HTTP-EQUIV="Refresh" CONTENT="0; URL=?id=2">'
    rows = [(1, "http://a.org/p?id=1", html, None), (2, "http://a.org/p?id=2", canonical("http://x.net/es/1"), None), (3, "http://first.org/", None, None)]
    assert {k: v[3] for k, v in verdicts(tuned, rows).items()} == {1: "block", 2: "block", 3: "block"}
