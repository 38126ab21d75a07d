"""URL filters against brute force over a graph in plain Python."""

import random
import re

import pytest

from mediamix.llm import urlfilter

PAGES = "page_id bigint, url string, html string, verdict string"
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"), ("block", "example.com", "/de/x"), ("allow", "a.example.com", "/d")]


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    query = re.match(r"(?:\?([^#]*))?", rest[len(host) + len(path) :])[1] or ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path, query


def usual(host, path, query):
    if re.match(r"(www|m)\.[^.]+\.", host):
        host = host.split(".", 1)[1]
    kept = sorted(p for p in query.split("&") if p and not re.match(r"(utm_\w*|ref|fbclid|gclid)(=|$)", p, re.I))
    return host, re.sub(r"(/index)?\.html?$", "", path).rstrip("/"), "&".join(kept)


def node(host, path, query):
    return host + path + ("?" + query if query else "") if host else None


def rule_of(host, path, rules):
    fits = [(-len(h + p), v, h + p) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(fits, default=None)


def brute(pages, rules, links=()):
    neighbours, verdicts = {}, {}

    def known(url):
        own, plain = parts(url), usual(*parts(url))
        for p in (own, plain):
            if p[0]:
                fit = rule_of(p[0], p[1], rules)
                verdicts.setdefault(node(*p), set()).add(fit and fit[1])
        if own[0]:
            join(node(*own), node(*plain))
        return node(*own)

    def join(a, b):
        neighbours.setdefault(a, set()).add(b)
        neighbours.setdefault(b, set()).add(a)

    for _, url in pages:
        known(url)
    for a, b in links:
        a, b = known(a), known(b)
        if a and b:
            join(a, b)
    out = []
    for number, url in pages:
        host, path, query = parts(url)
        fit = rule_of(host, path, rules)
        verdict = fit and fit[1]
        if not fit:
            seen, todo = set(), [node(host, path, query)] if host else []
            while todo:
                n = todo.pop()
                if n not in seen:
                    seen.add(n)
                    todo += neighbours.get(n, ())
            found = set().union(*(verdicts[n] for n in seen)) if seen else set()
            verdict = "block" if "block" in found and "allow" not in found else "allow"
        out.append((number, host, path, fit and fit[2], verdict))
    return sorted(out, key=repr)


def ours(spark, rows, rules=RULES, redirects=None):
    df = spark.createDataFrame([(i, u, h, "own") for i, u, h in rows], PAGES)
    links = None if redirects is None else spark.createDataFrame(redirects, "source string, target string")
    out = urlfilter.judge(df, urlfilter.rule_table(spark, rules), links)
    assert out.columns == [*df.columns, "host", "path", "rule", "verdict_"]
    assert not out.where("verdict <> 'own'").count()
    return sorted((tuple(r) for r in out.select("page_id", "host", "path", "rule", "verdict_").collect()), key=repr)


def test_random_urls_and_redirects(spark):
    rng = random.Random(2)
    hosts = ["example.com", "www.example.com", "A.Example.com", "x.net", "example.net", "e.org", "m.e.org", "other.io", "b.other.io", "net", "badexample.com"]
    ends = ["", "/", "/de", "/de/", "/de/x", "/en/1", "/en/1.html", "/fr/2?utm_source=a", "/fr/2#x", "/d?b=1&a=2", "/d?a=2&ref=q&b=1", "?q=/de/"]
    urls = [rng.choice(["http://", "https://", "http://", "no scheme "]) + rng.choice(hosts) + rng.choice(ends) for _ in range(200)] + [None, "", "://", "http://"]
    links = [(rng.choice(urls), rng.choice(urls)) for _ in range(60)]
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(None, urls[0], None), (3, urls[3], "")]
    assert ours(spark, rows, redirects=links) == brute([(i, u) for i, u, _ in rows], RULES, links)


def test_declared_links(spark):
    page = "<html><head>{}</head></html>"
    rows = [
        (1, "http://ok.io/a/b", page.format('<LINK href="https://example.com/de/1" rel="canonical">')),
        (2, "http://ok.io/c", page.format("<meta http-equiv=refresh content='0; URL=/a/b'>")),
        (3, "http://ok.io/d", page.format('<!-- <link rel=canonical href="//x.net/"> --><script>"<link rel=canonical href=//x.net/>"</script>')),
        (4, "http://ok.io/e", page.format("<link rel=canonical href=//x.net/q?a=1&amp;b=2>")),
        (5, "http://ok.io/f/g", page.format('<link rel="canonical" href="./h">')),
        (6, "http://ok.io/f/h", page.format('<link rel="canonical" href="http://x.net/">')),
        (7, "http://ok.io/i", page.format('<link rel="stylesheet" href="http://x.net/canonical">')),
        (8, "http://e.org/fr/1", page.format('<link rel="canonical" href="http://x.net/">')),
        (9, "http://ok.io/j", page.format('<link rel="canonical" href="http://e.org/fr/9">')),
        (10, "http://example.com/de/2", page.format('<link rel="canonical" href="http://ok.io/j">')),
    ]
    verdicts = {r[0]: r[4] for r in ours(spark, rows)}
    # 6 and 8 name the same address: its block meets an explicit allow, which comes first for aliases
    assert verdicts == {1: "block", 2: "block", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "allow", 10: "block"}


def test_long_chains_and_hubs(spark):
    chain = [(f"http://c.io/{i}", f"http://c.io/{i + 1}") for i in range(200)] + [("http://c.io/200", "http://x.net/")]
    hub = [(f"http://h.io/{i}", "http://hub.io/") for i in range(2000)] + [("http://hub.io/", "http://example.com/de/")]
    rows = [(i, a, None) for i, (a, _) in enumerate(chain[:-1] + hub[:-1])]
    assert {r[4] for r in ours(spark, rows, redirects=chain + hub)} == {"block"}


@pytest.mark.parametrize("rules", [[], [("block", "io", "")], [("block", "c.io", "/a"), ("allow", "c.io", "/a")]])
def test_other_rules_and_no_rows(spark, rules):
    rows = [(1, "http://c.io/a", None), (2, "http://c.io", None), (3, None, None)]
    assert ours(spark, rows, rules) == brute([r[:2] for r in rows], rules)
    assert ours(spark, [], rules) == []
