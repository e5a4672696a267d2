import re

import pytest
from pyspark.sql import functions as F

from feedloom.llm.url_filter import host_links, host_of, judge_urls, path_of, propagated, rule_of

ALLOW, BLOCK = ["org/", "com/fr/"], ["example.org/es/", "example.org/en/1", "com/de/"]
URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://A.Example.ORG/es/1?x#y", "http://example.org/en/17", "https://example.org/en/2",
    "http://xorg/", "http://org", "http://org/", "http://b.com/fr/", "http://b.com/fr", "http://b.com/de/x?/fr/", "http://b.com#/de/",
    "a://b.org/c://d", "http://ÀB.com/de/\n2", "x" * 100_000, "http://u:p@h.com:80/fr/a",
]
SCHEMA = "page_id long, url string, html string, host string, rule string, id long"


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = re.split(r"[?#]", rest[cut:], maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path


def _rule(host, path):
    found = []
    for rule in ALLOW + BLOCK:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            found.append(rule)
    return max(found, key=len, default=None)


def _pages(spark, rows):
    return spark.createDataFrame([(n, u, h, "x", "y", 0) for n, (u, h) in enumerate(rows)], SCHEMA).repartition(3)


def test_parts_and_rules(spark):
    rows = _pages(spark, [(u, None) for u in URLS])
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    for row in rows.select("url", host.alias("h"), path.alias("p"), rule_of(ALLOW + BLOCK, host, path).alias("r")).collect():
        assert (row.h, row.p) == _parts(row.url)
        assert row.r == _rule(row.h, row.p)


def test_links(spark):
    html = """<a href="http://B.com/x">1</a><A HREF='//c.com'>2</A><a href=/local>3</a><a href="https://a.com/y">own</a>
        <a class="x" href = "https://b.com?q">4</a><a href="mailto:x@d.com">5</a>"""
    got = host_links(_pages(spark, [("http://a.com/", html), ("http://a.com/2", html), (None, html), ("http://e.com/", None)]))
    assert sorted(map(tuple, got.collect())) == [("a.com", "b.com", 4), ("a.com", "c.com", 2)]


def _brute(rows, damping=0.85):
    hosts = [_parts(u)[0] for u, _ in rows]
    rules = [_rule(*_parts(u)) for u, _ in rows]
    seen = sum(r is not None for r in rules) or 1
    links = {}
    for host, (_, html) in zip(hosts, rows):
        for to in re.findall(r'href="http://([^/"]*)', html or ""):
            if host and to != host:
                links[host, to] = links.get((host, to), 0) + 1
    out = []
    for side, arcs in ((ALLOW, links), (BLOCK, {(b, a): n for (a, b), n in links.items()})):
        score = {}
        under_way = {}
        for host, rule in zip(hosts, rules):
            if host and rule in side:
                under_way[host] = under_way.get(host, 0) + (1 - damping) / seen
        for _ in range(200):
            after = {}
            for host, value in under_way.items():
                score[host] = score.get(host, 0) + value
                total = sum(n for (a, _), n in arcs.items() if a == host)
                for (a, b), n in arcs.items():
                    if a == host:
                        after[b] = after.get(b, 0) + damping * value * n / total
            under_way = after
        out.append(score)
    return hosts, rules, *out


def test_equals_brute_force(spark):
    def to(*hosts):
        return "".join(f'<a href="http://{h}/x">x</a>' for h in hosts)

    rows = [
        ("http://good.org/", to("n1.net", "n2.net", "n2.net")), ("http://good.org/b", to("n3.net")), ("http://n1.net/", to("n3.net", "bad.com")),
        ("http://bad.com/de/1", to("n4.net")), ("http://bad.com/de/2", None), ("http://bad.com/en", to("good.org")),
        ("http://n4.net/", to("bad.com")), ("http://n4.net/", to("bad.com")), ("http://n5.net/", to("n4.net")), ("http://n6.net/", ""),
        ("http://n2.net/", to("n1.net")), (None, to("bad.com")), *[(u, None) for u in URLS],
    ]
    hosts, rules, trust, distrust = _brute(rows)
    got = {r.id: r for r in judge_urls(_pages(spark, rows), ALLOW, BLOCK).collect()}
    assert len(got) == len(rows)
    assert distrust["n4.net"] > 0 and trust["n3.net"] > 0
    for n, (host, rule) in enumerate(zip(hosts, rules)):
        assert (got[n].host, got[n].rule) == (host, rule)
        assert got[n].trust == pytest.approx(trust.get(host, 0) if host else 0, abs=1e-3)
        assert got[n].distrust == pytest.approx(distrust.get(host, 0) if host else 0, abs=1e-3)
        if rule:
            assert got[n].verdict == ("allow" if rule in ALLOW else "block")
        else:
            assert got[n].verdict == ("block" if distrust.get(host, 0) > trust.get(host, 0) else "allow")
    assert got[6].verdict == "block" and got[9].verdict == "allow"


def test_empty_and_clash(spark):
    assert judge_urls(_pages(spark, []), ALLOW, BLOCK).collect() == []
    assert [r.verdict for r in judge_urls(_pages(spark, [("http://a.org/", "")]), [], []).collect()] == ["allow"]
    with pytest.raises(ValueError):
        judge_urls(_pages(spark, []), ["org/"], ["org/"])


def test_little_distrust_reaches_far_hosts(spark):
    # Trust ends at once, and 54 hosts are lined up before the blocked one.
    seeds = spark.createDataFrame([("good", 1.0, 0.0), ("h0", 0.0, 1e-6)], "host string, trust double, distrust double")
    links = spark.createDataFrame(
        [("good", "end", 1)] + [(f"h{n + 1}", f"h{n}", 1) for n in range(54)], "a string, b string, n long").coalesce(1)
    got = {r.host: (r.trust, r.distrust) for r in propagated(seeds.coalesce(1), links).collect()}
    assert got.pop("good") == pytest.approx((0.15, 0)) and got.pop("end") == pytest.approx((0.15 * 0.85, 0))
    assert len(got) == 55
    for n in range(55):
        assert got[f"h{n}"] == pytest.approx((0, 0.15e-6 * 0.85 ** n), rel=1e-9, abs=0)
