"""Hosts, paths and rules against Python; propagation against a plain power iteration."""

import re
from collections import Counter, defaultdict

import numpy as np
from foliomill.llm import queries, url_filter

URLS = [
    "http://Www.Example.COM/en/x?y#z", "https://a.example.com/en/", "https://example.com/en", "ftp://m.x.net/fr/1", "http://net/es/",
    "http://xnet/es/", "http://a.com", "http://a.com?x=/en/", "no scheme/com/", None, "", "://", "http://ü.com/É//://x", "a://b.net:80/es/é",
    "http://blog.www.example.com/en/7", "http://a.org/\nfr/",
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def limit(flow, own, d=0.85):
    """The scores x with x = own + d * flow x, by solving the equations."""
    hosts = sorted({*own, *(h for e in flow for h in e)})
    at = {h: k for k, h in enumerate(hosts)}
    m = np.eye(len(hosts))
    for (a, b), share in flow.items():
        m[at[b], at[a]] -= d * share
    x = np.linalg.solve(m, [own.get(h, 0.0) for h in hosts]) if hosts else []
    return dict(zip(hosts, x, strict=True))


def brute(pages, threshold=0.25):
    rows = [(i, *plain(u), h) for i, u, h in pages]
    ruled = [plain_rule(h, p) for _, h, p, _ in rows]
    of = defaultdict(list)
    for (_, h, _, _), (_, v) in zip(rows, ruled, strict=True):
        if h:
            of[h].append(v)
    edges, total = Counter(), Counter()
    for _, h, _, html in rows:
        for x in re.findall(r"""href\s*=\s*["']?\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#"'\s<>]+)""", html or "", re.I):
            if h and x.lower() != h:
                edges[h, x.lower()] += 1
                total[h] += 1
    part = lambda h, v: of[h].count(v) / len(of[h])
    trust = limit({(a, b): n / total[a] for (a, b), n in edges.items()}, {h: part(h, "allow") for h in of})
    distrust = limit(
        {(b, a): n / total[a] for (a, b), n in edges.items()}, {h: (0.15 if total[h] else 1.0) * part(h, "block") for h in of}
    )
    out = []
    for (i, h, p, _), (rule, v) in zip(rows, ruled, strict=True):
        bad = distrust.get(h, 0.0)
        own = "block" if bad > threshold and bad > trust.get(h, 0.0) else "allow"
        out.append((i, h, p, rule, v or own))
    return out


def test_graph(spark):
    to = lambda *hosts: "".join(f'<a HREF = "//{h}/x">' if k % 2 else f"<a href='https://{h}?q'>" for k, h in enumerate(hosts))
    pages = [
        (1, "http://bad.example.com/en/1", ""), (2, "http://bad.example.com/en/2", None), (3, "http://good.com/", to("near.org", "near.org", "mixed.org")),
        (4, "http://links-to-bad.org/", to("bad.example.com", "Bad.Example.com")), (5, "http://near.org/", to("x.org")),
        (6, "http://mixed.org/", to("bad.example.com", "good.com")), (7, "http://far.org/", to("links-to-bad.org", "far2.org")), (8, None, to("x.org")),
        (None, "http://lone.org/", '<a href="/local">'), (4, "http://links-to-bad.org/", to("bad.example.com")), (9, "http://far.org/p", "x" * 200000),
    ]
    pages += [(100 + k, u, "") for k, u in enumerate(URLS)]
    pages += [(200 + k, f"http://linker{k}.org/", to("bad.example.com", "bad.example.com", "else.org")) for k in range(30)]
    pages += [(300, "http://portal.org/", to("bad.example.com", *[f"site{k}.org" for k in range(40)]))]
    pages += [(400, "http://ring-a.org/", to("ring-b.org")), (401, "http://ring-b.org/", to("ring-a.org", "bad.example.com"))]
    pages += [(500 + k, f"http://part.net/{p}/{k}", "") for k, p in enumerate(("fr", "en", "en"))]
    frame = spark.createDataFrame([(*p, "w", 2) for p in pages], "page_id long, url string, html string, host string, verdict int").repartition(3)
    for most_small in (200_000, 0):
        rows = url_filter.judge(frame, most_small=most_small).collect()
        got = sorted(str((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in rows)
        assert got == sorted(map(str, brute(pages)))
        verdict = {r.page_id: r.verdict for r in rows}
        assert [verdict[i] for i in (4, 7, 400, 401)] == ["block"] * 4  # two links away, and round a ring
        assert {verdict[200 + k] for k in range(30)} == {"block"}  # however many link to it
        assert verdict[300] == "allow" and verdict[5] == "allow"  # one link of many
        assert (verdict[500], verdict[501], verdict[502]) == ("block", "block", "block")  # a third of its pages
        assert all(0 <= r.distrust <= 1 for r in rows)
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    rows = queries.QUERIES["op9_url_filter"](spark, sf).collect()
    assert sorted(str((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in rows) == sorted(map(str, brute(pages)))
    assert {r.verdict for r in rows if r.rule is None} == {"allow", "block"}
