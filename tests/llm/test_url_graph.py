import random
import re

import numpy as np
import pytest

from tidemark.llm import queries, url_graph


def plain(url):
    url = url or ""
    if "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, v) for h, p, v in [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def pagerank(links, mass, damping=url_graph.DAMPING, rounds=url_graph.ROUNDS):
    start = {h: (1 - damping) * m for h, m in mass.items()}
    now = dict(start)
    for _ in range(rounds):
        new = dict(start)
        for a, outs in links.items():
            for b in outs:
                if a in now:
                    new[b] = new.get(b, 0) + damping * now[a] / len(outs)
        now = new
    return now


def brute(pages, excess=url_graph.EXCESS):
    judged = {i: plain(u) for i, u, _ in pages}
    hosts, links = {}, {}
    for i, _, html in pages:
        host = judged[i][0]
        hosts.setdefault(host, []).append(judged[i][3])
        for link in re.findall(r"""(?:href|src|action)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)""", html or "", re.I):
            if host and host != link.lower():
                links.setdefault(host, set()).add(link.lower())
    for host in [h for h in hosts if h]:
        parent = host.split(".", 1)[1] if "." in host else None
        if parent in hosts and parent:
            links.setdefault(host, set()).add(parent)
            links.setdefault(parent, set()).add(host)
    back = {}
    for a, outs in links.items():
        for b in outs:
            back.setdefault(b, set()).add(a)
    ranks = []
    for verdict, graph in (("allow", links), ("block", back)):
        count = {h: v.count(verdict) for h, v in hosts.items() if h and verdict in v}
        total = sum(v.count(verdict) for v in hosts.values()) or 1
        rank = pagerank(graph, {h: n / total for h, n in count.items()})
        whole = sum(rank.values()) or 1
        ranks.append({h: x / whole for h, x in rank.items()})
    out = []
    for i, _, _ in pages:
        host, path, rule, verdict = judged[i]
        bad = ranks[1].get(host, 0) - ranks[0].get(host, 0) - excess * len(hosts[host]) / len(pages)
        out.append((i, host, path, rule, verdict or ("block" if round(bad, 12) > 0 else "allow")))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


def test_whole_table(spark, small):
    pages = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()]
    assert rows(queries.op7_url_filter(spark, small)) == brute(pages)


@pytest.fixture(scope="module")
def graph():
    a = lambda *hosts: "".join(f'<a href="https://{h}/x?y">t</a> <img src=//{h}>' for h in hosts)
    pages = [
        ("http://Bad.NET/es/1", a("other.org")), ("http://bad.net/fr/2", ""), ("http://bad.net/en/3", a("bad.net")),
        ("http://liker.org/", a("bad.net", "BAD.net", "far.org")), ("http://far.org/a", a("friend.org")), ("http://friend.org/b", a("liker.org")),
        ("https://good.com/x", a("nice.org", "liker2.org")), ("https://nice.org/", a("deep.org")), ("https://deep.org/", a("bad.net")),
        ("https://www.example.com/en/1", ""), ("https://m.example.com/en/1", ""), ("https://example.com/en", ""), ("https://example.com", ""),
        ("http://blog.nice.org/z#f", None), ("nothing", a("bad.net")), (None, None), ("x://", ""), ("http://?q", ""), ("http://a://b", ""), ("http://evil.com.org/en/", ""),
    ]
    return [(i, u, h) for i, (u, h) in enumerate(pages)]


def test_link_graph(spark, graph):
    df = spark.createDataFrame(graph, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as rule", "3 as links", "4 as score")
    got = rows(url_graph.verdicts(df))
    assert got == brute(graph)
    verdict = {r[1]: r[4] for r in got if r[3] is None}
    assert verdict["bad.net"] == "block" and verdict["liker.org"] == "block"
    assert verdict["deep.org"] == "block" and verdict["example.com"] == verdict[""] == "allow"


def test_hot_host_repeats_and_empty(spark, graph):
    pages = graph + [(100 + i, "http://bad.net/en/hot", '<a href="http://good.com">') for i in range(50)] + [graph[0], graph[0]]
    schema = "page_id long, url string, html string"
    assert rows(url_graph.verdicts(spark.createDataFrame(pages, schema))) == brute(pages)
    assert rows(url_graph.verdicts(spark.createDataFrame([], schema))) == []


def solved(links, mass):
    """The ranks as the solution of the linear system, without rounds."""
    hosts = sorted({h for pair in links for h in pair} | set(mass))
    at, passed = {h: i for i, h in enumerate(hosts)}, np.eye(len(hosts))
    for a, b in links:
        passed[at[b], at[a]] -= url_graph.DAMPING / sum(x == a for x, _ in links)
    x = np.linalg.solve(passed, [(1 - url_graph.DAMPING) * mass.get(h, 0) for h in hosts])
    return dict(zip(hosts, x))


def test_ranks_solve_the_linear_system(spark):
    rng = random.Random(4)
    chain = [(f"c{i}", f"c{i + 1}") for i in range(30)]
    ring = [("r0", "r1"), ("r1", "r2"), ("r2", "r0"), ("c5", "r0")]
    links = sorted({*chain, *ring, *[(f"m{rng.randrange(12)}", f"n{rng.randrange(12)}") for _ in range(40)], *[(f"n{i}", f"m{i}") for i in range(12)]})
    seeds = [("distrust", "c30", 0.6), ("distrust", "r1", 0.4), ("trust", "c0", 0.5), ("trust", "m1", 0.5)]
    df = spark.createDataFrame(links, "source string, target string").coalesce(1)
    got = {(r.kind, r.host): r.score for r in url_graph.propagate(df, spark.createDataFrame(seeds, "kind string, host string, mass double").coalesce(1)).collect()}
    for kind, pairs in (("trust", links), ("distrust", [(b, a) for a, b in links])):
        want = solved(pairs, {h: m for k, h, m in seeds if k == kind})
        assert {h for h, x in want.items() if abs(x) > 1e-15} == {h for k, h in got if k == kind}
        assert all(abs(want[h] - x) < 1e-11 for (k, h), x in got.items() if k == kind)


def test_far_end_of_a_chain_is_blocked(spark):
    """Fourteen hosts, of which the last is blocked: whoever links there over thirteen hops is blocked too."""
    link = lambda h: f'<a href="http://{h}/">'
    pages = [(i, f"http://h{i}.org/", link(f"h{i + 1}.org") if i < 12 else link("bad.net")) for i in range(13)] + [(13, "http://bad.net/es/", "")]
    pages += [(100 + i, f"http://plain{i}.org/", "") for i in range(300)]
    got = {r[1]: r[4] for r in rows(url_graph.verdicts(spark.createDataFrame(pages, "page_id long, url string, html string")))}
    assert all(got[f"h{i}.org"] == "block" for i in range(13)) and got["plain7.org"] == "allow"


def test_too_few_rounds_are_an_error(spark):
    df = spark.createDataFrame([(f"c{i}", f"c{i + 1}") for i in range(9)], "source string, target string").coalesce(1)
    with pytest.raises(ValueError):
        url_graph.propagate(df, spark.createDataFrame([("trust", "c0", 1.0)], "kind string, host string, mass double").coalesce(1), rounds=4)
