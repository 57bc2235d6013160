import re

from strata.llm import link_graph as G
from strata.llm.queries import QUERIES


def plain_host_path(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    return host.translate({k: k + 32 for k in range(65, 91)}), path


def plain_rule(host, path):
    fits = [r for r in G.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def plain_rank(edges, seeds, damping=G.DAMPING, rounds=G.ROUNDS):
    total = sum(seeds.values())
    seeds = {h: w / total for h, w in seeds.items()} if total else {}
    out = {}
    for (a, _), w in edges.items():
        out[a] = out.get(a, 0) + w
    rank = dict(seeds)
    for _ in range(rounds):
        moved = {}
        for (a, b), w in edges.items():
            if a in rank:
                moved[b] = moved.get(b, 0) + rank[a] * w / out[a]
        kept = sum(moved.values())
        rank = {h: damping * moved.get(h, 0) + seeds.get(h, 0) * (1 - damping * kept) for h in {*moved, *seeds}}
    return rank


def test_host_and_path(spark):
    urls = [None, "", "x", "http://", "http://A.b?c/d", "ftp://u@H:8/p/q?x://z/", "://q/#f", "http://a/b#c?d", "http://É.Net/"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [tuple(r) for r in df.select(G.host_of(df.u), G.path_of(df.u)).collect()]
    assert got == [plain_host_path(u) for u in urls]


def test_query(spark, folder):
    root, pages = folder
    got = QUERIES["op9_link_graph"](spark, f"{root}/messy").collect()
    key = lambda r: tuple(str(x) for x in r)
    want = []
    for i, url, _ in pages:
        host, path = plain_host_path(url)
        rule = plain_rule(host, path)
        want.append((i, host, path, rule and rule.text))
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(want, key=key)
    assert all(r.verdict == ("block" if r.rule in ("net/", "example.com/de/") else "allow") for r in got if r.rule)
    assert QUERIES["op9_link_graph"](spark, f"{root}/empty").count() == 0


def test_trust_and_distrust(spark):
    """A host that links to blocked hosts is blocked, one that trusted hosts link to is not."""
    link = lambda *hosts: "".join(f'<a class="x" href="https://{h}/p">x</a>' for h in hosts)
    pages = [(1, "http://bad.net/a", ""), (2, "http://farm.com/", link("bad.net", "bad.net", "other.com")),
             (3, "http://farm.com/2", link("bad.net")), (4, "http://good.org/fr/", link("friend.com")),
             (5, "http://friend.com/", ""), (6, "http://other.com/", ""),
             (7, "http://a.www.sub.com/", ""), (8, "http://lone.com/", None)]
    got = {r.page_id: r for r in G.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert {i: r.verdict for i, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow",
                                                     6: "allow", 7: "allow", 8: "allow"}
    edges = {("farm.com", "bad.net"): 2, ("farm.com", "other.com"): 1, ("good.org", "friend.com"): 1,
             ("a.www.sub.com", "www.sub.com"): 1, ("www.sub.com", "a.www.sub.com"): 1}
    trust = plain_rank(edges, {"good.org": 1})
    distrust = plain_rank({(b, a): w for (a, b), w in edges.items()}, {"bad.net": 1})
    for r in got.values():
        assert abs(r.trust - trust.get(r.host, 0)) < 1e-12 and abs(r.distrust - distrust.get(r.host, 0)) < 1e-12


def test_no_python_in_the_plan(spark, folder):
    plan = QUERIES["op9_link_graph"](spark, f"{folder[0]}/messy")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_hosts_with_mixed_pages_are_seeds(spark):
    """Any share of pages under a rule counts, as distrust, as trust, or as both."""
    pages = [(1, "http://example.com/de/", ""), (2, "http://example.com/x", ""),
             (3, "http://m.example.com/de/", ""), *((i, f"http://m.example.com/{i}", "") for i in (4, 5, 6)),
             (7, "http://a.org/fr/", ""), *((i, f"http://a.org/{i}", "") for i in (8, 9, 10)),
             (11, "http://example.net/en/", ""), (12, "http://example.net/x", ""),
             (13, "http://plain.com/", ""), (14, "http://lone.com/", "")]
    got = {r.page_id: r for r in G.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert {i for i, r in got.items() if r.verdict == "block"} == {1, 2, 3, 4, 5, 6, 12}
    trust = plain_rank({}, {"a.org": 0.25, "example.net": 0.5})
    distrust = plain_rank({}, {"example.com": 0.5, "m.example.com": 0.25, "example.net": 0.5})
    for r in got.values():
        assert abs(r.trust - trust.get(r.host, 0)) < 1e-12 and abs(r.distrust - distrust.get(r.host, 0)) < 1e-12
