import re

import pytest

from lakeops.llm import urls

RULES = [("org", "/", "allow"), ("bad.org", "/", "block"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
SCHEMA = "page_id long, url string, html string, host string, rule string, rank double, kind int"


def run(spark, rows, rules=RULES, **how):
    df = spark.createDataFrame([(i, u, h, "x", "y", 0.0, 1) for i, u, h in rows], SCHEMA)
    table = spark.createDataFrame([(h, p, v, h + p) for h, p, v in rules], "host string, path string, verdict string, rule string")
    return {r.page_id: r for r in urls.judge(df, table, **how).collect()}


def slow(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), v == "block", h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[2:] if fit else None


URLS = [None, "", "no scheme", "http://", "http://A.EXAMPLE.org/es/1?x=/fr/", "https://example.org/en/1", "https://example.org/en/2", "https://example.org", "ftp://x.com/fr/#a/de/",
        "http://com/de/", "http://x.com?/de/", "http://xorg/", "http://a://b/fr/", "http://É.org/", "http://sub.bad.org/z", "http://a..com/de/", "http://u.net/" + "a" * 9000, "http://org/"]


def test_rules(spark):
    got = run(spark, [(i, u, None) for i, u in enumerate(URLS)])
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule = slow(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule and rule[0]), u
        assert rule is None or got[i].verdict == rule[1]


def propagate(edges, seeds, rounds, damping):
    """Personalised PageRank straight from the definition."""
    out = {}
    for (a, _), w in edges.items():
        out[a] = out.get(a, 0) + w
    rank = dict(seeds)
    for _ in range(rounds):
        new = {h: (1 - damping) * s for h, s in seeds.items()}
        for (a, b), w in edges.items():
            new[b] = new.get(b, 0) + damping * rank.get(a, 0) * w / out[a]
        rank = new
    return rank


def test_propagation(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">x</a><A HREF=//{h.upper()}/y>' for h in hosts)
    rows = [(1, "http://good.org/", link("friend.net")), (2, "http://friend.net/", link("far.net")), (3, "http://farm.net/", link("spam.bad.org", "farm2.net")),
            (4, "http://farm2.net/", link("farm.net")), (5, "http://spam.bad.org/", link("victim.net")), (6, "http://victim.net/", None), (7, "http://far.net/", "<a href='/local'>"),
            (8, "http://blog.farm.net/", ""), (1, "http://good.org/", link("friend.net"))]
    df = spark.createDataFrame([(i, u, h, "", "", 0.0, 0) for i, u, h in rows], SCHEMA)
    table = spark.createDataFrame([(h, p, v, h + p) for h, p, v in RULES], "host string, path string, verdict string, rule string")
    got = urls.judge(df, table, tolerance=1e-12).collect()
    verdict = {r.host: r.verdict for r in got}
    assert len(got) == len(rows)
    assert verdict["farm.net"] == verdict["farm2.net"] == verdict["blog.farm.net"] == "block"
    assert verdict["friend.net"] == verdict["far.net"] == verdict["victim.net"] == "allow"
    edges = {("good.org", "friend.net"): 4, ("friend.net", "far.net"): 2, ("farm.net", "spam.bad.org"): 2, ("farm.net", "farm2.net"): 2, ("farm2.net", "farm.net"): 2,
             ("spam.bad.org", "victim.net"): 2, ("blog.farm.net", "farm.net"): 1, ("farm.net", "blog.farm.net"): 1, ("spam.bad.org", "bad.org"): 1, ("bad.org", "spam.bad.org"): 1}
    trust = propagate(edges, {"good.org": 2 / 3}, 300, urls.DAMPING)
    distrust = propagate({(b, a): w for (a, b), w in edges.items()}, {"spam.bad.org": 1 / 3}, 300, urls.DAMPING)
    for r in got:
        assert abs((r.trust or 0) - trust.get(r.host, 0)) < 1e-9 and abs((r.distrust or 0) - distrust.get(r.host, 0)) < 1e-9, r.host


@pytest.mark.parametrize("length,tolerance", [(13, urls.TOLERANCE), (40, urls.TOLERANCE), (40, 0.5), (13, 1e-9)])
def test_verdicts_do_not_depend_on_the_rounds(spark, length, tolerance):
    """Every host of a chain to a blocked one is blocked, with any tolerance; ranks are within it of the limit."""
    rows = [(i, f"http://h{i}.net/", f'<a href="http://{"bad.org" if i == length - 2 else f"h{i + 1}.net"}/">x</a>') for i in range(length - 1)] + [(length, "http://bad.org/", None)]
    got = run(spark, rows, tolerance=tolerance)
    assert all(r.verdict == "block" for r in got.values()) and len(got) == length
    edges = {(f"h{i + 1}.net" if i < length - 2 else "bad.org", f"h{i}.net"): 1 for i in range(length - 1)}
    limit = propagate(edges, {"bad.org": 1.0}, 200, urls.DAMPING)
    assert sum(abs((r.distrust or 0) - limit[r.host]) for r in got.values()) <= 10 * tolerance


def test_sql_reaches_far_hosts(spark, tmp_path):
    """The query's SQL on a chain of 13 hosts."""
    import duckdb

    from lakeops.llm.sql import url_filter

    rows = [(i, f"http://h{i}.net/", f'<a href="http://{"bad.org" if i == 11 else f"h{i + 1}.net"}/">x</a>') for i in range(12)] + [(12, "http://bad.org/", None), (13, "http://x.org/", None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    found = {r[0]: r[4] for r in con.execute(url_filter(RULES)).fetchall()}
    assert found == {i: ("allow" if i == 13 else "block") for i in range(14)} == {i: r.verdict for i, r in run(spark, rows).items()}


def test_defined_cases(spark):
    assert run(spark, []) == {}
    assert {r.verdict for r in run(spark, [(1, "http://a.net/", None), (None, None, None)], rules=[]).values()} == {"allow"}
    tie = run(spark, [(1, "http://a.net/x", None)], rules=[("a.net", "/x", "allow"), ("a.net", "/x", "block")])
    assert tie[1].verdict == "block"
