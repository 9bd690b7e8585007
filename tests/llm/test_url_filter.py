import numpy as np

from logmetrics.llm import url_filter as u

SCHEMA = "page_id bigint, url string, html string, host string, verdict int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, url, html, "clash", 1) for i, url, html in rows], SCHEMA)


URLS = [
    (1, "https://a.example.org/en/2", None),
    (2, "https://a.example.org/es/2", ""),
    (3, "https://EXAMPLE.org/en/11?x#y", "<a>"),
    (4, "https://notexample.org/es/x", "x"),
    (5, "http://m.shop.com/fr/1#top", "x"),
    (6, "http://shop.com/de/1", "x"),
    (7, "http://shop.com/en/1", "x"),
    (8, "http://org", "x"),
    (9, "http://org/?q", "x"),
    (10, None, "x"),
    (11, "no scheme/fr/", "x"),
    (12, "http://b.net?x://y/z", "x"),
    (None, "ftp://c.com/fr/\nline", "x"),
    (12, "http://b.net?x://y/z", "x"),
]


def test_rules(spark):
    out = u.report(pages_of(spark, URLS)).collect()
    assert len(out) == len(URLS)
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out}
    assert by[1] == ("a.example.org", "/en/2", "org/", "allow")
    assert by[2][2:] == ("example.org/es/", "block")
    assert by[3] == ("example.org", "/en/11", "example.org/en/1", "block")
    assert by[4][2:] == ("org/", "allow")
    assert by[5] == ("m.shop.com", "/fr/1", "com/fr/", "allow")
    assert by[6][2:] == ("com/de/", "block")
    assert by[7][2] is None and by[7][3] == "block"  # its host holds a blocked page only
    assert by[8][1:3] == ("", None) and by[9] == ("org", "/", "org/", "allow")
    assert by[10] == ("", "", None, "allow") == by[11]
    assert by[12] == ("b.net", "", None, "allow")
    assert by[None][:3] == ("c.com", "/fr/\nline", "com/fr/")


def brute_rank(hosts, links, seeds, damping=u.DAMPING):
    n = len(hosts)
    w = np.zeros((n, n))
    for a, b, k in links:
        w[hosts.index(a), hosts.index(b)] += k
    out = w.sum(axis=1)
    s = np.array([seeds.get(x, 0.0) for x in hosts])
    # The fixed point itself: a walker jumps to a seed, or follows a link; without links it jumps.
    step = np.where(out[:, None] > 0, damping * w / np.where(out > 0, out, 1)[:, None] + (1 - damping) * s, s)
    values, vectors = np.linalg.eig(step.T)
    r = np.real(vectors[:, np.argmax(np.real(values))])
    return dict(zip(hosts, r / r.sum()))


def test_propagation_equals_matrix(spark):
    links = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "a", 1.0), ("d", "c", 1.0), ("c", "e", 3.0)]
    seeds = {"a": 0.75, "d": 0.25}
    got = u.propagate(spark.createDataFrame(list(seeds.items()), "host string, s double"), spark.createDataFrame(links, "src string, dst string, n double"))
    want = brute_rank(list("abcde"), links, seeds)
    assert {r.host for r in got.collect()} == set("abcde")
    for r in got.collect():
        assert abs(r.r - want[r.host]) < 1e-5
    assert abs(sum(want.values()) - 1) < 1e-9


def test_two_hosts_in_a_cycle_reach_the_fixed_point(spark):
    links = [("a", "b", 1.0), ("b", "a", 1.0)]
    got = u.propagate(spark.createDataFrame([("a", 1.0)], "host string, s double"), spark.createDataFrame(links, "src string, dst string, n double"))
    ranks = {r.host: r.r for r in got.collect()}
    assert abs(ranks["a"] - 1 / (1 + u.DAMPING)) < 1e-5 and abs(sum(ranks.values()) - 1) < 1e-9


def test_graph_decides_between_hosts(spark):
    rows = [(1, "http://bad.com/de/1", "x"), (2, "http://good.org/1", '<a href="https://near.net/x">n</a>'), (3, "http://farm.net/1", '<a class=x href=//bad.com/de/2>b</a> <a href="http://BAD.com/">b</a>')]
    rows += [(4, "http://near.net/1", "x"), (5, "http://lone.net/", "x"), (6, "http://farm.net/1", '<a href="http://bad.com/">')]
    by = {r.page_id: r.verdict for r in u.report(pages_of(spark, rows)).collect()}
    assert by == {1: "block", 2: "allow", 3: "block", 4: "allow", 5: "allow", 6: "block"}


def test_empty_and_clashing(spark):
    assert u.report(pages_of(spark, [])).count() == 0
    out = u.judge(pages_of(spark, URLS))
    assert out.columns == ["page_id", "url", "html", "host", "verdict", "host_", "path", "rule", "verdict_"]
