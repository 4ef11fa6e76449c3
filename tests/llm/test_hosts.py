import pytest

from carestrata.llm import hosts as m

PAGES = "page_id long, url string, html string, host string, score int"


def judged(spark, rows):
    frame = spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(rows)], PAGES)
    return {r.page_id: r for r in m.judge_urls(frame).collect()}


def test_rules_and_parts(spark):
    rows = [
        ("https://A.Example.ORG/es/x?q#f", None),
        ("http://example.org/en/12", ""),
        ("http://example.org/en/2", ""),
        ("http://notexample.org/es/", ""),
        ("ftp://x.com/fr/", ""),
        ("http://com/de/", ""),
        ("http://org", ""),
        ("http://a.net?x=/de/", ""),
        ("no scheme", "x"),
        (None, None),
        ("a://b://c.org/x", ""),
    ]
    r = judged(spark, rows)
    assert (r[0].host, r[0].path, r[0].rule, r[0].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert [r[i].rule for i in range(1, 7)] == ["example.org/en/1", "org/", "org/", "com/fr/", "com/de/", None]
    assert (r[7].host, r[7].path) == ("a.net", "") and (r[8].host, r[8].path) == ("", "") == (r[9].host, r[9].path)
    assert r[8].verdict == r[9].verdict == "allow" and r[10].host == "b:"


def test_distrust_goes_against_links_and_trust_along_them(spark):
    bad, good = "http://bad.example.org/es/1", "http://good.example.org/it/1"
    rows = [
        (bad, ""),
        (good, '<a href="http://friend.net/x">f</a>'),
        ("http://farm.net/", '<a HREF=http://Bad.example.org/es/1>b</a>'),
        ("http://friend.net/", ""),
        ("http://mixed.net/", '<a href="http://bad.example.org/es/1"></a>'),
        ("http://sub.farm.net/", None),
        ("http://lonely.net/", ""),
    ]
    r = judged(spark, rows)
    assert r[2].verdict == "block" and r[2].trust == 0 and r[2].distrust > 0
    assert r[3].verdict == "allow" and r[3].trust > 0
    assert r[5].verdict == "block"  # linked with the domain above
    assert r[6].verdict == "allow" and r[6].trust == r[6].distrust == 0


def test_scores_against_a_plain_loop(spark):
    edges = {("a", "b"): 0.5, ("a", "c"): 0.5, ("b", "c"): 1.0, ("c", "a"): 1.0}
    seeds = {"a": 0.7, "c": 0.3}
    want = dict(seeds)
    for _ in range(4):
        new = {k: v * (1 - m.DAMPING) for k, v in seeds.items()}
        for (s, d), share in edges.items():
            new[d] = new.get(d, 0) + want.get(s, 0) * share * m.DAMPING
        want = new
    e = spark.createDataFrame([("t", s, d, x) for (s, d), x in edges.items()], "kind string, src string, dst string, share double")
    s = spark.createDataFrame([("t", h, x) for h, x in seeds.items()], "kind string, host string, seed double")
    got = {r.host: r.score for r in m.spread(e, s, 4, m.DAMPING).collect()}
    assert got == pytest.approx(want)


def test_no_pages(spark):
    assert m.judge_urls(spark.createDataFrame([], PAGES)).count() == 0


def test_long_chains_ties_and_odd_pages(spark):
    rows = [("http://bad.example.org/es/1", "")]
    rows += [(f"http://h{i}.net/", f'<a href="http://h{i - 1}.net/">x</a>' if i else '<a href="http://bad.example.org/">x</a>') for i in range(40)]
    rows += [("http://good.example.org/it/", '<a href="http://both.net/">x</a>'), ("http://both.net/", '<a href="http://bad.example.org/">y</a>' * 2)]
    frame = spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(rows)] + [(None, "http://h3.net/", None, "x", 1), (1, *rows[1], "x", 1)], PAGES)
    found = m.judge_urls(frame).collect()
    assert len(found) == len(rows) + 2
    assert all(r.verdict == "block" for r in found if r.host.startswith("h"))
    assert m.ROUNDS == 57 and m.DAMPING**57 <= m.BOUND < m.DAMPING**56


def test_equal_scores_are_allowed(spark):
    rows = [("http://b.example.org/es/1", ""), ("http://g.example.org/it/1", '<a href="http://t.net/">x</a>'), ("http://t.net/", '<a href="http://b.example.org/">y</a>')]
    r = judged(spark, rows)
    assert r[2].trust == r[2].distrust > 0 and r[2].verdict == "allow"
