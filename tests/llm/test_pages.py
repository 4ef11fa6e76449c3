import random

import numpy as np
import pyarrow as pa
import pytest

from carestrata.llm import pages as m


def kept(html):
    ((text, _),) = m.main_texts([m.blocks_of(html)])
    return text


@pytest.mark.parametrize("html, text", [
    (None, ""),
    ("", ""),
    ("plain  text \n here", "plain text here"),
    ("<article><h1>A &amp;amp; b</h1><p>one<br>two&nbsp;three</p><p><b>x</b>y</article>after", "A &amp; b\n\none two three\n\nxy"),
    ("<p>cut &am", "cut &am"),
    ("<nav><ul><li>menu</ul></nav><div class='ad'>buy</div><p>text</p><footer>c</footer>", "text"),
    ("<body><header>site</header><article><header><h1>T</h1></header><p>x</p></article></body>", "T\n\nx"),
    ("<script>var t='</p>';</script><style>p{}</style><p>a<!-- <p>no</p> -->b</p><noscript>no</noscript>", "ab"),
    ("<article><p>a</p><aside>no</aside><form><input value='>'>no</form><p>b</p></article>", "a\n\nb"),
    ("<article><p>a</p><section id='comments'><article class='comment'><p>no</p></article></section></article>", "a"),
    ("<main><div>in main</div><article><p>in article</p></article></main>", "in article"),
    ("<div role='main'><div>x</div>y</div><div>z</div>", "x\n\ny"),
    ("<div class='cookieNotice'>no<div>no</div></div><div>yes</div>", "yes"),
    ("<div class='menu'>left open <article>yes</article>", "yes"),
    ("<article>a<div class='share'>left open</article><p>no", "a"),
    ("<p class='notice'>no<p>yes", "yes"),
    ("<p hidden>no</p><p title='hidden'>yes</p><span aria-hidden='true'>no</span>", "yes"),
    ("a < b and <3 c > d", "a < b and <3 c > d"),
    ("<p title=\"a > b\">x</p><p title=\"open>y</p>", "x\n\ny"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
    ("<ARTICLE><P>upper</P></ARTICLE>", "upper"),
    ("<article class='post comments-open'>kept</article>", "kept"),
    ("<script>never closed <p>no", ""),
])
def test_one_page(html, text):
    assert kept(html) == text


def plain_cover(tokens, page, run, least):
    """Every stretch of `run` tokens against every other."""
    stretches = {}
    for i in range(len(tokens) - run + 1):
        stretches.setdefault(tuple(tokens[i : i + run]), []).append(i)
    out = np.zeros(len(tokens), bool)
    for places in stretches.values():
        if len({page[i] for i in places}) >= least:
            for i in places:
                out[i : i + run] = True
    return out


@pytest.mark.parametrize("seed", range(30))
def test_repeats_against_all_stretches(seed):
    r = random.Random(seed)
    tokens, page = [], []
    for i in range(r.randint(1, 6)):
        n = r.randint(0, 30)
        tokens += [r.randint(0, 2) for _ in range(n)] + [-1 - i]
        page += [i] * (n + 1)
    run, least = r.randint(1, 9), r.randint(2, 3)
    found = m.repeated_tokens(np.array(tokens), np.array(page), run, least)
    assert found.tolist() == plain_cover(tokens, page, run, least).tolist()


def test_template_of_a_host_without_marks(spark, prose):
    top, end = "Welcome to our site where all the news of the town is found", "All rights are with the owners of this site and its many authors"
    body = {i: [" ".join(prose((i, j), 12)) for j in range(3)] for i in range(30)}
    html = {i: f"<div>{top}</div>" + "".join(f"<div>{x}</div>" for x in b) + f"<div>{end}</div>" for i, b in body.items()}
    rows = [(i, f"http://one.org/{i}", h, "h", 1, "r") for i, h in html.items()] + [(99, "http://other.org/1", html[0], "h", 1, "r")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string, shard int, text string")
    out = m.extracted(frame)
    assert out.columns == ["page_id", "url", "host", "shard", "text", "n_chars", "n_repeated"]
    found = {r.page_id: r for r in out.collect()}
    for i, b in body.items():
        assert found[i].text == "\n\n".join(b) and found[i].n_repeated == 2 and found[i].n_chars == len(found[i].text)
    assert found[99].text == "\n\n".join([top, *body[0], end])  # a host of its own, where nothing repeats


def test_copies_of_an_article_stay(spark, prose):
    text = " ".join(prose(1, 40))
    rows = [(i, "http://a.org/x", f"<div>{text}</div><article><p>{text}</p></article>") for i in range(5)] * 2
    rows += [(7, None, None), (8, "no host", ""), (None, None, "<p>x"), (9, "http://b.org", "<p>" + "z " * 200_000)]
    found = m.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    assert all(r.text == text for r in found if r.url == "http://a.org/x")
    assert {r.page_id: r.n_chars for r in found if r.url != "http://a.org/x"} == {7: 0, 8: 0, None: 1, 9: 399_999}
    assert m.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_shards_of_a_large_host(spark, monkeypatch, prose):
    monkeypatch.setattr(m, "SHARD_PAGES", 16)
    frame = spark.createDataFrame([(i, "http://a.org", f"<p>{i}</p><div>{' '.join(prose(2, 20))}</div>") for i in range(200)], "page_id long, url string, html string")
    assert 10 <= m.sharded(frame).select("shard").distinct().count() <= 13
    assert all(r.text == str(r.page_id) for r in m.extracted(frame).collect())


def test_repeats_are_those_of_the_whole_host(spark, monkeypatch, prose):
    """Runs on 3 to 12 % of a host's pages around a share of 7 %: shards of any size find the same."""
    r = random.Random(5)
    often = {i: " ".join(prose(("run", i), 9)) for i in range(12)}
    pages = []
    for i in range(150):
        blocks = [" ".join(prose((i, j), r.randint(1, 12))) for j in range(4)] + [often[k] for k in often if r.random() < 0.03 + 0.01 * k]
        r.shuffle(blocks)
        pages.append((i, "http://a.org" if i % 5 else "http://b.org", "".join(f"<div>{b}</div>" for b in blocks)))
    pages += pages[:9]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)

    def found(size):
        monkeypatch.setattr(m, "SHARD_PAGES", size)
        return sorted(map(tuple, m.extracted(frame, 8, 0.07).collect()))

    whole = found(1000)
    assert found(16) == whole and found(3) == whole and len({x[-1] for x in whole}) > 1


def test_blocks_of_odd_pages_as_lines():
    html = "0 x<p>a\r\nb\x0bc\x85d&#10;&#13;e\u2028f&nbsp;g</p><article><h1> 21 </h1><nav>&lt;p&gt; \\n</nav><p>é</article><custom>1"
    blocks = m.blocks_of(html)
    assert len(blocks) == 6 and {b.kind for b in blocks} == {"", "p", "h1", "nav"}
    pages = ["\n".join(map(m.line_of, x)) for x in (blocks, [], blocks[:1])]
    assert m.blocks_in(pa.table({"blocks": pages})) == [blocks, [], blocks[:1]]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_pages_of_large_hosts_are_exchanged_once(spark, monkeypatch, prose, adaptive):
    monkeypatch.setattr(m, "SHARD_PAGES", 16)
    pages = [(i, f"http://{'ab'[i % 2]}.org/{i}", f"<p>{i}</p><div>{' '.join(prose(i % 5, 20))}</div>") for i in range(100)]
    frame = spark.createDataFrame([*pages, (None, "http://c.org", "<p>x")], "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        out = m.extracted(frame)
        assert {r.page_id: r.text for r in out.collect()} == {None: "x"} | {i: str(i) for i in range(100)}
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    # named from, counted on and taken out of the same exchange, and nothing of it is hidden in a plan that ran before
    assert plan.count("FlatMapGroupsInArrow") == 2 and plan.count("FlatMapCoGroupsInArrow") == 2
    assert plan.count("ReusedExchange [host#") == 2


@pytest.mark.parametrize("size, share", [(4, 0.07), (4, 0.3), (16, 0.07)])
def test_only_runs_that_can_reach_the_share_go_to_all_shards(spark, monkeypatch, prose, size, share):
    """Shards of four pages name what stands on one page; what stands nowhere else isn't asked of others."""
    monkeypatch.setattr(m, "SHARD_PAGES", size)
    top = " ".join(prose("top", 10))
    pages = [(i, "http://a.org", f"<div>{top}</div><div>{' '.join(prose(i, 30))}</div>") for i in range(120)]
    shards = m.sharded(spark.createDataFrame(pages, "page_id long, url string, html string"), share)
    per_shard = [r["count"] for r in shards.groupBy("shard").count().collect()]
    left = m.candidates(shards, 8, share).collect()
    least, unnamed = m.least_pages(120, share), sum(max(0, int(np.ceil(share * n - 1e-6)) - 1) for n in per_shard)
    assert {(r.least, r.above, r.shards) for r in left} == {(least, least - unnamed, -(-120 // size))}
    if least - unnamed > size:  # more than one shard alone has
        assert len(left) == 5  # of twelve tokens: the block's kind, ten words and the next block's kind
    assert {r.run for r in m.host_runs(shards, 8, share).collect()} <= {r.run for r in left}
    assert all(r.n_repeated == 1 and top not in r.text for r in m.extracted(spark.createDataFrame(pages, "page_id long, url string, html string"), 8, share).collect())
