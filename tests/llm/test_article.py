"""Blocks of pages, and the labeller on pages it has not seen."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import article, layouts, registry
from cardwarden.llm.blocks import blocks, features

PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
<header><a href="/">My Site</a><p>A tagline for readers</p></header>
<nav class="menu"><ul><li><a href="/">Home</a></li><li><a href="/about">About</a></li></ul></nav>
<div class="cookie-banner"><p>We use cookies to improve your experience.</p><button>Accept</button></div>
<main><article><h1>The title&nbsp;of the &lt;piece&gt;</h1><p>First <b>para</b>graph, with
 more &amp;amp; text.<ul><li>one thing<li>another thing</ul><p>Second paragraph ends<br>here.</article>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="x">Other story</a></li></ul></aside>
<section id="comments"><h2>Comments</h2><div class="comment"><p>Alice says: I liked this a lot.</p></div>
<form><label>Your name</label><input><button>Post</button></form></section></main>
<footer><p>&copy; 2024 My Site. All rights reserved.</p></footer>"""
TEXT = "The title of the <piece>\nFirst paragraph, with more &amp; text.\none thing\nanother thing\nSecond paragraph ends here."


def texts(page):
    return [b.text for b in blocks(page)]


@pytest.mark.parametrize("page, found", [
    ("", []),
    ("plain &eacute; text", ["plain é text"]),
    ("a<b>b</b>c<br>d <p>e<p>f</p>g", ["abc d", "e", "f", "g"]),
    ("1 < 2 <3 <!-- x > --> 4 <! y> 5", ["1 < 2 <3 4 5"]),
    ("x<!-- never closed <p>y", ["x"]),
    ("x<script>if (a</b) '</p>'</script>y<style>p{}", ["xy"]),
    ("<p a='>' b=\">\" c=d/>x</p><p e='>y", ["x", "y"]),
    ("<DIV>A</Div><textarea>t</textarea>&#xD800;&#0;", ["A", "��"]),
    ("</p></div>t<td>u<td>v<tr><td>w", ["t", "u", "v", "w"]),
    ("<a>l</a>t", ["lt"]),
    ("<", ["<"]), ("<a", []), ("x</", ["x"]),
])
def test_blocks(page, found):
    assert texts(page) == found


def test_links_and_paths():
    one, two = blocks("<div class=x><a href=1>ab</a>cd</div><nav><a>ab</a></nav>")
    assert (one.linked, two.linked) == (0.5, 1.0)
    assert not np.allclose(one.path, two.path)
    open_link = blocks("<p><a href=1>a</p><p>b</p>")
    assert [b.linked for b in open_link] == [1.0, 0.0]


def test_blocks_of_bad_pages_take_linear_time():
    for piece in ("<div>", "<li><ul>", "<p a='", '<a b="', "<!-- ", "<script>", "</div>", "<", "<li>x", "<td a=b "):
        blocks(piece * 20_000)


@pytest.fixture(scope="module")
def net():
    return article.fit()


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in article._start(rng).items()}
    x, live = rng.normal(size=(5, 2, article.INPUTS)), np.ones((5, 2))
    live[3:, 1] = 0
    weights = rng.normal(size=(5, 2, article.HIDDEN))
    for side in article.SIDES:
        keep = []
        article._steps(net, side, x, live, article._zero(2), keep)
        grads = {k: np.zeros_like(v) for k, v in net.items()}
        article._back(net, side, x, live, keep, weights, grads)
        for name in (f"x{side}", f"h{side}", f"a{side}"):
            for at in rng.integers(0, net[name].size, 4):
                old, losses = net[name].flat[at], []
                for step in (1e-2, -1e-2):
                    net[name].flat[at] = old + step
                    losses.append((article._steps(net, side, x, live, article._zero(2))[0] * weights).sum())
                net[name].flat[at] = old
                assert abs((losses[0] - losses[1]) / 2e-2 - grads[name].flat[at]) < 2e-2 * (1 + abs(grads[name].flat[at]))


def test_made_up_pages_held_out(net):
    pages = [blocks(p, layouts.MARK) for p in layouts.pages(200, 77)]
    right = [(s >= 0.5) == (b.mark == "1") for page, told in zip(pages, article.score(net, pages), strict=True)
             for b, s in zip(page, told, strict=True)]
    assert np.mean(right) > 0.98


def test_long_pages_are_read_in_spans(net, monkeypatch):
    page = blocks("<nav><a>x</a></nav><article>" + "<p>some words, here.</p>" * 700 + "</article><footer>y</footer>")
    whole = article.score(net, [page, page[:3], []])
    monkeypatch.setattr(article, "CELLS", 64)
    spans = article.score(net, [page, page[:3], []])
    assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(whole, spans, strict=True))
    assert features([], []).shape == (0, article.INPUTS)


def test_extract_takes_awkward_rows(spark, net):
    long = "<article>" + "<p>Words that go on and on, without an end.</p>" * 20_000 + "</article>"
    rows = [(1, "u", PAGE), (1, "u", PAGE), (1, None, None), (2, "v", ""), (None, "w", "<nav>x</nav>"), (3, "z", long)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, text string, score int")
    found = sorted(map(tuple, article.extract(df, net).collect()), key=str)
    assert [r for r in found if r[:2] == (1, "u")] == [(1, "u", TEXT)] * 2
    assert {r for r in found if r[0] != 3 and r[1] != "u"} == {(1, None, ""), (2, "v", ""), (None, "w", "")}
    assert [r[2].count("\n") for r in found if r[0] == 3] == [19_999]
    assert article.extract(df.limit(0), net).count() == 0
    labelled = article.label_blocks(df.where("page_id = 1"), net)
    kept = labelled.where("score >= 0.5 and url = 'u'").groupBy("block").agg(F.first("text").alias("t")).orderBy("block")
    assert "\n".join(r.t for r in kept.collect()) == TEXT


def test_query_on_given_pages(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    found = {r.page_id: r for r in registry.op11_main_text(spark, "/root/testdata/sf0.001").collect()}
    wrong = 0
    for row in given:
        inside = row.html[row.html.index("<article>") : row.html.index("</article>")]
        assert found[row.page_id].n_chars == len(found[row.page_id].text)
        wrong += found[row.page_id].text != "\n".join(texts(inside))
    assert len(found) == len(given) and wrong <= len(given) // 100
