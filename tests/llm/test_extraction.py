import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import extraction as X
from attesta.llm.common import table

SF = "/root/testdata/sf0.01"
OTHER = """<!doctype html><html><head><title>Site | Post</title><style>p{color:red}</style></head><body class="home">
<div class="cookie-banner"><p>We use cookies to give you the best experience. <button>Accept</button></p></div>
<header><div class="logo">The Site</div></header><div id="topMenu" class="navbar"><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></div>
<div class="content post"><h1>A title &amp; more</h1><p>First   paragraph of the&nbsp;story, with a <a href="x">link</a> in it.
<p>Second one &lt;here&gt;<br>goes on and says a little more about it.</p><div class="ad">Buy now! Cheap things.</div>
<ul><li>One thing that matters<li>Another thing that matters</ul><script>if (a < b) { document.write("<p>no</p>") }</script>
<p>Third paragraph closes the story in a few plain words.</p></div>
<div class="sidebar"><h3>Related</h3><ul><li><a href=c>Another story</a></ul></div>
<form class="newsletter"><label>Email</label><input name=e><button>Send</button></form>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I liked the story a lot, thank you for it.</p></div></section>
<footer><p>&copy; 2024 The Site. All rights reserved.</p></footer><!-- <p>gone</p> --></body></html>"""
MAIN = ["A title & more", "First paragraph of the story, with a link in it.", "Second one <here> goes on and says a little more about it.", "One thing that matters", "Another thing that matters", "Third paragraph closes the story in a few plain words."]


@pytest.fixture(scope="module")
def model(spark):
    return X.fit(table(spark, SF, "pages"))


def article(page):
    """What a plain reading of the given pages' markup says."""
    parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", page, re.S)[1])
    return "\n".join(t for p in parts if (t := " ".join(html.unescape(re.sub("<[^>]*>", "", p)).split())))


def test_given_pages(spark, model):
    pages = table(spark, SF, "pages")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    out = X.extract(pages, model).collect()
    assert len(out) == len(want) and all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in out)


def test_query(spark):
    out = X.op11_html(spark, SF)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == table(spark, SF, "pages").count()


def test_pages_of_other_layouts(model):
    own = X.blocks(OTHER)
    assert [b.text for b, s in zip(own, model.scores([own])[0], strict=True) if s >= 0.5] == MAIN
    rng, wrong, n = np.random.default_rng(99), 0, 0
    for _ in range(150):
        own, y = X.rewritten(*X.made(rng), rng)
        if own:
            wrong, n = wrong + int(((model.scores([own])[0] >= 0.5) != (y > 0)).sum()), n + len(y)
    assert wrong <= 0.02 * n


def test_context_decides(model):
    """One block, two pages: after comments have begun it is none of the article's, within the article it is."""
    same = X.Block(("html", "body", "div", "p"), "These few words may stand anywhere and say nothing of themselves.")
    story = [X.Block(("html", "body", "article", "p"), f"Sentence number {i} of the story is as long as others are.") for i in range(4)]
    comments = [X.Block(("html", "body", "section", ".comments", "div", ".comment", "p"), "I liked it.") for _ in range(6)]
    alone, after = model.scores([[*story[:2], same, *story[2:]], [*story, *comments, same, *comments]])
    assert alone[2] > after[10]


def test_blocks():
    text = lambda page: [b.text for b in X.blocks(page)]
    assert text("") == [] and text("plain &amp; simple") == ["plain & simple"]
    assert text("<p>a<p>b<b>c</b>d<br>e<td>f") == ["a", "bcd e", "f"]
    assert text('<p title="a > b">x</p><p title=\'">\'>y') == ["x", "y"]
    assert text('<p title="never closed>x</p>') == ["x"]
    assert text("<script>a</scripty></p></SCRIPT >b<style>c") == ["b"]
    assert text("a < b and <3, 4>3 <!-- c --!> d --> e") == ["a < b and <3, 4>3 e"]
    assert text("<head><title>t</title><meta charset=x><body>b") == ["b"]
    assert X.blocks("<ul class='mainMenu x'><li><a href=1>one</a> two<li>three")[0] == X.Block(("ul", ".main", ".menu", ".x", "li"), "one two", 3)
    assert X.blocks("<table><tr><td>1<td>2<tr><td>3")[2].path == ("table", "tr", "td")


def test_sizes(model):
    many = "<article>" + "<p>Some words of a story that goes on and on.</p>" * 30_000 + "</article>"
    own = X.blocks(many)
    assert len(own) == 30_000 and (model.scores([own, []])[0] >= 0.5).all()
    assert len(X.blocks("<p>" + "x" * 3_000_000)[0].text) == 3_000_000


def test_edges(spark, model):
    rows = [(1, "u", "<article><p>Some words of a story.</p></article>"), (1, "u", "<article><p>Some words of a story.</p></article>"), (2, None, None), (None, "u", ""), (3, "u", "<nav><ul><li><a href=x>Menu</a></ul></nav>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("other"), "n_chars": F.lit(7)})
    got = sorted((tuple(r) for r in X.extract(df, model).collect()), key=str)
    assert got == sorted([(1, "u", "Some words of a story.", 22)] * 2 + [(2, None, "", 0), (None, "u", "", 0), (3, "u", "", 0)], key=str)
    assert X.extract(df.limit(0)).count() == 0
    assert X.extract(df.where("page_id = 1")).first().text == "Some words of a story."  # a sample of one page


def test_gradients():
    rng = np.random.default_rng(0)
    model, d = X.Labeller(), X.TAGS + X.WORDS + X.MEASURES
    for k in model.p:
        model.p[k] = rng.normal(0, 0.2, model.p[k].shape)
    pages = [(rng.normal(0, 1, (n, d)), rng.integers(0, 2, n)) for n in (4, 2)]

    def loss():
        z = [(x @ model.p["w"] + model.p["bias"]) for x, _ in pages]
        total = 0.0
        for (x, y), own in zip(pages, z, strict=True):
            mask = np.ones((len(y), 1))
            there, _ = X.Direction.forward(own[:, None, : 4 * X.HIDDEN], mask, model.p["there"], False)
            back, _ = X.Direction.forward(own[:, None, 4 * X.HIDDEN :], mask, model.p["back"], True)
            s = (np.concatenate((there, back), 2) @ model.p["out"])[:, 0, 0] + (x @ model.p["skip"])[:, 0] + model.p["off"][0]
            total -= (y * s - np.logaddexp(0, s)).sum()
        return total / 6

    grads = model._gradients(pages)
    for k in ("there", "back", "bias", "out", "off"):
        at = tuple(0 for _ in model.p[k].shape)
        old, eps = model.p[k][at], 1e-2
        model.p[k][at] = old + eps
        up = loss()
        model.p[k][at] = old - eps
        down = loss()
        model.p[k][at] = old
        assert abs((up - down) / (2 * eps) - grads[k][at]) < 2e-3, k
