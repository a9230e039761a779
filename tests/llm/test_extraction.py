"""Extraction of articles: cutting pages, the network's gradients, held-out layouts and given pages."""

import html
import re

import numpy as np
import pytest

from lakeferry.llm import extraction
from lakeferry.llm.queries import op13_extraction

SF = "/root/testdata/sf0.01"


def cut(page):
    return [b.text for b in extraction.Reader().blocks(page)]


def test_blocks_of_a_page():
    page = (
        "<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><!-- no <p>no</p> -->"
        '<p>One&nbsp;  &amp; <b>tw</b>o<br>three<p>four <script>var t="</p>no";</script>five<ul><li>a<li>b</ul>'
        "<table><tr><td>c<td>d</table>1 < 2 <img alt='a > b'> end</section></div>"
    )
    assert cut(page) == ["One & two", "three", "four", "five", "a", "b", "c", "d", "1 < 2 end"]
    assert cut("") == [] and cut("bare  text") == ["bare text"] and cut("<p>x<script>never closed") == ["x"]
    assert cut("<div title='unclosed>text") == ["<div title='unclosed>text"]


def test_paths_and_links():
    reader = extraction.Reader()
    blocks = reader.blocks('<div class="commentList main-2" hidden><a href=x>link</a> and<p>text')
    names = [{n for e in b.path for n in reader.names[e]} for b in blocks]
    assert {"t:div", "n:comment", "n:list", "n:main", "p:comm", "hidden"} <= names[0]
    assert blocks[0].linked == 4 and blocks[1].linked == 0 and "t:p" in names[1]


def test_deep_and_long_pages_in_linear_time():
    deep = "<div>" * 30_000 + "text" + "</p></div>" * 30_000
    assert cut(deep) == ["text"]
    assert len(cut("<li>x" * 50_000)) == 50_000
    assert cut("<" * 50_000 + '"') == ["<" * 50_000 + '"']


def truth(page):
    """Text of the article element, which all given pages have."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", "\0", inner))
    blocks = [" ".join(html.unescape(x).split()) for x in inner.split("\0")]
    return " ".join(b for b in blocks if b)


def loss(model, seen, y):
    p = np.clip(model.article(seen).astype(float), 1e-7, 1 - 1e-7)
    return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()


def test_a_step_follows_the_gradient():
    """Training on one group lowers its loss steadily, through every parameter."""
    features = extraction.Features()
    pages = extraction.training_pages([], features, 12, seed=3)
    seen = features.see([b for b, _ in sorted(pages, key=lambda x: len(x[0]))])
    y = np.concatenate([y for _, y in sorted(pages, key=lambda x: len(x[0]))]).astype(float)
    losses = [loss(extraction.train(pages, features, epochs=n), seen, y) for n in (1, 10, 40)]
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.4


def test_gradient_of_the_recurrence():
    rng = np.random.default_rng(0)
    p = {"w_f": rng.normal(size=(3, 8)), "u_f": rng.normal(size=(2, 8)), "o_f": rng.normal(size=8)}
    x, back = rng.normal(size=(5, 2, 3)), rng.normal(size=(5, 2, 2))

    def value():
        return float((extraction._trained_side(x, p, "f")[0] * back).sum())

    grads = {}
    dx = extraction._gradient_side(back, extraction._trained_side(x, p, "f")[1], p, "f", grads)
    for array, grad in ((p["w_f"], grads["w_f"]), (p["u_f"], grads["u_f"]), (p["o_f"], grads["o_f"]), (x, dx)):
        at = tuple(int(rng.integers(s)) for s in array.shape)
        array[at] += 1e-2
        high = value()
        array[at] -= 2e-2
        low = value()
        array[at] += 1e-2
        assert abs((high - low) / 2e-2 - grad[at]) < 2e-3 + 0.02 * abs(grad[at])


@pytest.fixture(scope="module")
def model(spark):
    return extraction.fit(spark.read.parquet(f"{SF}/pages.parquet"), count=600, epochs=8)


def test_held_out_layouts(spark, model):
    others = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()
    features = extraction.Features()
    pages = extraction.training_pages([r["html"] for r in others], features, 200, seed=91)[:200]
    y = np.concatenate([y for _, y in pages])
    found = model.article(features.see([b for b, _ in pages])) >= 0.5
    assert (found == y).mean() > 0.95
    assert (found & y).sum() / y.sum() > 0.95 and (found & y).sum() / found.sum() > 0.95


def test_context_decides(model):
    """The same paragraph is article among paragraphs and a comment under the comments."""
    said = "This is a sentence, and here is another one. It says little."
    page = (
        f"<div class=nav><a href=1>Home</a> <a href=2>News</a></div><div class=post><h1>A title</h1><p>{said} One.</p>"
        f"<p>{said} Two.</p><p>{said} Three.</p></div><div id=comments><h3>Comments</h3><p>{said} Four.</p>"
        "<a href=#>Reply</a></div><footer>All rights reserved.</footer>"
    )
    text = extraction.extract(model, extraction.Features(), [page])[0]
    assert "Three." in text and "Four." not in text and "Home" not in text and "rights" not in text


def test_awkward_pages(spark, model):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "u", "<article><h1>Title of it</h1><p>A text, of words.</p></article>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "'x' as n_chars")
    got = sorted(map(tuple, extraction.main_text(frame, model).collect()), key=lambda r: (r[0] or 0, r[2]))
    assert got[1:] == [(1, "u", "", 0), (2, None, "", 0), (2, None, "", 0)]
    assert got[0][:2] == (None, "u") and got[0][3] == len(got[0][2])
    assert extraction.main_text(frame.limit(0), extraction.train([], extraction.Features(), epochs=1)).count() == 0
    assert extraction.fit(frame.limit(0), count=8, epochs=1) is not None


def test_given_pages(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = op13_extraction(spark, SF).collect()
    assert len(found) == len(pages)
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"] for r in found)
    exact = sum(r["text"] == truth(pages[r["page_id"]]["html"]) for r in found)
    assert exact / len(found) >= 0.98
