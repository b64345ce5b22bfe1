"""HTML extraction: messages against all labellings, gradient steps, malformed pages, held-out and hand-written pages."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadra.llm import htmltree as H
from quadra.llm.samplepages import labelled_pages

SAID = "The committee met on Tuesday to discuss the new bridge over the river, and agreed to fund a study."
OTHER = "Nobody was sure at first whether the old one could be repaired in time for the summer."


@pytest.fixture(scope="module")
def model():
    return H.train(labelled_pages())


def runs(html):
    return list(H.parse(html).text.values())


def text_of(model, html):
    page = H.parse(html)
    return H.main_text(page, model.marginals([page])[0])


def test_marginals_equal_all_labellings():
    rng = np.random.default_rng(3)
    pages = [H.parse(h) for h in ("<nav><a href=x>a</a></nav><article><h1>t</h1><p>b c.</p></article>", "<p>x<p>y", "plain")]
    weights, edges = rng.normal(size=H.FEATURES), rng.normal(size=(H.KINDS, 2, 2))
    found = H.Model(weights, edges).marginals(pages)
    for page, got in zip(pages, found, strict=True):
        forest = H.Forest([page])
        own = np.zeros(len(page.tag))
        own[forest.order] = np.bincount(forest.owner, weights[forest.column], len(own))
        kind = [H._KIND.get(t, H.KINDS - 1) for t in page.tag]
        total, content = 0.0, np.zeros(len(own))
        for labels in itertools.product((0, 1), repeat=len(own)):
            score = sum(own[k] for k, y in enumerate(labels) if y) + sum(edges[kind[k], labels[page.parent[k]], labels[k]] for k in range(1, len(own)))
            total += np.exp(score)
            content += np.exp(score) * np.array(labels)
        assert np.allclose(got, content / total)


def test_batches_of_pages_do_not_mix(model):
    pages = [H.parse(h) for h in labelled_pages(30, seed=5)]
    together = model.marginals(pages)
    assert all(np.allclose(a, model.marginals([p])[0]) for a, p in zip(together, pages, strict=True))


def test_training_raises_the_likelihood():
    pages = labelled_pages(40, seed=2)

    def loss(model):
        parsed = [H.parse(h) for h in pages]
        return -sum(np.log(np.where(np.array(p.label) == 1, c, 1 - c) + 1e-12).mean() for p, c in zip(parsed, model.marginals(parsed), strict=True))

    assert loss(H.train(pages, steps=60)) < loss(H.train(pages, steps=10)) < loss(H.train(pages, steps=1))


def test_held_out_layouts(model):
    pages = [H.parse(h) for h in labelled_pages(300, seed=99)]
    right = [[(c[k] >= 0.5) == p.label[k] for k in p.text] for p, c in zip(pages, model.marginals(pages), strict=True)]
    assert np.mean([x for page in right for x in page]) > 0.97 and np.mean([all(page) for page in right]) > 0.85


@pytest.mark.parametrize(("html", "want"), [
    ("<p>a<p>b<b>c<br>d</p>e", ["a", "bc d", "e"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
    ("x &lt;b&gt; &amp;amp; &#233;&nbsp;\t\n y &unknown; &amp", ["x <b> &amp; é y &unknown; &"]),
    ("a<!-- <p>no</p> -->b<script>if (a<b) '<p>'</script>c", ["ab c"]),
    ("<p title='a>b' data-x=\"c>d\">e</p><style>p{}</style>", ["e"]),
    ("a < b and c > d <3", ["a < b and c > d <3"]),
    ("</div></p>a</article><div>b", ["a", "b"]),
    ("<script>never closed <p>x", []),
    ("<select><option>no</select>yes<hr>more", ["yes", "more"]),
    ("<H1>Big</H1><P>small", ["Big", "small"]),
    ("<h2>one<h3>two</h3>", ["one", "two"]),
    ("<!doctype html><?xml x?><![CDATA[no]]>yes", ["yes"]),
    ("unclosed <p class='x", ["unclosed"]),
    ("", []),
])
def test_parser(html, want):
    assert runs(html) == want


def test_links_end_with_their_block():
    page = H.parse("<div><a href=x>ab</div><p>cd <a href=y>ef</a> gh</p>")
    assert list(zip(page.text.values(), page.linked, strict=True)) == [("ab", 2), ("cd ef gh", 2)]


def test_written_pages(model):
    title, body = "Bridge study funded", f"{SAID}\n\n{OTHER}"
    menu = "<ul><li><a href=/>Home</a></li><li><a href=/a>About</a></li><li><a href=/n>News</a></li></ul>"
    semantic = f"<html><body><header><p>Site</p><nav>{menu}</nav></header><article><h1>{title}</h1><p>{SAID}<p>{OTHER}</article><footer>&copy; 2024 Site</footer>"
    blocks = (
        f'<body><div class="cookie-notice"><p>We use cookies. By continuing you accept this.</p><button>OK</button></div><div id="menu">{menu}</div>'
        f'<div id="content"><h1>{title}</h1><p>{SAID}</p><div class="ad">Buy our shoes now, they are the best shoes!</div><p>{OTHER}</p></div>'
        f'<div id="sidebar"><h3>Popular</h3>{menu}</div><div class="comments"><div class="comment"><b>Ann</b><p>Thank you for writing it up so well.</p></div></div>'
        f'<form><p>Subscribe to our newsletter</p><input></form><div id="footer">All rights reserved.</div></body>'
    )
    nested = (
        f'<main><article class="post"><h1>{title}</h1><p>{SAID}</p><p>{OTHER}</p><section class="comments"><h2>2 comments</h2>'
        f'<article class="comment"><p>{SAID}</p></article><article class="comment"><p>I disagree, it was fine.</p></article></section></article></main><aside class="sidebar"><p>{OTHER}</p></aside>'
    )
    for page in (semantic, blocks, nested):
        assert text_of(model, page) == f"{title}\n\n{body}"
    assert text_of(model, f"<nav>{menu}</nav><footer>c</footer>") == ""


def article(k):
    """A page as the tables have them, and its text."""
    said = ["Only.", f"{SAID} {k} &amp; more", "the same line"] + ["the same line"] * (k % 90)
    html = (
        f'<!DOCTYPE html><html lang="en"><head><title>t</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body><nav>'
        f'<ul><li><a href="/a">a</a></li><li><a href="/b">b</a></li></ul></nav><!-- ad --><div class="ad">{OTHER}</div><article><h1>Title {k}</h1>'
        + "".join(f"<p>{s}</p>" for s in said) + f"</article><footer>&copy; x.example &middot; {OTHER}</footer>" + "</body></html>" * (k % 2)
    )
    return html, "\n\n".join([f"Title {k}", *(s.replace("&amp;", "&") for s in said)])


def test_query_and_edge_rows(spark, tmp_path):
    pages = [article(k) for k in range(120)]
    long = "<article><h1>T</h1>" + "".join(f"<p>{SAID} {k}</p>" for k in range(6000)) + "</article><footer>&copy; x</footer>"
    deep = "<div>" * 3000 + f"<p>{SAID}</p>"
    rows = [(k, "u", h, "c", "c") for k, (h, _) in enumerate(pages)]
    rows += [(500, None, None, "c", "c"), (501, "u", "", "c", "c"), (None, "u", pages[0][0], "c", "c"), (0, "u", pages[0][0], "c", "c"), (502, "u", long, "c", "c"), (503, "u", deep, "c", "c")]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string").repartition(4).write.parquet(str(tmp_path / "pages.parquet"))
    df = H.op13_html(spark, str(tmp_path))
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    found = {}
    for r in df.collect():
        assert r.n_chars == len(r.text) and found.setdefault(r.page_id, r.text) == r.text
    assert len(found) == 125 and df.count() == len(rows)
    assert all(found[k] == want for k, (_, want) in enumerate(pages))
    assert found[500] == found[501] == "" and found[None] == pages[0][1]
    assert found[502].count("\n\n") == 6000 and found[503] in ("", SAID)


def test_no_pages(spark, model):
    empty = spark.createDataFrame([], "page_id long, html string")
    assert empty.select(H.extract(F.col("html"), model)).collect() == []
