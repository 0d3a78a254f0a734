import random
import time

import numpy as np
import pytest

from postloom.llm import html
from postloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def forest(shipped):
    return html.learn(shipped.read.parquet(f"{FOLDER}/pages.parquet"))


def text_of(forest, page):
    nodes = html.parse(page)
    return html._text(nodes, html.decode(nodes, 2 * forest.margin(html.features(nodes))))


def test_whole_table(shipped):
    """The articles of the table, by a plain cut at their tags."""
    import html as references
    import re

    pages = {r["page_id"]: r for r in shipped.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = QUERIES["op7_html_text"](shipped, FOLDER).collect()
    assert len(rows) == len(pages)
    right = 0
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        blocks = [" ".join(references.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        right += r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]
    assert right == len(rows)


def test_other_layouts(forest, shipped):
    pages = shipped.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    runs = wrong = 0
    for r in pages:
        for made in html.layouts(html.parse(r["html"]), 4, 77 + r["page_id"]):
            nodes, holds = html._layout_truth(made)
            kept = html.decode(nodes, 2 * forest.margin(html.features(nodes)))
            for node, hold, keep in zip(nodes, holds, kept):
                if node.text is not None:
                    runs += 1
                    wrong += hold != keep
    assert wrong <= 0.02 * runs


def test_a_page_of_another_make(forest):
    page = """<html><head><title>T</title></head><body class="home"><div id="header"><h2>Site name</h2><p>Tagline of the site.</p></div>
    <div class="cookie-banner"><p>We use cookies to improve. Accept?</p></div><ul class="menu"><li><a href=a>Home</a></li><li><a href=b>About us</a></li></ul>
    <div class="wrapper"><div class="col-8"><h1>Main title here</h1><p>First paragraph, with <a href=x>a link</a> and <b>bold</b>
    text &amp; more. It is long&nbsp;enough.</p><p>Second paragraph with more text. And yet another sentence.</p></div>
    <div class="sidebar"><h3>Related</h3><p>Some teaser that looks like a paragraph. It has sentences.</p></div></div>
    <section id="comments"><div class="comment"><p>Great article, I liked it very much. Thanks!</p></div></section>
    <form action=x><label>Mail</label><input></form><script>var a = "<p>no</p>";</script><footer><p>Copyright 2020 Site.</p></footer></body></html>"""
    assert text_of(forest, page) == (
        "Main title here\nFirst paragraph, with a link and bold text & more. It is long enough.\n"
        "Second paragraph with more text. And yet another sentence."
    )


def test_choices_do_not_contradict(forest):
    draw = np.random.default_rng(0)
    nodes = html.parse("<div><ul><li>a<p>b</p></li></ul><p>c</p></div>" * 5)
    for _ in range(50):
        kept = html.decode(nodes, draw.normal(size=len(nodes)))
        assert all(kept[node.parent] for node, keep in zip(nodes, kept) if keep and node.parent >= 0)


def test_scores_equal_the_model(shipped):
    """The arrays that tasks use, and the trees of Spark ML."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    draw = random.Random(1)
    rows = [(float(x[0] + x[1] > 1), x) for x in ([draw.random() for _ in range(3)] for _ in range(300))]
    frame = shipped.createDataFrame(rows, "label double, features array<double>").withColumn("features", array_to_vector("features"))
    model = GBTClassifier(maxIter=5, maxDepth=html.TREE_DEPTH, seed=1).fit(frame)
    forest = html.Forest([html._as_arrays(t) for t in model.trees], list(model.treeWeights))
    margins = forest.margin(np.array([x for _, x in rows]))
    raw = [r["rawPrediction"][1] for r in model.transform(frame).collect()]
    assert np.allclose(2 * margins, raw) or np.allclose(margins, raw)


@pytest.mark.parametrize("page", ["", "x", "<", "<p", "<!-- x", "</p></div>", "<p>a<p>b</b>c", "<script>", "<a><b><c>", "<p class='x>y", "&lt;&#x41;&bogus;", "<td>a<td>b", "\x00<p>\x00"])
def test_broken_markup(forest, page):
    assert isinstance(text_of(forest, page), str)


def test_long_page_and_deep_nesting(forest):
    assert text_of(forest, "<div>" * 3_000 + "<p>deep text</p>") is not None
    article = "<article>" + "".join(f"<p>Paragraph {i} has some words. And a sentence.</p>" for i in range(5_000)) + "</article>"
    assert text_of(forest, f"<html><body>{article}</body></html>").count("\n") == 4_999


def test_odd_rows(shipped):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<article><p>Some text here.</p></article>"), (3, "u", "<article><p>Some text here.</p></article>")]
    pages = shipped.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("text", "n_chars", "id", "all", "seed", "holds", "features", "label"):
        pages = pages.withColumn(name, pages["url"])
    found = html.extract(pages).collect()
    assert len(found) == 5
    assert all(r["text"] == "" and r["n_chars"] == 0 for r in found if r["page_id"] in (1, 2))
    assert html.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "</section>" * 100_000, "<svg>" * 200_000, "<p>x" + "</li>" * 200_000, "<li><main>" + "<div>" * 50_000 + "</li>" * 50_000,
        '<a ">" ' * 200_000 + '"', "<!x " * 300_000, "<!-- " * 200_000, "<ul><li>" * 100_000, "<td>" * 200_000, "<p " * 300_000, "</svg" * 200_000 + "<svg>" * 10_000,
        "<img alt='" + "a > b " * 100_000 + "'>after", '<b x="' * 200_000,
    ],
    ids=range(13),
)
def test_parsing_takes_time_in_proportion(page):
    start = time.perf_counter()
    nodes = html.parse(page)
    assert time.perf_counter() - start < 10
    if page.endswith("after"):
        assert [node.text for node in nodes if node.text] == ["after"]


def test_names_menus_and_comments_of_another_make(forest):
    page = """<html><body><div><a href=a>Home</a> <a href=b>News</a></div><article><h1>The title of it</h1>
    <p>One paragraph of the text is here. It has two sentences.</p><div class="ad-free-article"><p>Another paragraph of the text, which is as long. And it has more.</p></div>
    <p>By the way: <math><mi>x</mi> = 2</math> and <object>a fallback text</object> stay.</p></article>
    <div><h2>Reader says</h2><div><p>I liked this article very much. Thanks a lot for it!</p></div></div><div><a href=c>More</a></div></body></html>"""
    assert text_of(forest, page) == (
        "The title of it\nOne paragraph of the text is here. It has two sentences.\n"
        "Another paragraph of the text, which is as long. And it has more.\nBy the way: x = 2 and a fallback text stay."
    )
    assert html.words_of(' class="ad-free-article no-sidebar"') == (1, 0)
    assert html.words_of(" id=main-content class='side-bar'") == (2, 2)
