import html
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelake.llm import html_graph as H


@pytest.fixture(scope="module")
def model():
    return H.fitted([H.of_layout(page) for page in H.LAYOUTS], [])


@pytest.mark.parametrize("k", range(len(H.LAYOUTS)))
def test_layouts(model, k):
    nodes = H.parse(H.LAYOUTS[k])
    want = "\n".join(re.sub(r"^\+", "", n.text) for n in nodes if n.text.startswith("+"))
    assert H.main_text(re.sub(r">[+-]", ">", H.LAYOUTS[k]), model) == want


def test_pages_of_the_table(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    for r in H.extract(pages, H.fit(pages)).join(pages, ["page_id", "url"]).collect():
        article = r["html"][r["html"].index("<article>") + 9 : r["html"].index("</article>")]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", "", article))
        want = "\n".join(t for b in blocks if (t := " ".join(html.unescape(b).split())))
        assert r["text"] == want and r["n_chars"] == len(want)


def test_messages_are_exact(model):
    """Against the sum over all labellings of a small tree."""
    nodes = H.parse("<body><nav><p>Home</p></nav><div><p>Some text that says a thing.</p><p>More.</p></div></body>")
    own = [model.own(n) for n in nodes]
    total, yes = 0.0, np.zeros(len(nodes))
    place = {id(n): k for k, n in enumerate(nodes)}
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        p = 1.0
        for k, n in enumerate(nodes):
            p *= own[k] if labels[k] else 1 - own[k]
            if n.parent is not None:
                p *= model.pairs.get(H.sort_of(n), model.other)[labels[place[id(n.parent)]]][labels[k]]
        total += p
        yes += p * np.array(labels)
    assert np.allclose(H.marginals(nodes, model), yes / total)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("<article><p>x &lt;b&gt; &amp;nbsp; y<br>z</p></article>", "x <b> &nbsp; y z"),
        ("<article><p>one\n two<p>three<ul><li>a<li>b</ul></article>", "one two\nthree\na\nb"),
        ("<article><p>x<script>var t='</p>';</script> y</p><style>p{}</style></article>", "x y"),
        ("<article><!-- <p>no</p> --><p>yes it is.</p></article", "yes it is."),
        ("<article><p>caf&eacute; &#8364; &unknown;</p></article>", "café € &unknown;"),
        ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
        ("<head><title>no</title></head><body><article><p>Main part.</p></article></body>", "Main part."),
    ],
)
def test_markup(model, page, text):
    assert H.main_text(page, model) == text


def test_deep_and_long_pages(model):
    assert H.main_text("<div><p>" * 3000 + "deep", model) == "deep"
    words = "A long line of words. " * 50_000
    assert H.main_text(f"<article><p>{words}</p></article>", model) == words.strip()


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>Twice is fine.</p></article>"), (3, "u", "<article><p>Twice is fine.</p></article>"), (None, "v", "<p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = H.extract(pages, H.fit(pages)).collect()
    assert sorted((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in got) == [
        (0, "v", "", 0),
        (1, "u", "", 0),
        (2, "", "", 0),
        (3, "u", "Twice is fine.", 14),
        (3, "u", "Twice is fine.", 14),
    ]
    none = pages.where("false")
    assert H.extract(none, H.fit(none)).count() == 0


BODY = "<article><h1>A title of the page</h1><p>The river rose for days before the bridge gave way, and the town had to wait for boats.</p></article>"
TEXT = "A title of the page\nThe river rose for days before the bridge gave way, and the town had to wait for boats."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><meta charset=x>{BODY}</html>",
        f"<title>T</title>{BODY}",
        f"<head><title>T</title><svg><path d=1><body>{BODY}</body>",
        f"<head><title>T</title><svg><path d=1>{BODY}",
        f"<head><title>T</title><object data=x><body>{BODY}</body>",
        f"<head><template><p>never shown</p><body>{BODY}",
        f"<head><template><p>never shown</p></template></head><body>{BODY}",
        f"<head><title>T</title></head><body><select><option>one<option>two</select>{BODY}",
        f"<head></head><body><svg><title>Icon</title><foreignObject><p>never shown</p></foreignObject></svg>{BODY}",
        f"<head></head><body><video src=x>{BODY}",
        f"<body>{BODY}<script>var a = '<p>never shown</p>'",
    ],
)
def test_heads_and_open_elements(model, page):
    assert H.main_text(page, model) == TEXT


def test_sample_has_one_row_per_page(spark):
    pages = spark.range(400).selectExpr("id % 2 page_id", "concat('<article><p>Text number ', id, '.</p></article>') html")
    one = H.one_each(pages, "page_id", "html")
    assert one.count() == 2 and one.collect() == H.one_each(pages.repartition(5), "page_id", "html").collect()
    assert H.within(one, "page_id", "html", 50).count() == 1 and H.within(one, "page_id", "html", 500).count() == 2
