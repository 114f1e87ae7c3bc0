from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from rankweave.llm import extraction as X
from rankweave.llm.dom import block_texts, read_page


@pytest.fixture(scope="module")
def model():
    rng = random.Random(11)
    pages = [read_page(X.labelled_page(rng)) for _ in range(300)]
    return X.fit(pages, [X.inherited_labels(p) for p in pages])


def read(source):
    page = read_page(source)
    return block_texts(page, [True] * len(page.nodes))


def test_blocks_of_a_page():
    assert read("<p>a  b<br>c</p>d<div>e<b>f</b>\n g</div>") == ["a b c", "d", "ef g"]
    assert read("<body><p>one<p>two <b>three<p>four</body>") == ["one", "two three", "four"]
    assert read("<script>var t='</p>';</script><style>p{}</style><!-- x --><p>&lt;&amp;amp;&eacute;&#233;&nbsp;x &copy</p>") == ["<&amp;éé x ©"]
    assert read("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table>") == ["a", "b", "c", "d", "e", "f"]
    assert read("text <p class='x") == ["text"] and read("") == [] and read("</div></p>") == []
    assert read("<p>a</b></div></p><i>b</i>") == ["a", "b"]
    assert len(read("<div>" * 3000 + "deep")) == 1


def test_sum_product_equals_enumeration():
    page = read_page("<body><nav><ul><li>a<li>b</ul></nav><article><h1>t</h1><p>x</article></body>")
    rng = np.random.RandomState(0)
    unary, pair = rng.standard_normal(X.N_FEATURES), rng.standard_normal((X.N_TAGS, 2, 2))
    forest = X.Forest([page, page])
    marginal, both = forest.marginals(unary, pair)
    n = len(page.nodes)
    score = np.zeros(n)
    np.add.at(score, forest.rows[forest.rows < n], unary[forest.columns[forest.rows < n]])
    total, ones, edges = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for labels in itertools.product((0, 1), repeat=n):
        y = np.array(labels)
        weight = np.exp(score @ y + sum(pair[forest.tag[i], y[forest.parent[i]], y[i]] for i in range(1, n)))
        total, ones = total + weight, ones + weight * y
        for i in range(1, n):
            edges[i, y[forest.parent[i]], y[i]] += weight
    assert marginal[:n] == pytest.approx(ones / total) and marginal[n:] == pytest.approx(marginal[:n])
    assert both[1:n] == pytest.approx(edges[1:] / total)


def test_held_out_pages(model):
    rng = random.Random(500)
    right = wrong = 0
    for _ in range(200):
        page = read_page(X.labelled_page(rng))
        found = X.Forest([page]).marginals(*model)[0] >= 0.5
        text = np.array([node.own > 0 for node in page.nodes])
        same = found[text] == X.inherited_labels(page)[text].astype(bool)
        right, wrong = right + same.sum(), wrong + (~same).sum()
    assert wrong < 0.03 * (right + wrong)


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in X.extract_text(pages).collect():
        source = sources[row["page_id"]]
        article = source[source.index("<article>") : (source + "</article>").index("</article>")]
        assert row["text"].split("\n") == read(article) and row["n_chars"] == len(row["text"])


def test_odd_rows(spark, model):
    rows = [(1, "u", None), (1, None, ""), (None, "u", "<article><p>Some text.</p></article>"), (2, "u", "<article>" + "<p>long text.</p>" * 20_000)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, text string, n_chars string")
    found = X.extract_text(df, model).collect()
    assert [(r["page_id"], r["url"], r["n_chars"]) for r in found] == [(1, "u", 0), (1, None, 0), (None, "u", 10), (2, "u", 20_000 * 11 - 1)]
    assert X.extract_text(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    "html",
    [
        "<html><head><title>t</title><article><p>Body here.</p></article></html>",
        "<head><meta charset=x><link rel=y><script>no()</script><article><p>Body here.</p></article>",
        "<head><style>a{}</style>\n Body here.",
        "<head><title>t</title></head><p>Body here.",
        "<head><noscript>none</noscript><body><p>Body here.</p>",
    ],
)
def test_a_head_left_open_ends_with_the_first_text(html):
    page = read_page(html)
    assert block_texts(page, [True] * len(page.nodes)) == ["Body here."]
