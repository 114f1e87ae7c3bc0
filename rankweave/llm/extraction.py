"""Main text of web pages: a tree-structured graphical model over the DOM with exact sum-product inference."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.dom import Node, Page, block_texts, read_page

TAGS = (
    "html body div section article main header footer nav aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th "
    "blockquote pre figure figcaption fieldset menu span a address details".split()
)
# Words in class, id and role, by what they tell.
MARKS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar tabs pagination pager toc skip".split(),
    "header": "header masthead head logo branding site hero".split(),
    "footer": "footer foot copyright colophon legal imprint bottom contentinfo".split(),
    "sidebar": "sidebar side aside rail widget widgets related recommended popular trending tags complementary".split(),
    "advert": "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner teaser".split(),
    "notice": "notice notices cookie cookies consent gdpr alert warning popup modal overlay dialog disclaimer message info".split(),
    "form": "form login signin signup register search newsletter subscribe subscription contact poll".split(),
    "comment": "comment comments respond reply replies discussion disqus feedback reviews".split(),
    "share": "share sharing social follow like tweet buttons byline meta author".split(),
    "content": "content article articles post posts entry story text body main maincontent page prose".split(),
}
CONTAINERS = [("article", ""), ("main", ""), ("div", "content"), ("div", "post-body"), ("section", "article-text"), ("div", "entry-content"),
              ("div", "story"), ("div", ""), ("section", ""), ("article", "post"), ("div", "main-text")]
BOILERPLATE = [
    ("links", [("nav", ""), ("ul", "menu"), ("div", "navbar"), ("div", "breadcrumbs"), ("nav", "toc"), ("div", "pagination"), ("menu", "")]),
    ("short", [("header", ""), ("div", "site-header"), ("div", "masthead"), ("div", "header")]),
    ("short", [("footer", ""), ("div", "footer"), ("div", "copyright"), ("div", "site-footer")]),
    ("mixed", [("aside", ""), ("div", "sidebar"), ("div", "related"), ("div", "widget"), ("section", "recommended"), ("aside", "rail")]),
    ("prose", [("div", "ad"), ("div", "ads"), ("div", "sponsored"), ("aside", "advertisement"), ("div", "promo banner"), ("section", "advert")]),
    ("prose", [("div", "notice"), ("div", "cookie-consent"), ("div", "alert"), ("section", "disclaimer"), ("div", "popup"), ("p", "notice")]),
    ("form", [("form", ""), ("form", "newsletter"), ("div", "login"), ("form", "search"), ("div", "subscribe")]),
    ("comments", [("div", "comments"), ("section", "comments"), ("ol", "comment-list"), ("div", "discussion"), ("section", "reader-comments")]),
    ("short", [("div", "share"), ("div", "social"), ("ul", "share-buttons")]),
]
GENERATED_PAGES = 400
TABLE_PAGES = 200
MAX_TABLE_CHARS = 20_000
STEPS = 150
LEARNING_RATE = 0.1
DECAY = 1e-3

_MARK_OF = {word: i for i, words in enumerate(MARKS.values()) for word in words}
_TAG_OF = {tag: i for i, tag in enumerate(TAGS)}
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
N_TAGS, N_MARKS = len(TAGS) + 1, len(MARKS)
_BUCKETS = (1, 20, 80, 250, 1000)


def _bucket(n: int) -> int:
    return sum(n >= b for b in _BUCKETS)


def node_features(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the features of each node, as pairs of node and feature."""
    n = len(page.nodes)
    total, linked = [x.own for x in page.nodes], [x.linked for x in page.nodes]
    for i in range(n - 1, 0, -1):  # parents stand before their children
        total[page.nodes[i].parent] += total[i]
        linked[page.nodes[i].parent] += linked[i]
    rows, columns = [], []
    for i, x in enumerate(page.nodes):
        base = N_TAGS
        found = [0, 1 + _TAG_OF.get(x.tag, N_TAGS - 1)]
        base = 1 + N_TAGS
        marks = {_MARK_OF[w] for w in map(str.lower, _SPLIT.split(x.marks)) if w in _MARK_OF} if x.marks else ()
        found += [base + m for m in marks]
        base += N_MARKS
        found.append(base + _bucket(x.own))
        base += len(_BUCKETS) + 1
        found.append(base + _bucket(total[i]))
        base += len(_BUCKETS) + 1
        density = linked[i] / total[i] if total[i] else 0.0
        found.append(base + (density > 0) + (density > 0.3) + (density > 0.7))
        base += 4
        found += [base + k for k, holds in enumerate((x.hidden, x.ended > 0, bool(x.marks))) if holds]
        rows += [i] * len(found)
        columns += found
    return np.array(rows), np.array(columns)


N_FEATURES = 1 + N_TAGS + N_MARKS + 2 * (len(_BUCKETS) + 1) + 4 + 3


class Forest:
    """The trees of some pages, laid out for inference by depth."""

    def __init__(self, pages: list[Page]):
        self.first = np.cumsum([0] + [len(p.nodes) for p in pages])
        self.parent = np.array([x.parent + start if x.parent >= 0 else -1 for p, start in zip(pages, self.first) for x in p.nodes])
        depth = np.array([x.depth for p in pages for x in p.nodes])
        self.levels = [np.flatnonzero(depth == d) for d in range(1, depth.max() + 1)] if len(depth) else []
        self.tag = np.array([_TAG_OF.get(x.tag, N_TAGS - 1) for p in pages for x in p.nodes], dtype=np.int64)
        found = [node_features(p) for p in pages]
        self.rows = np.concatenate([r + start for (r, _), start in zip(found, self.first)])
        self.columns = np.concatenate([c for _, c in found])

    def marginals(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum-product: P(content) of each node, and P(parent, child) of each edge, by child.

        ``unary`` weighs the features for content. ``pair`` has a table over (parent, child) for each tag of a child.
        Messages go up from the deepest nodes and then down, all nodes of one depth at once.
        """
        n = len(self.parent)
        up = np.zeros((n, 2))
        np.add.at(up[:, 1], self.rows, unary[self.columns])
        edge = pair[self.tag]  # node, parent's state, own state
        message = np.zeros((n, 2))
        for level in reversed(self.levels):
            message[level] = np.logaddexp(edge[level, :, 0] + up[level, 0:1], edge[level, :, 1] + up[level, 1:2])
            np.add.at(up, self.parent[level], message[level])
        belief = up.copy()
        both = np.zeros((n, 2, 2))
        for level in self.levels:
            outside = belief[self.parent[level]] - message[level]
            joint = outside[:, :, None] + edge[level] + up[level][:, None, :]
            joint -= joint.max(axis=(1, 2), keepdims=True)
            weight = np.exp(joint)
            both[level] = weight / weight.sum(axis=(1, 2), keepdims=True)
            belief[level] = up[level] + np.logaddexp(edge[level, 0] + outside[:, 0:1], edge[level, 1] + outside[:, 1:2])
        probability = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
        return probability, both


def fit(pages: list[Page], labels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of whole label trees: observed minus expected counts, with decay, by Adam steps."""
    forest, y = Forest(pages), np.concatenate(labels).astype(int)
    inner = np.flatnonzero(forest.parent >= 0)
    seen_unary = np.bincount(forest.columns, weights=y[forest.rows], minlength=N_FEATURES)
    seen_pair = np.zeros((N_TAGS, 2, 2))
    np.add.at(seen_pair, (forest.tag[inner], y[forest.parent[inner]], y[inner]), 1)
    weights = np.zeros(N_FEATURES + N_TAGS * 4)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        unary, pair = weights[:N_FEATURES], weights[N_FEATURES:].reshape(N_TAGS, 2, 2)
        p, both = forest.marginals(unary, pair)
        expected = np.zeros((N_TAGS, 2, 2))
        np.add.at(expected, forest.tag[inner], both[inner])
        gradient = np.concatenate(
            [seen_unary - np.bincount(forest.columns, weights=p[forest.rows], minlength=N_FEATURES), (seen_pair - expected).ravel()]
        ) / len(pages) - DECAY * weights
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        weights = weights + LEARNING_RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return weights[:N_FEATURES], weights[N_FEATURES:].reshape(N_TAGS, 2, 2)


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(("ta", "ne", "ro", "li", "su", "ke")) for _ in range(rng.randint(1, 4))) for _ in range(n))


def _boilerplate(rng: random.Random) -> str:
    kind, places = rng.choice(BOILERPLATE)
    tag, name = rng.choice(places)
    items = range(rng.randint(1, 6))
    if kind == "links":
        inside = "<ul>" + "".join(f'<li><a href="#">{_words(rng, rng.randint(1, 3))}</a></li>' for _ in items) + "</ul>"
        inside = inside if tag != "ul" else inside[4:-5]
    elif kind == "short":
        inside = _words(rng, rng.randint(1, 25)) + rng.choice(("", ".")) + rng.choice(("", f'<a href="#">{_words(rng, 2)}</a>', f"<p>{_words(rng, 8)}.</p>"))
    elif kind == "mixed":
        inside = f"<h3>{_words(rng, 2)}</h3>" + "".join(f"<p>{_words(rng, rng.randint(3, 40))}.</p>" for _ in items)
    elif kind == "prose":
        inside = "".join(f"<p>{_words(rng, rng.randint(3, 40))}.</p>" for _ in items) if rng.random() < 0.4 and tag != "p" else _words(rng, rng.randint(3, 40)) + "."
    elif kind == "form":
        inside = f"<label>{_words(rng, 2)}</label><input><p>{_words(rng, rng.randint(2, 20))}.</p>"
    else:
        inside = "".join(rng.choice(("<div>{}.</div>", "<p>{}.</p>", "<li>{}.</li>", '<div class="comment"><p>{}.</p></div>')).format(_words(rng, rng.randint(3, 60))) for _ in items)
    return f'<{tag} class="{name}" data-label="0">{inside}</{tag}>' if name else f'<{tag} data-label="0">{inside}</{tag}>'


def _paragraph(rng: random.Random) -> str:
    text = _words(rng, rng.choice((1, 2, 5, 12, 30, 60, 120))) + rng.choice((".", ".", ".", "", "!"))
    return rng.choice(
        (f"<p>{text}</p>",) * 8
        + (f"<p><b>{text}</b></p>", f"<p><b>{text}<br>", f"<h2>{text[:60]}</h2>", f"<blockquote><p>{text}</p></blockquote>", f"<pre>{text}</pre>",
           f"<ul><li>{text}</li><li>{_words(rng, 6)}</li></ul>", f"<table><tr><td>{text}</td><td>{_words(rng, 2)}</td></tr></table>",
           f'<p>{text} <a href="#">{_words(rng, 2)}</a> {_words(rng, 3)}.</p>', f"<div>{text}</div>", f"<figure><figcaption>{text}</figcaption></figure>")
    )


def labelled_page(rng: random.Random) -> str:
    """A page with ``data-label`` 1 where the main text begins and 0 where something else begins."""
    tag, name = rng.choice(CONTAINERS)
    body = [f"<h1>{_words(rng, rng.randint(2, 12))}</h1>"] if rng.random() < 0.8 else []
    bare = rng.random() < 0.05  # no element around the main text
    for _ in range(rng.randint(1, 12)):
        body.append(_boilerplate(rng) if rng.random() < 0.12 and not bare else _paragraph(rng))
    if bare:
        body = [part.replace(">", ' data-label="1">', 1) for part in body]
    main = "".join(body) if bare else f'<{tag} class="{name}" data-label="1">{"".join(body)}</{tag}>'
    around = [_boilerplate(rng) for _ in range(rng.randint(1, 6))]
    at = rng.randint(0, len(around))
    parts = [*around[:at], main, *around[at:]]
    if rng.random() < 0.3:
        parts = [f'<div class="{rng.choice(("wrapper", "container", "page", "row"))}">', *parts, "</div>"]
    return "<html><body>" + "".join(parts) + "</body></html>"


def inherited_labels(page: Page) -> np.ndarray:
    """1 below ``data-label`` 1 and 0 below ``data-label`` 0, whichever is nearer; 0 below none."""
    labels = np.zeros(len(page.nodes), dtype=np.int64)
    for i, node in enumerate(page.nodes):
        own = node.label in ("1", "0")
        labels[i] = int(node.label) if own else labels[node.parent] if node.parent >= 0 else 0
    return labels


def article_labels(page: Page) -> np.ndarray | None:
    """Labels of a page with one article that holds nothing but text elements; None for others."""

    def inside(node: Node) -> bool:
        while node.parent >= 0 and node.tag != "article":
            node = page.nodes[node.parent]
        return node.tag == "article"

    labels = np.array([inside(node) for node in page.nodes], dtype=np.int64)
    plain = all(not n.marks and n.tag not in ("aside", "form", "nav", "footer", "header", "section") for n, y in zip(page.nodes, labels) if y)
    return labels if plain and sum(n.tag == "article" for n in page.nodes) == 1 else None


def fit_extractor(pages: DataFrame, html: str = "html", generated: int = GENERATED_PAGES, table_pages: int = TABLE_PAGES):
    """Fit on ``generated`` labelled pages of many layouts and up to ``table_pages`` of the given ones.

    The given pages carry no labels, but one whose only article holds plain text elements tells where its text is.
    """
    rng = random.Random(11)
    known = [read_page(labelled_page(rng)) for _ in range(generated)]
    labels = [inherited_labels(page) for page in known]
    hashed = pages.where(F.col(html).contains("<article") & (F.length(html) < MAX_TABLE_CHARS)).select(
        F.xxhash64(html).alias("h"), F.col(html).alias("html")
    )
    # The hashes are drawn first, so that partitions send hashes and not pages.
    last = hashed.select("h").distinct().orderBy("h").limit(table_pages).agg(F.max("h")).first()[0]
    drawn = hashed.where(F.col("h") <= F.lit(last).cast("long")).groupBy("h").agg(F.min("html").alias("html"))
    for row in drawn.orderBy("h").collect():
        page = read_page(row["html"])
        found = article_labels(page)
        if found is not None:
            known.append(page)
            labels.append(found)
    return fit(known, labels)


PAGES_AT_ONCE = 50


def extract_text(
    pages: DataFrame, model: tuple[np.ndarray, np.ndarray] | None = None, *, keep: list[str] | None = None, html: str = "html"
) -> DataFrame:
    """The columns ``keep`` (``page_id, url`` unless given) with ``text`` and ``n_chars`` of each row of ``pages``.

    Nodes are the block elements of a page and those with a class, id or role. Each has a potential from its tag, the
    words in its marks, its amount of text and links; each edge has one over parent and child. Messages up and down the
    tree give the exact probability that a node is main text; the text of those at 0.5 or more is kept, a block per
    line. Scripts, styles, heads, buttons and the like have no text at all. ``br`` is white space.

    A null or empty page has an empty text. Markup that is not closed, nested wrongly or cut off gives whatever tree
    it opens. Repeated rows are read alike and stay; an empty table gives an empty result.
    """
    keep = keep or ["page_id", "url"]
    weights = pages.sparkSession.sparkContext.broadcast(model or fit_extractor(pages, html))
    chosen = pages.select(*keep, F.col(html).alias("_html"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "_html"] + ["text string", "n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unary, pair = weights.value
        for batch in batches:
            texts: list[str] = []
            sources = batch.column("_html").to_pylist()
            for begin in range(0, len(sources), PAGES_AT_ONCE):
                read = [read_page(source or "") for source in sources[begin : begin + PAGES_AT_ONCE]]
                forest = Forest(read)
                content = forest.marginals(unary, pair)[0] >= 0.5
                texts += ["\n".join(block_texts(page, content[start:])) for page, start in zip(read, forest.first)]
            kept = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*keep, "text", "n_chars"]
            )

    return chosen.mapInArrow(run, schema)
