"""HTML to a tree of nodes with their pieces of text."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
SILENT = frozenset("script style head title noscript template iframe object svg math canvas audio video select button textarea".split())
IN_HEAD = frozenset("base basefont bgsound command link meta noframes noscript script style template title".split())
# A start tag closes open elements of these names first, up to a container that holds them.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = frozenset("ul ol menu dl table body html article section div main aside nav header footer form td th blockquote".split())
CUT_TAG = re.compile(r"<[A-Za-z/!][^<>]*\Z")


@dataclass
class Node:
    tag: str
    marks: str  # class, id and role
    parent: int
    depth: int
    hidden: bool
    label: str | None
    own: int = 0  # characters of text directly in it
    linked: int = 0  # of these, in links
    ended: int = 0  # pieces that end a sentence


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    pieces: list[tuple[int, int, str]] = field(default_factory=list)  # node, block, text


class _Reader(HTMLParser):
    """Every block element is a node, and so is any element with a class, id or role; others belong to what they are in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.stack: list[tuple[str, int]] = []  # tag, node
        self.block = 0
        self.silent = 0
        self.links = 0
        self._open("html", {}, True)

    def _open(self, tag: str, attributes: dict, node: bool):
        parent = self.stack[-1][1] if self.stack else -1
        if node:
            marks = " ".join(filter(None, map(attributes.get, ("class", "id", "role"))))
            style = (attributes.get("style") or "").replace(" ", "").lower()
            hidden = "hidden" in attributes or "display:none" in style or attributes.get("aria-hidden") == "true"
            depth = self.page.nodes[parent].depth + 1 if parent >= 0 else 0
            label = attributes.get("data-label")
            self.page.nodes.append(Node(tag, marks, parent, depth, hidden, label))
            parent = len(self.page.nodes) - 1
        self.stack.append((tag, parent))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def _close_to(self, depth: int):
        while len(self.stack) > depth:
            tag, _ = self.stack.pop()
            self.silent -= tag in SILENT
            self.links -= tag == "a"
            self.block += tag in BLOCKS

    def _last(self, names, holders=frozenset()) -> int | None:
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth][0]
            if tag in names:
                return depth
            if tag in holders:
                return None
        return None

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.handle_data(" ")
        if self.stack[-1][0] == "head" and tag not in IN_HEAD | {"html", "head"}:
            self._close_to(len(self.stack) - 1)  # its end tag may be left out
        if tag in VOID:
            self.block += tag == "hr"
            return
        if tag in ("html", "body"):
            if any(t == tag for t, _ in self.stack[1:]) or tag == "html":
                return
            head = self._last({"head"})
            if head is not None:
                self._close_to(head)
        if tag in BLOCKS and tag not in ("html", "body"):
            paragraph = self._last({"p"}, HOLDERS)
            if paragraph is not None:
                self._close_to(paragraph)
        if tag in CLOSES:
            found = self._last(CLOSES[tag], HOLDERS - {"td", "th"} if tag == "tr" else HOLDERS - CLOSES[tag])
            if found is not None:
                self._close_to(found)
        attributes = dict(attrs)
        self.block += tag in BLOCKS
        self._open(tag, attributes, tag in BLOCKS or any(attributes.get(k) for k in ("class", "id", "role")))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS and self.stack[-1][0] == tag:
            self._close_to(len(self.stack) - 1)

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_data(" ")
        depth = self._last({tag})
        if depth is None:
            return
        if tag not in BLOCKS and tag not in SILENT and self._last(BLOCKS) is not None and self._last(BLOCKS) > depth:
            return  # an inline end tag does not close blocks
        self._close_to(depth)

    def handle_data(self, data):
        if self.stack[-1][0] == "head" and data.strip():
            self._close_to(len(self.stack) - 1)
        if self.silent:
            return
        node = self.stack[-1][1]
        self.page.pieces.append((node, self.block, data))
        text = data.strip()
        if text:
            owner = self.page.nodes[node]
            owner.own += len(text)
            owner.linked += len(text) if self.links else 0
            owner.ended += text[-1] in ".!?…:;\"'"


def read_page(html: str) -> Page:
    """Never fails: whatever is not closed ends with the page, and a tag cut off at its end is left out."""
    reader = _Reader()
    reader.feed(CUT_TAG.sub("", html))
    reader.close()
    return reader.page


def block_texts(page: Page, chosen) -> list[str]:
    """The text of each block, from pieces of ``chosen`` nodes, with white space as one blank."""
    texts: list[str] = []
    last, parts = None, []
    for node, block, text in [*page.pieces, (None, None, "")]:
        if block != last:
            joined = " ".join("".join(parts).split())
            if joined:
                texts.append(joined)
            last, parts = block, []
        if node is not None and chosen[node]:
            parts.append(text)
    return texts
