"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is read into blocks: the text between block-level tags, with the elements around it.
A logistic classifier, trained on the marked blocks of :data:`SAMPLES`, gives each block a
probability of being content. The cut that separates content from boilerplate at least cost
pays, for each block, the negative log-probability of its side, and for each pair of related
blocks on different sides their tie: neighbours in page order, and blocks of the same parent
element. A maximum flow from the content terminal to the boilerplate terminal finds it.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm._common import schema, small_batches, text_or_empty

#: Elements whose text is never shown as running text.
SILENT = frozenset("script style noscript template head title svg math iframe object canvas select textarea button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: Elements that an opening tag of the first kind closes.
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
#: Opening a block closes an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
    "pre section table ul".split()
)
BOILERPLATE = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|respond|cookies?|consent|footer|header|masthead|menu|nav|"
    r"navbar|navigation|newsletter|notices?|pagination|pager|popup|promo\w*|recommend\w*|related|share|sharing|sidebar|"
    r"signup|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[-_\s])",
    re.IGNORECASE,
)
CONTENT = re.compile(r"(?:^|[-_\s])(?:article|content|entry|main|post|story|text|body)(?:$|[-_\s])", re.IGNORECASE)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.DOTALL,
)
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.IGNORECASE) for t in ("script", "style", "textarea", "title", "noscript", "iframe")}
_ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

#: Ties: of neighbours in page order, more for those of one parent; and between a parent's further blocks.
NEIGHBOUR, SIBLING = 0.3, 0.9


class Node:
    """An open element. What features ask of all elements around is handed down, so a block costs no walk."""

    __slots__ = ("tag", "number", "up", "depth", "block", "gold", "article", "boiler_tag", "form", "boiler_name", "content_name", "framed")

    def __init__(self, tag: str, name: str, number: int, gold: bool, up: Node | None):
        self.tag, self.number, self.up = tag, number, up
        self.depth = up.depth + 1 if up else 1
        #: The nearest element that is not inline, itself included.
        self.block: Node | None = (up.block if up else None) if tag in INLINE else self
        over = lambda what: up is not None and getattr(up, what)
        self.gold = gold or over("gold")
        self.article = tag in ("article", "main") or over("article")
        # a header, footer or aside counts wherever it stands; comments inside the article too
        self.boiler_tag = tag in ("nav", "footer", "aside", "header", "dialog", "menu") or over("boiler_tag")
        self.form = tag in ("form", "fieldset", "label", "input") or over("form")
        self.boiler_name = bool(name and BOILERPLATE.search(name)) or over("boiler_name")
        self.content_name = bool(name and CONTENT.search(name)) or over("content_name")
        self.framed = tag not in ("html", "body", "div", "p", "span", "section") or over("framed")


def same_places(x: Node | None, y: Node | None) -> int:
    """How many elements of the two paths have the same tag at the same depth; shared ones aren't walked."""
    if not x or not y:
        return 0
    while x.depth > y.depth:
        x = x.up
    while y.depth > x.depth:
        y = y.up
    found = 0
    while x is not y:
        found += x.tag == y.tag
        x, y = x.up, y.up
    return found + (x.depth if x else 0)


@dataclass
class Block:
    text: str
    parent: int
    #: The innermost element around the text that is not inline.
    node: Node | None
    link_chars: int

    @property
    def gold(self) -> bool:
        return bool(self.node and self.node.gold)


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order; broken markup is read as browsers do, roughly."""
    found: list[Block] = []
    stack: list[Node] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0
    silent = 0
    number = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                node = stack[-1].block if stack else None
                outer = node.up if node and node.up and node.tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6") else node
                found.append(Block(text, outer.number if outer else 0, node, min(linked, len(text))))
            parts.clear()
        linked = 0

    def close(k: int) -> None:
        nonlocal silent
        silent -= sum(e.tag in SILENT for e in stack[k:])
        opened.subtract(e.tag for e in stack[k:])
        del stack[k:]

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        upto = m.start() if m else size
        if upto > at and not silent:
            piece = page[at:upto]
            parts.append(piece)
            if any(e.tag == "a" for e in stack[-4:]):
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m[0].startswith("<![CDATA[") and not silent:
                parts.append(m[0][9:-3].replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if tag == "br" or tag == "wbr":
            if not silent and tag == "br":
                parts.append(" ")
            continue
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[k].tag == tag:
                    if tag not in INLINE:
                        flush()
                    close(k)
                    break
                if tag in INLINE and stack[k].tag not in INLINE:
                    break
            else:
                if tag not in INLINE:
                    flush()
            continue
        if tag not in INLINE:
            flush()
            shut = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
            k = len(stack)
            while k:
                top = stack[k - 1]
                if top.tag in shut:
                    k -= 1
                    close(k)
                elif top.tag in INLINE:
                    k = top.block.depth if top.block else 0
                else:
                    break
        if tag in VOID:
            continue
        attrs = m["attrs"]
        names, gold = "", "data-gold" in attrs
        if "=" in attrs:
            for a in _ATTR.finditer(attrs):
                names += " " + (a[2] if a[2] is not None else a[3] if a[3] is not None else a[4])
        if attrs.endswith("/") and tag not in ("p", "div", "a", "span"):
            continue
        number += 1
        stack.append(Node(tag, names.strip(), number, gold, stack[-1] if stack else None))
        opened[tag] += 1
        silent += tag in SILENT
        if tag in _RAW_END:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else size
            close(len(stack) - 1)
    flush()
    return found


FEATURES = (
    "bias", "article", "boiler tag", "form", "boiler name", "content name", "link share", "paragraph", "heading", "item",
    "log chars", "sentence", "words over 10", "outside any",
)


def features_of(block: Block) -> list[float]:
    node = block.node
    have = lambda what: float(bool(node and getattr(node, what)))
    words = block.text.count(" ") + 1
    leaf = node.tag if node else ""
    return [
        1.0,
        have("article"),
        have("boiler_tag"),
        have("form"),
        have("boiler_name"),
        have("content_name"),
        block.link_chars / max(1, len(block.text)),
        float(leaf == "p"),
        float(leaf in ("h1", "h2", "h3", "h4", "h5", "h6")),
        float(leaf in ("li", "dd", "dt", "td", "th")),
        min(np.log1p(len(block.text)), 7.0) / 7,
        float(block.text.rstrip("\"')”»").endswith((".", "!", "?", ":", "…", ";"))),
        float(words > 10),
        1.0 - have("framed"),
    ]


#: Pages whose content blocks carry the attribute data-gold.
SAMPLES = (
    '<html><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News.</a></li></ul></nav><div class="ad">Buy now for less, only here and only today.</div>'
    '<article data-gold><h1>A day at sea</h1><p>The boat left early.</p><p>It came back at night, with all of its crew and a lot of fish on board.</p><p>Yes.</p></article>'
    "<footer>&copy; site &middot; All the rights are reserved by us.</footer></body></html>",
    '<html><body><header><div>My site</div><p>A place for long texts about all there is, every day.</p></header><main data-gold><h2>On time</h2><p>Time flies, they say; and it never comes back to where it was.</p><ul><li>one</li><li>two</li></ul></main>'
    '<aside><p>Read this too: the best of the year, chosen by our readers for you.</p></aside><section class="comments"><p>I liked it a lot, thank you for this!</p><p>No.</p></section></body></html>',
    '<html><body><div id="menu"><a href="/">Start</a> <a href="/x">More</a></div><div class="content" data-gold><p>Some words first.</p><p>Then a longer paragraph with a <a href="/y">link</a> in it, and an end.</p></div>'
    '<div class="sidebar"><p>About me: I write about the weather and the wind.</p></div><form><p>Your mail address, please:</p><label>Name</label></form></body></html>',
    '<html><body><div class="cookie-notice"><p>We use cookies to make this site better for you.</p></div><article><h1 data-gold>Bread</h1><p data-gold>Flour and water.</p><blockquote data-gold><p>It is good.</p></blockquote><p data-gold>Bake it for an hour in a hot oven until it is brown.</p>'
    '<div class="share"><a href="/t">Share this</a></div><div class="comments"><h3>Comments</h3><p>Works well, and it tastes like that of my mother.</p></div></article><div class="related"><h3>Related</h3><ul><li><a href="/1">Cake</a></li></ul></div></body></html>',
    '<html><body><nav><a href="/">A</a></nav><article><p data-gold><b>First words of it<br></p><p data-gold>More of it follows here and goes on for a while, then ends.</p><table data-gold><tr><td>1</td><td>2</td></tr></table></article><div class="promo">Subscribe today and get one month free of charge.</div><footer><p>Contact us at any time, day or night.</p></footer></body></html>',
    '<html><body><div class="post-body" data-gold><h2>Plain</h2><p>Here is what was said, word by word, on that day.</p><p>Nothing else.</p></div><div class="newsletter"><p>Get our best stories by mail, each week.</p></div><div id="footer"><p>Made by hand in a small town by the sea.</p></div></body></html>',
    "<html><body><p data-gold>A page with no structure at all, only this text.</p><p data-gold>And this one.</p></body></html>",
    '<html><body><div data-gold>Bare text in a div that goes on for some time, as old pages do.</div><div data-gold>More of it.</div><div class="banner"><p>Win a car today, it is easy and free!</p></div></body></html>',
    '<html><body><header><nav><ul><li><a href="/">x</a></li></ul></nav></header><article><header data-gold><h1>Title in the article</h1></header><section data-gold><p>Text in a section.</p></section><aside><p>See the map of the region on page nine.</p></aside><section id="comments"><div><p>Great read. Thanks to all of you.</p></div></section><form><p>Leave a reply to this text here.</p></form></article></body></html>',
)


@lru_cache(maxsize=1)
def classifier() -> np.ndarray:
    """Logistic weights from the samples, by Newton's method with a small quadratic penalty."""
    rows = [(features_of(b), b.gold) for page in SAMPLES for b in blocks_of(page)]
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        hess = x.T @ (x * (p * (1 - p))[:, None]) + 0.05 * np.eye(len(w))
        w += np.linalg.solve(hess, x.T @ (y - p) - 0.05 * w)
    return w


def minimum_cut(content: list[float], boiler: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the content terminal in a minimum cut.

    ``content[k]`` is what it costs to call k content, ``boiler[k]`` boilerplate; a tie
    (a, b, cost) is paid where a and b differ. Augmenting shortest paths by levels (Dinic).
    """
    n = len(content)
    s, t = n, n + 1
    to: list[int] = []
    room: list[float] = []
    near: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        near[a].append(len(to))
        to.append(b)
        room.append(there)
        near[b].append(len(to))
        to.append(a)
        room.append(back)

    for k in range(n):
        # what both terminals would pay in any case is left out
        d = boiler[k] - content[k]
        if d > 0:
            edge(s, k, d, 0.0)
        elif d < 0:
            edge(k, t, -d, 0.0)
    for a, b, cost in ties:
        edge(a, b, cost, cost)
    tiny = 1e-12
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in near[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[k] >= 0 for k in range(n)]
        upto = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if room[e] <= tiny)
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while upto[a] < len(near[a]):
                e = near[a][upto[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                upto[a] += 1
            else:
                if a == s:
                    break
                upto[to[path[-1] ^ 1]] += 1
                a = to[path.pop() ^ 1]


def label(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    """Which blocks are content."""
    if not blocks:
        return []
    z = np.clip(np.array([features_of(b) for b in blocks]) @ weights, -12, 12)
    content, boiler = np.logaddexp(0, -z).tolist(), np.logaddexp(0, z).tolist()
    ties: list[tuple[int, int, float]] = []
    last: dict[int, int] = {}
    for k, b in enumerate(blocks):
        if k and blocks[k - 1].parent != b.parent:
            x, y = blocks[k - 1].node, b.node
            ties.append((k - 1, k, NEIGHBOUR * same_places(x, y) / max(1, x.depth if x else 0, y.depth if y else 0)))
        if b.parent in last:
            ties.append((last[b.parent], k, SIBLING))
        last[b.parent] = k
    return minimum_cut(content, boiler, ties)


def main_text(page: str) -> str:
    """The content blocks of ``page``, one per line."""
    blocks = blocks_of(page)
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks, classifier()), strict=True) if keep)


RESULT = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """A row of :data:`RESULT` for each of (page_id, url, html), in one pass without a shuffle.

    A null or empty page, and one without content, has the empty text; urls may be null;
    repeated rows have a row each; other columns are not read. Pages of any length are read
    whole; the cut of a page takes memory in proportion to its blocks.
    """
    classifier()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_or_empty("html").alias("html"))
    return small_batches(rows).mapInArrow(run, schema(RESULT))
