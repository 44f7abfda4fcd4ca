"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its elements, with a leaf for each block of text. Every node is content or not. A logistic model of a node's
tag, its class and id words, links and text gives its own potential; parent and child share one by the sort of the child. One pass of
sum-product messages up and one down give exact marginals, so a paragraph is judged by what it is, by what it is in and by what is beside it.

The potentials are fitted on labelled pages: the layouts below, whose text is marked as content (+) or not (-), and at most ``sample_pages``
pages of the table (those with the lowest hash of page_id) that mark their article themselves, by one <article> or <main> element. There the text inside counts
as content but for parts whose name says otherwise. Every page's whole markup is parsed and judged.

A block of text ends where a block element begins or ends; <br> is white space. A null or empty page gives an empty text. Broken markup
is read as browsers do in simple cases: open elements are closed by the end of their parent, paragraphs and items by the next
one. Repeated rows are handled each by itself; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.samples import one_each, sample, within

SAMPLE_PAGES = 1500
SAMPLE_CHARS = 1 << 26
LAYOUT_WEIGHT = 5

# HTML elements by their role.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_SILENT = frozenset("script style template noscript head title svg math iframe object canvas audio video textarea select option datalist".split())
_RAW = frozenset("script style textarea title noscript iframe".split())
# Start tags that may stand in a head, and those that end an open svg or math element.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_ENDS_DRAWING = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre ruby s small span strike strong sub sup table tt u ul var".split()
)
_CLOSES = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
# Words in class and id values that tell what a part of a page is for.
_GOOD = frozenset("article content main post entry story body text page prose copy blog news".split())
_BAD = frozenset(
    "nav navbar navigation menu header masthead footer foot sidebar side aside rail ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored "
    "cookie cookies consent gdpr notice alert popup modal overlay comment comments reply replies discussion disqus share sharing social related recommended more "
    "newsletter subscribe signup login search breadcrumb breadcrumbs pagination pager toolbar widget tags byline form copyright legal skip teaser trending".split()
)

_TOLD = _BAD | _GOOD
_REGIONS = frozenset("article main header footer nav aside form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*|[^>]*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BODY = re.compile(r"<body[\s/>]", re.I)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    """An element, or (tag "") a block of text."""

    __slots__ = ("children", "hint", "link", "names", "parent", "parts", "region", "tag", "text")

    def __init__(self, tag: str, parent: Node | None, names: frozenset[str] = frozenset()) -> None:
        self.tag, self.parent, self.names = tag, parent, names
        self.children: list[Node] = []
        self.parts: list[str] = []
        self.text, self.link = "", 0
        self.hint = "bad" if names & _BAD else "good" if names & _GOOD else "none"
        own = tag if tag in _REGIONS else self.hint if self.hint != "none" else ""
        above = "" if parent is None else parent.region
        self.region = f"{above.rpartition('>')[2]}>{own}" if own else above


@lru_cache(4096)
def _names(attributes: str) -> frozenset[str]:
    if "=" not in attributes:
        return frozenset()
    found = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            found.update(word.lower() for word in _NAME_WORDS.findall("".join(values)))
    return frozenset(found & _TOLD)


class _Parser:
    def __init__(self) -> None:
        self.root = Node("html", None)
        self.open = [self.root]
        self.nodes = [self.root]
        self.silent: str | None = None
        self.depth_silent = 0
        self.leaf: Node | None = None
        self.links = 0

    def block(self) -> Node:
        return self.open[-1]

    def say(self, raw: str) -> None:
        if self.leaf is None:
            if not raw.strip():
                return
            self.leaf = Node("", self.block())
            self.block().children.append(self.leaf)
            self.nodes.append(self.leaf)
        text = html.unescape(raw) if "&" in raw else raw
        self.leaf.parts.append(text)
        if self.links:
            self.leaf.link += len(text)

    def start(self, tag: str, attributes: str) -> None:
        if tag in _INLINE:
            if tag == "br":
                if self.leaf is not None:
                    self.leaf.parts.append(" ")
            elif tag == "a":
                self.links += 1
            return
        self.leaf = None
        if tag in _CLOSES:
            closed, within = (set(names.split()) for names in _CLOSES[tag])
            self._close(closed, within)
        elif tag != "html":
            self._close({"p"}, {"html", "body", "article", "section", "div", "td", "li", "aside", "main", "blockquote"})
        if tag in ("html", "body") and any(n.tag == tag for n in self.open):
            return
        if tag in _VOID:
            return
        node = Node(tag, self.block(), _names(attributes))
        self.block().children.append(node)
        self.nodes.append(node)
        self.open.append(node)

    def _close(self, closed: set[str], within: set[str]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in closed:
                del self.open[k:]
                self.links = 0
                return
            if self.open[k].tag in within:
                return

    def end(self, tag: str) -> None:
        if tag in _INLINE:
            if tag == "a":
                self.links = max(self.links - 1, 0)
            return
        self.leaf = None
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                self.links = 0
                return


def _ended_by(tag: str, silent: list[str], begun: bool) -> None:
    """Leave what a start tag ends without an end tag: the head, whatever is open in it, and drawings."""
    if tag == "body" and not begun or silent == ["head"] and tag not in _IN_HEAD:
        silent.clear()
    elif tag in _ENDS_DRAWING:
        while silent and silent[-1] in ("svg", "math"):
            silent.pop()


def parse(page: str) -> list[Node]:
    """The tree's nodes, parents before children, in page order. Text that is never shown is left out.

    An element whose text is not shown must be closed somewhere further on in the page, or be in a head that a body follows; if not, its start tag is
    passed over (but for scripts and styles, which then last to the end).
    """
    p, at, silent, begun = _Parser(), 0, [], False
    last_end: dict[str, int] = {}

    def closed_after(tag: str, at: int) -> bool:
        if tag not in last_end:
            last_end[tag] = max((end.start() for end in re.finditer(rf"</{tag}[\s/>]", page, re.I)), default=-1)
        return last_end[tag] >= at

    while True:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if silent == ["head"] and text.strip():
            silent.clear()
        if text and not silent:
            p.say(text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if silent:
                if tag in silent:
                    del silent[len(silent) - 1 - silent[::-1].index(tag) :]
            else:
                p.end(tag)
            continue
        _ended_by(tag, silent, begun)
        drawn = bool(silent) and silent[-1] in ("svg", "math")
        if tag in _SILENT or drawn and tag in ("foreignobject", "desc"):
            alone = (drawn or tag in ("svg", "math")) and m[3].endswith("/")
            if tag == "head":
                if not begun and not silent:
                    silent.append(tag)
            elif not alone and (tag in ("script", "style") or closed_after(tag, at) or "head" in silent and _BODY.search(page, at)):
                silent.append(tag)
        elif not silent:
            begun |= tag not in _IN_HEAD
            p.start(tag, m[3])
        if silent and silent[-1] in _RAW:
            closing = re.compile(rf"</{silent[-1]}[\s/>]", re.I).search(page, at)
            at = closing.start() if closing else len(page)
    for node in p.nodes:
        if not node.tag:
            node.text = " ".join("".join(node.parts).split())
    return p.nodes


Kind = tuple


def kind(node: Node) -> Kind:
    """What a node's own potential depends on."""
    parent = node.parent
    if node.tag:
        return node.tag, node.hint, node.names, "" if parent is None else parent.tag
    size = len(node.text)
    ended = size > 0 and node.text[-1] in ".!?"
    return "", parent.tag, node.region, min(int(log1p(size)), 7), ended, min(int(4 * node.link / max(size, 1)), 4), min(len(parent.children), 4)


def features(k: Kind) -> list[str]:
    if k[0]:
        tag, hint, names, parent = k
        return [f"tag={tag}", f"hint={hint}", *(f"name={name}" for name in names), f"path={parent}>{tag}"]
    _, parent, region, size, ended, links, beside = k
    return ["text", f"in={parent}", f"region={region}", f"size={size}", f"sentence={ended}", f"links={links}", f"beside={beside}"]


def sort_of(node: Node) -> str:
    """Which potential a node shares with its parent."""
    if not node.tag:
        return "text"
    if node.tag in ("nav", "aside", "footer", "header", "form", "button", "menu", "dialog"):
        return node.tag
    return f"element {node.hint}"


class Model:
    def __init__(self, weights: dict[str, float], bias: float, pairs: dict[str, np.ndarray]) -> None:
        self.weights, self.bias = weights, bias
        self.pairs = {sort: [[float(x) for x in row] for row in table] for sort, table in pairs.items()}
        self.other = self.pairs.get("element none", [[1.0, 1.0], [1.0, 1.0]])
        self.known: dict[Kind, float] = {}

    def own(self, node: Node) -> float:
        """A node's probability of content by itself."""
        k = kind(node)
        p = self.known.get(k)
        if p is None:
            z = self.bias + sum(self.weights.get(name, 0.0) for name in features(k))
            if len(self.known) > 50_000:
                self.known.clear()
            p = self.known[k] = 1 / (1 + exp(-max(-12.0, min(12.0, z))))
        return p


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """The probability of content of each node: messages up the tree, then down."""
    place = {id(node): k for k, node in enumerate(nodes)}
    own = [model.own(node) for node in nodes]
    up: list[tuple[float, float]] = [(1.0, 1.0)] * len(nodes)  # of each node to its parent
    inside = [(1 - p, p) for p in own]
    parents = [-1 if node.parent is None else place[id(node.parent)] for node in nodes]
    tables = [model.pairs.get(sort_of(node), model.other) for node in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        t, (no, yes) = tables[k], inside[k]
        a, b = t[0][0] * no + t[0][1] * yes, t[1][0] * no + t[1][1] * yes
        up[k] = (a / (a + b), b / (a + b))
        no, yes = inside[parents[k]]
        no, yes = no * up[k][0], yes * up[k][1]
        inside[parents[k]] = (no / (no + yes), yes / (no + yes))
    out = [0.0] * len(nodes)
    whole = list(inside)
    for k in range(len(nodes)):
        if k:
            # what the parent knows without this child
            no, yes = whole[parents[k]]
            no, yes = no / up[k][0], yes / up[k][1]
            t = tables[k]
            a, b = t[0][0] * no + t[1][0] * yes, t[0][1] * no + t[1][1] * yes
            no, yes = inside[k][0] * a, inside[k][1] * b
            whole[k] = (no / (no + yes), yes / (no + yes))
        out[k] = whole[k][1]
    return out


def main_text(page: str, model: Model) -> str:
    nodes = parse(page)
    chances = marginals(nodes, model)
    return "\n".join(node.text for node, p in zip(nodes, chances, strict=True) if node.text and p >= 0.5)


Labelled = list[tuple[Node, int]]


def _with_labels(nodes: list[Node], content: set[int]) -> Labelled:
    """Labels of all nodes from those of the text: an element is content if most of its text is."""
    size, good = defaultdict(int), defaultdict(int)
    for node in nodes:
        if node.text:
            above: Node | None = node
            while above is not None:
                size[id(above)] += len(node.text)
                good[id(above)] += len(node.text) * (id(node) in content)
                above = above.parent
    return [(node, int(2 * good[id(node)] > size[id(node)])) for node in nodes if node.tag or node.text]


def of_layout(page: str) -> Labelled:
    nodes = parse(page)
    content = {id(node) for node in nodes if node.text.startswith("+")}
    for node in nodes:
        node.text = node.text.lstrip("+- ")
    return _with_labels(nodes, content)


def of_page(page: str) -> Labelled | None:
    """Labels of a page that marks its article itself."""
    nodes = parse(page)
    marked = [node for node in nodes if node.tag in ("article", "main")]
    if len({node.tag for node in marked}) != len(marked) or not marked:
        return None
    content = set()
    for node in nodes:
        above, found = node, False
        while above is not None and above.hint != "bad" and above.tag not in ("nav", "aside", "footer", "form", "button", "dialog"):
            found |= above is marked[-1]
            above = above.parent
        if node.text and found and above is None:
            content.add(id(node))
    return _with_labels(nodes, content)


def fitted(layouts: list[Labelled], pages: list[Labelled], steps: int = 300) -> Model:
    examples: dict[tuple[Kind, int], float] = defaultdict(float)
    pairs: dict[str, np.ndarray] = defaultdict(lambda: np.full((2, 2), 0.5))
    page_weight = min(1.0, 200.0 / max(len(pages), 1))  # layouts say what the table's pages may lack
    for weight, labelled in [(LAYOUT_WEIGHT, x) for x in layouts] + [(page_weight, x) for x in pages]:
        label_of = {id(node): label for node, label in labelled}
        for node, label in labelled:
            examples[kind(node), label] += weight
            if node.parent is not None and id(node.parent) in label_of:
                pairs[sort_of(node)][label_of[id(node.parent)], label] += weight
    named = [features(key) for key, _ in examples]
    names = sorted({name for own in named for name in own})
    index = {name: k for k, name in enumerate(names)}
    rows = [[index[name] for name in own] for own in named]
    flat, owner = np.concatenate([np.array(r) for r in rows]), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    target = np.array([label for _, label in examples], float)
    amount = np.array(list(examples.values()))
    w, bias = np.zeros(len(names)), 0.0
    for _ in range(steps):
        z = bias + np.bincount(owner, w[flat], len(rows))
        gap = amount * (target - 1 / (1 + np.exp(-z))) / amount.sum()
        w += 4.0 * (np.bincount(flat, gap[owner], len(names)) - 1e-4 * w)
        bias += 4.0 * gap.sum()
    potentials = {}
    for sort, met in pairs.items():
        share = met / met.sum()
        potentials[sort] = share / share.sum(axis=1, keepdims=True) / share.sum(axis=0, keepdims=True)
    return Model(dict(zip(names, w.tolist(), strict=True)), float(bias), potentials)


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Model:
    chosen = sample(pages.where("page_id is not null").select("page_id").distinct(), "page_id", sample_pages, 31)
    # sample_pages is a parameter, so the broadcast has a bound
    texts = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").where("html is not null")
    rows = within(one_each(texts, "page_id", "html"), "page_id", "html", SAMPLE_CHARS).orderBy("page_id").collect()
    found = [labelled for row in rows if (labelled := of_page(row["html"])) is not None]
    return fitted([of_layout(page) for page in LAYOUTS], found)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars: one row per page."""

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", model) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(extracted, "page_id long, url string, text string, n_chars long")


_SENTENCE = "The river rose for three days before the bridge gave way and the town had to wait for boats."
_NAV = '<nav><ul><li><a href="/a">-Home</a></li><li><a href="/b">-World news</a></li><li><a href="/c">-About</a></li></ul></nav>'
_FOOT = "<footer><p>-&copy; 2024 The Daily Example. All rights reserved.</p><ul><li><a href='/t'>-Terms</a></li><li><a href='/p'>-Privacy</a></li></ul></footer>"
_TEXT = f"<h1>+Flood in the valley</h1><p>+{_SENTENCE}</p><h2>+What comes next</h2><p>+{_SENTENCE} {_SENTENCE}</p><ul><li>+Boats leave at nine.</li><li>+Bring water.</li></ul><blockquote><p>+{_SENTENCE}</p></blockquote><p>+Yes.</p>"
_PARTS = [
    f'<header class="site-header"><div class="logo">-The Daily Example</div><p>-{_SENTENCE}</p></header>',
    f'<header><h1>-The Daily Example</h1>{_NAV}</header>',
    '<div class="ad">-Buy two lamps and get one for free.</div>',
    f'<div class="advert banner"><p>-{_SENTENCE}</p></div>',
    f'<aside><h3>-Most read</h3><p>-{_SENTENCE}</p><ul><li><a href="/1">-Storm over the bay</a></li></ul></aside>',
    f'<div id="sidebar"><h3>-Also here</h3><p>-{_SENTENCE}</p><ul><li><a href="/1">-Storm over the bay</a></li><li>-Weather</li></ul></div>',
    f'<div class="cookie-notice"><p>-We use cookies. {_SENTENCE}</p><button>-Accept</button></div>',
    f'<div class="notice"><p>-{_SENTENCE}</p></div>',
    '<form action="/s"><label>-Your mail</label><input name="m"><p>-We write once a week to all who sign up.</p><button>-Send</button></form>',
    f'<section class="comments"><h2>-Two comments</h2><div class="comment"><p>-{_SENTENCE}</p></div><div class="comment"><p>-I was there. {_SENTENCE}</p></div></section>',
    f'<div id="comments"><h3>-Comments</h3><ol><li><p>-{_SENTENCE}</p></li><li>-Well said.</li></ol></div>',
    '<div class="share social"><a href="/x">-Share</a> <a href="/y">-Post</a></div>',
    f'<div class="related"><h3>-Related</h3><ul><li><a href="/1">-Storm over the bay</a></li></ul><p>-{_SENTENCE}</p></div>',
    '<ul class="breadcrumb"><li><a href="/">-Home</a></li><li><a href="/n">-News</a></li></ul>',
    f'<div class="newsletter"><p>-{_SENTENCE}</p></div>',
    _NAV,
    '<div class="menu"><ul><li><a href="/a">-Home</a></li><li><a href="/b">-World</a></li></ul></div>',
    '<ul><li><a href="/a">-Home</a></li><li><a href="/b">-World</a></li><li><a href="/c">-Sport</a></li></ul>',
    f'<div class="footer"><p>-{_SENTENCE}</p></div>',
    '<div class="popup modal"><p>-Stay with us for one more story.</p></div>',
]
_BODIES = [
    f"<article>{_TEXT}</article>",
    f"<main>{_TEXT}</main>",
    f'<main><article class="post">{_TEXT}</article></main>',
    f'<div class="content">{_TEXT}</div>',
    f'<div id="main-content"><div class="article-body">{_TEXT}</div></div>',
    f'<div class="wrapper"><div class="entry-content">{_TEXT}</div></div>',
    f'<article><header><h1>+Flood in the valley</h1></header><div><p>+{_SENTENCE}</p><p>+{_SENTENCE}</p></div></article>',
    f"<div><div>{_TEXT}</div></div>",
    f"<article><section>{_TEXT}</section><section><h2>+Later</h2><p>+{_SENTENCE}</p><table><tr><td>+Monday</td><td>+4 m</td></tr></table></section></article>",
    f'<section class="story"><div>{_TEXT}</div><pre>+12 boats 4 carts</pre></section>',
]


def _layouts() -> list[str]:
    """Each body between the parts that may go with it, outside it and (but for navigation) inside its end."""
    pages = []
    for k, body in enumerate(_BODIES):
        for shift in range(5):
            own = [_PARTS[(4 * k + 7 * shift + j) % len(_PARTS)] for j in range(6)]
            cut = body.rindex("</")
            inner = body[:cut] + own[5] + body[cut:] if shift % 2 else body
            pages.append(f"<html><body>{_NAV if shift % 3 else ''}{own[0]}{own[1]}{inner}{own[2]}{own[3]}{own[4]}{_FOOT}</body></html>")
        pages.append(f"<html><body>{body}</body></html>")
    return pages


LAYOUTS = _layouts()
