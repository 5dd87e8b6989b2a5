"""Web pages as trees of block elements and runs of text, with features of every node."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np

# Names of HTML elements and words that sites use for parts of a page.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg annotation annotation-xml noembed noframes xmp select object canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr"
    " math semantics maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow"
    " ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split()
)
#: Elements of RAW whose start tag can end them, by a slash.
FOREIGN = frozenset("svg annotation annotation-xml".split())
#: Elements whose start ends an open element of the listed names.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "body": ("head",),
}
#: Names at which the search for an element to end stops.
HOLDS = frozenset("body html article section main div table ul ol dl nav aside header footer form td th".split())
WORDS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs skip",
    "header": "header masthead topbar logo branding",
    "footer": "footer foot copyright legal colophon",
    "side": "sidebar side aside related recommended widget trending popular rail archive",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe signup paywall",
    "ad": "ad ads adv advert adverts advertisement sponsor sponsored promo promoted banner",
    "form": "form search login contact survey",
    "comment": "comment comments reply replies respond discussion disqus thread",
    "share": "share sharing social follow",
    "about": "byline author meta tags more",
    "content": "article content main post entry story body text prose markdown page",
}
TAGS = (
    "article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption table tr td th nav"
    " header footer aside form fieldset button details summary address body html"
).split()

#: Deeper elements are children of their ancestor at this depth, as in browsers; their text stays.
MAX_DEPTH = 512

_KINDS = list(WORDS)
_HEADER, _ABOUT, _NAMED_CONTENT = (_KINDS.index(k) for k in ("header", "about", "content"))
_WORD_OF = {w: k for k, words in enumerate(WORDS.values()) for w in words.split()}
_TAG_OF = {t: k for k, t in enumerate(TAGS)}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?(?P<odd>[a-zA-Z][^\s/>]*+)[^>]*+>|<[!?/][^>]*+>",
    re.S,
)
#: The same for pages with a quote that nothing closes: from there on a tag ends at the next ``>``.
_PLAIN_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>[^>]*+)>|(?P<odd>(?!))|<[!?/][^>]*+>",
    re.S,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PARTS = re.compile(r"[a-z]+")

#: Sums over the text of a leaf: bias, log of its words, none but links, share in links, ends a
#: sentence, few words, rights notice, speaks of cookies.
LEAF = 8
SIZE = LEAF + len(TAGS) + len(WORDS) + 4
_RIGHTS = re.compile(r"©|\(c\) |all rights reserved|copyright", re.I)
_COOKIE = re.compile(r"\bcookies?\b|\bsubscribe\b|\bsign up\b|\blog ?in\b", re.I)


@dataclass
class Tree:
    """Nodes in page order: parents before children. ``text`` is None for elements."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    name: list[str] = field(default_factory=list)
    words: list[frozenset[int]] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, name: str, words=frozenset(), hidden=False, text=None, linked=0) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.name.append(name)
        self.words.append(words)
        self.hidden.append(hidden)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


class _Open:
    """The open elements of a page. What is asked of them takes no walk over the others."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.nodes: list[int] = []
        self.at: dict[str, list[int]] = {}
        self.holds: list[int] = []

    def push(self, name: str, node: int) -> None:
        if name in HOLDS:
            self.holds.append(len(self.names))
        self.at.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.nodes.append(node)

    def cut(self, size: int) -> None:
        """End all elements from this place on."""
        while len(self.names) > size:
            name = self.names.pop()
            self.nodes.pop()
            self.at[name].pop()
            if name in HOLDS:
                self.holds.pop()

    def last(self, name: str) -> int:
        """Where the innermost open element of this name is; 0, the root, if there is none."""
        places = self.at.get(name)
        return places[-1] if places else 0

    def end(self, name: str) -> None:
        if place := self.last(name):
            self.cut(place)

    def end_inside(self, names: tuple[str, ...]) -> None:
        """End the nearest of ``names`` unless an element that holds blocks lies between."""
        place = max(map(self.last, names))
        if place and place >= (self.holds[-1] if self.holds else 0):
            self.cut(place)

    def parent(self) -> int:
        return self.nodes[min(len(self.nodes), MAX_DEPTH) - 1]


def parse(html: str | None) -> Tree:
    """The tree of a page, however broken its markup, in time linear in its length.

    Unclosed elements end with their parents, end tags without a start are passed over. Scripts,
    styles, comments, the head's title and other text that is not shown make no node. White
    space in a run of text is one space. The header of an article counts as a section of it.
    """
    tree = Tree()
    open_ = _Open()
    open_.push("", tree.add(-1, "html"))
    run, link = [], [0, 0]
    html = html or ""
    last_end = html.rfind(">")
    token = _TOKEN

    def close_run() -> None:
        text = " ".join("".join(run).split())
        if text:
            up = open_.parent()
            tree.add(up, tree.name[up], text=text, linked=min(link[1], len(text)))
        run.clear()
        link[1] = 0

    def put(piece: str) -> None:
        if "&" in piece:
            piece = unescape(piece)
        run.append(piece)
        if link[0]:
            link[1] += len(" ".join(piece.split()))

    at = done = 0
    while True:
        at = html.find("<", at)
        if at < 0 or at > last_end and not html.startswith(("<!--", "<![CDATA["), at):
            if at >= 0 and (comment := html.find("<!--", at)) >= 0:
                put(html[done:comment])
                done = at = comment
                continue
            put(html[done:])
            break
        m = token.match(html, at)
        if not m:
            at += 1
            continue
        if at > done:
            put(html[done:at])
        at = done = m.end()
        if m["odd"]:
            token = _PLAIN_TOKEN
        name = (m["name"] or m["odd"] or "").lower()
        if not name:
            continue
        if m["end"] or m[0].startswith("</"):
            if name == "a":
                link[0] = 0
            if name in INLINE or name in VOID or name in RAW:
                continue
            close_run()
            open_.end(name)
            continue
        if name in RAW:
            if name in FOREIGN and m[0].endswith("/>"):
                continue
            stop = re.compile(rf"</{name}\b[^>]*+>", re.I).search(html, at, last_end + 1)
            at = done = stop.end() if stop else len(html)
            continue
        if name in INLINE:
            if name == "a":
                link[0] = 1
            continue
        close_run()
        if name in VOID or name == "html":
            continue
        open_.end_inside(ENDS.get(name, ("p",)))
        attrs = m["attrs"] or ""
        named = " ".join(a or b or c for a, b, c in _NAMED.findall(attrs)).lower()
        words = frozenset(_WORD_OF[w] for w in _PARTS.findall(named) if w in _WORD_OF)
        if _NAMED_CONTENT in words:
            words -= {_HEADER}
        inside = open_.last("article") or open_.last("main")
        shown = "section" if name == "header" and inside else name
        open_.push(name, tree.add(open_.parent(), shown, words, bool(attrs and _HIDDEN.search(attrs))))
    close_run()
    return _with_text(tree)


def _with_text(tree: Tree) -> Tree:
    """The tree without elements that hold no text."""
    keep = [x is not None for x in tree.text]
    for i in range(len(keep) - 1, 0, -1):
        if keep[i]:
            keep[tree.parent[i]] = True
    keep[0] = True
    at = {-1: -1}
    out = Tree()
    for i, kept in enumerate(keep):
        if kept:
            at[i] = out.add(at[tree.parent[i]], tree.name[i], tree.words[i], tree.hidden[i], tree.text[i], tree.linked[i])
    return out


#: Kinds of parents: roots, plain boxes, boxes named as content or as something else, blocks of text.
_ROOT, _BOX, _CONTENT, _APART, _BLOCK = range(5)
_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption caption summary address".split())
_BOXES = frozenset("nav header footer aside form button".split())
EDGES = 10


def edge_kinds(tree: Tree) -> list[int]:
    """The kind of the edge to each node: by its parent, and whether it is a run of text."""
    own = []
    for name, words, hidden in zip(tree.name, tree.words, tree.hidden):
        if name in ("html", "body"):
            own.append(_ROOT)
        elif hidden or name in _BOXES or words - {_NAMED_CONTENT, _ABOUT}:
            own.append(_APART)
        elif name in ("article", "main") or words:
            own.append(_CONTENT)
        else:
            own.append(_BLOCK if name in _BLOCKS else _BOX)
    return [2 * own[up] + (text is not None) if up >= 0 else 0 for up, text in zip(tree.parent, tree.text)]


def features(tree: Tree) -> np.ndarray:
    """One row per node. Elements and leaves fill the columns of tag and words alike; a leaf has its own besides."""
    out = np.zeros((len(tree.parent), SIZE), dtype=np.float64)
    for i, text in enumerate(tree.text):
        row = out[i]
        if text is None:
            if tree.name[i] in _TAG_OF:
                row[LEAF + _TAG_OF[tree.name[i]]] = 1
            for w in tree.words[i]:
                row[LEAF + len(TAGS) + w] = 1
            row[-4], row[-3] = 1, tree.hidden[i]
            continue
        n = text.count(" ") + 1
        share = tree.linked[i] / len(text)
        row[:LEAF] = (
            1,
            np.log1p(n) / 3,
            share > 0.9,
            share,
            text[-1] in ".!?:;\"'”»…",
            n < 4,
            bool(_RIGHTS.search(text)),
            n < 40 and bool(_COOKIE.search(text)),
        )
        row[-2] = tree.name[i] == "p"
        row[-1] = tree.name[i] in ("h1", "h2", "h3")
    return out
