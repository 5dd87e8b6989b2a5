"""Main text of web pages by a tree-structured graphical model over DOM nodes."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglark.llm.common import stage, with_package
from loglark.llm.page_tree import EDGES, SIZE, Tree, edge_kinds, features, parse

#: Labelled pages learned from: of the table, at most, and composed ones.
TRAIN_PAGES, COMPOSED = 200, 300
#: Longer pages are not learned from, which bounds what the driver holds.
TRAIN_CHARS = 200_000
EPOCHS, RATE, DECAY = 150, 0.05, 1e-3
#: Pages of one batch whose trees are inferred together.
TOGETHER = 256

#: Parts of a page that are no main text, by element name and by kind of word.
APART = frozenset("nav header footer aside form button".split())
APART_WORDS = frozenset(range(9))


class Forest:
    """Trees of several pages in one set of arrays, ordered by depth for messages."""

    def __init__(self, trees: list[Tree]) -> None:
        sizes = [len(t.parent) for t in trees]
        starts = np.cumsum([0, *sizes])
        self.starts = starts
        self.x = np.concatenate([features(t) for t in trees])
        self.parent = np.concatenate([np.array(t.parent) + s * (np.array(t.parent) >= 0) for t, s in zip(trees, starts)])
        depth = np.concatenate([t.depth for t in trees])
        self.kind = np.concatenate([edge_kinds(t) for t in trees]).astype(np.int64)
        self.levels = [np.flatnonzero(depth == d) for d in range(1, int(depth.max()) + 1)]


class Model:
    """Log-potentials: of a node's label by its features, of (parent, child) labels by the kind of edge."""

    def __init__(self) -> None:
        self.node = np.zeros(SIZE)
        self.edge = np.zeros((EDGES, 2, 2))

    def beliefs(self, f: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all nodes, and of the label pairs of all edges (roots get zeros).

        Messages go up level by level, each the sum over the child's labels of what its
        subtree says, then down, each what the rest of the tree says.
        """
        n = len(f.parent)
        inside, message, outside = np.zeros((n, 2)), np.zeros((n, 2)), np.zeros((n, 2))
        inside[:, 1] = f.x @ self.node
        for level in reversed(f.levels):
            message[level] = np.logaddexp.reduce(inside[level][:, None, :] + self.edge[f.kind[level]], axis=2)
            np.add.at(inside, f.parent[level], message[level])
        pairs = np.zeros((n, 2, 2))
        for level in f.levels:
            up = f.parent[level]
            rest = inside[up] - message[level] + outside[up]
            both = rest[:, :, None] + self.edge[f.kind[level]]
            outside[level] = np.logaddexp.reduce(both, axis=1)
            both = both + inside[level][:, None, :]
            pairs[level] = np.exp(both - np.logaddexp.reduce(both, axis=(1, 2), keepdims=True))
        total = inside + outside
        return np.exp(total - np.logaddexp.reduce(total, axis=1, keepdims=True))[:, 1], pairs

    def train(self, f: Forest, labels: np.ndarray) -> None:
        """Ascent on the likelihood of the labels: seen minus expected features, with Adam steps."""
        gold = labels.astype(int)
        child = np.flatnonzero(f.parent >= 0)
        seen = np.zeros_like(self.edge)
        np.add.at(seen, (f.kind[child], gold[f.parent[child]], gold[child]), 1)
        state = [[np.zeros_like(w) for w in (self.node, self.edge)] for _ in range(2)]
        for t in range(1, EPOCHS + 1):
            p, pairs = self.beliefs(f)
            expected = np.zeros_like(self.edge)
            np.add.at(expected, f.kind[child], pairs[child])
            grads = (f.x.T @ (labels - p) / len(labels), (seen - expected) / len(labels))
            for k, (name, g) in enumerate(zip(("node", "edge"), grads)):
                weight, m, v = getattr(self, name), state[0][k], state[1][k]
                g = g - DECAY * weight
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                setattr(self, name, weight + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8))


def labels_of(tree: Tree, shown: set[int] | None = None) -> np.ndarray | None:
    """Content labels from markup: text inside ``article`` or ``main`` but in no part that stands apart.

    ``shown`` gives the leaves directly instead. An element is content if most of its text
    is. None where the page says nothing.
    """
    n = len(tree.parent)
    if shown is None:
        if not any(x in ("article", "main") for x in tree.name):
            return None
        inside, apart, shown = [False] * n, [False] * n, set()
        for i, up in enumerate(tree.parent):
            leaf = tree.text[i] is not None
            inside[i] = (up >= 0 and inside[up]) or (not leaf and tree.name[i] in ("article", "main"))
            apart[i] = (up >= 0 and apart[up]) or (
                not leaf and (tree.name[i] in APART or tree.hidden[i] or bool(tree.words[i] & APART_WORDS))
            )
            if leaf and inside[i] and not apart[i]:
                shown.add(i)
    good, size = np.zeros(n), np.zeros(n)
    for i in range(n - 1, -1, -1):
        if tree.text[i] is not None:
            size[i] = len(tree.text[i])
            good[i] = size[i] * (i in shown)
        if tree.parent[i] >= 0:
            size[tree.parent[i]] += size[i]
            good[tree.parent[i]] += good[i]
    return (good * 2 > size).astype(float)


def composed(rng: random.Random) -> tuple[str, str]:
    """A page of random words in a random layout, and its main text."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    links = lambda n: "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(n))
    text: list[str] = []

    def say(a: int, b: int, end: str = ".") -> str:
        text.append(words(a, b).capitalize() + end)
        return text[-1]

    def box(tag: str, names: list[str], inner: str) -> str:
        plain = rng.random() < 0.3 and tag != "div"
        return f"<{tag}>{inner}</{tag}>" if plain else f'<{tag} {rng.choice(("class", "id"))}="{rng.choice(names)}">{inner}</{tag}>'

    def blocks() -> str:
        out, top = [], rng.random()
        if top < 0.5:
            out.append(f"<h1>{say(3, 9, '')}</h1>")
        elif top < 0.8:
            name = rng.choice(("", ' class="entry-header"', ' class="post-header"'))
            inner = f"<h1>{say(3, 9, '')}</h1>"
            if rng.random() < 0.6:
                inner += f'<p class="{rng.choice(("byline", "author", "meta"))}">{say(2, 6, rng.choice(("", ".")))}</p>'
            out.append(f"<header{name}>{inner}</header>" if rng.random() < 0.7 else f'<div class="entry-header">{inner}</div>')
        for _ in range(rng.randint(1, 10)):
            kind = rng.random()
            if kind < 0.65:
                out.append(f"<p>{say(1, 80)}</p>")
            elif kind < 0.75:
                out.append(f"<h2>{say(2, 6, '')}</h2><p>{say(8, 60)}</p>")
            elif kind < 0.85:
                out.append("<ul>" + "".join(f"<li>{say(3, 14)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif kind < 0.88:
                name = rng.choice(("author-note", "tags", "read-more", "byline", "post-meta"))
                out.append(f'<div class="{name}"><p>{say(3, 40)}</p></div>')
            elif kind < 0.92:
                out.append(f"<blockquote><p>{say(6, 30)}</p></blockquote>")
            else:
                out.append(f"<p>{say(20, 60)}<br>{say(4, 20)}")
            if rng.random() < 0.08:
                out.append(box("div", ["ad", "ads", "advert", "sponsored"], words(2, 12)))
        return "".join(out)

    head = [
        lambda: box(rng.choice(("nav", "div")), ["nav", "menu", "navbar", "breadcrumb"], f"<ul>{links(rng.randint(2, 8))}</ul>"),
        lambda: box(rng.choice(("header", "div")), ["header", "masthead", "topbar"], f"<h2>{words(1, 3)}</h2><p>{words(2, 9)}</p>"),
        lambda: box("div", ["ad", "ads", "advert", "banner", "promo"], words(3, 20) + "."),
        lambda: box("div", ["cookie", "consent", "notice", "newsletter", "popup"], f"<p>{words(6, 25)}.</p><button>ok</button>"),
        lambda: box("form", ["search", "login", "form"], f"<label>{words(1, 3)}</label><input><button>{word()}</button>"),
    ]
    tail = [
        lambda: box(rng.choice(("aside", "div")), ["sidebar", "related", "widget", "popular"], f"<h3>{words(1, 3)}</h3><ul>{links(4)}</ul><p>{words(4, 20)}.</p>"),
        lambda: box(rng.choice(("section", "div")), ["comments", "comment", "replies"], "".join(f"<div class=\"comment\"><p>{words(3, 40)}.</p></div>" for _ in range(rng.randint(1, 4)))),
        lambda: box("form", ["subscribe", "contact", "form"], f"<p>{words(3, 12)}.</p><input>"),
        lambda: box("div", ["share", "social"], f"<ul>{links(3)}</ul>"),
        lambda: f"<footer>&copy; {word()}.example &middot; {words(2, 12)}.</footer>",
        lambda: box("div", ["footer", "copyright"], f"<p>{words(3, 14)}. All rights reserved.</p>"),
    ]
    before = "".join(part() for part in rng.sample(head, rng.randint(1, 4)))
    body = blocks()
    kind = rng.random()
    if kind < 0.45:
        body = f"<article>{body}</article>"
    elif kind < 0.6:
        body = f"<main>{body}</main>"
    elif kind < 0.95:
        body = f'<div {rng.choice(("class", "id"))}="{rng.choice(("content", "post", "entry", "story", "main", "article-body"))}">{body}</div>'
    if rng.random() < 0.3:
        body = f'<div class="{rng.choice(("wrap", "container", "row"))}">{body}</div>'
    after = "".join(part() for part in rng.sample(tail, rng.randint(1, 4)))
    return f"<html><head><title>{words(2, 6)}</title></head><body>{before}{body}{after}</body></html>", " ".join(text)


def train(pages: list[str], seed: int = 5) -> Model:
    """A model from pages whose markup shows their main text, and from composed pages."""
    rng, trees, labels = random.Random(seed), [], []
    for html in pages:
        tree = parse(html)
        known = labels_of(tree)
        if known is not None:
            trees.append(tree)
            labels.append(known)
    for _ in range(COMPOSED):
        html, text = composed(rng)
        tree, left = parse(html), text
        shown = set()
        for i, piece in enumerate(tree.text):
            if piece is not None and left.startswith(piece):
                shown.add(i)
                left = left[len(piece) :].lstrip()
        trees.append(tree)
        labels.append(labels_of(tree, shown))
    model = Model()
    model.train(Forest(trees), np.concatenate(labels))
    return model


def extract(model: Model, pages: list[str | None]) -> list[str]:
    """Main text of each page: its runs of text that are content with probability 1/2 or more."""
    out: list[str] = []
    for start in range(0, len(pages), TOGETHER):
        trees = [parse(p) for p in pages[start : start + TOGETHER]]
        forest = Forest(trees)
        p, _ = model.beliefs(forest)
        for tree, at in zip(trees, forest.starts):
            out.append(" ".join(t for i, t in enumerate(tree.text) if t is not None and p[at + i] >= 0.5))
    return out


def _extracted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = extract(model, batch.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return run


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", train_pages: int = TRAIN_PAGES
) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Every run of text between block tags is a node, below the elements that hold it; the
    model gives each the probability that it is main text, and those from 1/2 are joined in
    page order by one space. References are decoded, white space inside a run is one space.
    It learns from composed pages and from the ``train_pages`` pages with ``article`` or
    ``main``, of at most TRAIN_CHARS characters, whose ids hash smallest. A page of any length and
    depth is read whole. An empty table gives an empty result. A null or empty page, or one without main text, has the
    empty text; repeated rows and null ids are rows like others; other columns are not read.
    """
    slim = with_package(pages).select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")
    )
    marked = slim.where((F.length("html") <= TRAIN_CHARS) & F.col("html").rlike("(?i)<(article|main)[ >]"))
    chosen = marked.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(train_pages).distinct()
    sample = marked.join(F.broadcast(stage(chosen, "page-sample")), "page_id").orderBy(F.xxhash64("html")).limit(train_pages)
    model = train([r.html for r in sample.select("html").collect()])
    return slim.mapInArrow(_extracted(model), "page_id long, url string, text string").withColumn(
        "n_chars", F.length("text").cast("long")
    )
