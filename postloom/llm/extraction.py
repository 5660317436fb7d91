"""Main text of web pages: a tree-structured graphical model over the blocks of a page.

Every node of the tree (`dom.py`) is content or not. Features of a node (tag, words of class, id and role, length, links,
marks of punctuation, tags above) give its own potential; features of a child give the potential of the pair it forms
with its parent. Messages go from the leaves to the root and back (sum-product, exact on a tree); the two messages
and its own potential make a node's marginal. Runs of text whose marginal is at least a half are the main text.

The weights maximise the likelihood of labelled pages. These are written by `labelled_pages`, a bounded number of pages
in many layouts whose elements carry their label, since the table has no labels. Training is the gradient of that likelihood:
observed features less those expected under the marginals.

Defined results: a null or empty page, or one without content, gives an empty text; broken or cut-off markup is
read as far as it goes; rows that share an id, or repeat, or have none, are each read; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import map_rows
from .dom import Node, parse

PLACES = 1 << 14
TRAINING_PAGES = 260
EPOCHS = 12
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_ABOVE = frozenset("nav aside footer header form article main section table ul ol dl blockquote figure dialog".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Places(dict):
    """Place of a feature's weight."""

    def __missing__(self, name: str) -> int:
        if len(self) > 100_000:
            self.clear()
        place = self[name] = xxhash.xxh32_intdigest(name) % PLACES
        return place


def _words_of(node: Node) -> set[str]:
    named = " ".join(_CAMEL.sub(" ", node.attributes.get(k, "")) for k in ("class", "id", "role", "aria-label", "itemprop"))
    return {w if len(w) < 5 else w.removesuffix("s") for w in _NAME.findall(named.lower())}


def _size(n: int) -> int:
    return n.bit_length()


@dataclass
class Tree:
    parents: list[int]
    features: list[list[int]]  # of the node
    pairs: list[list[int]]  # of the node as a child
    nodes: list[Node]


_GENERIC = ("p", "div", "li", "td", "span", "")


def tree_of(nodes: list[Node], place: Places) -> Tree:
    """Features of all nodes."""
    n = len(nodes)
    chars, linked, stops = [0] * n, [0] * n, [0] * n
    for i, x in enumerate(nodes):
        if not x.tag:
            chars[i], linked[i] = len(x.text), x.linked
            stops[i] = x.text.count(". ") + x.text.count(", ") + (x.text[-1] in ".!?…")
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        chars[p] += chars[i]
        linked[p] += linked[i]
        stops[p] += stops[i]
    above: list[frozenset] = [frozenset()] * n
    named: list[set[str]] = [set()] * n
    outer: list[frozenset] = [frozenset()] * n
    features, pairs, parents = [], [], []
    for i, x in enumerate(nodes):
        p = x.parent
        parents.append(p)
        if p >= 0:
            up = nodes[p]
            above[i] = above[p] | {up.tag} if up.tag in _ABOVE else above[p]
            outer[i] = outer[p] | named[p] if named[p] else outer[p]
        if x.attributes:
            named[i] = _words_of(x)
        share = 10 * linked[i] // chars[i] if chars[i] else 0
        share = 0 if share < 3 else 1 if share < 7 else 2
        tag = x.tag or ("text" if p < 0 else f"text-{nodes[p].tag}")
        size = _size(chars[i])
        f = ["bias", f"tag {tag}", f"size {size}", f"share {share}", f"sized link {min(size, 9)} {share}", f"stops {min(_size(stops[i]), 5)}",
             f"{'run' if not x.tag else 'box'} stops {min(stops[i], 1)} share {share}"]
        f += [f"above {a}" for a in above[i]]
        f += [f"name {w}" for w in named[i]]
        f += [f"outer {w}" for w in outer[i]]
        if "article" in above[i] or "main" in above[i]:
            f.append(f"inside {tag}")
        if not x.tag:
            if "©" in x.text:
                f.append("copyright")
            if nodes[p].tag in _HEADINGS:
                f.append("heading")
        hidden = x.attributes.get("style", "").replace(" ", "").lower()
        if "hidden" in x.attributes or "display:none" in hidden or x.attributes.get("aria-hidden") == "true":
            f.append("hidden")
        g = ["pair", f"pair {x.tag if x.tag not in _GENERIC else 'plain'}", f"pair {'run' if not x.tag else 'box'} of {nodes[p].tag if p >= 0 else ''}"]
        if named[i]:
            g.append("pair named")
        features.append([place[name] for name in f])
        pairs.append([place[name] for name in g])
    return Tree(parents, features, pairs, nodes)


@dataclass
class Weights:
    node: np.ndarray  # per place: score of being content
    pair: np.ndarray  # per place: scores of (parent, child) = 00, 01, 10, 11


def _added(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def propagate(parents: list[int], own: list[float], pair: list[tuple[float, float, float, float]], pairwise: bool = False):
    """Marginals of being content, and if asked for those of (parent, child) pairs."""
    n = len(parents)
    below0, below1 = [0.0] * n, list(own)
    message0, message1 = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):
        e00, e01, e10, e11 = pair[i]
        m0, m1 = _added(e00 + below0[i], e01 + below1[i]), _added(e10 + below0[i], e11 + below1[i])
        message0[i], message1[i] = m0, m1
        p = parents[i]
        below0[p] += m0
        below1[p] += m1
    whole0, whole1 = below0[:], below1[:]
    both: list[tuple[float, ...]] = [(0.0,) * 4]
    for i in range(1, n):
        p = parents[i]
        rest0, rest1 = whole0[p] - message0[i], whole1[p] - message1[i]
        top = max(rest0, rest1)
        rest0, rest1 = rest0 - top, rest1 - top
        e00, e01, e10, e11 = pair[i]
        whole0[i] = below0[i] + _added(rest0 + e00, rest1 + e10)
        whole1[i] = below1[i] + _added(rest0 + e01, rest1 + e11)
        if pairwise:
            joint = (rest0 + e00 + below0[i], rest0 + e01 + below1[i], rest1 + e10 + below0[i], rest1 + e11 + below1[i])
            high = max(joint)
            shares = [math.exp(j - high) for j in joint]
            both.append(tuple(s / sum(shares) for s in shares))
    marginals = [1 / (1 + math.exp(min(max(a - b, -700.0), 700.0))) for a, b in zip(whole0, whole1)]
    return (marginals, both) if pairwise else marginals


def potentials(tree: Tree, node: list[float], pair: list[tuple[float, ...]]) -> tuple[list[float], list[tuple[float, ...]]]:
    own = [sum([node[k] for k in f]) for f in tree.features]
    edges = [tuple(map(sum, zip(*[pair[k] for k in g]))) for g in tree.pairs]
    return own, edges


class Extractor:
    """Weights as lists, for pages one at a time."""

    def __init__(self, weights: Weights):
        self.node = weights.node.tolist()
        self.pair = [tuple(row) for row in weights.pair.tolist()]
        self.places = Places()

    def main_text(self, source: str) -> str:
        nodes = parse(source)
        if len(nodes) < 2:
            return ""
        tree = tree_of(nodes, self.places)
        marginals = propagate(tree.parents, *potentials(tree, self.node, self.pair))
        return "\n\n".join(x.text for x, m in zip(nodes, marginals) if not x.tag and m >= 0.5)


def labels(nodes: list[Node]) -> list[int]:
    """Labels of a labelled page: a run has that of the nearest element with one, an element that of most text below."""
    n = len(nodes)
    given: list[int] = [0] * n
    weight = [[0, 0] for _ in range(n)]
    for i, x in enumerate(nodes):
        given[i] = int(x.attributes["data-y"]) if "data-y" in x.attributes else given[x.parent] if x.parent >= 0 else 0
    for i in range(n - 1, -1, -1):
        if not nodes[i].tag:
            weight[i][given[i]] += len(nodes[i].text)
        if nodes[i].parent >= 0:
            for k in (0, 1):
                weight[nodes[i].parent][k] += weight[i][k]
    return [g if not x.tag or not any(w) else int(w[1] > w[0]) for g, x, w in zip(given, nodes, weight)]


def fit(pages: list[str], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4) -> Weights:
    """Stochastic gradient of the pages' likelihood, with a rate per weight."""
    place = Places()
    trees = [(tree_of(nodes, place), labels(nodes)) for nodes in map(parse, pages)]
    node, pair = np.zeros(PLACES), np.zeros((PLACES, 4))
    node_sum, pair_sum = np.full(PLACES, 1e-3), np.full((PLACES, 4), 1e-3)
    for _ in range(epochs):
        for tree, truth in trees:
            n = len(truth)
            used = sorted({k for f in tree.features for k in f} | {k for g in tree.pairs for k in g})
            own, edges = potentials(tree, dict(zip(used, node[used].tolist())), dict(zip(used, map(tuple, pair[used].tolist()))))
            marginals, both = propagate(tree.parents, own, edges, pairwise=True)
            g_node, g_pair = np.zeros(PLACES), np.zeros((PLACES, 4))
            for i in range(n):
                if abs(truth[i] - marginals[i]) > 1e-4:
                    np.add.at(g_node, tree.features[i], truth[i] - marginals[i])
                if i:
                    gap = -np.array(both[i])
                    gap[2 * truth[tree.parents[i]] + truth[i]] += 1
                    if np.abs(gap).max() > 1e-4:
                        np.add.at(g_pair, tree.pairs[i], gap)
            for w, g, s in ((node, g_node, node_sum), (pair, g_pair, pair_sum)):
                g = g[used] - decay * w[used]
                s[used] += g * g
                w[used] += rate * g / np.sqrt(s[used])
    return Weights(node, pair)


_WORDS = (
    "the of and in to a is that for it with on as are was by be from this an or at der die und das ein zu den mit von ist im le la les de et"
    " en un une du des que est el los las por con para se del al more most such other some any its their which when there these into than")


def labelled_pages(count: int = TRAINING_PAGES, seed: int = 11) -> list[str]:
    """Pages in many layouts; an element with data-y says whether the text in it is main text."""
    r = random.Random(seed)
    common = _WORDS.split()
    syllables = "an er on the re in th ti es or en at ed nd ha ou ea he ch ie ung lich eur tion ment pas ci os as ue co".split()

    def word() -> str:
        return r.choice(common) if r.random() < 0.4 else "".join(r.choice(syllables) for _ in range(r.randint(1, 5)))

    def phrase(low: int, high: int) -> str:
        return " ".join(word() for _ in range(r.randint(low, high)))

    def sentence(low: int = 2, high: int = 22) -> str:
        parts = phrase(low, high)
        if r.random() < 0.3:
            parts += f", {phrase(2, 8)}"
        return parts.capitalize() + r.choice("....!?")

    def paragraph() -> str:
        return " ".join(sentence() for _ in range(r.choice((1, 1, 2, 3, 5, 9))))

    def name(*choices: str) -> str:
        """A class or an id from these words, or nothing at times."""
        if r.random() < 0.08:
            return ""
        word_, kind = r.choice(choices), r.choice(("class", "class", "id"))
        return f' {kind}="{word_}{r.choice(("", "", "-1", "-box", " wrap", "-inner"))}"'

    def links(low: int, high: int) -> str:
        items = [f'<a href="/{word()}">{phrase(1, 3)}</a>' for _ in range(r.randint(low, high))]
        style = r.random()
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if style < 0.6 else r.choice((" | ", " ", " &middot; ")).join(items)

    def wrap(tag: str, inner: str, *names: str, y: int = 0) -> str:
        return f'<{tag} data-y="{y}"{name(*names) if names else ""}>{inner}</{tag}>'

    def menu() -> str:
        return wrap("nav", links(3, 9)) if r.random() < 0.6 else wrap(r.choice(("div", "ul")), links(3, 9), "menu", "nav", "navbar", "navigation", "topmenu")

    def header() -> str:
        inner = r.choice((f"<h1>{phrase(1, 4)}</h1>", f"<div>{phrase(1, 4)}</div>", f"<p>{sentence(2, 8)}</p>", f'<a href="/">{phrase(1, 2)}</a>'))
        inner += links(2, 5) if r.random() < 0.4 else ""
        return wrap("header", inner) if r.random() < 0.6 else wrap("div", inner, "header", "masthead", "site-header", "topbar", "banner", "logo")

    def footer() -> str:
        inner = r.choice(("&copy; ", "Copyright ", "")) + f"{word()}.example &middot; {sentence(1, 12)}"
        inner = inner if r.random() < 0.6 else f"<p>{inner}</p>" + (links(2, 6) if r.random() < 0.5 else "")
        return wrap("footer", inner) if r.random() < 0.7 else wrap("div", inner, "footer", "site-footer", "bottom", "copyright", "legal")

    def advert() -> str:
        inner = r.choice((sentence(2, 18), f"<p>{paragraph()}</p>", f'<a href="/{word()}">{sentence(2, 8)}</a>'))
        return wrap(r.choice(("div", "div", "aside", "section", "p")), inner, "ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "sponsor")

    def sidebar() -> str:
        inner = f"<h3>{phrase(1, 3)}</h3>" + r.choice((links(3, 7), f"<p>{paragraph()}</p>"))
        return wrap("aside", inner) if r.random() < 0.6 else wrap("div", inner, "sidebar", "related", "widget", "side", "recommended", "popular", "trending")

    def notice() -> str:
        inner = f"<p>{sentence()} {sentence()}</p>" if r.random() < 0.6 else sentence()
        inner += f"<button>{word()}</button>" if r.random() < 0.5 else ""
        return wrap(r.choice(("div", "section", "aside", "p", "dialog")), inner, "cookie", "notice", "cookie-consent", "gdpr", "alert", "privacy-notice", "consent", "popup", "modal", "disclaimer", "subscribe", "newsletter", "paywall")

    def form() -> str:
        return wrap("form", f"<label>{phrase(1, 4)}</label><input name=q><p>{sentence(2, 9)}</p><button>{word()}</button>", "search", "login", "signup", "form", "contact")

    def comments() -> str:
        one = lambda: wrap(r.choice(("div", "li", "article")), f"<b>{word()}</b><p>{paragraph()}</p>", "comment", "reply", "comment-body", "response")
        inner = f"<h3>{phrase(1, 2)}</h3>" + "".join(one() for _ in range(r.randint(1, 5)))
        return wrap(r.choice(("div", "section", "ol", "ul")), inner, "comments", "comment-list", "discussion", "responses", "disqus", "replies")

    def share() -> str:
        return wrap("div", links(2, 5), "share", "social", "tags", "breadcrumb", "breadcrumbs", "meta", "pagination", "author-links")

    def body_block() -> str:
        kind = r.random()
        if kind < 0.62:
            inner = paragraph()
            if r.random() < 0.2:
                inner += f' <a href="/{word()}">{phrase(1, 4)}</a> {sentence()}'
            return f"<p>{inner}</p>" if r.random() < 0.85 else f"<p>{inner}"
        if kind < 0.70:
            return f"<p><b>{sentence()}<br>"
        if kind < 0.80:
            level = r.randint(2, 4)
            return f"<h{level}>{phrase(1, 9)}</h{level}>"
        if kind < 0.87:
            return r.choice(("<ul>{}</ul>", "<ol>{}</ol>")).format("".join(f"<li>{sentence(2, 12)}</li>" for _ in range(r.randint(2, 5))))
        if kind < 0.92:
            return f"<blockquote>{r.choice(('{}', '<p>{}</p>')).format(paragraph())}</blockquote>"
        if kind < 0.95:
            return f"<pre>{phrase(3, 20)}</pre>"
        if kind < 0.98:
            return f"<figure><img src=x><figcaption>{sentence()}</figcaption></figure>"
        return "<table>" + "".join(f"<tr><td>{phrase(1, 3)}</td><td>{phrase(1, 3)}</td></tr>" for _ in range(3)) + "</table>"

    def article() -> str:
        blocks = [f"<h1>{sentence(2, 9)}</h1>" if r.random() < 0.85 else ""]
        blocks += [body_block() for _ in range(r.choice((1, 1, 2, 4, 7, 12)))]
        for extra in (advert, share, notice, form, sidebar):
            if r.random() < 0.12:
                blocks.insert(r.randint(1, len(blocks)), extra())
        if r.random() < 0.15:
            blocks.append(comments())
        if r.random() < 0.15 and blocks[0]:
            blocks[0] = f"<header>{blocks[0]}</header>"
        inner = "".join(blocks)
        kind = r.random()
        if kind < 0.45:
            inner = wrap("article", inner, "post", "article", "entry", y=1) if r.random() < 0.4 else wrap("article", inner, y=1)
        elif kind < 0.6:
            inner = f'<main data-y="1">{inner}</main>'
        else:
            inner = f'<{r.choice(("div", "div", "section", "td"))} data-y="1"{name("content", "article", "post", "entry-content", "article-body", "story", "main", "text", "body", "post-content")}>{inner}</div>'
        return f'<main>{inner}</main>' if r.random() < 0.15 else f"<div{name('container', 'wrapper', 'page', 'row', 'layout')}>{inner}</div>" if r.random() < 0.25 else inner

    pages = []
    for k in range(count):
        before = [f() for f in (header, menu, notice, advert, share, form) if r.random() < 0.45]
        after = [f() for f in (comments, sidebar, advert, form, footer, notice, menu) if r.random() < 0.42]
        if k % 4 == 0:
            before, after = [menu(), advert()], [footer()]
        r.shuffle(before)
        ending = "</body></html>" if r.random() < 0.9 else ""
        pages.append(
            f"<!DOCTYPE html><html><head><title>{sentence()}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
            f"<body>{''.join(before)}{article() if r.random() < 0.96 else ''}{''.join(after)}{ending}")
    return pages


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html", training_pages: int = TRAINING_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ship_package(pages.sparkSession)
    weights = fit(labelled_pages(training_pages))

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        extractor = Extractor(weights)
        for row in each:
            text = extractor.main_text(row["html"])
            yield row["page_id"], row["url"], text, len(text)

    chosen = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("html"))
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    return map_rows(chosen, rows, "page_id long, url string, text string, n_chars long", arrow)
