"""HTML as a tree of blocks, made to stand broken markup.

Nodes are block elements and, below them, runs of text without a block boundary inside. Inline elements are not nodes; links
are remembered for the share of a run's characters inside them. Scripts, styles, comments, drawings and form controls give no text;
formulas are text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*\Z", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead"
    " tr ul caption".split())
RAW = frozenset("script style textarea title iframe noscript template svg select canvas video audio object".split())
#: Without an end these hold the rest of the page; another one without an end is taken as not there, so that nothing after it is lost.
ENDLESS = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("hr br img input meta link base area col embed source track wbr param".split())
#: An opening element ends an open one of these, if no element of the second set stands between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}),
}


@dataclass
class Node:
    tag: str  # "" for a run of text
    parent: int
    attributes: dict[str, str] = field(default_factory=dict)
    text: str = ""
    linked: int = 0  # characters inside links


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(next((v for v in m.groups()[1:] if v is not None), "")) for m in _ATTRIBUTE.finditer(source)}


def parse(source: str) -> list[Node]:
    """Nodes in page order, parents before children; the first is the root."""
    nodes = [Node("html", -1)]
    stack = [0]
    run: list[tuple[str, bool]] = []
    link_depth = 0  # depth of the stack at which a link was opened, 0 outside links

    def flush() -> None:
        if not run:
            return
        parts = [(html.unescape(t), linked) for t, linked in run]
        run.clear()
        text = _SPACE.sub(" ", "".join(t for t, _ in parts)).strip()
        if text:
            linked = sum(len(_SPACE.sub(" ", t).strip()) for t, inside in parts if inside)
            nodes.append(Node("", stack[-1], text=text, linked=linked))

    def close(depth: int) -> None:
        nonlocal link_depth
        flush()
        del stack[depth:]
        if link_depth > len(stack):
            link_depth = 0

    def end_open(tags: set[str] | frozenset[str], barrier: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[depth]].tag
            if tag in tags:
                close(depth)
                return
            if tag in barrier:
                return

    at, size = 0, len(source)
    while at < size:
        found = _TOKEN.search(source, at)
        stop = found.start() if found else size
        if stop > at:
            run.append((source[at:stop], link_depth > 0))
        if not found:
            break
        at = found.end()
        closing, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW and not closing:
            if not rest.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*/?>", re.IGNORECASE).search(source, at)
                at = end.end() if end else size if tag in ENDLESS else at
            run.append((" ", False))
        elif tag == "a":
            link_depth = 0 if closing else len(stack)
        elif tag == "br":
            run.append((" ", False))
        elif tag in ("button", "option") and not closing:
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(source, at)
            at = end.end() if end else at
        elif tag in BLOCKS:
            if closing:
                for depth in range(len(stack) - 1, 0, -1):
                    if nodes[stack[depth]].tag == tag:
                        close(depth)
                        break
                else:
                    flush()
                continue
            flush()
            if tag in ("html", "body"):
                nodes[0].attributes |= attributes(rest)
                continue
            end_open({"p"}, {"td", "th", "table"} if tag != "p" else {"td", "th", "table", "div", "article", "section", "li", "blockquote"})
            if tag in _ENDS:
                end_open(*_ENDS[tag])
            if tag in VOID:
                continue
            nodes.append(Node(tag, stack[-1], attributes(rest) if rest.strip() else {}))
            stack.append(len(nodes) - 1)
    flush()
    return nodes
