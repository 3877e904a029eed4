"""A small HTML reader: the tree of block elements of a page, with its text in blocks.

Inline elements leave no node; a stretch of text between block boundaries is a leaf.  Contents of
scripts, styles and the like are skipped, end tags may be missing, and a page may stop anywhere.  A
skipped element without an end tag ends with the element around it; only raw text, such as a script's,
runs to its end tag wherever that is.  Time is in proportion to the page: what is open is known by name,
so that no tag walks past elements that stay open.
"""

from __future__ import annotations

import html
import re

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|</?([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)>?", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

# Groups of element names.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("script style title noscript template svg math iframe object textarea canvas audio video select".split())
_RAW = set("script style title textarea iframe noscript".split())
_DRAWN = ("svg", "math")  # a block element ends these
_ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
# An element closes an open one of these names, up to one of the others.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


class Tree:
    """Nodes in page order, parents before children.  A leaf has a text and the part of it in links."""

    def __init__(self) -> None:
        self.tag: list[str] = [""]
        self.attributes: list[str] = [""]
        self.parent: list[int] = [-1]
        self.text: list[str | None] = [None]
        self.linked: list[float] = [0.0]

    def add(self, tag: str, attributes: str, parent: int, text: str | None = None, linked: float = 0.0) -> int:
        self.tag.append(tag)
        self.attributes.append(attributes)
        self.parent.append(parent)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.tag) - 1


class _Open:
    """The open elements, and where those of each name stand among them."""

    def __init__(self) -> None:
        self.names: list[str] = [""]
        self.nodes: list[int] = [0]
        self.at: dict[str, list[int]] = {}
        self.muted = 0  # open skipped elements

    def push(self, name: str, node: int) -> None:
        self.at.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.nodes.append(node)
        self.muted += name in SKIPPED

    def close(self, depth: int) -> None:
        """Close all elements from this depth on."""
        while len(self.names) > depth:
            name = self.names.pop()
            self.nodes.pop()
            self.at[name].pop()
            self.muted -= name in SKIPPED

    def last(self, names) -> int:
        """The depth of the innermost open element of these names; 0 for none."""
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=0)

    def close_within(self, closed, until) -> None:
        """Close the innermost of the first names, unless one of the others is open within it."""
        depth = self.last(closed)
        if depth > self.last(until):
            self.close(depth)


def parse(page: str) -> Tree:
    """The tree of a page; node 0 stands above all."""
    tree, still = Tree(), _Open()
    run: list[str] = []
    in_links = links = 0  # characters in links; open links

    def flush() -> None:
        nonlocal in_links
        if run:
            text = " ".join("".join(run).split())
            if text:
                tree.add("#text", "", still.nodes[-1], text, min(1.0, in_links / len(text)))
            run.clear()
        in_links = 0

    def take(text: str) -> None:
        nonlocal in_links
        if still.muted:
            return
        text = html.unescape(text) if "&" in text else text
        run.append(text)
        if links:
            in_links += len(text.strip())

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            take(page[at:])
            break
        if m.start() > at:
            take(page[at : m.start()])
        at = m.end()
        name = m[1]
        if name is None:
            continue
        name = name.lower()
        if page[m.start() + 1] == "/":
            if name == "a":
                links = max(0, links - 1)
            elif name == "br":
                take(" ")
            elif name not in INLINE:
                depth = still.last((name,))
                flush()
                if depth:
                    still.close(depth)
                    links = 0
            continue
        attributes = m[2]
        if name in _RAW:
            flush()
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in INLINE:
            if name == "a" and not still.muted:
                links += 1
            elif name == "br":
                take(" ")
            continue
        if name == "head":
            continue
        flush()
        if name in _ENDS_P:
            if still.muted:
                still.close_within(_DRAWN, ())
            still.close_within(("p",), ("table", "td", "th", "button"))
        if name in _CLOSES:
            still.close_within(*_CLOSES[name])
        links = 0
        node = still.nodes[-1] if still.muted or name in SKIPPED else tree.add(name, attributes, still.nodes[-1])
        if name not in VOID and not attributes.endswith("/"):
            still.push(name, node)
    flush()
    return tree


def attributes_of(text: str) -> dict[str, str]:
    """Attribute values by name, in lower case."""
    return {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(text)}
