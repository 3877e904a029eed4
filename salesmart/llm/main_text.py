"""Main text of web pages by a tree-structured graphical model.

Every block element and every stretch of text of a page is a node with a hidden label: content or
not.  A node's potential comes from its features - element name, words in class, id and role, and
for text its length, links and punctuation; an edge potential ties each child to its parent.
Sum-product messages, first from the leaves upward and then back down, give each node's exact
marginal; text whose marginal is content is kept.

The weights are those of greatest likelihood on labelled pages: gradient ascent, with marginals
from the same messages.  The labelled pages are made by rule from layouts of articles and of what
surrounds them (`labelled_pages`); their number is a parameter, and pages of one's own can be given.

Cases: null and empty pages have an empty text; a page cut short is read as far as it goes; very
long pages take time in proportion; repeated rows give repeated rows, an empty table an empty one.
"""

from __future__ import annotations

import functools
import math
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm.common import pieces, schema_with, with_columns
from salesmart.llm.dom import Tree, attributes_of, parse

#: Labelled pages that the weights are fitted on.
TRAINING_PAGES = 200
ROUNDS = 40

# What words in class, id and role say about an element.
_WORDS = {
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner adsense dfp affiliate",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs skip toolbar links",
    "head": "header masthead topbar top logo branding site",
    "foot": "footer foot bottom copyright legal colophon imprint",
    "side": "sidebar side aside rail widget widgets complementary related recommended recommendations popular trending more",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog paywall subscribe newsletter signup banner warning",
    "comment": "comment comments disqus reply replies respond discussion reviews feedback",
    "share": "share sharing social follow facebook twitter tags meta byline author bio",
    "form": "form search searchform login register contact input",
    "content": "article content post entry story body text main page blog news prose hentry articlebody copy",
    "part": "title headline heading lead summary intro paragraph section chapter caption quote figure",
}
_SAYS: dict[str, set[str]] = {}
for _kind, _list in _WORDS.items():
    for _word in _list.split():
        _SAYS.setdefault(_word, set()).add(_kind)
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# Element names with a feature of their own.
_NAMES = (
    "nav header footer aside article main section form button fieldset menu dialog ul ol li dl dd dt table tr td th div p "
    "h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption details summary address body html hr input #text"
).split()

FEATURES = (
    ["any", "leaf", "hidden", "other element"]
    + [f"<{n}>" for n in _NAMES]
    + [f"says {k}" for k in _WORDS]
    + [f"links {i}" for i in range(4)]
    + [f"length {i}" for i in range(6)]
    + ["sentence", "mark of rights"]
    + [f"in <{n}>" for n in _NAMES]
)
_AT = {name: i for i, name in enumerate(FEATURES)}


class Weights(NamedTuple):
    node: list[float]  # by feature, in favour of content
    edge: list[list[float]]  # for elements and for text: of (parent, child) 00, 01, 10, 11


@functools.lru_cache(maxsize=4096)
def _element_features(tag: str, attributes: str) -> tuple[int, ...]:
    found = {"any", f"<{tag}>" if tag in _NAMES else "other element"}
    if attributes:
        values = attributes_of(_CAMEL.sub("-", attributes))
        words = _SPLIT.split(" ".join(values.get(k, "") for k in ("class", "id", "role", "itemprop", "aria-label")))
        found |= {f"says {kind}" for w in words for kind in _SAYS.get(w, ())}
        if "hidden" in values or "display:none" in values.get("style", "").replace(" ", ""):
            found.add("hidden")
    return tuple(_AT[f] for f in found)


def _leaf_features(text: str, linked: float, above: str) -> list[int]:
    found = [_AT["any"], _AT["leaf"], _AT["<#text>"], _AT[f"links {min(3, int(linked * 3.999))}"]]
    found.append(_AT[f"length {min(5, int(math.log2(1 + len(text)) / 2))}"])
    if text[-1] in ".!?…:;\"'”»)":
        found.append(_AT["sentence"])
    if "©" in text or "All rights reserved" in text:
        found.append(_AT["mark of rights"])
    if above in _NAMES:
        found.append(_AT[f"in <{above}>"])
    return found


def features(tree: Tree) -> list[tuple[int, ...] | list[int]]:
    """The features of each node that are present."""
    out: list = [(_AT["any"],)]
    for i in range(1, len(tree.tag)):
        text = tree.text[i]
        if text is None:
            out.append(_element_features(tree.tag[i], tree.attributes[i]))
        else:
            out.append(_leaf_features(text, tree.linked[i], tree.tag[tree.parent[i]]))
    return out


def _through(odds: float, w00: float, w01: float, w10: float, w11: float) -> float:
    """Log odds of a neighbour's label from this node's log odds (the second index is this node's)."""
    if odds > 500:
        return w11 - w01
    e = math.exp(odds)
    a, b = math.exp(w10), math.exp(w00)
    return math.log((math.exp(w11) * e + a) / (math.exp(w01) * e + b))


def marginals(parent: list[int], leaf: list[bool], score: list[float], edge: list[list[float]]) -> tuple[list[float], list]:
    """Log odds of every node's label given the whole tree, and for each node (child) the log odds
    of its own part and of its parent without it, from which edge marginals follow."""
    n = len(parent)
    up, message = list(score), [0.0] * n
    for i in range(n - 1, 0, -1):
        w = edge[leaf[i]]
        message[i] = _through(up[i], w[0], w[1], w[2], w[3])
        up[parent[i]] += message[i]
    full, pairs = list(up), [(0.0, 0.0)] * n
    for i in range(1, n):
        w, above = edge[leaf[i]], full[parent[i]] - message[i]
        full[i] = up[i] + _through(above, w[0], w[2], w[1], w[3])
        pairs[i] = (up[i], above)
    return full, pairs


def _scores(found: list, node: list[float]) -> list[float]:
    return [sum([node[f] for f in own]) for own in found]


def content(tree: Tree, weights: Weights) -> list[bool]:
    """Which nodes are content."""
    full, _ = marginals(tree.parent, [t is not None for t in tree.text], _scores(features(tree), weights.node), weights.edge)
    return [odds >= 0 for odds in full]


def extract(page: str | None, weights: Weights) -> str:
    """Blocks of main text in page order."""
    if not page:
        return ""
    tree = parse(page)
    kept = content(tree, weights)
    return "\n\n".join(t for t, keep in zip(tree.text, kept, strict=True) if keep and t is not None)


# --- training --------------------------------------------------------------------------------

#: What marks a text of a labelled page as content; it is no feature.
MARK = "\x01"
# Layouts of the labelled pages.
_ARTICLES = (
    "<article>{}</article>|<main>{}</main>|<main><article>{}</article></main>|<div class='content'>{}</div>|"
    "<div id='main-content'><div class='post'>{}</div></div>|<section class='entry-content'>{}</section>|{}|"
    "<div class='wrapper'><div class='story-body'>{}</div></div>|<div id='page'><article class='hentry'>{}</article></div>|"
    "<div>{}</div>|<div class='container'><div class='row'><article>{}</article></div></div>|<section><div>{}</div></section>|"
    "<article><header>{}</header></article>|<article><section>{}</section></article>"
).split("|")
_AROUND = (
    "<nav><ul>{l}</ul></nav>|<nav>{a}</nav>|<header><h1>{s}</h1>{a}</header>|<header class='site-header'><p>{t}</p></header>|"
    "<div class='header'>{s}</div>|<div id='menu'><ul>{l}</ul></div>|<ul class='navigation'>{l}</ul>|<div class='breadcrumbs'>{a}</div>|"
    "<div class='ad'>{t}</div>|<div class='advert banner'><p>{t}</p></div>|<div id='ads'>{s}</div>|<div class='sponsored'>{t}{a}</div>|"
    "<aside>{t}</aside>|<aside><h3>{s}</h3><ul>{l}</ul></aside>|<div class='sidebar'><h2>{s}</h2><p>{t}</p><ul>{l}</ul></div>|"
    "<div id='sidebar'><div class='widget'>{t}</div></div>|<div class='related-posts'><ul>{l}</ul></div>|"
    "<div class='cookie-notice'><p>{t}</p><button>{s}</button></div>|<div id='cookie-consent'>{t}</div>|"
    "<div role='dialog' class='popup'>{t}</div>|<div class='newsletter-signup'><p>{t}</p></div>|<div class='notice'>{t}</div>|"
    "<form>{s}<label>{s}</label><input><button>{s}</button></form>|<form class='search'><p>{t}</p></form>|"
    "<section class='comments'><h2>{s}</h2><div class='comment'><p>{t}</p></div><div><p>{t}</p></div></section>|"
    "<div id='comments'><p>{t}</p><p>{t}</p><p>{t}</p></div>|<ol class='comment-list'><li><p>{t}</p></li><li>{t}</li></ol>|"
    "<div class='share'>{a}</div>|<footer>© {s}</footer>|<footer><p>{t}</p>{a}</footer>|<div class='footer'><p>© {t}</p></div>|"
    "<div id='footer'>{a}{s}</div>|<footer><ul>{l}</ul><p>{t}</p></footer>|<div hidden>{t}</div>|<div role='navigation'>{a}</div>|"
    "<div class='alert'><p>{t}</p></div>|<section class='reader-comments'><article><p>{t}</p></article></section>|"
    "<p class='copyright'>© {s}</p>|<div class='promo'><h3>{s}</h3><p>{t}</p></div>|<menu>{l}</menu>"
).split("|")
_INSIDE = (
    "<h1>{s}</h1>|<h2>{s}</h2>|<h3>{t}</h3>|<p>{t}</p>|<p>{t}</p>|<p>{t}</p>|<p><b>{t}</b></p>|<p>{s}</p>|<p>{w}</p>|<p>{w}</p>|"
    "<ul><li>{s}</li><li>{t}</li></ul>|<ol><li>{t}</li><li>{w}</li></ol>|<blockquote><p>{t}</p></blockquote>|<pre>{s}</pre>|"
    "<p>{t} {a}</p>|<p>{a} {s}</p>|<p>{a}</p>|<table><tr><td>{s}</td><td>{w}</td></tr></table>|<div>{t}</div>|<div><p>{t}</p></div>|"
    "<figure><figcaption>{s}</figcaption></figure>|<section><h2>{s}</h2><p>{t}</p></section>|{t}|<dl><dt>{w}</dt><dd>{t}</dd></dl>|"
    "<h4>{w}</h4>|<h5>{s}</h5>|<p class='lead'>{t}</p>|<p>{t}</p>|<p>{t}</p>|<h1 class='title'>{s}</h1>"
).split("|")


def labelled_pages(count: int = TRAINING_PAGES, seed: int = 7) -> list[str]:
    """Pages whose content texts begin with MARK."""
    draw = random.Random(seed)

    def words(low: int, high: int) -> str:
        made = ["".join(draw.choice("aeioulnrst") for _ in range(draw.randint(1, 9))) for _ in range(draw.randint(low, high))]
        return " ".join(made).capitalize()

    def filled(layout: str, mark: str) -> str:
        def text(low: int, high: int, end: str) -> str:
            return mark + words(low, high) + end

        sentence = lambda: text(5, 60, draw.choice([".", ".", ".", "!", "?", ""]))
        link = lambda: f"<a href='/x'>{text(1, 4, '')}</a>"
        return layout.format(
            t=sentence(), s=text(1, 7, draw.choice(["", "."])), w=text(1, 2, draw.choice(["", "."])),
            a=" ".join(link() for _ in range(draw.randint(1, 4))),
            l="".join(f"<li>{link()}</li>" for _ in range(draw.randint(2, 8))),
        )

    def surroundings(most: int) -> str:
        return "".join(filled(draw.choice(_AROUND), "") for _ in range(draw.randint(0, most)))

    pages = []
    for _ in range(count):
        blocks = [filled(draw.choice(_INSIDE), MARK) for _ in range(draw.randint(1, 14))]
        if draw.random() < 0.4:
            blocks.insert(draw.randint(0, len(blocks)), filled(draw.choice(_AROUND[8:28]), ""))
        article = draw.choice(_ARTICLES).format("".join(blocks))
        pages.append(f"<html><body>{surroundings(4)}{article}{surroundings(4)}</body></html>")
    return pages


def _labels(tree: Tree) -> list[bool]:
    """Marked texts are content, and so are the elements around them; marks are taken off."""
    labels = [t is not None and MARK in t for t in tree.text]
    for i in range(len(labels) - 1, 0, -1):
        if labels[i]:
            labels[tree.parent[i]] = True
    tree.text = [t if t is None else t.replace(MARK, "") for t in tree.text]
    return labels


def fit(pages: list[str], rounds: int = ROUNDS, rate: float = 0.5, decay: float = 0.02) -> Weights:
    """Weights of greatest likelihood, with a penalty on their squares."""
    examples = []
    for page in pages:
        tree = parse(page)
        labels = _labels(tree)
        examples.append((tree.parent, [t is not None for t in tree.text], features(tree), labels))
    node, edge = np.zeros(len(FEATURES)), np.zeros((2, 4))
    seen_node, seen_edge = np.full(len(FEATURES), 1e-6), np.full((2, 4), 1e-6)
    for _ in range(rounds):
        node_slope, edge_slope = -decay * len(pages) * node, -decay * len(pages) * edge
        weights, edges = node.tolist(), edge.tolist()
        for parent, leaf, found, labels in examples:
            full, pairs = marginals(parent, leaf, _scores(found, weights), edges)
            for i, own in enumerate(found):
                miss = labels[i] - 1 / (1 + math.exp(-max(-500.0, min(500.0, full[i]))))
                for f in own:
                    node_slope[f] += miss
                if i:
                    mine, above = pairs[i]
                    w = edges[leaf[i]]
                    logs = np.array([w[0], w[1] + mine, w[2] + above, w[3] + mine + above])
                    p = np.exp(logs - logs.max())
                    edge_slope[int(leaf[i])] -= p / p.sum()
                    edge_slope[int(leaf[i]), 2 * labels[parent[i]] + labels[i]] += 1
        # each weight moves at its own rate, by the slopes it has seen
        seen_node += node_slope**2
        seen_edge += edge_slope**2
        node += rate * node_slope / np.sqrt(seen_node)
        edge += rate * edge_slope / np.sqrt(seen_edge)
    return Weights(node.tolist(), edge.tolist())


@functools.lru_cache(maxsize=1)
def default_weights() -> Weights:
    return fit(labelled_pages())


def main_text(frame: DataFrame, html: str = "html", weights: Weights | None = None) -> DataFrame:
    """The frame without its pages, with their main text and its number of code points."""
    weights = weights or default_weights()
    kept = [c for c in frame.columns if c not in (html, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, html):
                out = [extract(p, weights) for p in piece.column(html).to_pylist()]
                columns = {"text": pa.array(out, pa.string()), "n_chars": pa.array(map(len, out), pa.int64())}
                yield with_columns(piece.select(kept), columns)

    return frame.mapInArrow(run, schema_with(frame, kept, {"text": "string", "n_chars": "bigint"}))
