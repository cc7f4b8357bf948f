"""Main text of pages by a graphical model over the tree of elements.

Every block element is a node that is main text or not. A node's potential comes from its tag, its class, id and role names, its words, links
and sentences; an edge's from the kind of the child. Messages are passed up the
tree and down again, which gives each node's exact marginal; blocks whose element has a marginal of one half or more are the text.
Node weights and edge tables are learned together by the likelihood of labelled pages (``labelled_pages``), a bounded number of them, on the driver.

Defined cases: a null page is an empty one; no page text is an empty string; unclosed elements and tags end with the page; a page without an element is plain text, which the
model knows as such and takes whole; repeated rows get a row each; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetide.llm.common import map_text
from codetide.llm.dom import Node, Page, read_page
from codetide.llm.labelled_pages import labelled_pages

CONTAINERS = frozenset("#page html body div section article main aside nav header footer form ul ol table tr td tbody dl figure fieldset dialog".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd figcaption th".split())
EDGE_KINDS = ("named", "container", "paragraph", "other")
#: Strength of the penalty on weights; steps of the fit and their size.
PENALTY, STEPS, RATE = 0.00005, 200, 0.15

_names = re.compile(r"[a-z]+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")


def features(node: Node, of_page: int, alone: bool = False) -> dict[str, float]:
    """Named features of a node; ``of_page`` is the number of words of the page, ``alone`` tells that it has no other node."""
    words, links = node.words, node.link_words
    out = {"bias": 1.0, f"{'tag' if node.names else 'plain'} {node.tag}": 1.0}
    for name in set(_names.findall(_camel.sub(" ", node.names).lower())):
        out[f"name {name}"] = 1.0
    if alone:
        out["alone"] = 1.0
    if words:
        out["words"] = min(1.0, math.log1p(words) / 7)
        out["share"] = words / max(1, of_page)
        out["links"] = links / words
        out["mostly links"] = float(links > 0.6 * words)
        out["sentences"] = min(1.0, 5 * node.sentences / words)
    else:
        out["empty"] = 1.0
    return out


def edge_kind(child: Node) -> str:
    if child.names:
        return "named"
    return "container" if child.tag in CONTAINERS else "paragraph" if child.tag in PARAGRAPHS else "other"


@dataclass(frozen=True)
class TreeModel:
    weights: dict[str, float]
    edges: dict[str, tuple[tuple[float, float], tuple[float, float]]]

    def marginals(self, page: Page) -> list[float]:
        """Probability of each node to be main text: one pass up the tree, one down."""
        nodes, weights = page.nodes, self.weights
        n, total = len(nodes), nodes[0].words
        own, up, tables = [], [(1.0, 1.0)] * n, []
        for node in nodes:
            z = sum(weights.get(k, 0.0) * v for k, v in features(node, total, n == 1).items())
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            own.append([1 - p, p])
            tables.append(self.edges.get(edge_kind(node), ((1.0, 1.0), (1.0, 1.0))))
        gathered = [list(x) for x in own]
        for i in range(n - 1, 0, -1):
            (a, b), ((t00, t01), (t10, t11)) = gathered[i], tables[i]
            m0, m1 = t00 * a + t01 * b, t10 * a + t11 * b
            s = m0 + m1
            up[i] = (m0 / s, m1 / s)
            above = gathered[nodes[i].parent]
            above[0] *= up[i][0]
            above[1] *= up[i][1]
            s = above[0] + above[1]
            above[0], above[1] = above[0] / s, above[1] / s
        belief = [gathered[0]] + [[0.0, 0.0]] * (n - 1)
        for i in range(1, n):
            parent, (u0, u1), ((t00, t01), (t10, t11)) = belief[nodes[i].parent], up[i], tables[i]
            c0, c1 = parent[0] / max(u0, 1e-300), parent[1] / max(u1, 1e-300)  # what the parent knows from elsewhere
            s = c0 + c1
            c0, c1 = c0 / s, c1 / s
            b0, b1 = gathered[i][0] * (c0 * t00 + c1 * t10), gathered[i][1] * (c0 * t01 + c1 * t11)
            s = b0 + b1
            belief[i] = [b0 / s, b1 / s]
        return [b[1] / (b[0] + b[1]) for b in belief]

    def text(self, source: str) -> str:
        page = read_page(source)
        inside = self.marginals(page)
        return " ".join(text for node, text in page.blocks if inside[node] >= 0.5)


def labels_of(page: Page) -> list[int]:
    """1 where more than half of a node's words are main text, by the marks of a labelled page."""
    mark = [0] * len(page.nodes)
    for i, node in enumerate(page.nodes):
        mark[i] = int(node.label) if node.label else mark[node.parent] if i else int(len(page.nodes) == 1)
    main = [node.own_words * m for node, m in zip(page.nodes, mark, strict=True)]
    for i in range(len(page.nodes) - 1, 0, -1):
        main[page.nodes[i].parent] += main[i]
    return [int(2 * main[i] > node.words) if node.words else mark[i] for i, node in enumerate(page.nodes)]


class Forest:
    """All labelled pages as arrays, so that messages of one depth are passed together."""

    def __init__(self, pages: Iterable[str]):
        rows, labels, parents, depths, kinds = [], [], [], [], []
        for source in pages:
            page, first = read_page(source), len(rows)
            labels += labels_of(page)
            for node in page.nodes:
                rows.append(features(node, page.nodes[0].words, len(page.nodes) == 1))
                parents.append(first + node.parent if node.parent >= 0 else -1)
                depths.append(depths[parents[-1]] + 1 if node.parent >= 0 else 0)
                kinds.append(EDGE_KINDS.index(edge_kind(node)))
        self.names = sorted({k for r in rows for k in r})
        column = {k: j for j, k in enumerate(self.names)}
        self.x = np.zeros((len(rows), len(self.names)))
        for i, r in enumerate(rows):
            for k, v in r.items():
                self.x[i, column[k]] = v
        self.y, self.parent, self.kind = np.array(labels), np.array(parents), np.array(kinds)
        depth = np.array(depths)
        self.levels = [np.flatnonzero(depth == d) for d in range(1, depth.max() + 1)]

    def beliefs(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginal of every node, and of every edge with its parent, by sum-product in logarithms."""
        gathered = np.stack([np.zeros(len(self.y)), self.x @ weights], axis=1)
        up = np.zeros_like(gathered)
        for level in reversed(self.levels):
            table = edges[self.kind[level]] + gathered[level][:, None, :]
            up[level] = np.logaddexp(table[:, :, 0], table[:, :, 1])
            np.add.at(gathered, self.parent[level], up[level])
        belief, pairs = gathered, np.zeros((len(self.y), 2, 2))
        belief = belief - np.logaddexp(belief[:, :1], belief[:, 1:])
        for level in self.levels:
            elsewhere = belief[self.parent[level]] - up[level]
            table = elsewhere[:, :, None] + edges[self.kind[level]] + gathered[level][:, None, :]
            table = np.exp(table - table.max(axis=(1, 2), keepdims=True))
            table /= table.sum(axis=(1, 2), keepdims=True)
            pairs[level] = table
            belief[level] = np.log(table.sum(axis=1) + 1e-300)
        return np.exp(belief[:, 1]), pairs


def train(pages: Iterable[str]) -> TreeModel:
    """Weights and edge tables of greatest penalised likelihood; the expected counts of each step come from sum-product."""
    forest = Forest(pages)
    n, linked = len(forest.y), forest.parent >= 0
    agreed = np.zeros((n, 2, 2))
    agreed[np.flatnonzero(linked), forest.y[forest.parent[linked]], forest.y[linked]] = 1
    sizes = (len(forest.names), 4 * len(EDGE_KINDS))
    value, mean, spread = np.zeros(sum(sizes)), np.zeros(sum(sizes)), np.zeros(sum(sizes))
    for step in range(1, STEPS + 1):  # Adam
        edges = value[sizes[0] :].reshape(-1, 2, 2)
        inside, pairs = forest.beliefs(value[: sizes[0]], edges)
        by_edge = np.zeros_like(edges)
        np.add.at(by_edge, forest.kind[linked], (pairs - agreed)[linked])
        slope = np.concatenate([forest.x.T @ (inside - forest.y), by_edge.ravel()]) / n + PENALTY * value
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope**2
        value = value - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    tables = np.exp(value[sizes[0] :].reshape(-1, 2, 2))
    weights = {k: float(v) for k, v in zip(forest.names, value[: sizes[0]], strict=True)}
    return TreeModel(weights, {k: tuple(tuple(float(v) for v in row) for row in t) for k, t in zip(EDGE_KINDS, tables, strict=True)})


_trained: list[TreeModel] = []


def default_model() -> TreeModel:
    if not _trained:
        _trained.append(train(labelled_pages()))
    return _trained[0]


def extract_text(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = model or default_model()

    def run(rows: list[dict]) -> Iterator[dict]:
        for r in rows:
            text = model.text(r["html"])
            yield {"page_id": r["page_id"], "url": r["url"], "text": text, "n_chars": len(text)}

    kept = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return map_text(kept, run, "page_id long, url string, text string, n_chars long")
