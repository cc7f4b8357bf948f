"""Growth of one tree over binned features, in memory: whole below a node of few rows; of the top, what rows and the driver need to know.

Only arrays here, so that the workers of tasks import little.
"""

from __future__ import annotations

from itertools import accumulate
from math import ceil, exp, factorial, sqrt

import numpy as np
import pandas as pd

#: Bins of a feature at most.
BINS = 32
#: Least decrease of the impurity; less is rounding.
LEAST_GAIN = 1e-12

#: Cumulative Poisson probabilities of mean 1.
POISSON = np.cumsum([exp(-1.0) / factorial(k) for k in range(16)])


def draws(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Copies of each row in a tree; a row and a tree have the same in every run of a task."""
    mix = np.uint64((seed * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD1342543DE82EF95) % (1 << 64))
    z = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return np.searchsorted(POISSON, (z >> np.uint64(11)) * 2.0**-53, side="right").astype(np.uint8)


def tried_features(rng: np.random.Generator, nodes: int, width: int) -> np.ndarray:
    """Features that each node tries, drawn without repeats."""
    return np.argsort(rng.random((nodes, width)), axis=1)[:, : ceil(sqrt(width))]


def best_splits(left: np.ndarray, total: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Best last bin on the left and its gain, from the counts by class, node and bin up to and with a bin."""
    right = total[:, :, None] - left
    valid = (left[0] + left[1] >= least) & (right[0] + right[1] >= least)
    a, b, t = ([n[k] * weights[k] for k in (0, 1)] for n in (left, right, total))
    whole = t[0] + t[1]
    with np.errstate(invalid="ignore", divide="ignore"):
        kept = (a[0] * a[0] + a[1] * a[1]) / (a[0] + a[1]) + (b[0] * b[0] + b[1] * b[1]) / (b[0] + b[1])
        gain = np.where(valid, kept / whole[:, None] - ((t[0] * t[0] + t[1] * t[1]) / (whole * whole))[:, None], -1.0)
    at = gain.argmax(1)
    return at, gain[np.arange(len(at)), at]


def grown(x: np.ndarray, label: np.ndarray, copies: np.ndarray, weights: np.ndarray, rng: np.random.Generator, depth: int, least: int) -> dict[str, np.ndarray]:
    """Nodes of the tree below a node with these rows, level by level; all nodes of a level are split at once."""
    levels, rows, at, nodes, base = [], np.arange(len(x)), np.zeros(len(x), np.int64), 1, 0
    label, copies, ahead = label.astype(np.int64), copies.astype(np.float64), depth
    while nodes:
        n = np.bincount(label[rows] * nodes + at, copies[rows], 2 * nodes).reshape(2, nodes)
        place, cut, gain = np.full(nodes, -1), np.full(nodes, -1), np.full(nodes, -1.0)
        open_ = (n.sum(0) >= 2 * least) & (n.min(0) > 0) & (ahead > 0)
        if open_.any():
            number = np.cumsum(open_) - 1
            inside = open_[at]
            rows, own = rows[inside], number[at[inside]]
            count, total = int(open_.sum()), n[:, open_]
            tried = tried_features(rng, count, x.shape[1])
            chosen, limit, most = np.full(count, -1), np.full(count, -1), np.full(count, LEAST_GAIN)
            y, c = label[rows], copies[rows]
            for features in tried.T:
                key = (y * count + own) * BINS + x[rows, features[own]]
                left = np.bincount(key, c, 2 * count * BINS).reshape(2, count, BINS).cumsum(2)
                bin_, found = best_splits(left, total, weights, least)
                better = found > most
                chosen, limit, most = np.where(better, features, chosen), np.where(better, bin_, limit), np.where(better, found, most)
            place[open_], cut[open_], gain[open_] = chosen, limit, np.where(chosen >= 0, most, -1.0)
            split = chosen >= 0
            rows, own = rows[split[own]], own[split[own]]
            at = 2 * (np.cumsum(split) - 1)[own] + (x[rows, chosen[own]] > limit[own])
        else:
            rows, at = rows[:0], at[:0]
        inner = place >= 0
        left = np.where(inner, base + nodes + 2 * (np.cumsum(inner) - 1), -1)
        levels.append({"place": place, "bin": cut, "left": left, "right": np.where(inner, left + 1, -1), "gain": gain, "n_0": n[0], "n_1": n[1]})
        base, nodes, ahead = base + nodes, 2 * int(inner.sum()), ahead - 1
    return pruned({k: np.concatenate([level[k] for level in levels]) for k in levels[0]}, [len(level["place"]) for level in levels], weights)


def pruned(tree: dict[str, np.ndarray], levels: list[int], weights: np.ndarray) -> dict[str, np.ndarray]:
    """Sibling leaves of one class become the leaf above; the other nodes are numbered anew, in the same order."""
    positive = tree["n_1"] * weights[1] > tree["n_0"] * weights[0]
    spans = [slice(end - n, end) for n, end in zip(levels, accumulate(levels), strict=True)]
    for span in reversed(spans):
        left, right = tree["left"][span], tree["right"][span]
        same = (left >= 0) & (tree["left"][left] < 0) & (tree["left"][right] < 0) & (positive[left] == positive[right])
        for column, leaf in (("left", -1), ("right", -1), ("place", -1), ("bin", -1), ("gain", -1.0)):
            tree[column][span] = np.where(same, leaf, tree[column][span])
    kept = np.zeros(len(positive), bool)
    kept[0] = True
    for span in spans:
        inner = kept[span] & (tree["left"][span] >= 0)
        for side in ("left", "right"):
            kept[tree[side][span][inner]] = True
    number = np.cumsum(kept) - 1
    tree = {k: v[kept] for k, v in tree.items()}
    return tree | {"node": np.arange(kept.sum())} | {side: np.where(tree[side] >= 0, number[tree[side]], -1) for side in ("left", "right")}


class Tops:
    """Nodes at the top of the trees, which all rows of a part pass: place and last bin on the left, children, counts by class.

    A node without children is a leaf, or the root of what a task grows.
    """

    def __init__(self, trees: int):
        self.nodes: list[list[dict]] = [[self._bottom(0)] for _ in range(trees)]

    @staticmethod
    def _bottom(depth: int, **known) -> dict:
        return {"place": -1, "bin": -1, "left": -1, "right": -1, "gain": -1.0, "depth": depth, "leaf": False} | known

    def split(self, tree: int, top: int, place: int, bin_: int, gain: float, left: tuple[int, int], right: tuple[int, int], depth: int) -> list[int]:
        """Gives a node its split, or leaves it as a leaf; returns its children that are none."""
        nodes = self.nodes[tree]
        node, free = nodes[top], len(nodes)
        node |= {"n_0": left[0] + right[0], "n_1": left[1] + right[1]}
        if gain <= LEAST_GAIN:
            node["leaf"] = True
            return []
        node |= {"place": place, "bin": bin_, "left": free, "right": free + 1, "gain": gain}
        below = node["depth"] + 1
        nodes += [self._bottom(below, n_0=n[0], n_1=n[1], leaf=not min(n) or below >= depth) for n in (left, right)]
        return [top for top in (free, free + 1) if not nodes[top]["leaf"]]

    def reached(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The node at the bottom of the top that each row comes to."""
        at = np.zeros(len(x), np.int64)
        place, cut, left, right = (np.array([n[c] for n in self.nodes[tree]]) for c in ("place", "bin", "left", "right"))
        for _ in range(max(n["depth"] for n in self.nodes[tree])):
            below = np.where(x[np.arange(len(x)), place[at]] <= cut[at], left[at], right[at])
            at = np.where(left[at] < 0, at, below)
        return at


def matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, width)
