"""Small gradient-boosted trees, and the same trees as a column expression."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Node:
    feature: int = -1  # -1: a leaf
    cut: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None
    value: float = 0.0


@dataclass(frozen=True)
class Trees:
    """A base score and trees of log odds; slope and shift calibrate them."""

    names: tuple[str, ...]
    base: float
    trees: tuple[Node, ...]
    slope: float = 1.0
    shift: float = 0.0


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, least: float = 4.0) -> Node:
    """A tree that fits gradients g with weights h by exact search over all cuts."""
    total_g, total_h = g[rows].sum(), h[rows].sum()
    leaf = Node(value=float(total_g / (total_h + 1.0)))
    if depth == 0:
        return leaf
    best, gain = None, 1e-6
    for f in range(x.shape[1]):
        order = rows[np.argsort(x[rows, f], kind="stable")]
        v, cg, ch = x[order, f], np.cumsum(g[order])[:-1], np.cumsum(h[order])[:-1]
        ok = np.flatnonzero((v[1:] > v[:-1]) & (ch >= least) & (total_h - ch >= least))
        if len(ok):
            s = cg[ok] ** 2 / (ch[ok] + 1) + (total_g - cg[ok]) ** 2 / (total_h - ch[ok] + 1) - total_g**2 / (total_h + 1)
            k = int(np.argmax(s))
            if s[k] > gain:
                best, gain = (f, float((v[ok[k]] + v[ok[k] + 1]) / 2)), float(s[k])
    if best is None:
        return leaf
    f, cut = best
    below = x[rows, f] < cut
    return Node(f, cut, grow(x, g, h, rows[below], depth - 1, least), grow(x, g, h, rows[~below], depth - 1, least))


def margin(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.value)
    return np.where(x[:, node.feature] < node.cut, margin(node.low, x), margin(node.high, x))


def raw(model: Trees, x: np.ndarray) -> np.ndarray:
    return model.base + sum((margin(t, x) for t in model.trees), np.zeros(len(x)))


def probability(model: Trees, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(model.slope * raw(model, x) + model.shift)))


def fit(names: tuple[str, ...], x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, grown: np.ndarray | None = None, held: np.ndarray | None = None) -> Trees:
    """Boosted trees for log loss, grown on some rows and calibrated on others (every fourth, unless masks are given)."""
    held = np.arange(len(x)) % 4 == 0 if held is None else held
    grown = ~held if grown is None else grown
    a, b = x[grown], y[grown]
    p = np.clip(b.mean(), 1e-3, 1 - 1e-3)
    base, trees = math.log(p / (1 - p)), []
    score = np.full(len(a), base)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-score))
        t = scaled(grow(a, b - q, q * (1 - q), np.arange(len(a)), depth), rate)
        trees.append(t)
        score += margin(t, a)
    model = Trees(names, base, tuple(trees))
    z, slope, shift = raw(model, x[held]), 1.0, 0.0
    for _ in range(50):  # Platt's two factors, drawn towards 1 and 0
        q = 1 / (1 + np.exp(-(slope * z + shift)))
        w = q * (1 - q)
        grad = np.array([((y[held] - q) * z).sum() - (slope - 1), (y[held] - q).sum() - shift])
        hess = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1]])
        step = np.linalg.solve(hess, grad)
        slope, shift = slope + step[0], shift + step[1]
    return Trees(names, base, tuple(trees), float(slope), float(shift))


def scaled(node: Node, by: float) -> Node:
    if node.feature < 0:
        return Node(value=node.value * by)
    return Node(node.feature, node.cut, scaled(node.low, by), scaled(node.high, by))


def column(model: Trees, features: dict[str, Column]) -> Column:
    """The calibrated probability as an expression over feature columns."""

    def tree(n: Node) -> Column:
        if n.feature < 0:
            return F.lit(n.value)
        return F.when(features[model.names[n.feature]] < n.cut, tree(n.low)).otherwise(tree(n.high))

    total = F.lit(model.base)
    for t in model.trees:
        total = total + tree(t)
    return 1 / (1 + F.exp(-(total * model.slope + model.shift)))
