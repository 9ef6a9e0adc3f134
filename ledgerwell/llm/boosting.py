"""Gradient-boosted trees of depth two over integer features, fitted to counted cells.

A cell is a combination of feature values with its number of positives and negatives. The cells of a
corpus are made by Spark over all its rows; there are as many as combinations, whatever the rows, so
the fitted trees score the cells, and rows find their score by their cell.
"""

from __future__ import annotations

import numpy as np

ROUNDS = 30
RATE = 0.4
RIDGE = 1.0

# A split: feature, and the value up to which rows go left. A tree: split, (left, right) each a value
# or (split, value, value).


def _best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, int] | None:
    best = None
    whole = g.sum() ** 2 / (h.sum() + RIDGE)
    for feature in range(x.shape[1]):
        for value in np.unique(x[:, feature])[:-1].tolist():
            left = x[:, feature] <= value
            gl, hl = g[left].sum(), h[left].sum()
            gain = gl**2 / (hl + RIDGE) + (g.sum() - gl) ** 2 / (h.sum() - hl + RIDGE) - whole
            if gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                best = float(gain), feature, int(value)
    return best


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    split = _best_split(x, g, h) if depth and len(x) > 1 else None
    if not split:
        return float(-g.sum() / (h.sum() + RIDGE)) * RATE
    left = x[:, split[1]] <= split[2]
    return split[1:], _grow(x[left], g[left], h[left], depth - 1), _grow(x[~left], g[~left], h[~left], depth - 1)


def tree_values(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    (feature, value), left, right = tree
    return np.where(x[:, feature] <= value, tree_values(left, x), tree_values(right, x))


def fit(x: np.ndarray, positives: np.ndarray, negatives: np.ndarray, rounds: int = ROUNDS) -> tuple[float, list]:
    """Start value and trees of the log odds, by Newton steps on the logistic loss."""
    n = positives + negatives
    if not n.sum():
        return 0.0, []
    start = float(np.log((positives.sum() + 0.5) / (negatives.sum() + 0.5)))
    margin, trees = np.full(len(x), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, n * p - positives, n * p * (1 - p), 2)
        if isinstance(tree, float):
            break
        trees.append(tree)
        margin = margin + tree_values(tree, x)
    return start, trees


def scores(model: tuple[float, list], x: np.ndarray) -> np.ndarray:
    margin = model[0] + sum((tree_values(t, x) for t in model[1]), np.zeros(len(x)))
    return 1 / (1 + np.exp(-margin))


def threshold(p: np.ndarray, positives: np.ndarray, negatives: np.ndarray, precision: float, least: int) -> float | None:
    """The lowest score at and above which the share of positives, by its lower bound, reaches
    ``precision`` among at least ``least`` rows; None if there is none."""
    found, order = None, np.argsort(-p, kind="stable")
    hits, total = np.cumsum(positives[order]), np.cumsum((positives + negatives)[order])
    for i, at in enumerate(order):
        last = i + 1 == len(order) or p[order[i + 1]] < p[at]
        if last and total[i] >= least:
            share = hits[i] / total[i]
            bound = share - 1.64 * np.sqrt(share * (1 - share) / total[i] + 1e-12)
            if bound >= precision:
                found = float(p[at])
    return found
