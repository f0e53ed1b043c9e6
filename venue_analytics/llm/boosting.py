"""Gradient boosting of small trees over counted integer feature vectors, as a column expression.

The fit takes a table of distinct feature vectors with counts of positive and negative cases (bounded
by its caller); the model is a sum of CASE expressions that Spark evaluates with the rest of a query.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column
from pyspark.sql import functions as F

Case = tuple[tuple[int, ...], float, float]  # features, positives, negatives
Tree = tuple  # (leaf,) or (feature, threshold, low, high)


def _grow(cases: list[tuple[tuple[int, ...], float, float]], depth: int, least: float) -> Tree:
    """Tree on ``(features, gradient, curvature)``; a split needs ``least`` curvature on both sides."""
    g, h = sum(c[1] for c in cases), sum(c[2] for c in cases)
    best, gain = None, 1e-6
    if depth and cases:
        for f in range(len(cases[0][0])):
            sums: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0])
            for x, cg, ch in cases:
                s = sums[x[f]]
                s[0] += cg
                s[1] += ch
            lg = lh = 0.0
            for v in sorted(sums)[:-1]:
                lg, lh = lg + sums[v][0], lh + sums[v][1]
                if lh >= least and h - lh >= least:
                    got = lg * lg / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g * g / (h + 1)
                    if got > gain:
                        best, gain = (f, v), got
    if best is None:
        return (g / (h + 1),)
    f, v = best
    return f, v, _grow([c for c in cases if c[0][f] <= v], depth - 1, least), _grow([c for c in cases if c[0][f] > v], depth - 1, least)


def value(tree: Tree, x: tuple[int, ...]) -> float:
    while len(tree) > 1:
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def fit(cases: list[Case], rounds: int = 20, depth: int = 3, rate: float = 0.3, least: float = 0.5) -> list[Tree]:
    """Boosted trees for the log odds of a positive case."""
    trees: list[Tree] = []
    score = [0.0] * len(cases)
    for _ in range(rounds if cases else 0):
        steps = []
        for (x, pos, neg), s in zip(cases, score):
            p = 1 / (1 + math.exp(-s))
            steps.append((x, pos - (pos + neg) * p, (pos + neg) * p * (1 - p)))
        tree = _grow(steps, depth, least)
        trees.append(tree)
        score = [s + rate * value(tree, c[0]) for s, c in zip(score, cases)]
    return trees


def predict(trees: list[Tree], x: tuple[int, ...], rate: float = 0.3) -> float:
    """Probability, rounded as :func:`probability` gives it."""
    return 1 / (1 + math.exp(-sum(rate * value(t, x) for t in trees)))


def probability(trees: list[Tree], features: list[Column], rate: float = 0.3) -> Column:
    """The model as a column expression over ``features``."""
    def column(tree: Tree) -> Column:
        if len(tree) == 1:
            return F.lit(float(rate * tree[0]))
        f, v, low, high = tree
        return F.when(features[f] <= v, column(low)).otherwise(column(high))
    total = F.lit(0.0)
    for t in trees:
        total = total + column(t)
    return 1 / (1 + F.exp(-total))


def band_limit(cases: list[tuple[float, float, float]], precision: float, prior: float) -> float:
    """Lowest probability whose band of held-out ``(probability, positives, negatives)`` has the share
    ``precision`` of positives; infinite if none has.

    The share is looked at within each band, not among all that reach it. A band's share is drawn to its own
    probability by ``prior`` cases, so few cases say little and many say all, and bands are pooled until
    their shares rise with the probability (isotonic regression)."""
    by: dict[float, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for p, a, b in cases:
        by[p][0] += a
        by[p][1] += b
    pooled: list[list[float]] = []  # lowest probability, weighted positives, weight
    for p in sorted(by):
        a, b = by[p]
        pooled.append([p, a + prior * p, a + b + prior])
        while len(pooled) > 1 and pooled[-2][1] * pooled[-1][2] >= pooled[-1][1] * pooled[-2][2]:
            _, a, n = pooled.pop()
            pooled[-1][1] += a
            pooled[-1][2] += n
    return next((p for p, a, n in pooled if a >= precision * n), math.inf)
