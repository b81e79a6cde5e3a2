"""Small tree ensembles over bounded samples: gradient boosting and a random forest, on binned features."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The leaf value of each row."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right, value = np.array(self.left), np.array(self.right), np.array(self.value)
        at = np.zeros(len(x), int)
        while len(moving := np.flatnonzero(feature[at] >= 0)):
            node = at[moving]
            at[moving] = np.where(x[moving, feature[node]] <= cut[node], left[node], right[node])
        return value[at]


def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Thresholds of each column: midpoints of its values, or quantiles where it has many."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)))
        out.append((values[:-1] + values[1:]) / 2)
    return out


def _grow(binned, cuts, target, weight, depth, least, rng, share) -> Tree:
    """A tree that fits target / weight by squares: the best cut over sums per bin, until depth or too few rows."""
    tree = Tree()

    def node(rows: np.ndarray, level: int) -> int:
        at = len(tree.feature)
        t, w = target[rows].sum(), weight[rows].sum()
        for part, x in ((tree.feature, -1), (tree.cut, 0.0), (tree.left, 0), (tree.right, 0), (tree.value, t / (w + 1.0))):
            part.append(x)
        if level == depth or len(rows) < 2 * least:
            return at
        best = (1e-9, -1, 0)
        d = binned.shape[1]
        for j in rng.permutation(d)[: max(1, int(share * d))]:
            if not len(cuts[j]):
                continue
            codes, n = binned[rows, j], len(cuts[j]) + 1
            ts = np.cumsum(np.bincount(codes, target[rows], n))[:-1]
            ws = np.cumsum(np.bincount(codes, weight[rows], n))[:-1]
            count = np.cumsum(np.bincount(codes, minlength=n))[:-1]
            gain = ts**2 / (ws + 1) + (t - ts) ** 2 / (w - ws + 1) - t * t / (w + 1)
            gain[(count < least) | (len(rows) - count < least)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], int(j), k)
        if best[1] < 0:
            return at
        j, k = best[1:]
        low = binned[rows, j] <= k
        tree.feature[at], tree.cut[at] = j, float(cuts[j][k])
        tree.left[at] = node(rows[low], level + 1)
        tree.right[at] = node(rows[~low], level + 1)
        return at

    node(np.arange(len(binned)), 0)
    del node  # which holds itself, and with it the rows of every tree until they are collected
    return tree


def _binned(x: np.ndarray, bins: int) -> tuple[np.ndarray, list[np.ndarray]]:
    cuts = _cuts(x, bins)
    return np.stack([np.searchsorted(c, column).astype(np.uint8) for c, column in zip(cuts, x.T, strict=True)], 1), cuts


@dataclass
class Boosted:
    """Boosted trees for a yes or no: probability = logistic(base + rate * sum of trees)."""

    base: float
    rate: float
    trees: list[Tree]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += self.rate * tree(x)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, seed: int = 11) -> Boosted:
    """Newton steps on the logistic loss. Without rows, or with one class, a constant."""
    mean = float(np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4))
    model = Boosted(float(np.log(mean / (1 - mean))), rate, [])
    if len(set(y.tolist())) < 2:
        return model
    rng = np.random.default_rng(seed)
    binned, cuts = _binned(x, 32)
    total = np.full(len(x), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        tree = _grow(binned, cuts, y - p, p * (1 - p), depth, 5, rng, 1.0)
        model.trees.append(tree)
        total += rate * tree(x)
    return model


@dataclass
class Forest:
    """The mean vote of trees grown on resampled rows, half of each class, with a random part of the columns at each cut.

    So a vote above one half says that a row resembles the positive rows more, however rare they are.
    """

    trees: list[Tree]
    share: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(x), self.share)
        return np.clip(np.mean([tree(x) for tree in self.trees], axis=0), 0, 1)


def forest(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 10, seed: int = 5) -> Forest:
    share = float(y.mean()) if len(y) else 0.0
    if len(set(y.tolist())) < 2:
        return Forest([], share)
    rng = np.random.default_rng(seed)
    grown = []
    classes = [np.flatnonzero(y == k) for k in (0, 1)]
    for _ in range(trees):
        rows = np.concatenate([rng.choice(c, max(1, len(x) // 2)) for c in classes])
        binned, cuts = _binned(x[rows], 32)
        grown.append(_grow(binned, cuts, y[rows].astype(float), np.ones(len(rows)), depth, 2, rng, x.shape[1] ** -0.5))
    return Forest(grown, share)
