"""Histogram gradient-boosted trees for two classes, in numpy.

Trees are complete binary trees of one depth, flattened into arrays: node ``i`` has the
children ``2 i + 1`` and ``2 i + 2``, and all rows walk one level at a time. Rows are held
whole, or counted by their bins and summed where they lie, level by level.
"""

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray  # trees x nodes; larger values go right
    leaf: np.ndarray  # trees x leaves
    bias: float
    scale: float = 1.0  # of the calibrated margin
    shift: float = 0.0

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        inner, every = self.feature.shape[1], np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(rows), int)
            for _ in range(inner.bit_length()):
                at = 2 * at + 1 + (rows[every, feature[at]] > threshold[at])
            out += leaf[at - inner]
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated probability of class 1 for rows of features."""
        return _sigmoid(self.scale * self.margin(rows) + self.shift)

    def calibrate(self, margin, labels, counts) -> None:
        """Fit scale and shift to margins that so many rows of a label have."""
        self.scale, self.shift = _calibrate(margin, labels, counts)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _edges(column):
    """Split points of one feature: quantiles of its distinct values."""
    values = np.unique(column)
    if len(values) > BINS:
        values = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[:-1]))
    return (values[1:] + values[:-1]) / 2


def fit(rows, labels, trees=80, depth=4, rate=0.15, smooth=5.0) -> Trees:
    """Boost on all rows but a fifth, which calibrates the margin.

    With no rows, or one class alone, every row scores the (smoothed) share of class 1.
    """
    rows, labels = np.asarray(rows, float), np.asarray(labels, float)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    bias = float(np.log(share / (1 - share)))
    inner, count = 2**depth - 1, trees
    if len(labels) < 20 or labels.min() == labels.max():
        count = 0
    model = Trees(
        np.zeros((count, inner), int), np.full((count, inner), np.inf),
        np.zeros((count, inner + 1)), bias,
    )
    if not count:
        return model
    order = np.random.default_rng(5).permutation(len(rows))
    aside, used = order[: len(rows) // 5], order[len(rows) // 5 :]
    x, y = rows[used], labels[used]
    edges = [_edges(x[:, f]) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    margin = np.full(len(y), bias)
    for t in range(count):
        p = _sigmoid(margin)
        at = _grow(model, t, binned, edges, y - p, p * (1 - p), depth, smooth)
        model.leaf[t] *= rate
        margin += model.leaf[t][at - inner]
    model.scale, model.shift = _calibrate(model.margin(rows[aside]), labels[aside])
    return model


def _grow(model, t, binned, edges, gradient, hessian, depth, smooth):
    """Fill tree ``t`` level by level; gives every row's leaf node."""
    at = np.zeros(len(binned), int)
    width = BINS + 1
    for level in range(depth):
        first, nodes = 2**level - 1, 2**level

        def sums(f):
            cell = (at - first) * width + binned[:, f]
            g = np.bincount(cell, gradient, nodes * width).reshape(nodes, width)
            return g, np.bincount(cell, hessian, nodes * width).reshape(nodes, width)

        right = np.zeros(len(binned), int)
        for node, chosen in enumerate(_split(model, t, first, nodes, sums, edges, smooth)):
            if chosen:
                f, cut = chosen
                inside = at == first + node
                right[inside] = binned[inside, f] > cut
        at = 2 * at + 1 + right
    inner = 2**depth - 1
    g = np.bincount(at - inner, gradient, inner + 1)
    h = np.bincount(at - inner, hessian, inner + 1)
    model.leaf[t] = g / (h + smooth)
    return at


def _split(model, t, first, nodes, sums, edges, smooth):
    """Set the best splits of one level; gives (feature, cut) of each node, or None.

    ``sums`` gives the gradients and hessians of a feature, by node and bin.
    """
    best, choice = np.zeros(nodes), [None] * nodes
    for f, splits in enumerate(edges):
        if not len(splits):
            continue
        g, h = (x.cumsum(axis=1) for x in sums(f))
        gl, hl = g[:, : len(splits)], h[:, : len(splits)]
        gr, hr = g[:, -1:] - gl, h[:, -1:] - hl
        gain = gl**2 / (hl + smooth) + gr**2 / (hr + smooth)
        gain -= g[:, -1:] ** 2 / (h[:, -1:] + smooth)
        gain[(hl < 1) | (hr < 1)] = 0
        cut = gain.argmax(axis=1)
        top = gain[np.arange(nodes), cut]
        for node in np.flatnonzero(top > best + 1e-9):
            best[node], choice[node] = top[node], (f, cut[node])
    for node, chosen in enumerate(choice):
        if chosen:
            model.feature[t, first + node] = chosen[0]
            model.threshold[t, first + node] = edges[chosen[0]][chosen[1]]
    return choice


#: Split points of whole, non-negative features, whatever the data: every number, then steps.
WHOLE = np.array([*range(40), *(40 * 1.5 ** np.arange(BINS - 41)).astype(int)]) + 0.5
#: Fixed point of summed gradients, so that sums do not depend on their order.
FIXED = 1 << 30


def bins(rows) -> np.ndarray:
    """Bins of whole features, in bytes."""
    return np.searchsorted(WHOLE, rows).astype(np.uint8)


def of_bins(binned: np.ndarray) -> np.ndarray:
    """Rows of features that lie in these bins."""
    return np.concatenate([[0.0], WHOLE + 0.5])[binned]


def _begun(model, t):
    """The finished trees alone."""
    return Trees(model.feature[:t], model.threshold[:t], model.leaf[:t], model.bias)


def gradient_sums(model, t, level, binned, labels, counts):
    """(feature, node and bin in one number, gradient, hessian) of counted rows, in fixed point."""
    rows, every = of_bins(binned), np.arange(len(binned))
    p = _sigmoid(_begun(model, t).margin(rows))
    at = np.zeros(len(rows), int)
    for _ in range(level):
        at = 2 * at + 1 + (rows[every, model.feature[t][at]] > model.threshold[t][at])
    width, nodes = BINS + 1, 2**level
    cell = (np.arange(binned.shape[1]) * nodes + (at - (nodes - 1))[:, None]) * width + binned
    keys, place = np.unique(cell, return_inverse=True)
    sums = np.zeros((2, len(keys)), np.int64)
    for own, x in zip(sums, (labels - p, p * (1 - p))):
        fixed = np.rint(x * FIXED).astype(np.int64) * counts
        np.add.at(own, place.reshape(cell.shape), fixed[:, None])
    return keys, *sums


def fit_counted(summed, totals, width, trees, depth=4, rate=0.15, smooth=5.0) -> Trees:
    """Boost on counted rows of bins, wherever they lie.

    ``totals`` are the numbers of rows of both classes; ``summed`` gives the sums of a
    function over all rows, as ``gradient_sums`` with a model, a tree and a level. Without
    both classes every row scores the (smoothed) share of class 1.
    """
    share = (totals[1] + 0.5) / (sum(totals) + 1)
    inner, count = 2**depth - 1, trees if min(totals) and sum(totals) >= 20 else 0
    model = Trees(
        np.zeros((count, inner), int), np.full((count, inner), np.inf),
        np.zeros((count, inner + 1)), float(np.log(share / (1 - share))),
    )
    for t in range(count):
        for level in range(depth):
            nodes = 2**level
            keys, *found = summed(model, t, level)
            g, h = np.zeros((2, width * nodes * (BINS + 1)))
            g[keys], h[keys] = (x / FIXED for x in found)
            g, h = (x.reshape(width, nodes, BINS + 1) for x in (g, h))
            choice = _split(model, t, nodes - 1, nodes, lambda f: (g[f], h[f]), [WHOLE] * width, smooth)
        for node, chosen in enumerate(choice):
            f, cut = chosen or (0, BINS)
            left = g[f, node, : cut + 1].sum(), h[f, node, : cut + 1].sum()
            right = g[f, node, cut + 1 :].sum(), h[f, node, cut + 1 :].sum()
            model.leaf[t, 2 * node : 2 * node + 2] = [rate * a / (b + smooth) for a, b in (left, right)]
    return model


def _calibrate(margin, labels, counts=1.0):
    """Scale and shift of the margin by Newton steps on the rows set aside."""
    if np.sum(counts * np.ones(len(labels))) < 20 or labels.min() == labels.max():
        return 1.0, 0.0
    design, weights = np.stack([margin, np.ones(len(margin))], axis=1), np.array([1.0, 0.0])
    for _ in range(25):
        p = _sigmoid(design @ weights)
        hessian = design.T @ (design * (counts * (p * (1 - p)))[:, None]) + 1e-2 * np.eye(2)
        gradient = design.T @ (counts * (labels - p)) - 1e-2 * (weights - [1, 0])
        weights += np.linalg.solve(hessian, gradient)
    return float(max(weights[0], 0.05)), float(weights[1])
