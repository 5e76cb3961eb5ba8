"""Quality rules learned as gradient-boosted trees over document statistics.

Trees are grown on histograms of quantile bins with logistic loss. Chosen features
carry a sign: the score never falls (1) or never rises (-1) with the feature. A split that breaks
this is not taken, and the middle of an accepted split bounds both subtrees. All trees are
flattened into arrays of nodes, so scoring moves all rows of a batch down one level at a time.

Without labels of both kinds there is nothing to learn: the score is the share of good
labels, and 1 without any label, so only the base rules reject.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import stats

#: The labelled rows that are learned from at most, by the order of a hash of doc_id.
SAMPLE_ROWS = 20_000
#: More symbols, capitals, marks, bars or repetition never make a text better.
SIGNS = {"symbol_share": -1, "upper_share": -1, "mark_share": -1, "bar_share": -1, "repeat_share": -1,
         "dup_line_share": -1, "top_word_share": -1}


@dataclass
class Forest:
    """Node arrays of all trees; a leaf is its own child. Roots are the places of first nodes."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out += self.value[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def _best_split(g: np.ndarray, h: np.ndarray, sign: np.ndarray, low: float, high: float, penalty: float, least: float):
    """Gain, feature and bin of the best split of a node; g and h are sums by feature and bin."""
    gl, hl = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
    total_g, total_h = g[0].sum(), h[0].sum()
    gr, hr = total_g - gl, total_h - hl
    left = np.clip(-gl / (hl + penalty), low, high)
    right = np.clip(-gr / (hr + penalty), low, high)

    def loss(w, gs, hs):
        return gs * w + 0.5 * (hs + penalty) * w * w

    whole = np.clip(-total_g / (total_h + penalty), low, high)
    gain = loss(whole, total_g, total_h) - loss(left, gl, hl) - loss(right, gr, hr)
    gain[(hl < least) | (hr < least) | ((right - left) * sign[:, None] < 0)] = -np.inf
    best = np.unravel_index(np.argmax(gain), gain.shape)
    return gain[best], *best, left[best], right[best]


def fit(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2,
        bins: int = 64, penalty: float = 1.0, least: float = 1.0) -> Forest:
    """``signs`` has 1, -1 or 0 (free) for each feature; ``least`` is the hessian that a side needs."""
    share = float(y.mean()) if len(y) else 1.0
    share = min(max(share, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T]
        binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
        n_features = x.shape[1]
        raw = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = p - y, p * (1 - p)

            def grow(rows: np.ndarray, level: int, low: float, high: float, value: float) -> int:
                at = len(nodes)
                nodes.append([0, np.inf, at, at, rate * value])
                raw_value = rate * value
                if level < depth and len(rows) > 1:
                    flat = (binned[rows] + np.arange(n_features) * bins).ravel()
                    g = np.bincount(flat, np.repeat(grad[rows], n_features), n_features * bins).reshape(n_features, bins)
                    h = np.bincount(flat, np.repeat(hess[rows], n_features), n_features * bins).reshape(n_features, bins)
                    gain, f, b, left, right = _best_split(g, h, signs, low, high, penalty, least)
                    if gain > 1e-9 and b < len(edges[f]):
                        side = binned[rows, f] <= b
                        middle = (left + right) / 2
                        bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)),
                                  0: ((low, high), (low, high))}[int(signs[f])]
                        nodes[at][:2] = [f, edges[f][b]]
                        nodes[at][2] = grow(rows[side], level + 1, *bounds[0], left)
                        nodes[at][3] = grow(rows[~side], level + 1, *bounds[1], right)
                        return at
                raw[rows] += raw_value
                return at

            everything = np.arange(len(y))
            roots.append(grow(everything, 0, -np.inf, np.inf, -grad.sum() / (hess.sum() + penalty)))
    n = np.array(nodes).reshape(-1, 5)
    return Forest(base, depth, np.array(roots, np.int64), n[:, 0].astype(np.int64), n[:, 1], n[:, 2].astype(np.int64),
                  n[:, 3].astype(np.int64), n[:, 4])


def labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Measured rows with a label ``y``: 1 if the labels of the doc_id average to 0.5 or more. Null labels don't count."""
    y = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
         .agg((F.avg("quality") >= 0.5).cast("int").alias("y")))
    return measured.join(y, "doc_id")


def learn(measured: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Fit on at most ``sample_rows`` labelled rows, chosen by a hash of doc_id and collected to the driver."""
    rows = (labelled(measured, labels).select("doc_id", "features", "y")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(sample_rows).toArrow())
    x = np.array(rows["features"].to_pylist(), np.float64).reshape(len(rows), len(stats.FEATURES))
    return fit(x, rows["y"].to_numpy().astype(np.float64), np.array([SIGNS.get(f, 0) for f in stats.FEATURES]))


def judge(measured: DataFrame, forest: Forest) -> DataFrame:
    """Add the score and the verdict of the base rules and the trees."""
    def run(batches):
        for batch in batches:
            score = pa.array(forest.score(stats.matrix(batch)))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "score"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in measured.schema)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (measured.mapInArrow(run, f"{fields}, score double").withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= 0.5)))
