"""Connected components by contraction to the smallest neighbour.

Each task first makes stars of the edges that it reads: every vertex leads to the smallest one that
they connect it with. That needs no shuffle and joins more of a small graph than a round does, as small files are
read together. In each round every vertex points to the smallest vertex among itself and its
neighbours, pointers are followed twice, and the edges are drawn anew between the ends
of the pointers. A star or a clique is gone after one round, and a vertex that is
not the least of its surroundings is always merged, so rounds grow with the logarithm of the size. Each round
is written out, which cuts the lineage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.sources.staging import stage

#: Edges that a task makes stars of at a time.
STEP_EDGES = 1 << 20


def smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that the links (a, b) between ``n`` positions lead to."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        for ends in (a, b):
            np.minimum.at(label, label[ends], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (smaller, larger) that connect what these do: from the smallest vertex to each other one."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = smallest(len(names), at[:len(a)], at[len(a):])
    other = np.flatnonzero(label != np.arange(len(names)))
    return names[label[other]], names[other]


def _stars(batches):
    a = b = np.empty(0, np.int64)
    for batch in batches:
        a, b = (np.concatenate([x, batch.column(c).to_numpy()]) for x, c in ((a, "a"), (b, "b")))
        if len(a) >= STEP_EDGES:
            a, b = _star(a, b)
            # What stays long is left to the rounds.
            if 2 * len(a) >= STEP_EDGES:
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})
                a = b = np.empty(0, np.int64)
    a, b = _star(a, b)
    yield pa.RecordBatch.from_pydict({"a": a, "b": b})


def _between(edges: DataFrame) -> DataFrame:
    """Edges that connect what these do, from the smaller to the larger vertex, without loops; those of a task are stars."""
    return edges.filter("a <> b").select("a", "b").mapInArrow(_stars, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every vertex of an edge (a, b): the smallest vertex of its component."""
    for _ in range(2):  # the stars of several tasks are read together
        edges = stage(_between(edges), "edges")
    labels = None
    while not edges.isEmpty():
        ends = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        low = stage(ends.groupBy(F.col("e.a").alias("v")).agg(F.least(F.col("v"), F.min("e.b")).alias("p")), "pointers")
        jump = low.select(F.col("v").alias("p"), F.col("p").alias("q"))
        twice = jump.select(F.col("p").alias("q"), F.col("q").alias("r"))
        ends_at = stage(low.join(jump, "p").join(twice, "q").select("v", F.col("r").alias("p")), "pointers")
        labels = ends_at.select("v", F.col("p").alias("label")) if labels is None else stage(
            labels.join(ends_at.select(F.col("v").alias("label"), "p"), "label", "left")
            .select("v", F.coalesce("p", "label").alias("label")), "labels")
        a, b = (ends_at.select(F.col("v").alias(c), F.col("p").alias(f"p{c}")) for c in "ab")
        moved = edges.join(a, "a").join(b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        edges = stage(_between(moved), "edges")
    return edges.select(F.col("a").alias("v"), F.col("b").alias("label")) if labels is None else labels
