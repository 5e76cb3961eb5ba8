"""Nearest vectors against a comparison of all."""

from __future__ import annotations

import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.plans import vectors


def frame(spark, rows, seen=None):
    kind = "id long, vector array<float>" + (", seen array<long>" if seen is not None else "")
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], *([seen.get(i)] if seen is not None else [])) for i, v in rows], kind)


def plain(rows, asked, seen, k):
    unit = {i: np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) for i, v in rows if v is not None and np.any(v)}
    out = []
    for q, v in asked:
        if v is None or not np.any(v):
            continue
        v = np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float))
        near = sorted((-round(float(v @ u), 6) + 0.0, i) for i, u in unit.items() if i not in (seen.get(q) or []))
        out += [(q, i, -s + 0.0, n) for n, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(3)
    heart = draw.normal(size=(12, 8))
    return [(7 * i - 50, (heart[i % 12] + 0.4 * draw.normal(size=8)).round(2)) for i in range(900)]


def got(df):
    return sorted((r.query, r.id, r.cosine + 0.0, r.place) for r in df.collect())


@pytest.mark.parametrize("cell", [8192, 100])
def test_one_cell_is_exact(spark, rows, monkeypatch, cell):
    """Also where the cell is cut into parts, with copies, ties, and vectors without a direction."""
    monkeypatch.setattr(vectors, "CELL", cell)
    more = rows + [(10_000 + i, rows[4][1]) for i in range(300)] + [(20_000, None), (20_001, np.zeros(8))]
    seen = {rows[0][0]: [rows[0][0]], rows[4][0]: [10_005, 10_006, -1]}
    asked = rows[:40] + [(20_000, None), (20_001, np.zeros(8))]
    found = vectors.nearest(frame(spark, more), frame(spark, asked, seen), vectors.EXACT, 5)
    want = plain(more, asked, seen, 5)
    assert [r[:2] + r[3:] for r in got(found)] == [r[:2] + r[3:] for r in want]
    assert [r[2] for r in got(found)] == pytest.approx([r[2] for r in want], abs=1.1e-6)


def test_cells_find_most(spark, rows, monkeypatch):
    monkeypatch.setattr(vectors, "CELL", 64)
    base = frame(spark, rows)
    index = vectors.fitted(base, 10, target=0.95)
    assert 1 < len(index.centres) <= 30 and index.probes < len(index.centres)
    asked = frame(spark, rows[::9], {})
    exact = vectors.nearest(base, asked, vectors.EXACT, 10)
    row = vectors.recall(vectors.nearest(base, asked, index, 10), exact).first()
    assert row.queries == 100 and row.pairs == 1000 and row.recall >= 0.9


def test_few_and_odd_vectors(spark):
    none = spark.createDataFrame([], "id long, vector array<float>")
    assert vectors.fitted(none) is vectors.EXACT
    assert vectors.nearest(none, none.withColumn("seen", F.array().cast("array<long>")), vectors.EXACT).count() == 0
    one = frame(spark, [(1, [1.0, 0.0])])
    assert vectors.fitted(one) is vectors.EXACT
    with pytest.raises(ValueError):
        vectors.fitted(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="no test tables")
def test_recall_on_all_vectors(spark):
    base = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    asked = base.filter("id % 100 = 0").withColumn("seen", F.array("id"))
    index = vectors.fitted(base, 10)
    row = vectors.recall(vectors.nearest(base, asked, index), vectors.nearest(base, asked, vectors.EXACT)).first()
    assert row.queries == 20 and row.recall >= 0.9


def test_comparison_holds_few_scores():
    """What a task holds while it compares does not grow with the queries that meet its vectors."""
    draw = np.random.default_rng(5)

    def side(n):
        return {"id": pa.array(np.arange(n)), "vector": pa.array(list(draw.normal(size=(n, 8))), pa.list_(pa.float64()))}

    found = pa.table(side(vectors.CELL))
    asked = pa.table({**side(1500), "seen": pa.array([[i] for i in range(1500)], pa.list_(pa.int64()))})
    tracemalloc.start()
    try:
        best = vectors._compared(10)(found, asked)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert best.num_rows == 15_000
    assert peak < 64e6


def test_vectors_are_sent_for_few_groups(spark, monkeypatch):
    """A group is as large as a task can hold, but for the parts that give all tasks work, and any dealing finds the same."""
    draw = np.random.default_rng(21)
    base = frame(spark, [(i, draw.normal(size=4).tolist()) for i in range(300)])
    asked = base.filter("id % 3 = 0").withColumn("seen", F.array("id"))
    want = sorted(map(tuple, vectors.nearest(base, asked, vectors.EXACT, 4).collect()))
    compared = vectors._compared
    for cell, most, groups, parts in ((10, 1000, 4, 4), (10, 50, 1, 6 * 2), (10, 1000, 10**6, 30 * 10), (1000, 1000, 64, 1)):
        for name, value in (("CELL", cell), ("MOST", most), ("GROUPS", groups)):
            monkeypatch.setattr(vectors, name, value)
        found = vectors.nearest(base, asked, vectors.EXACT, 4)
        assert sorted(map(tuple, found.collect())) == want
        monkeypatch.setattr(vectors, "_compared", lambda k: lambda x, y: pa.table({"query": [x.num_rows], "id": [y.num_rows], "cosine": [0.0]}))
        sizes = vectors.nearest(base, asked, vectors.EXACT, 4).collect()
        monkeypatch.setattr(vectors, "_compared", compared)
        assert len(sizes) <= parts
