"""Quality scores by ridge regression on random Fourier features, calibrated.

Statistics are standardised with moments over all labelled rows; cosines of random
projections of them approximate a Gaussian kernel. Each task adds the products of its
rows into the normal equations, Spark adds the sums of the tasks, and the driver
solves one system whose size is the number of features. Two folds score each other's
rows, and an isotonic fit over a fixed number of score bins turns scores into shares.

Labels, language, source and id are no inputs. Null texts are empty and are scored.
Repeated labels of a doc_id are averaged, null labels don't count. With labels of one kind only
the score is their share, and 0.5 without any.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import stats, words
from siltstone.llm.boosting import labelled

DIMENSIONS = 160
RIDGE = 1e-3  # for each row
SCORE_BINS = 1024
SEED = 20


@dataclass
class Features:
    """The map from statistics to a constant, the standardised statistics and cosines."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray

    @classmethod
    def drawn(cls, mean: np.ndarray, scale: np.ndarray, dimensions: int = DIMENSIONS) -> Features:
        draw = np.random.default_rng(SEED)
        width = np.sqrt(2 * len(mean))  # the median distance of standardised rows is about this
        return cls(mean, scale, draw.normal(size=(len(mean), dimensions)) / width, draw.uniform(0, 2 * np.pi, dimensions))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        cosines = np.sqrt(2 / self.weights.shape[1]) * np.cos(z @ self.weights + self.phase)
        return np.column_stack([np.ones(len(z)), z, cosines])


@dataclass
class Model:
    features: Features
    weights: np.ndarray
    knots: np.ndarray
    shares: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.features(x) @ self.weights
        share = np.interp(raw, self.knots, self.shares)
        # A trace of the uncalibrated score keeps the order where the fit is flat; it never crosses 0.5.
        return np.where(share >= 0.5, 0.5 + (share - 0.5) * 0.999, share * 0.998) + 0.0005 * np.clip(raw, 0, 1)


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weighted least-squares fit that never falls (pool adjacent violators)."""
    pools: list[list[float]] = []
    for value, w in zip(y, weight):
        pools.append([value, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w2, n = pools.pop()
            u, w1, m = pools[-1]
            pools[-1] = [(u * w1 + v * w2) / (w1 + w2), w1 + w2, m + n]
    return np.concatenate([np.full(int(n), v) for v, _, n in pools]) if pools else np.empty(0)


def _equations(train: DataFrame, features: Features) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Sums of products for each fold: features by features, and features by label."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = features(stats.matrix(batch))
            y, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
            for f in np.unique(fold):
                part = x[fold == f]
                sums[f] = sums.get(f, 0) + part.T @ np.column_stack([part, y[fold == f]])
        for f, total in sums.items():
            n = total.shape[0]
            yield pa.RecordBatch.from_pydict({
                "fold": pa.array(np.full(n, f), pa.int32()), "i": pa.array(np.arange(n), pa.int32()),
                "sums": pa.array(list(total), pa.list_(pa.float64()))})

    rows = (train.select("features", "y", "fold").mapInArrow(run, "fold int, i int, sums array<double>")
            .select("fold", "i", F.posexplode("sums").alias("j", "part"))
            .groupBy("fold", "i", "j").agg(F.sum("part").alias("total")).toArrow())
    n = 1 + len(features.mean) + features.weights.shape[1]
    out = {}
    fold, i, j, total = (rows[c].to_numpy() for c in ("fold", "i", "j", "total"))
    for f in np.unique(fold):
        full = np.zeros((n, n + 1))
        own = fold == f
        full[i[own], j[own]] = total[own]
        out[int(f)] = full[:, :n], full[:, n]
    return out


def _solve(gram: np.ndarray, target: np.ndarray) -> np.ndarray:
    penalty = RIDGE * max(gram[0, 0], 1.0) * np.eye(len(target))
    penalty[0, 0] = 1e-9
    return np.linalg.solve(gram + penalty, target)


def fold_of(doc_id: str = "doc_id"):
    """The remainder that tells folds apart; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3, F.lit(0)).cast("int")


def learn(measured: DataFrame, labels: DataFrame) -> Model:
    """Fit on all labelled rows outside the held-out fold 1; folds 0 and 2 calibrate each other."""
    train = labelled(measured.filter(fold_of() != 1), labels).withColumn("fold", fold_of())
    width = len(stats.FEATURES)
    moments = train.agg(F.count("*").alias("n"), F.avg("y").alias("share"), *(
        m(F.get("features", F.lit(i))).alias(f"{m.__name__}{i}") for i in range(width) for m in (F.avg, F.stddev_pop))).first()
    if not moments["n"] or moments["share"] in (0, 1):
        share = 0.5 if moments["share"] is None else moments["share"]
        flat = Features.drawn(np.zeros(width), np.ones(width))
        return Model(flat, np.zeros(1 + width + DIMENSIONS), np.zeros(1), np.array([float(share)]))
    scale = np.array([moments[f"stddev_pop{i}"] for i in range(width)])
    features = Features.drawn(np.array([moments[f"avg{i}"] for i in range(width)]), np.where(scale > 1e-12, scale, 1.0))
    sums = _equations(train, features)
    gram, target = sum(s[0] for s in sums.values()), sum(s[1] for s in sums.values())
    weights = _solve(gram, target)
    of_other = {f: _solve(gram - s[0], target - s[1]) if len(sums) > 1 else weights for f, s in sums.items()}

    def scored(batches):
        for batch in batches:
            x, fold = features(stats.matrix(batch)), batch.column("fold").to_numpy(zero_copy_only=False)
            raw = sum(np.where(fold == f, x @ w, 0.0) for f, w in of_other.items()) + np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column("y")], ["raw", "y"])

    place = F.floor((F.least(F.greatest(F.col("raw"), F.lit(-0.5)), F.lit(1.5)) + 0.5) * (SCORE_BINS / 2))
    bins = (train.select("features", "fold", "y").mapInArrow(scored, "raw double, y int").groupBy(place.alias("bin"))
            .agg(F.count("*").alias("n"), F.avg("y").alias("share"), F.avg("raw").alias("raw")).toArrow())
    order = np.argsort(bins["raw"].to_numpy(), kind="stable")
    n, share, raw = (bins[c].to_numpy().astype(np.float64)[order] for c in ("n", "share", "raw"))
    return Model(features, weights, raw, isotonic(share, n))


def score(measured: DataFrame, model: Model) -> DataFrame:
    """Add ``score`` and ``predicted`` to measured rows."""
    def run(batches):
        for batch in batches:
            out = pa.array(np.clip(model.score(stats.matrix(batch)), 0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "score"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in measured.schema)
    return measured.mapInArrow(run, f"{fields}, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score is 0.5 or more, with all their columns."""
    def run(batches):
        words.release(memories=True)
        for batch in batches:
            for step in words.steps(batch, limit=stats.STEP_BYTES):
                found = stats.statistics(step.column("text"))
                x = np.column_stack([found[f] for f in stats.FEATURES])
                yield step.filter(pa.array(model.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
