"""Nearest vectors by cosine, through cells around centres.

The centres are learned from a sample of at most ``SAMPLE`` vectors. Every vector goes to the cell of its nearest centre, and a
query looks into the ``probes`` nearest cells. Their number is measured, not guessed: the neighbours of queries in the
sample are found by comparing all of it, and ``probes`` is what reaches the asked share of them. With one cell the search is
exact. A cell of more than ``MOST`` vectors is cut into parts, and the queries of a cell into parts as well, so a task compares
two bounded groups however many vectors are alike; the best of all parts meet by query. Cells with much of the work are cut into more parts, of ``CELL``
or more, so that there is work for ``GROUPS`` tasks; no more, as a vector is sent for each part of the queries and a query for each part of the vectors.

Cosines are ranked by six digits, equal ones by id. Null vectors, and vectors of zeros, are not found and find nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.sources.staging import stage as write_stage

#: Vectors that centres and probes are learned from; queries among them.
SAMPLE = 20_000
SAMPLE_QUERIES = 500
#: Vectors, or queries, that are worth a task of their own, and the most of them that a task compares at a time.
CELL = 8192
MOST = 1 << 16
#: Groups that all comparisons are dealt into where ``MOST`` asks for no more: each sends its vectors and its queries once more.
GROUPS = 64
#: Cosines that a task holds at a time, each some six times over while they are ranked.
SCORES = 1 << 19
ROUNDS = 15
DIGITS = 6
_PLACES = 24

Stage = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Index:
    """Unit centres, one a row, and how many of the nearest cells a query looks into."""

    centres: np.ndarray
    probes: int


#: Everything in one cell: each query is compared with all vectors.
EXACT = Index(np.zeros((1, 0)), 1)


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors as rows of length one."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _usable(vectors: DataFrame) -> DataFrame:
    """(id, vector) of the vectors that have a direction, all of one length; an error where lengths differ."""
    sizes = vectors.filter("vector is not null").agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of {sizes[0]} to {sizes[1]} dimensions")
    if vectors.schema["vector"].dataType.simpleString() != "array<float>":  # those stay as they are until they are compared
        vectors = vectors.withColumn("vector", F.col("vector").cast("array<double>"))
    return vectors.filter(F.exists("vector", lambda x: x != 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x)))


def _means(x: np.ndarray, cells: int, draw: np.random.Generator) -> np.ndarray:
    """Unit centres of k-means by cosine; a centre without vectors is drawn anew."""
    centres = x[draw.choice(len(x), cells, replace=False)]
    for _ in range(ROUNDS):
        cell = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        length = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), x[draw.integers(0, len(x), cells)])
    return centres


def fitted(vectors: DataFrame, k: int = 10, target: float = 0.97, cells: int | None = None, seed: int = 15) -> Index:
    """Centres and probes for ``k`` neighbours of which the share ``target`` is to be found.

    There are as many cells as the root of the number of vectors, at most a tenth of the sample. The sample is less
    dense than all vectors, so its neighbours are farther away and the share is reached with room.
    """
    usable = _usable(vectors.select("id", "vector"))
    n = usable.count()
    x = usable.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()["vector"].combine_chunks()
    if not n:
        return EXACT
    x, draw = _matrix(x), np.random.default_rng(seed)
    cells = max(1, min(cells or int(np.sqrt(n)), -(-len(x) // 10)))
    if cells == 1:
        return EXACT
    centres = _means(x, cells, draw)
    asked = draw.choice(len(x), min(SAMPLE_QUERIES, len(x)), replace=False)
    home = np.argmax(x @ centres.T, axis=1)
    ranks = np.empty((len(asked), cells), np.int64)
    np.put_along_axis(ranks, np.argsort(-(x[asked] @ centres.T), axis=1, kind="stable"), np.arange(cells)[None, :], axis=1)
    near = x[asked] @ x.T
    near[np.arange(len(asked)), asked] = -2
    best = np.argpartition(-near, min(k, len(x) - 1) - 1, axis=1)[:, :min(k, len(x) - 1)]
    needed = np.sort(np.take_along_axis(ranks, home[best], axis=1).ravel())
    return Index(centres, 1 + int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]))


def _celled(vectors: DataFrame, index: Index, probes: int) -> DataFrame:
    """Each vector with the ``probes`` nearest of the cells, one a row."""
    if len(index.centres) == 1:
        return vectors.withColumn("cell", F.lit(0))

    def run(batches):
        rows = max(1, SCORES // len(index.centres))
        for batch in (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows)):
            near = _matrix(batch.column("vector")) @ index.centres.T
            cell = np.argsort(-near, axis=1, kind="stable")[:, :probes] if probes > 1 else np.argmax(near, axis=1)[:, None]
            cell = pa.FixedSizeListArray.from_arrays(pa.array(cell.astype(np.int32).ravel()), cell.shape[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, cell.cast(pa.list_(pa.int32()))], [*batch.schema.names, "cells"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema) + ", cells array<int>"
    return vectors.mapInArrow(run, schema).withColumn("cell", F.explode("cells")).drop("cells")


def _compared(k: int):
    """The ``k`` nearest vectors of each query in a group of both."""
    def run(found: pa.Table, asked: pa.Table) -> pa.Table:
        if not found.num_rows or not asked.num_rows:
            return OUT.empty_table()
        x, ids = _matrix(found["vector"].combine_chunks()), found["id"].combine_chunks()
        order = np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable")
        x, ids = x[order], ids.take(pa.array(order))
        apart = ids.to_numpy(zero_copy_only=False)
        number = np.arange(len(apart))
        out, rows = [], max(1, SCORES // len(apart))
        for at in range(0, asked.num_rows, rows):
            part = asked.slice(at, rows)
            scaled = _matrix(part["vector"].combine_chunks()) @ x.T
            scaled *= 10**DIGITS
            scaled += 0.5
            keys = np.floor(scaled, out=scaled).astype(np.int64)
            keys <<= _PLACES
            keys += (1 << _PLACES) - 1 - number
            seen = part["seen"].combine_chunks()
            who = np.repeat(np.arange(part.num_rows), seen.value_lengths().to_numpy(zero_copy_only=False))
            what = seen.flatten().to_numpy(zero_copy_only=False)
            place = np.searchsorted(apart, what)
            here = place < len(apart)
            here[here] = apart[place[here]] == what[here]
            none = -(1 << 60)
            keys[who[here], place[here]] = none
            best = keys if keys.shape[1] <= k else np.partition(keys, keys.shape[1] - k, axis=1)[:, -k:]
            row, column = np.nonzero(best > none)
            key = best[row, column]
            item = (1 << _PLACES) - 1 - (key & ((1 << _PLACES) - 1))
            out.append(pa.table({"query": part["id"].combine_chunks().take(pa.array(row)), "id": ids.take(pa.array(item)),
                                 "cosine": pa.array((key >> _PLACES) / 10**DIGITS)}))
        return pa.concat_tables(out)

    OUT = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("cosine", pa.float64())])
    return run


def nearest(vectors: DataFrame, queries: DataFrame, index: Index, k: int = 10, stage: Stage = write_stage) -> DataFrame:
    """(query, id, cosine, place): the ``k`` nearest vectors of each query.

    ``vectors``: (id, vector), ``queries``: (id, vector, seen), where ``seen`` lists ids that are not to be found. Ids are
    numbers. The shuffle carries each vector once for each part of its cell's queries, and a query once for each part of the cells it looks into.
    """
    ids = F.col("id").cast("long").alias("id")
    found = stage(_celled(_usable(vectors.select(ids, "vector")), index, 1), "cells")
    none = F.array().cast("array<long>")
    asked = stage(_celled(_usable(queries.select(ids, "vector", F.coalesce(F.col("seen").cast("array<long>"), none).alias("seen"))),
                          index, index.probes), "probes")

    # One row a cell, and there are no more cells than centres.
    sizes = found.groupBy("cell").agg(F.count("*").alias("n")).join(asked.groupBy("cell").agg(F.count("*").alias("q")), "cell")
    work = F.col("n").cast("double") * F.col("q")
    share = F.ceil(GROUPS * work / F.sum(work).over(Window.partitionBy()))
    some = lambda c, wanted: F.greatest(F.ceil(F.col(c) / MOST), F.least(F.ceil(F.col(c) / CELL), wanted)).cast("int")
    sizes = F.broadcast(sizes.withColumn("share", share).withColumn("parts", some("n", F.col("share")))
                        .withColumn("turns", some("q", F.ceil(F.col("share") / F.col("parts")))).select("cell", "parts", "turns"))
    part, turn = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("turns")).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = found.join(sizes, "cell").withColumn("part", part).withColumn("turn", every("turns"))
    right = asked.join(sizes, "cell").withColumn("turn", turn).withColumn("part", every("parts"))
    key = ["cell", "part", "turn"]
    best = left.select(*key, "id", "vector").groupBy(*key).cogroup(right.select(*key, "id", "vector", "seen").groupBy(*key)).applyInArrow(
        _compared(k), "query long, id long, cosine double")
    order = Window.partitionBy("query").orderBy(F.desc("cosine"), "id")
    return best.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries, pairs that are to be found and the share of them that was found."""
    hit = found.select("query", "id", F.lit(1).alias("hit"))
    return exact.join(hit, ["query", "id"], "left").agg(
        F.count_distinct("query").alias("queries"), F.count("*").alias("pairs"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
