"""Exact and sketched quantiles.

``exact_quantiles`` scans a table twice, however many columns and quantiles are asked for:

1. Mergeable sketches (KLL) of all columns give each quantile a bracket, two values between which it lies. They are
   merged in two steps, so that no task receives one from every input split.
2. The values inside the brackets are counted, and the rows on that side of a bracket where fewer lie. Both
   are summed before the shuffle and written out; what is left in a bracket are about two parts in a thousand of the rows.

The rest works on what was written. A bracket with more than ``RANKED`` distinct values is cut at values that divide them evenly,
and the piece that holds the rank goes on, until few enough are left to be ranked in one task. A sketch can be wrong; a bracket without its
rank is seen by the counts, and the second scan is repeated for it with the whole range on that side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.sources.staging import stage as write_stage

#: Size of a sketch, and the share of all ranks by which it may be off: twice what it keeps to in 99 of 100 cases.
SKETCH = 8192
ROOM = 0.0015
#: Tasks in which sketches are merged first.
MERGERS = 64
#: Distinct values that are ranked in one task, and pieces into which more of them are cut.
RANKED = 100_000
PIECES = 256

Stage = Callable[[DataFrame, str], DataFrame]


def melt(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, value double), one row per column and input row, nulls kept."""
    columns = list(columns)
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value")


def _valid(name: str) -> Column:
    """The value as a double; null and NaN are null."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def _brackets(df: DataFrame, columns: list[str], quantiles: list[float]) -> dict[tuple[int, int], list]:
    """For each column and quantile that has values (by place): [number of values, low, high]."""
    sketches = [f(_valid(c)).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in (
        ("n", F.count), ("low", F.min), ("high", F.max), ("sketch", lambda v: F.kll_sketch_agg_double(v, SKETCH)))]
    merged = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("merger")).agg(*sketches)
    whole = {"n": F.sum, "low": F.min, "high": F.max, "sketch": F.kll_merge_agg_double}
    row = merged.agg(*[f(f"{name}{i}").alias(f"{name}{i}") for i in range(len(columns)) for name, f in whole.items()])
    ends = F.array(*[F.lit(min(1.0, max(0.0, q + side * ROOM))) for q in quantiles for side in (-1, 1)])
    found = row.select(*[c for i in range(len(columns)) for c in (
        f"n{i}", f"low{i}", f"high{i}", F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"sketch{i}", ends)).alias(f"ends{i}"))]).first()
    brackets = {}
    for i in range(len(columns)):
        if found[f"n{i}"]:
            for j, q in enumerate(quantiles):
                low, high = found[f"ends{i}"][2 * j:2 * j + 2]
                brackets[i, j] = [found[f"n{i}"], found[f"low{i}"] if q <= ROOM else low, found[f"high{i}"] if q >= 1 - ROOM else high]
    return brackets


def _counted(df: DataFrame, columns: list[str], quantiles: list[float], brackets: dict[tuple[int, int], list]) -> DataFrame:
    """(i, j, value, n): values inside a bracket, and with a null value the rows on its rarer side."""
    names = list(dict.fromkeys(columns[i] for i, _ in brackets))
    rows = [(columns[i], i, j, float(low), float(high), quantiles[j] >= 0.5) for (i, j), (_, low, high) in brackets.items()]
    limits = df.sparkSession.createDataFrame(rows, "column_name string, i int, j int, low double, high double, above boolean")
    values = melt(df, names).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    value, inside = F.col("value"), F.col("value").between(F.col("low"), F.col("high"))
    aside = F.when(F.col("above"), value > F.col("high")).otherwise(value < F.col("low"))
    found = values.join(F.broadcast(limits), "column_name").filter(inside | aside)  # one row for each bracket
    return found.groupBy("i", "j", F.when(inside, value).alias("value")).agg(F.count("*").alias("n"))


def _rank(n: int, q: float) -> int:
    """The rank, from 1, of the least value that at least this share of the values doesn't exceed."""
    return max(1, n - math.floor(n - q * n))


def _where(pairs: Iterable[tuple[int, int]]) -> Column:
    return reduce(or_, [(F.col("i") == i) & (F.col("j") == j) for i, j in pairs], F.lit(False))


def _narrowed(values: DataFrame, ranks: dict[tuple[int, int], int], stage: Stage) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """Cut the values of each bracket into pieces of about the same number, and keep the one with the rank."""
    shares = F.array(*[F.lit(k / PIECES) for k in range(1, PIECES)])
    cuts = values.groupBy("i", "j").agg(F.percentile_approx("value", shares, 100 * PIECES).alias("cuts"))
    piece = F.size(F.filter("cuts", lambda c: c < F.col("value")))
    pieces = stage(values.join(F.broadcast(cuts), ["i", "j"]).withColumn("piece", piece).drop("cuts"), "pieces")
    kept, left = {}, {}
    sums: dict[tuple[int, int], list] = {}
    for r in pieces.groupBy("i", "j", "piece").agg(F.sum("n").alias("n")).collect():  # at most PIECES for each bracket
        sums.setdefault((r.i, r.j), []).append((r.piece, r.n))
    for pair, parts in sums.items():
        rank = ranks[pair]
        for number, n in sorted(parts):
            if rank <= n:
                kept[pair], left[pair] = number, rank
                break
            rank -= n
    chosen = reduce(or_, [(F.col("i") == i) & (F.col("j") == j) & (F.col("piece") == k) for (i, j), k in kept.items()])
    return pieces.filter(chosen).drop("piece"), left


def exact_quantiles(df: DataFrame, columns: Iterable[str], quantiles: Iterable[float], stage: Stage = write_stage) -> DataFrame:
    """(column_name, quantile, value): the least value that reaches the rank.

    Equals SQL's ``percentile_disc``. Nulls and NaN are left out; a column that has no value has no row. The table is read
    when this is called.
    """
    columns, quantiles = list(columns), [float(q) for q in quantiles]
    brackets = _brackets(df, columns, quantiles)
    done: list[DataFrame] = []
    while brackets:
        counted = stage(_counted(df, columns, quantiles, brackets), "bracket-values")
        sums = {(r.i, r.j): r for r in counted.groupBy("i", "j").agg(
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("aside"),
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("inside"),
            F.count("value").alias("distinct")).collect()}  # one row for each bracket
        again, ranks = {}, {}
        for pair, (n, low, high) in brackets.items():
            found, q = sums.get(pair), quantiles[pair[1]]
            aside, inside = (found.aside, found.inside) if found else (0, 0)
            rank = _rank(n, q) - (n - aside - inside if q >= 0.5 else aside)
            if 1 <= rank <= inside:
                ranks[pair] = rank
            else:
                again[pair] = [n, float("-inf") if rank < 1 else low, float("inf") if rank > inside else high]
        values = counted.filter(F.col("value").isNotNull())
        large = {p: r for p, r in ranks.items() if sums[p].distinct > RANKED}
        small = {p: r for p, r in ranks.items() if p not in large}
        while True:
            if small:
                rank = F.create_map(*[x for (i, j), r in small.items() for x in (F.lit(f"{i} {j}"), F.lit(r))])
                order = Window.partitionBy("i", "j").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
                wanted = F.element_at(rank, F.concat_ws(" ", "i", "j"))
                done.append(values.filter(_where(small)).withColumn("upto", F.sum("n").over(order)).withColumn("rank", wanted).filter(
                    (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))).select("i", "j", "value"))
            if not large:
                break
            values, large = _narrowed(values.filter(_where(large)), large, stage)
            sizes = {(r.i, r.j): r["count"] for r in values.groupBy("i", "j").count().collect()}
            small = {p: r for p, r in large.items() if sizes[p] <= RANKED}
            large = {p: r for p, r in large.items() if p not in small}
        brackets = again
    if not done:
        return df.sparkSession.createDataFrame([], "column_name string, quantile double, value double")
    names, shares = F.array(*map(F.lit, columns)), F.array(*map(F.lit, quantiles))
    return reduce(DataFrame.unionByName, done).select(
        names[F.col("i")].alias("column_name"), shares[F.col("j")].alias("quantile"), "value")


def sketched_quantiles(df: DataFrame, columns: Iterable[str], quantiles: Iterable[float],
                       accuracy: int = 10000) -> DataFrame:
    """Same shape from ``percentile_approx``; one scan, for tables of moderate size.

    Choose ``accuracy`` of at least 10 / (1 - quantile), or the rank error exceeds
    the tail that the quantile cuts off.
    """
    columns, quantiles = list(columns), [float(q) for q in quantiles]
    sketch = F.percentile_approx("value", F.array(*[F.lit(q) for q in quantiles]), accuracy)
    wanted = F.array(*[F.lit(q) for q in quantiles])
    return (
        melt(df, columns).filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("column_name").agg(F.arrays_zip(wanted.alias("quantile"), sketch.alias("value")).alias("z"))
        .select("column_name", F.inline("z").alias("quantile", "value"))
    )


def one_row(quantiles: DataFrame, columns: Iterable[str]) -> Column:
    """A struct with one field per column, as a scalar subquery (a one-row result)."""
    fields = [F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(c) for c in columns]
    return quantiles.agg(F.struct(*fields)).scalar()
