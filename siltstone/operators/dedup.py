"""Duplicate keys, by policy.

All three policies pre-aggregate per key before the shuffle instead of numbering
the rows of a key in a window, so a key that holds a large share of the table
never sits in one task.

The keys that have copies are found first. With ``stage`` they are written before
the rows are matched with them: Spark then knows their size, so where they are few
it broadcasts them and the table itself is not shuffled at all.

``order_by`` must order the rows of a key totally. A table without such a column
is read with ``sources.readers.with_row_id`` and ordered by ``ROW_ID``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.skew import counted_join

DUPLICATE = "is_duplicate"
COPIES = "_copies"

Stage = Callable[[DataFrame, str], DataFrame]


def _with_key(df: DataFrame, keys: list[str]) -> DataFrame:
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def _order(order_by: list[str]):
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)


def mark_all_copies(df: DataFrame, keys: list[str], stage: Stage | None = None) -> DataFrame:
    """Policy reject_all: every row of a key with more than one row is marked.

    A null key is no duplicate. Only keys with copies take part in the join.
    """
    repeated = (
        _with_key(df, keys).groupBy(*keys).agg(F.count("*").alias(COPIES)).filter(F.col(COPIES) > 1)
    )
    if stage is not None:
        repeated = stage(repeated, "repeated-keys")
    marked = counted_join(df, repeated, keys, rows=COPIES)
    return marked.withColumn(DUPLICATE, F.col(COPIES).isNotNull()).drop(COPIES)


def mark_later_copies(df: DataFrame, keys: list[str], order_by: list[str],
                      stage: Stage | None = None) -> DataFrame:
    """Policy reject_rest: every row but the first of its key is marked."""
    first = (
        _with_key(df, keys).groupBy(*keys)
        .agg(F.count("*").alias(COPIES), F.min(_order(order_by)).alias("_first"))
        .filter(F.col(COPIES) > 1)
    )
    if stage is not None:
        first = stage(first, "first-rows")
    marked = counted_join(df, first, keys, rows=COPIES)
    later = F.col(COPIES).isNotNull() & ~_order(order_by).eqNullSafe(F.col("_first"))
    return marked.withColumn(DUPLICATE, later).drop(COPIES, "_first")


def keep_first(df: DataFrame, keys: list[str], order_by: list[str], unique: bool = False,
               stage: Stage | None = None) -> DataFrame:
    """Policy drop_rest: the first row of each key, nothing else.

    With ``unique`` no two rows of a key are equal in ``order_by`` (the row's file position, for instance). Then only keys and
    that order are aggregated, and the winners are fetched by them: no other column is sorted, aggregated or compared, and where few keys have
    copies the rows are not shuffled. Without it the first row is found with all its columns. A null key is a key.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    if unique:
        known = mark_later_copies(_with_key(df, keys), keys, order_by, stage)
        without = df.filter(reduce(or_, [F.col(k).isNull() for k in keys]))
        return known.filter(~F.col(DUPLICATE)).select(*df.columns).unionByName(keep_first(without, keys, order_by))
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), _order(order_by)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)
