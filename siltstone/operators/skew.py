"""Joins from many rows to one row per key that hold up under hot keys.

A key is *hot* when it has more than 1/HOT_SHARE of the counted rows, so there
are fewer than HOT_SHARE hot keys whatever the data (pigeonhole). Their lookup
rows are broadcast: a proven bound. The rows of all other keys take a shuffle join
in which no key is large. Rows with a hot or null key have nothing to find in that
join, so they carry a salt that spreads them over its tasks and matches nothing.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_SHARE = 1000


def _is_hot(counts: DataFrame, rows: str):
    """Compares with the total as a scalar subquery, a one-row result."""
    return F.col(rows) * HOT_SHARE > counts.agg(F.sum(rows)).scalar()


def _split_join(facts: DataFrame, lookup: DataFrame, hot: DataFrame, keys: list[str], how: str) -> DataFrame:
    payload = [c for c in lookup.columns if c not in keys]
    found_hot = hot.select(*keys, F.struct(*payload).alias("_hot"))
    # Always 0, but not a literal: Spark leaves literals out of the shuffle keys.
    zero = F.pmod(F.hash(*keys), F.lit(1))
    found = lookup.select(*keys, zero.alias("_salt"), F.struct(*payload).alias("_cold"))

    # The salt is a function of the row and its task, so a task that runs again
    # sends every row where it went before; exact copies spread by task.
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    content = [f.name for f in facts.schema if f.name not in keys and not isinstance(f.dataType, T.MapType)]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *content), F.lit(tasks)).cast("int")
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    salt = F.when(F.col("_hot").isNotNull() | no_key, 1 + spread).otherwise(0)
    joined = (
        facts.join(F.broadcast(found_hot), keys, "left")
        .withColumn("_salt", salt)
        .join(found, [*keys, "_salt"], "left")
        .withColumn("_hit", F.coalesce("_hot", "_cold"))
    )
    if how == "inner":
        joined = joined.filter(F.col("_hit").isNotNull())
    return joined.select(*facts.columns, *[F.col("_hit").getField(c).alias(c) for c in payload])


def counted_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left",
                 rows: str = "n") -> DataFrame:
    """Join ``lookup``, unique on ``keys``, whose column ``rows`` counts the facts of each key.

    ``how`` is ``left`` or ``inner``.
    """
    return _split_join(facts, lookup, lookup.filter(_is_hot(lookup, rows)), keys, how)


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """As ``counted_join``, for a lookup without counts: the facts are counted by a scan of the keys.

    ``facts`` is read again for the counts; give a table or a staged frame.
    """
    counts = facts.groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot_keys = counts.filter(_is_hot(counts, "_rows")).select(*keys)
    hot = lookup.join(F.broadcast(hot_keys), keys, "left_semi")  # fewer than HOT_SHARE keys
    return _split_join(facts, lookup, hot, keys, how)
