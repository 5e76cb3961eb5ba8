"""Per-item aggregates and the master table they are joined into.

Every satellite has one row per key, so the left joins neither multiply rows nor
meet a large key; each aggregate is already partitioned by the key it is joined on.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import clean


def sorted_set(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """The distinct non-null values of each key, as a sorted array."""
    return (df.filter(F.col(value).isNotNull()).groupBy(key)
            .agg(F.sort_array(F.collect_set(value)).alias(name)))


def _optional(df: DataFrame, name: str, make) -> Column | None:
    return make() if name in df.columns else None


def _aggregate(df: DataFrame, key: str, measures: dict[str, tuple[Column | None, str]]) -> DataFrame:
    """A measure without its source column is a typed null."""
    return df.groupBy(key).agg(*[
        (F.lit(None).cast(kind) if col is None else col.cast(kind)).alias(name)
        for name, (col, kind) in measures.items()
    ])


def reviews_per_item(df: DataFrame, key: str = "app_id") -> DataFrame:
    """Reviews, positive and negative ones, mean votes and a name, per item.

    The name is the least non-null one, so that it does not depend on row order.
    """
    def verdict():
        return clean.to_boolean(F.col("voted_up"), strict=True)

    return _aggregate(df, key, {
        "review_count_all_reviews": (F.count("*"), "bigint"),
        "positive_review_count": (_optional(df, "voted_up", lambda: F.count_if(verdict())), "bigint"),
        "negative_review_count": (_optional(df, "voted_up", lambda: F.count_if(~verdict())), "bigint"),
        "avg_votes_up": (_optional(df, "votes_up", lambda: F.avg(clean.to_long(df, "votes_up"))), "double"),
        "avg_votes_funny": (
            _optional(df, "votes_funny", lambda: F.avg(clean.to_long(df, "votes_funny"))), "double"),
        "game_from_reviews": (_optional(df, "game", lambda: F.min("game")), "string"),
    })


def interactions_per_item(df: DataFrame, key: str = "app_id") -> DataFrame:
    """Recommendation events per item: count, means and how many recommend it."""
    means = {"hours": "avg_recommendation_hours", "helpful": "avg_helpful", "funny": "avg_funny"}

    def mean(source: str):
        return lambda: F.avg(clean.to_double(df, source))

    return _aggregate(df, key, {
        "recommendation_event_count": (F.count("*"), "bigint"),
        **{name: (_optional(df, source, mean(source)), "double") for source, name in means.items()},
        "recommended_count": (_optional(
            df, "is_recommended", lambda: F.count_if(clean.to_boolean(F.col("is_recommended"), strict=True))),
            "bigint"),
    })


def master_table(base: DataFrame, satellites: Iterable[DataFrame | None], key: str = "app_id") -> DataFrame:
    """The base with every satellite that exists; a repeated column is an error."""
    for satellite in satellites:
        if satellite is None:
            continue
        repeated = set(base.columns) & set(satellite.columns) - {key}
        if repeated:
            raise ValueError(f"columns on both sides of the join: {sorted(repeated)}")
        base = base.join(satellite, key, "left")
    return base
