"""Where the tables of each layer are.

A table is a directory partitioned by ``batch_date``; jobs read one batch of it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources import readers


@dataclass(frozen=True)
class Source:
    """A raw source: its name, its files below the raw root and their format.

    Without a ``schema`` the types of a CSV are inferred, which reads the files once
    more; ``infer=False`` leaves every column text, which the silver jobs accept.
    """

    name: str
    pattern: str
    format: Literal["csv", "json"] = "csv"
    multi_line: bool = False
    schema: str | None = None
    infer: bool = True


# The raw sources, named by what they hold. ``{batch}`` is the batch
# date. Long quoted text spans lines, so those sources are read as multi-line.
SOURCES = [
    Source("all_reviews", "all_reviews/batch_date={batch}/*.csv.gz", multi_line=True),
    Source("rec_games", "recommendations/batch_date={batch}/games.csv"),
    Source("rec_users", "recommendations/batch_date={batch}/users.csv"),
    Source("rec_recommendations", "recommendations/batch_date={batch}/recommendations.csv"),
    Source("rec_games_meta", "recommendations/batch_date={batch}/games_metadata.json", "json", multi_line=True),
    Source("insight_games", "insights/batch_date={batch}/games/*"),
    Source("insight_genres", "insights/batch_date={batch}/genres/*"),
    Source("insight_tags", "insights/batch_date={batch}/tags/*"),
    Source("insight_categories", "insights/batch_date={batch}/categories/*"),
    Source("insight_descriptions", "insights/batch_date={batch}/descriptions/*", multi_line=True),
    Source("insight_reviews", "insights/batch_date={batch}/reviews/*", multi_line=True),
    Source("insight_promotional", "insights/batch_date={batch}/promotional/*", multi_line=True),
    Source("insight_usage", "insights/batch_date={batch}/usage/*"),
]


@dataclass(frozen=True)
class Layout:
    root: str
    sources: list[Source] = field(default_factory=lambda: list(SOURCES))

    def raw(self, source: Source, batch_date: str) -> str:
        return f"{self.root}/raw/{source.pattern.format(batch=batch_date)}"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def rejected(self, name: str) -> str:
        return f"{self.root}/silver/_rejected/{name}"

    def quality(self, name: str) -> str:
        return f"{self.root}/silver/quality/{name}"

    @property
    def metrics(self) -> str:
        """What the writes of bronze and silver have counted."""
        return f"{self.root}/_metrics"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def batch_of(table: DataFrame, batch_date: str) -> DataFrame:
    """One batch; the filter on the partition column prunes the scan."""
    return table.filter(F.col("batch_date").cast("string") == batch_date).drop("batch_date")


def read_batch(spark: SparkSession, path: str, batch_date: str, row_id: bool = False) -> DataFrame:
    """One batch of a layer table, with the file position of each row on demand."""
    table = readers.read_parquet(spark, path)
    return batch_of(readers.with_row_id(table) if row_id else table, batch_date)


def read_batch_if_any(spark: SparkSession, path: str, batch_date: str) -> DataFrame | None:
    """None where the table does not exist."""
    table = readers.read_optional(spark, path)
    return None if table is None else batch_of(table, batch_date)


def read_table_to(spark: SparkSession, path: str, batch_date: str) -> DataFrame:
    """All batches up to this one."""
    return readers.read_parquet(spark, path).filter(F.col("batch_date").cast("string") <= batch_date).drop("batch_date")
