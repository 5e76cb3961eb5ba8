"""Registry of the queries that are checked against SQL on the same tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from siltstone.checks import fixtures
from siltstone.context import RunContext

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CONTEXT = RunContext(
    batch_date="2024-01-01", processed_at=fixtures.PROCESSED_AT, as_of=fixtures.AS_OF, store="store")


class Tables:
    """The given tables by name, and the fixtures that Spark derives from them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def fixture(self, name: str) -> DataFrame:
        sql, inputs = fixtures.FIXTURES[name]
        return self.spark.sql(sql, **{t: self.table(t) for t in inputs})

    def select(self, sql: str, *inputs: str) -> DataFrame:
        """Spark SQL over given tables, written as ``{table}``."""
        return self.spark.sql(sql, **{t: self.table(t) for t in inputs})

    @cached_property
    def ctx(self) -> RunContext:
        return CONTEXT


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables)``; ``oracle`` may use the fixtures as table names."""
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, path: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, path))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = fixtures.with_fixtures(oracle)
        return fn
    return register
