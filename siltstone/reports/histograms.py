"""Fixed-width histograms of many columns in one aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.context import RunContext
from siltstone.operators.schema import present, union_all

HISTOGRAM_SCHEMA = """
    table_name string, column_name string, bucket_start double, bucket_end double,
    bucket_size double, bin_count bigint, created_at timestamp
"""


@dataclass(frozen=True)
class Bins:
    """Values above ``max_value`` are left out; there is no overflow bucket."""

    column: str
    size: float
    max_value: float | None = None


def histogram(df: DataFrame, table: str, specs: list[Bins]) -> DataFrame:
    """Every row yields its bucket per column; a task sends one count per bucket."""
    buckets = []
    for spec in specs:
        value = F.col(spec.column).cast("double")
        size = F.lit(float(spec.size))
        kept = value if spec.max_value is None else F.when(value <= float(spec.max_value), value)
        buckets.append(F.struct(
            F.lit(spec.column).alias("column_name"), size.alias("bucket_size"),
            (F.floor(kept / size) * size).alias("bucket_start")))
    return (
        df.select(F.inline(F.array(*buckets))).filter(F.col("bucket_start").isNotNull())
        .groupBy("column_name", "bucket_size", "bucket_start").agg(F.count("*").alias("bin_count"))
        .select(F.lit(table).alias("table_name"), "column_name", "bucket_start",
                (F.col("bucket_start") + F.col("bucket_size")).alias("bucket_end"), "bucket_size", "bin_count")
    )


def histogram_report(spark: SparkSession, ctx: RunContext, tables: Mapping[str, DataFrame | None],
                     specs: Mapping[str, list[Bins]], on_missing: str = "skip", known: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """``on_missing="error"``: a column that a table lacks is an error, unless it is ``known`` to be missing at times."""
    frames = []
    for table, df in tables.items():
        if df is None:
            continue
        names = set(present(df, [s.column for s in specs[table]], on_missing, (known or {}).get(table, ())))
        kept = [s for s in specs[table] if s.column in names]
        if kept:
            frames.append(histogram(df, table, kept))
    if not frames:
        return spark.createDataFrame([], HISTOGRAM_SCHEMA)
    return (union_all(frames).withColumn("created_at", ctx.stamp())
            .orderBy("table_name", "column_name", "bucket_start"))
