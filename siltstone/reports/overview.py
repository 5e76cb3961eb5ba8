"""Rows of each layer, rates and row conservation, one row per table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.context import RunContext
from siltstone.operators.outliers import FLAG
from siltstone.operators.schema import union_all

OVERVIEW_SCHEMA = """
    table_name string, bronze_row_count bigint, silver_row_count bigint,
    rejected_row_count bigint, silver_outlier_count bigint, rejected_rate double,
    retention_rate double, silver_outlier_rate double, row_delta bigint,
    column_count_bronze bigint, column_count_silver bigint, overview_created_at timestamp
"""

COUNTS_SCHEMA = "table_name string, layer string, row_count bigint, outliers bigint, columns bigint"


@dataclass(frozen=True)
class Layers:
    """The frames of a table by layer; a missing one counts as empty."""

    bronze: DataFrame | None
    silver: DataFrame | None
    rejected: DataFrame | None


def _counts(table: str, layer: str, df: DataFrame) -> DataFrame:
    outliers = F.count_if(F.col(FLAG)) if layer == "silver" and FLAG in df.columns else F.lit(0).cast("bigint")
    return df.agg(F.count("*").alias("row_count"), outliers.alias("outliers")).select(
        F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), "row_count", "outliers",
        F.lit(len(df.columns)).cast("bigint").alias("columns"))


def overview(spark: SparkSession, ctx: RunContext, datasets: dict[str, Layers]) -> DataFrame:
    """One count per table and layer, turned into columns by table."""
    counts = [
        _counts(table, layer, df)
        for table, layers in datasets.items()
        for layer, df in vars(layers).items() if df is not None
    ]
    if not counts:
        return overview_of(spark, ctx, list(datasets), spark.createDataFrame([], COUNTS_SCHEMA))
    return overview_of(spark, ctx, list(datasets), union_all(counts))


def written_layers(written: DataFrame, bronze_of: dict[str, str]) -> DataFrame:
    """Counts by table and layer out of what the writes have counted; ``bronze_of`` names each table's bronze table."""
    places = {f"{layer}/{name}": (table, layer) for table, bronze in bronze_of.items()
              for layer, name in (("bronze", bronze), ("silver", table), ("rejected", table))}
    named = written.sparkSession.createDataFrame([(n, *p) for n, p in places.items()], "table_name string, of string, layer string")
    outliers = F.when(F.col("layer") == "silver", F.col("flagged")).otherwise(0)
    return written.join(F.broadcast(named), "table_name").select(  # three rows a table
        F.col("of").alias("table_name"), "layer", "row_count", outliers.alias("outliers"), "columns")


def overview_of(spark: SparkSession, ctx: RunContext, tables: list[str], counts: DataFrame) -> DataFrame:
    """The overview from ``COUNTS_SCHEMA`` rows; a layer without a row counts as empty."""
    names = spark.createDataFrame([(t,) for t in tables], "table_name string")

    def of(layer: str, measure: str):
        return F.coalesce(F.sum(F.when(F.col("layer") == layer, F.col(measure))), F.lit(0).cast("bigint"))

    def rate(part: str, whole: str):
        return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))

    wide = names.join(counts, "table_name", "left").groupBy("table_name").agg(
        of("bronze", "row_count").alias("bronze_row_count"),
        of("silver", "row_count").alias("silver_row_count"),
        of("rejected", "row_count").alias("rejected_row_count"),
        of("silver", "outliers").alias("silver_outlier_count"),
        of("bronze", "columns").alias("column_count_bronze"),
        of("silver", "columns").alias("column_count_silver"))
    return wide.select(
        "table_name", "bronze_row_count", "silver_row_count", "rejected_row_count", "silver_outlier_count",
        rate("rejected_row_count", "bronze_row_count").alias("rejected_rate"),
        rate("silver_row_count", "bronze_row_count").alias("retention_rate"),
        rate("silver_outlier_count", "silver_row_count").alias("silver_outlier_rate"),
        (F.col("bronze_row_count") - F.col("silver_row_count") - F.col("rejected_row_count")).alias("row_delta"),
        "column_count_bronze", "column_count_silver", ctx.stamp().alias("overview_created_at"))
