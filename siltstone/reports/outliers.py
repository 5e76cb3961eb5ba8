"""Outliers by the interquartile range, for all columns of a table at once."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.context import RunContext
from siltstone.operators import quantiles
from siltstone.operators.schema import present, union_all

OUTLIER_SCHEMA = """
    table_name string, column_name string, row_count bigint, non_null_count bigint,
    outlier_count bigint, outlier_rate double, q1 double, q3 double, iqr double,
    lower_bound double, upper_bound double, min_value double, max_value double,
    mean_value double, created_at timestamp
"""
FENCE = 1.5


def iqr_profile(df: DataFrame, table: str, columns: list[str], accuracy: int | None = None) -> DataFrame:
    """Quartiles, fences and the values strictly outside them, per column: one aggregation for all of them.

    A column without values keeps its row, with zero counts and null statistics.
    """
    quartiles = (
        quantiles.exact_quantiles(df, columns, [0.25, 0.75]) if accuracy is None
        else quantiles.sketched_quantiles(df, columns, [0.25, 0.75], accuracy)
    )
    of = {(r.column_name, r["quantile"]): r.value for r in quartiles.collect()}  # two rows a column
    entries = []
    for name in columns:
        value = F.col(f"`{name}`").cast("double")
        q1, q3 = of.get((name, 0.25)), of.get((name, 0.75))
        none = q1 is None or q3 is None
        iqr = None if none else q3 - q1
        bounds = {"q1": q1, "q3": q3, "iqr": iqr, "lower_bound": None if none else q1 - FENCE * iqr,
                  "upper_bound": None if none else q3 + FENCE * iqr}
        outside = F.lit(False) if none else (value < bounds["lower_bound"]) | (value > bounds["upper_bound"])
        valid, outliers = F.count(value), F.count_if(outside)
        rate = F.coalesce(outliers / F.nullif(valid, F.lit(0)), F.lit(0.0))
        entries.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(name).alias("column_name"), F.count("*").alias("row_count"),
            valid.alias("non_null_count"), outliers.alias("outlier_count"), rate.alias("outlier_rate"),
            *[F.lit(x).cast("double").alias(b) for b, x in bounds.items()],
            F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.avg(value).alias("mean_value")))
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def outlier_report(spark: SparkSession, ctx: RunContext, tables: Mapping[str, DataFrame | None],
                   columns: Mapping[str, list[str]], accuracy: int | None = None,
                   on_missing: str = "skip", known: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """``on_missing="error"``: a column that a table lacks is an error, unless it is ``known`` to be missing at times."""
    frames = []
    for table, df in tables.items():
        names = [] if df is None else present(df, columns[table], on_missing, (known or {}).get(table, ()))
        if names:
            frames.append(iqr_profile(df, table, names, accuracy))
    if not frames:
        return spark.createDataFrame([], OUTLIER_SCHEMA)
    return union_all(frames).withColumn("created_at", ctx.stamp()).orderBy("table_name", "column_name")
