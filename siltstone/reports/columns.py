"""Nulls and distinct values per column, bronze against silver."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.context import RunContext
from siltstone.operators.schema import present, union_all

COLUMN_SCHEMA = """
    table_name string, column_name string, bronze_row_count bigint, silver_row_count bigint,
    bronze_null_count bigint, silver_null_count bigint, bronze_null_rate double,
    silver_null_rate double, null_rate_improvement double, bronze_distinct_count bigint,
    silver_distinct_count bigint, created_at timestamp
"""


def layer_profile(df: DataFrame, table: str, layer: str, columns: list[str],
                  approximate: bool = True) -> DataFrame:
    """One aggregation for all columns of the layer, then one row per column."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    entries = []
    for c in columns:
        rows, nulls = F.count("*"), F.count_if(F.col(c).isNull())
        entries.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
            rows.alias(f"{layer}_row_count"), nulls.alias(f"{layer}_null_count"),
            F.coalesce(nulls / F.nullif(rows, F.lit(0)), F.lit(0.0)).alias(f"{layer}_null_rate"),
            distinct(F.col(c)).alias(f"{layer}_distinct_count")))
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def column_report(spark: SparkSession, ctx: RunContext,
                  datasets: Mapping[str, tuple[DataFrame | None, DataFrame | None]],
                  columns: Mapping[str, list[str]], approximate: bool = True,
                  on_missing: str = "skip", known: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """``datasets``: table name to (bronze, silver).

    A column that only one layer has is reported with nulls on the other side.
    ``on_missing="error"`` makes a column that neither layer has an error, unless it is ``known`` to be missing at times.
    """
    sides: dict[str, list[DataFrame]] = {"bronze": [], "silver": []}
    for table, (bronze, silver) in datasets.items():
        if bronze is None or silver is None:
            continue
        if on_missing == "error":
            unknown = set(columns[table]) - set(bronze.columns) - set(silver.columns) - set((known or {}).get(table, ()))
            if unknown:
                raise ValueError(f"{table}: no layer has the columns {sorted(unknown)}")
        for layer, df in (("bronze", bronze), ("silver", silver)):
            names = present(df, columns[table])
            if names:
                sides[layer].append(layer_profile(df, table, layer, names, approximate))
    if not sides["bronze"] or not sides["silver"]:
        return spark.createDataFrame([], COLUMN_SCHEMA)
    joined = union_all(sides["bronze"]).join(union_all(sides["silver"]), ["table_name", "column_name"], "full_outer")
    gain = F.coalesce("bronze_null_rate", F.lit(0.0)) - F.coalesce("silver_null_rate", F.lit(0.0))
    measures = [f"{layer}_{m}" for m in ("row_count", "null_count", "null_rate") for layer in ("bronze", "silver")]
    return joined.select(
        "table_name", "column_name", *measures, gain.alias("null_rate_improvement"),
        "bronze_distinct_count", "silver_distinct_count", ctx.stamp().alias("created_at"),
    ).orderBy("table_name", "column_name")
