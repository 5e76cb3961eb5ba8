"""Column profiles: one scan per table, however many columns it has.

``summary`` gives rows that can be merged: counts, sums of squares about the mean and a sketch (HLL) of the distinct values of
each column. A profile is made of merged rows, so the profile of many batches needs their summaries, not their data. Sketches
are merged in two steps, so that no task receives one from every input split. The number of distinct
values is an estimate with a standard error of 0.8 %.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.schema import union_all

PROFILE_SCHEMA = """
    table_name string, column_name string, row_count bigint, null_count bigint,
    null_ratio double, data_type string, min_value double, max_value double,
    avg_value double, stddev_value double, distinct_count bigint
"""
SUMMARY_SCHEMA = """
    table_name string, column_name string, data_type string, row_count bigint, null_count bigint,
    value_count bigint, min_value double, max_value double, mean_value double, squares double, distinct_sketch binary
"""
# Logarithm of the cells of a sketch; the standard error is about 1.04 / sqrt(2 ** CELLS).
CELLS = 14
# Tasks in which the sketches of a table are merged first.
MERGERS = 64
NUMERIC_SCHEMA = """
    table_name string, column_name string, min_value double, max_value double,
    avg_value double, stddev_value double
"""

_NUMERIC_STATS = {"min_value": F.min, "max_value": F.max, "avg_value": F.avg, "stddev_value": F.stddev}


def _is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def _rows(df: DataFrame, fields: list[T.StructField], entry: Callable) -> DataFrame:
    """One aggregation whose one row holds an entry per column, then a row per entry."""
    entries = F.array(*[F.struct(*entry(f)) for f in fields])
    return df.agg(entries.alias("e")).select(F.inline("e"))


def _null_entry(table: str, field: T.StructField) -> list:
    col = F.col(f"`{field.name}`")
    rows, nulls = F.count("*"), F.count_if(col.isNull())
    return [
        F.lit(table).alias("table_name"), F.lit(field.name).alias("column_name"),
        rows.alias("row_count"), nulls.alias("null_count"),
        F.coalesce(nulls / F.nullif(rows, F.lit(0)), F.lit(0.0)).alias("null_ratio"),
        F.lit(str(field.dataType)).alias("data_type"),
    ]


def _numeric_entry(field: T.StructField) -> list:
    col = F.col(f"`{field.name}`")
    return [
        (stat(col) if _is_numeric(field) else F.lit(None)).cast("double").alias(name)
        for name, stat in _NUMERIC_STATS.items()
    ]


def profile_columns(df: DataFrame, table: str) -> DataFrame:
    """Rows, nulls and type of every column."""
    return _rows(df, df.schema.fields, lambda f: _null_entry(table, f))


def profile_numeric(df: DataFrame, table: str) -> DataFrame:
    """Least, greatest, mean and sample deviation of the numeric columns."""
    fields = [f for f in df.schema.fields if _is_numeric(f)]
    if not fields:
        return df.sparkSession.createDataFrame([], NUMERIC_SCHEMA)
    return _rows(df, fields, lambda f: [
        F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"), *_numeric_entry(f)])


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def _summary_entry(table: str, field: T.StructField) -> list:
    col = F.col(f"`{field.name}`")
    number = col.cast("double") if _is_numeric(field) else F.lit(None).cast("double")
    # Any type is hashed first, so a sketch is one of 64-bit numbers; maps have no hash of their own.
    hashed = F.xxhash64(col.cast("string") if _has_map(field.dataType) else col)
    return [
        F.lit(table).alias("table_name"), F.lit(field.name).alias("column_name"), F.lit(str(field.dataType)).alias("data_type"),
        F.count("*").alias("row_count"), F.count_if(col.isNull()).alias("null_count"), F.count(number).alias("value_count"),
        F.min(number).alias("min_value"), F.max(number).alias("max_value"), F.avg(number).alias("mean_value"),
        (F.var_pop(number) * F.count(number)).alias("squares"),
        F.hll_sketch_agg(F.when(col.isNotNull(), hashed), CELLS).alias("distinct_sketch"),
    ]


def summary(df: DataFrame, table: str) -> DataFrame:
    """Rows that ``merged`` adds up, a few for each column; a table without rows has rows of zeros."""
    fields = df.schema.fields
    entries = F.array(*[F.struct(*_summary_entry(table, f)) for f in fields])
    parts = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("_merger")).agg(entries.alias("e")).select(F.inline("e"))
    zeros = df.sparkSession.createDataFrame(
        [(table, f.name, str(f.dataType), 0, 0, 0, None, None, None, None, None) for f in fields], SUMMARY_SCHEMA)
    return parts.unionByName(zeros)


def merged(summaries: DataFrame) -> DataFrame:
    """One row for each column of the union of what the summaries are of, again a summary.

    Squares about the means of the parts and the squares of the distances of these means add up to those about the whole mean.
    """
    part = F.struct("value_count", "mean_value")
    rows = summaries.groupBy("table_name", "column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.sum("value_count").alias("value_count"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.sort_array(F.collect_list(F.when(F.col("value_count") > 0, part))).alias("_parts"),  # a number for each merger or batch
        F.sum("squares").alias("squares"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"))
    zero = F.lit(0.0)
    rows = rows.withColumn("mean_value", F.aggregate(
        "_parts", zero, lambda s, p: s + p["value_count"] * p["mean_value"]) / F.nullif(F.col("value_count"), F.lit(0)))
    between = F.aggregate("_parts", zero, lambda s, p: s + p["value_count"] * F.pow(p["mean_value"] - F.col("mean_value"), F.lit(2.0)))
    return rows.withColumn("squares", F.col("squares") + between).select(*T._parse_datatype_string(SUMMARY_SCHEMA).names)


def profile_of(summaries: DataFrame) -> DataFrame:
    """The profile of all that the summaries are of; no numbers for columns that hold none."""
    rows = merged(summaries)
    return rows.select(
        "table_name", "column_name", "row_count", "null_count",
        F.coalesce(F.col("null_count") / F.nullif(F.col("row_count"), F.lit(0)), F.lit(0.0)).alias("null_ratio"),
        "data_type", "min_value", "max_value", F.col("mean_value").alias("avg_value"),
        F.when(F.col("value_count") > 1, F.sqrt(F.col("squares") / (F.col("value_count") - 1))).alias("stddev_value"),
        F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)).alias("distinct_count"))


def profile_table(df: DataFrame, table: str) -> DataFrame:
    """Rows, nulls, type, numbers and distinct values of every column."""
    return profile_of(summary(df, table))


def summarize(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """The summaries of all tables that exist; an error if none does."""
    found = {name: df for name, df in tables.items() if df is not None}
    if not found:
        raise ValueError("no table to profile")
    return union_all(summary(df, name) for name, df in found.items())


def profile_tables(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """One profile of all tables that exist; an error if none does."""
    return profile_of(summarize(tables))


def profile_distribution(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """All values of each column with their number, the most frequent first, and how many there are.

    Values are counted before they are ranked by number; those with the same number share a rank, which
    depends on the numbers alone, so the ranking sees one row for each column and number.
    """
    values = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value").filter(F.col("value").isNotNull())
    counted = values.groupBy("column_name", "value").agg(F.count("*").alias("value_count"))
    distinct = counted.groupBy("column_name").agg(F.count("*").alias("distinct_count"))
    numbers = counted.groupBy("column_name", "value_count").agg(F.count("*").alias("_values"))
    before = (Window.partitionBy("column_name").orderBy(F.desc("value_count"))
              .rowsBetween(Window.unboundedPreceding, -1))
    ranks = numbers.select("column_name", "value_count", (F.coalesce(F.sum("_values").over(before), F.lit(0)) + 1).alias("value_rank"))
    ranked = counted.join(ranks, ["column_name", "value_count"])
    return ranked.join(distinct, "column_name").select(
        F.lit(table).alias("table_name"), "column_name", "distinct_count", "value_rank", "value", "value_count")
