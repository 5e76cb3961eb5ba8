"""How often each quality issue occurs among the rejected rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.context import RunContext
from siltstone.operators import rules
from siltstone.operators.schema import union_all

ISSUE_SCHEMA = """
    table_name string, issue_name string, issue_count bigint,
    issue_rate_on_bronze double, issue_rate_on_rejected double, created_at timestamp
"""
ISSUE_COLUMN = "quality_issue"


def _issue_array(df: DataFrame):
    """Accept the array and the ``|``-joined text form."""
    for name in (rules.ISSUES, ISSUE_COLUMN):
        if name in df.columns:
            is_text = isinstance(df.schema[name].dataType, T.StringType)
            return rules.from_text(F.col(name)) if is_text else F.col(name)
    return None


def issue_report(spark: SparkSession, ctx: RunContext,
                 datasets: Mapping[str, tuple[DataFrame | None, DataFrame | None]]) -> DataFrame:
    """``datasets``: table name to (bronze, rejected). One count per single issue."""
    counted, sizes = [], []
    for table, (bronze, rejected) in datasets.items():
        issues = None if rejected is None else _issue_array(rejected)
        if bronze is None or issues is None:
            continue
        name = F.lit(table).alias("table_name")
        counted.append(
            rejected.select(F.explode(issues).alias("issue_name"))
            .withColumn("issue_name", F.trim("issue_name")).filter(F.col("issue_name") != "")
            .groupBy("issue_name").agg(F.count("*").alias("issue_count"))
            .select(name, "issue_name", "issue_count"))
        sizes.append(bronze.agg(F.count("*").alias("bronze"), F.lit(0).cast("bigint").alias("rejected"))
                     .select(name, "bronze", "rejected"))
        sizes.append(rejected.agg(F.lit(0).cast("bigint").alias("bronze"), F.count("*").alias("rejected"))
                     .select(name, "bronze", "rejected"))
    if not counted:
        return spark.createDataFrame([], ISSUE_SCHEMA)
    totals = union_all(sizes).groupBy("table_name").agg(
        F.sum("bronze").alias("bronze"), F.sum("rejected").alias("rejected"))
    rate = {
        f"issue_rate_on_{side}": F.coalesce(F.col("issue_count") / F.nullif(F.col(side), F.lit(0)), F.lit(0.0))
        for side in ("bronze", "rejected")
    }
    return (
        union_all(counted).join(F.broadcast(totals), "table_name")  # one row per table
        .select("table_name", "issue_name", "issue_count", *[c.alias(n) for n, c in rate.items()],
                ctx.stamp().alias("created_at"))
        .orderBy("table_name", F.desc("issue_count"), "issue_name")
    )
