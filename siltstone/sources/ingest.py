"""Raw files to bronze Parquet, with the metadata of the run."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.context import RunContext
from siltstone.sources import readers, sinks
from siltstone.sources.layout import Layout, Source


def read_source(spark: SparkSession, source: Source, path: str) -> DataFrame:
    if source.format == "json":
        return readers.read_json(spark, path, source.schema, source.multi_line)
    return readers.read_csv(spark, path, source.schema, infer_schema=source.infer, multi_line=source.multi_line)


def with_ingest_metadata(df: DataFrame, ctx: RunContext, source_name: str,
                         file_column: str | None = "source_file",
                         batch_column: str | None = "batch_date",
                         time_column: str = "bronze_ingested_at") -> DataFrame:
    """Add the batch, the run's time, the source and the file of every row.

    For a frame that scans files directly, as the file comes from the scan.
    """
    added = {time_column: ctx.stamp(), "source_name": F.lit(source_name)}
    if batch_column:
        added[batch_column] = ctx.batch()
    if file_column:
        added[file_column] = F.col("_metadata.file_path")
    return df.select("*", *[c.alias(n) for n, c in added.items()])


def ingest(spark: SparkSession, layout: Layout, ctx: RunContext,
           sources: Iterable[Source] | None = None) -> list[str]:
    """Read every source and replace its batch in bronze; returns the table names."""
    done = []
    for source in sources if sources is not None else layout.sources:
        raw = read_source(spark, source, layout.raw(source, ctx.batch_date))
        tagged = with_ingest_metadata(raw, ctx, source.name)
        sinks.write_measured(tagged, layout.bronze(source.name), ctx.batch_date, layout.metrics, f"bronze/{source.name}")
        done.append(source.name)
    return done
