"""Scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_ID = ["_file", "_row"]
CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path, schema: T.StructType | str | None = None, header: bool = True,
             infer_schema: bool = True, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """CSV, plain or compressed, one path, a glob or a list.

    With a ``schema`` there is no inference scan, and a line that does not fit
    is kept in ``_corrupt_record`` if the schema has that column. ``multi_line``
    is for quoted text that spans lines; such a file cannot be split, so leave it
    off for plain tables. Quotes inside a quoted field are doubled.
    """
    reader = (
        spark.read.option("header", header).option("sep", sep)
        .option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("mode", "PERMISSIVE")
    )
    if schema is None:
        return reader.option("inferSchema", infer_schema).csv(path)
    return reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def read_json(spark: SparkSession, path, schema: T.StructType | str | None = None,
              multi_line: bool = True) -> DataFrame:
    """JSON; ``multi_line=False`` for one object per line, which can be split."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def with_row_id(table: DataFrame) -> DataFrame:
    """Add the file and the position in it: a total order that a re-read repeats.

    For a frame that scans Parquet files directly.
    """
    return table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def if_any(scan: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame of the scan, or None where there are no files; other errors are raised."""
    try:
        return scan()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_optional(spark: SparkSession, path) -> DataFrame | None:
    """The Parquet table, or None where there is none."""
    return if_any(lambda: spark.read.parquet(path))


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def parse_json(text: str | F.col, schema: str):
    """A struct out of JSON text held in a column."""
    return F.from_json(text, schema)
