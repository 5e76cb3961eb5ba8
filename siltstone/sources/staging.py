"""Cutting lineage with a written table.

Staged tables are Parquet, so later reads of a staged table prune columns, and
they live in the shared folder that the session names in
``spark.checkpoint.dir``; a lost executor costs a re-read, not a re-run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_FOLDERS: set[str] = set()


def staging_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; without it the warehouse, which is shared as well."""
    configured = spark.sparkContext.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's own folder, which goes when the application ends."""
    folder = f"{staging_root(spark)}/staged/{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _FOLDERS.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _write_and_scan(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the frame and return a scan of what was written.

    The table stays until the application ends, as the scan is lazy; jobs use ``staged_tables``, which
    cleans up earlier.
    """
    return _write_and_scan(df, staging_path(df.sparkSession, name))


def sorted_files(df: DataFrame, key: str, name: str) -> list[str]:
    """Write the frame in the order of a column and return its Parquet files in that order, for ``in_order`` in tasks."""
    return sorted(stage(df.orderBy(key), name).inputFiles(), key=lambda file: file.rsplit("/", 1)[1])


def in_order(files: list[str], rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """The rows of ``sorted_files``, some at a time, as a task reads them from the shared folder."""
    for file in files:
        uri = file.replace("s3a://", "s3://", 1)
        if uri.startswith("file:"):
            store, path = fs.LocalFileSystem(), unquote("/" + uri.removeprefix("file:").lstrip("/"))
        else:
            store, path = fs.FileSystem.from_uri(uri)
        with store.open_input_file(path) as source:
            yield from pq.ParquetFile(source, buffer_size=1 << 20).iter_batches(rows)  # pages, not whole columns


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``stage`` for one job; its tables are deleted when the job is over."""
    folder = staging_path(spark, "job")

    def stage_in_folder(df: DataFrame, name: str) -> DataFrame:
        return _write_and_scan(df, f"{folder}/{name}-{uuid.uuid4().hex}")

    try:
        yield stage_in_folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def use_checkpoints(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` and ALS a checkpoint folder where none is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(staging_root(spark))
