"""Files in the shared staging folder that tasks write and read by byte ranges.

Spark has no sink or source for flat binary files that can be read in parts, so tasks
use Arrow's file systems. A task writes under a name of its own and reports it in the
rows that it returns; files of lost attempts are in no row and nobody reads them.
"""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm import words
from siltstone.sources.staging import staging_path

#: Text bytes of a block: what one task holds at a time, some fifteen times over while it works.
BLOCK_BYTES = 2 << 20
_SHIPPED: set[int] = set()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, as a URI."""
    path = staging_path(spark, name)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it."""
    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str) -> str:
    """A name that no other attempt of this or another task takes."""
    return f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"


def write_bytes(uri: str, parts: list[bytes]) -> int:
    store, path = opened(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(path, compression=None) as out:
        return sum(out.write(part) or len(part) for part in parts)


def read_bytes(uri: str, start: int, length: int) -> bytes:
    store, path = opened(uri)
    with store.open_input_file(path) as file:
        return file.read_at(length, start)


def file_sizes(folder: str) -> list[tuple[str, int]]:
    """Every file of a folder by name, and its bytes."""
    store, path = opened(folder)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    scheme = folder.split(path)[0] if path in folder else ""
    return sorted((f"{scheme}{f.path}", f.size) for f in found if f.type == fs.FileType.File)


def write_blocks(docs: DataFrame, folder: str, limit: int = BLOCK_BYTES) -> DataFrame:
    """Write all rows and columns as block files in the order given.

    Returns (block, file, n_rows) lazily; stage it before it is read twice. A block's number tells its
    place: Spark's partition, then the block in it.
    """
    def run(batches):
        partition, n, kept, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal n, kept, size
            file = new_file(folder, ".parquet")
            store, path = opened(file)
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            table = pa.Table.from_batches(kept)
            pq.write_table(table, path, filesystem=store, compression="zstd")
            out = pa.RecordBatch.from_pydict(
                {"block": [(partition << 32) + n], "file": [file], "n_rows": [table.num_rows]})
            n, kept, size = n + 1, [], 0
            return out

        for batch in batches:
            for step in words.steps(batch, limit=limit // 4):
                kept.append(step)
                size += step.nbytes
                if size >= limit:
                    yield flush()
        if kept:
            yield flush()

    return docs.mapInArrow(run, "block long, file string, n_rows long")


def read_block(file: str, columns: list[str] | None = None) -> pa.RecordBatch:
    """The rows of a block file, in the order in which they were written."""
    store, path = opened(file)
    return pq.read_table(path, filesystem=store, columns=columns).combine_chunks().to_batches()[0]


def texts(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and the starts of each text in it; null is empty."""
    text = text.fill_null("")
    at = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1 + text.offset)[text.offset:].astype(np.int64)
    data = text.buffers()[2]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(text) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def with_starts(blocks: DataFrame, size: str, start: str) -> DataFrame:
    """Add to each row of (block, ``size``, ...) the sum of ``size`` over the blocks before it.

    In two levels, so no window holds more than the blocks of one task or one row for each task.
    """
    part = F.shiftright("block", 32)
    each = blocks.groupBy(part.alias("_part")).agg(F.sum(size).alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    each = each.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum(size).over(Window.partitionBy("_part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return (blocks.withColumn("_part", part).join(each, "_part")
            .withColumn(start, F.coalesce(inside, F.lit(0)) + F.col("_before")).drop("_part", "_before"))


def ordered(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in ascending order of doc_id over all tasks; equal ids by a hash of the text, null ids first."""
    tie = F.xxhash64("text")  # and not the text itself: Spark samples the keys to find the ranges
    return docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)


def ship(spark: SparkSession) -> None:
    """Give this package to the workers of a session that was started elsewhere than in its folder."""
    root = Path(__file__).resolve().parents[2]
    if str(root) in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] or id(spark.sparkContext) in _SHIPPED:
        return
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for file in sorted((root / "siltstone").rglob("*.py")):
            archive.write(file, file.relative_to(root))
    uri = f"{shared_folder(spark, 'package')}/siltstone.zip"
    write_bytes(uri, [content.getvalue()])
    spark.sparkContext.addPyFile(uri)
    _SHIPPED.add(id(spark.sparkContext))
