"""Token counts of documents in flat token files that have no index.

A flat file holds nothing but ids of fixed width, each document followed by the
separator id. Tasks read blocks of fixed size by byte range and find the separators of
a block with one comparison over the array. What a block needs from those before it is
the place of their last separator and their number: a running maximum and a running
sum over one narrow row for each block.

Tokens behind the last separator of a file are a document that is not terminated. A
separator right after another ends an empty document. An empty file has no documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm import files, words
from siltstone.llm.tokens import byte_tokenizer

BLOCK_TOKENS = 1 << 22


def width_of(path: str, separator: int) -> int:
    """Bytes of an id: 2 if the vocabulary and the separator allow it, else 4."""
    return 2 if max(byte_tokenizer(path, special_as_text=True).n_ids, separator + 1) <= 1 << 16 else 4


def write_flat(docs: DataFrame, folder: str, path: str, separator: int) -> DataFrame:
    """Write the ids of whole texts as they come, each followed by ``separator``.

    One flat file of unsigned little-endian ids for each task, as wide as ``width_of`` says. The string of the separator
    inside a text is ordinary text. Null texts are empty. Returns (file, place, doc_id) lazily:
    the place of each document in its file; stage it, then the files are there.
    """
    def run(batches):
        file = files.new_file(folder, ".bin")
        store, name = files.opened(file)
        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
        coder, place, kind = byte_tokenizer(path, special_as_text=True), 0, f"<u{width_of(path, separator)}"
        with store.open_output_stream(name, compression=None) as out:
            for batch in batches:
                for step in words.steps(batch):
                    ids, starts = coder.encode(step.column("text"))
                    out.write(np.insert(ids, starts[1:], separator).astype(kind).tobytes())
                    n = step.num_rows
                    yield pa.RecordBatch.from_pydict({
                        "file": [file] * n, "place": pa.array(range(place, place + n), pa.int64()),
                        "doc_id": step.column("doc_id")})
                    place += n

    return docs.select("doc_id", "text").mapInArrow(run, "file string, place long, doc_id long")


def scan_flat(sizes: DataFrame, separator: int, width: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents of flat files with ids of ``width`` bytes, given as (file, n_bytes).

    Returns (file, place, start, n_tokens, terminated): the start in tokens of the file, the number without
    the separator.
    """
    step = block_tokens * width
    blocks = (sizes.filter("n_bytes > 0")
              .select("file", "n_bytes", F.explode(F.sequence(F.lit(0), F.expr(f"(n_bytes - 1) div {step}"))).alias("block"))
              .repartition(max(1, sizes.agg(F.sum(F.ceil(F.col("n_bytes") / step))).first()[0] or 1), "file", "block"))

    def run(batches):
        for batch in batches:
            for file, n_bytes, block in zip(*(c.to_pylist() for c in batch.columns)):
                if n_bytes % width:
                    raise ValueError(f"{file}: {n_bytes} bytes are not whole tokens")
                begin = block * step
                ids = np.frombuffer(files.read_bytes(file, begin, min(step, n_bytes - begin)), f"<u{width}")
                ends = np.flatnonzero(ids == separator) + begin // width
                last = begin // width + len(ids)
                yield pa.RecordBatch.from_pydict({
                    "file": [file], "block": pa.array([block], pa.int64()), "ends": pa.array([ends], pa.list_(pa.int64())),
                    "rest": pa.array([last if begin + step >= n_bytes else None], pa.int64())})

    found = blocks.mapInArrow(run, "file string, block long, ends array<long>, rest long")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = (found.withColumn("n", F.size("ends"))
              .withColumn("last", F.when(F.col("n") > 0, F.element_at("ends", -1)))
              .withColumn("carry", F.coalesce(F.max("last").over(before) + 1, F.lit(0)))
              .withColumn("first_place", F.coalesce(F.sum("n").over(before), F.lit(0))))
    # The end of the file closes a document only if tokens are left behind the last separator.
    open_end = F.col("rest") > F.coalesce(F.greatest(F.col("last") + 1, "carry"), "carry")
    closed = F.transform("ends", lambda end, i: F.struct(
        i.alias("i"), end.alias("end"), F.lit(True).alias("terminated"),
        F.when(i == 0, F.col("carry")).otherwise(F.get("ends", i - 1) + 1).alias("start")))
    rest = F.array(F.struct(
        F.col("n").alias("i"), F.col("rest").alias("end"), F.lit(False).alias("terminated"),
        F.coalesce(F.col("last") + 1, "carry").alias("start")))
    docs = placed.select("file", "first_place", F.explode(
        F.when(open_end, F.concat(closed, rest)).otherwise(closed)).alias("d"))
    return docs.select("file", (F.col("first_place") + F.col("d.i")).alias("place"), "d.start",
                       (F.col("d.end") - F.col("d.start")).alias("n_tokens"), "d.terminated")
