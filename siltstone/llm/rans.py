"""Token files coded with a static range asymmetric numeral system.

One frequency table, counted over the whole corpus, codes every block. A block holds
whole documents and is decoded on its own: its tokens are dealt over interleaved lanes,
each with its own state, so one numpy operation moves all lanes by one symbol. Every
few rows of lanes a checkpoint keeps the states and the place in the words, from which
decoding can begin in parallel. Header and payload carry checksums.

Block layout, little-endian: magic, header length, crc32 of the header, crc32 of the
body, header (JSON), body. The body is doc ids (i8), null flags (u1), document lengths
(u8), checkpoint states (u8), checkpoint places (u8), words (u4).

Null texts are empty: only the end id. Rows with equal or null doc_id stay apart;
null ids come first.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import files, words
from siltstone.llm.tokens import byte_tokenizer

BITS = 20  # frequencies sum to 2 ** BITS
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
LANES = 4096
CHECKPOINT_ROWS = 64
BLOCK_TOKENS = 1 << 20
MAGIC = b"RANS1\0\0\0"


class Table:
    """Frequencies of all ids that occur, scaled to a power of two, each at least 1."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, np.int64)
        seen = counts > 0
        if seen.sum() > 1 << BITS:
            raise ValueError("more different ids than slots")
        total = max(int(counts.sum()), 1)
        scaled = np.where(seen, np.maximum(1, (counts * ((1 << BITS) / total)).astype(np.int64)), 0)
        # What rounding leaves over or lacks goes to or comes from the most frequent ids.
        order, left = np.argsort(-counts, kind="stable"), (1 << BITS) - int(scaled.sum())
        if left > 0 and seen.any():
            scaled[order[0]] += left
        for i in order:
            if left >= 0:
                break
            take = min(int(scaled[i]) - 1, -left)
            scaled[i] -= take
            left += take
        self.freq = scaled.astype(np.uint64)
        self.first = (np.cumsum(scaled) - scaled).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(scaled), dtype=np.uint32), scaled)


def encode_tokens(table: Table, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, and the states and the places in the words at each checkpoint."""
    n, bits = len(ids), np.uint64(BITS)
    freq, first = table.freq[ids], table.first[ids]
    if n and not freq.all():
        raise ValueError("an id that the table doesn't have")
    rows = -(-n // LANES)
    state = np.full(LANES, LOW)
    chunks: list[np.ndarray] = [np.empty(0, np.uint32)] * rows
    states = {}
    for row in range(rows - 1, -1, -1):
        at = slice(row * LANES, min(n, (row + 1) * LANES))
        f, x = freq[at], state[:at.stop - at.start]
        full = x >= ((LOW >> bits) << WORD) * f
        chunks[row] = x[full].astype(np.uint32)
        x = np.where(full, x >> WORD, x)
        quotient = x // f
        state[:len(f)] = (quotient << bits) + (x - quotient * f) + first[at]
        if row % CHECKPOINT_ROWS == 0:
            states[row] = state.copy()
    places = words.offsets(np.fromiter(map(len, chunks), np.int64, rows))[:-1][::CHECKPOINT_ROWS]
    flat = np.concatenate(chunks) if chunks else np.empty(0, np.uint32)
    kept = np.concatenate([states[r] for r in sorted(states)]) if states else np.empty(0, np.uint64)
    return flat, kept, places


def decode_tokens(table: Table, n: int, flat: np.ndarray, states: np.ndarray, places: np.ndarray,
                  checkpoint: int = 0, until: int | None = None) -> np.ndarray:
    """The ids between two checkpoints; ``until`` None: to the end of the block."""
    if n == 0:
        return np.empty(0, np.uint32)
    mask, bits = np.uint64((1 << BITS) - 1), np.uint64(BITS)
    rows = -(-n // LANES)
    begin, end = checkpoint * CHECKPOINT_ROWS, rows if until is None else min(rows, until * CHECKPOINT_ROWS)
    state = states[checkpoint * LANES:(checkpoint + 1) * LANES].copy()
    place = int(places[checkpoint])
    out = np.empty(min(n, end * LANES) - begin * LANES, np.uint32)
    for row in range(begin, end):
        width = min(LANES, n - row * LANES)
        x = state[:width]
        slot = x & mask
        symbol = table.symbol[slot]
        out[(row - begin) * LANES:(row - begin) * LANES + width] = symbol
        x = table.freq[symbol] * (x >> bits) + slot - table.first[symbol]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << WORD) | flat[place:place + len(low)]
        place += len(low)
        state[:width] = x
    return out


def pack(table: Table, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    flat, states, places = encode_tokens(table, ids)
    body = b"".join([doc_ids.astype("<i8").tobytes(), nulls.astype("u1").tobytes(), lengths.astype("<u8").tobytes(),
                     states.astype("<u8").tobytes(), places.astype("<u8").tobytes(), flat.astype("<u4").tobytes()])
    header = json.dumps({"docs": len(doc_ids), "tokens": len(ids), "lanes": LANES, "bits": BITS, "words": len(flat),
                         "checkpoint_rows": CHECKPOINT_ROWS, "checkpoints": len(places)}).encode()
    return MAGIC + struct.pack("<III", len(header), zlib.crc32(header), zlib.crc32(body)) + header + body


def unpack(table: Table, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Doc ids, null flags, lengths and ids of a block; raises where a checksum doesn't fit."""
    size, head_crc, body_crc = struct.unpack("<III", block[len(MAGIC):len(MAGIC) + 12])
    begin = len(MAGIC) + 12
    header, body = block[begin:begin + size], block[begin + size:]
    if block[:len(MAGIC)] != MAGIC or zlib.crc32(header) != head_crc or zlib.crc32(body) != body_crc:
        raise ValueError("a damaged block")
    h, at, out = json.loads(header), 0, []
    if (h["lanes"], h["bits"], h["checkpoint_rows"]) != (LANES, BITS, CHECKPOINT_ROWS):
        raise ValueError("a block with other settings")
    for kind, count in (("<i8", h["docs"]), ("u1", h["docs"]), ("<u8", h["docs"]), ("<u8", h["checkpoints"] * LANES),
                        ("<u8", h["checkpoints"]), ("<u4", h["words"])):
        out.append(np.frombuffer(body, kind, count, at))
        at += out[-1].nbytes
    return out[0], out[1], out[2].astype(np.int64), decode_tokens(table, h["tokens"], out[5], out[3], out[4])


def tokenize(docs: DataFrame, path: str, end_id: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of whole documents in ascending order of doc_id: (block, doc_ids, lengths, ids).

    ``ids`` are compressed 16-bit unsigned integers where the vocabulary allows it, else 32-bit, each text
    followed by ``end_id``.
    """
    def run(batches):
        coder, partition, n, kept, size = byte_tokenizer(path), TaskContext.get().partitionId(), 0, [], 0
        kind = "<u2" if max(coder.n_ids, end_id + 1) <= 1 << 16 else "<u4"

        def flush():
            nonlocal n, kept, size
            out = pa.RecordBatch.from_pydict({
                "block": [(partition << 32) + n],
                "doc_ids": pa.array([[i for k in kept for i in k[0]]], pa.list_(pa.int64())),
                "lengths": pa.array([np.concatenate([k[1] for k in kept])], pa.list_(pa.int64())),
                "width": pa.array([np.dtype(kind).itemsize], pa.int32()), "ids": [zstandard.compress(b"".join(k[2] for k in kept), 1)]})
            n, kept, size = n + 1, [], 0
            return out

        for batch in batches:
            for step in words.steps(batch, limit=1 << 21):
                ids, starts = coder.encode(step.column("text"))
                whole = np.insert(ids, starts[1:], end_id)
                kept.append((step.column("doc_id").to_pylist(), np.diff(starts) + 1, whole.astype(kind).tobytes()))
                size += len(whole)
                if size >= block_tokens:
                    yield flush()
        if kept:
            yield flush()

    return files.ordered(docs).mapInArrow(
        run, "block long, doc_ids array<long>, lengths array<long>, width int, ids binary")


def _ids(row: dict) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(row["ids"]), f"<u{row['width']}")


def count(tokenized: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs in all blocks; a task emits one row for each id at most."""
    def run(batches):
        total = np.zeros(1, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                new = np.bincount(_ids(row))
                if len(new) > len(total):
                    total, new = new, total
                total[:len(new)] += new
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})

    return tokenized.select("width", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def table_of(counts: DataFrame) -> Table:
    """The shared table; its rows are as many as the vocabulary at most, so the driver can hold them."""
    rows = counts.collect()
    out = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return Table(out)


def write(tokenized: DataFrame, table: Table, folder: str) -> DataFrame:
    """Write coded files; returns lazily (block, file, at, n_bytes, n_docs, n_tokens). Stage it, then the files are there."""
    shared = tokenized.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        file, at = files.new_file(folder, ".rans"), 0
        store, name = files.opened(file)
        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(name, compression=None) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    ids = _ids(row).astype(np.uint32)
                    doc_ids = np.array([0 if i is None else i for i in row["doc_ids"]], np.int64)
                    nulls = np.array([i is None for i in row["doc_ids"]])
                    block = pack(shared.value, doc_ids, nulls, np.array(row["lengths"]), ids)
                    out.write(block)
                    yield pa.RecordBatch.from_pydict({
                        "block": [row["block"]], "file": [file], "at": [at], "n_bytes": [len(block)],
                        "n_docs": [len(doc_ids)], "n_tokens": [len(ids)]})
                    at += len(block)

    return tokenized.mapInArrow(run, "block long, file string, at long, n_bytes long, n_docs long, n_tokens long")


def read(manifest: DataFrame, table: Table) -> DataFrame:
    """Decode all blocks in parallel: (doc_id, start, ids) with the end id, the start over all files."""
    shared = manifest.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, nulls, lengths, ids = unpack(
                    shared.value, files.read_bytes(row["file"], row["at"], row["n_bytes"]))
                ends = words.offsets(lengths)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64(), mask=nulls.astype(bool)),
                    "start": pa.array(ends[:-1] + row["start"], pa.int64()),
                    "ids": pa.array([p.tobytes() for p in np.split(ids.astype("<u4"), ends[1:-1])] if len(doc_ids) else [],
                                    pa.binary())})

    # A block is much work and a short row, so the rows are dealt out by number, not by their bytes.
    starts = files.with_starts(manifest, "n_tokens", "start").repartition(max(1, manifest.count()), "block")
    return starts.select("file", "at", "n_bytes", "start").mapInArrow(run, "doc_id long, start long, ids binary")
