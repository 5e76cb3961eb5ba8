"""Exact repeats across documents with suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a
smaller doc_id. Three exchanges find these strings:

1. Each string of ``length`` bytes has an anchor, the shorter run inside it with the least
   hash; equal strings have equal anchors. Blocks of documents tell each bucket of hashes which
   anchors they hold, and hear which of theirs occur in other documents as well.
2. Blocks send the bytes around such anchors to the anchors' buckets. A bucket puts
   different surroundings of an anchor one after the other and sorts their suffixes in
   two stages: those smaller than their successor are sorted, the rest is induced from them by
   scans of the buckets of first bytes. Neighbours with a common prefix of ``length``
   or more are the same string, and the least doc_id of such a run decides.
3. The byte ranges to remove go back to the blocks.

Documents are written once as block files and read by the tasks that own them, so texts are
never shuffled whole. An anchor occurs at most once for each block in the first exchange; surroundings
are sent for repeated text only. In a bucket, equal surroundings of however many documents are
one entry before anything is sorted. A single anchor can therefore be as hot as it likes if its surroundings are
equal; with different ones it costs about 66 bytes for each occurrence in one task.

Null texts are empty. Rows without doc_id keep their text and take part in nothing; rows with the same doc_id
don't count as earlier than each other. Matches never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siltstone.llm import files, words
from siltstone.sources.staging import stage

LENGTH = 50
ANCHOR = 16
PIECE = 1 << 18
#: Odd multipliers of the hash of runs of 2, 4, 8 and 16 bytes.
FACTORS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


# ---- suffix arrays ----------------------------------------------------------

def eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one big-endian number; zeros behind the end."""
    out = np.zeros(len(data) + 8, np.uint64)
    out[:len(data)] = data
    for shift in (1, 2, 4):
        out[:-shift] = (out[:-shift] << np.uint64(8 * shift)) | out[shift:]
    return out


def _smaller_than_successor(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one behind it; the last is not."""
    change = np.flatnonzero(data[1:] != data[:-1])  # last places of runs of equal bytes
    ends = np.append(change, len(data) - 1)
    rises = np.append(data[change] < data[change + 1], False)
    return np.repeat(rises, np.diff(np.append(-1, ends)))


def _sorted_directly(keys: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by their first ``depth`` bytes; only ties go on to the next eight."""
    order = at[np.argsort(keys[at], kind="stable")]
    group = np.concatenate([[0], np.cumsum(keys[order][1:] != keys[order][:-1])])
    for done in range(8, depth, 8):
        sizes = np.bincount(group)
        tied = np.flatnonzero(sizes[group] > 1)
        if not len(tied):
            break
        key = keys[np.minimum(order[tied] + done, len(keys) - 1)]
        turn = np.lexsort((key, group[tied]))
        order[tied] = order[tied][turn]
        key, own = key[turn], group[tied]
        fresh = np.zeros(len(order), np.int64)
        fresh[tied[1:]] = (key[1:] != key[:-1]) & (own[1:] == own[:-1])
        bounds = np.concatenate([[0], group[1:] != group[:-1]])
        group = np.cumsum(fresh | bounds)
    return order


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in the order of their first ``depth`` bytes at least."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    direct = _smaller_than_successor(data)
    out = np.full(n, -1, np.int64)
    total, of_direct = np.bincount(data, minlength=256), np.bincount(data[direct], minlength=256)
    begin = np.cumsum(total) - total
    behind = begin + total - of_direct  # within a first byte the induced suffixes come first
    filled = begin.copy()
    ordered = _sorted_directly(eights(data), np.flatnonzero(direct), depth)
    ends = np.cumsum(of_direct)
    for c in np.flatnonzero(of_direct):
        out[behind[c]:behind[c] + of_direct[c]] = ordered[ends[c] - of_direct[c]:ends[c]]
    last = data[-1]
    out[filled[last]] = n - 1
    filled[last] += 1

    def induce(places: np.ndarray) -> None:
        before = places[places > 0] - 1
        before = before[~direct[before]]
        before = before[np.argsort(data[before], kind="stable")]
        bytes_, first, counts = np.unique(data[before], return_index=True, return_counts=True)
        for b, f, k in zip(bytes_, first, counts):
            out[filled[b]:filled[b] + k] = before[f:f + k]
            filled[b] += k

    for c in np.flatnonzero(total):
        seen = begin[c]
        while seen < filled[c]:  # grows while runs of the same byte are induced
            upto = filled[c]
            induce(out[seen:upto])
            seen = upto
        induce(out[behind[c]:behind[c] + of_direct[c]])
    return out


def same_as_before(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix has a common prefix of ``length`` or more with the one before it in the order."""
    keys, same = eights(data), np.zeros(len(order), bool)
    if len(order):
        a, b = order[:-1], order[1:]
        same[1:] = True
        for done in sorted({*range(0, length - 7, 8), length - 8}):
            same[1:] &= keys[np.minimum(a + done, len(data))] == keys[np.minimum(b + done, len(data))]
    return same


# ---- anchors ----------------------------------------------------------------

def anchors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, first, last) of anchors: strings that start from ``first`` to ``last`` have this one.

    In pieces, so a text of any length needs little memory.
    """
    window = length - ANCHOR + 1
    for at in range(0, len(data) - length + 1, PIECE):
        part = data[at:at + PIECE + length - 1].astype(np.uint64)
        count = len(part) - length + 1
        h = part
        for shift, factor in zip((1, 2, 4, 8), FACTORS):  # runs of 2, 4, 8 and 16 bytes
            h = h[:-shift] * factor + h[shift:]
        h = words.mixed(h)
        # The place in the low bits makes the leftmost of equal hashes the least.
        least = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:count], least[window - width:window - width + count])
        place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        # Strings that end in the text in which they start.
        text = np.searchsorted(starts, np.arange(at, at + count), side="right")
        valid = np.flatnonzero(at + np.arange(count) + length <= starts[text])
        if not len(valid):
            continue
        new = np.ones(len(valid), bool)
        new[1:] = (np.diff(valid) != 1) | (np.diff(place[valid]) != 0) | (np.diff(text[valid]) != 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(valid)) - 1
        # Least hashes are small numbers; mixed once more they spread over all buckets.
        yield words.mixed(h[place[valid[first]]]), at + valid[first], at + valid[last]


def _of_block(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, ...]:
    """Bytes, starts, and the hash, first, last and row of all anchors of rows with a doc_id."""
    data, starts = files.texts(batch.column("text"))
    found = list(anchors(data, starts, length))
    h, first, last = (np.concatenate([f[i] for f in found]) if found else np.empty(0, k)
                      for i, k in enumerate((np.uint64, np.int64, np.int64)))
    row = np.searchsorted(starts, first, side="right") - 1
    known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)[row]
    return data, starts, h[known], first[known], last[known], row[known]


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _joined(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(v for v in table[column].to_pylist() if v is not None), kind)


def _ask(manifest: DataFrame, buckets: int, length: int) -> DataFrame:
    """(bucket, block, hashes, several): the anchors of each block, and whether several of its documents have them."""
    def run(batches):
        for rows in batches:
            for block, file in zip(rows.column("block").to_pylist(), rows.column("file").to_pylist()):
                batch = files.read_block(file)
                _, _, h, _, _, row = _of_block(batch, length)
                doc = batch.column("doc_id").fill_null(0).to_numpy()[row]
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
                last = np.append(first[1:], len(h))[:len(first)] - 1
                hashes, several = h[first], doc[first] != doc[last]
                cuts = np.searchsorted(_bucket(hashes, buckets), np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(full, pa.int64()), "block": pa.array(np.full(len(full), block), pa.int64()),
                    "hashes": [_blob(hashes[cuts[b]:cuts[b + 1]]) for b in full],
                    "several": [_blob(several[cuts[b]:cuts[b + 1]]) for b in full]})

    return manifest.select("block", "file").mapInArrow(run, "bucket long, block long, hashes binary, several binary")


def _shared_anchors(table: pa.Table) -> pa.Table:
    """Per bucket: which anchors each block shares with another document."""
    h, several = _joined(table, "hashes", np.uint64), _joined(table, "several", bool)
    sizes = np.array([len(v) // 8 for v in table["hashes"].to_pylist()])
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    new = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    counts = np.diff(np.append(new, len(h)))
    shared = np.empty(len(h), bool)
    shared[order] = np.repeat((counts > 1) | np.logical_or.reduceat(several[order], new), counts)
    ends = words.offsets(sizes)
    return pa.table({"block": table["block"], "hashes": pa.array(
        [_blob(h[a:b][shared[a:b]]) for a, b in zip(ends, ends[1:])], pa.binary())})


def _surroundings(buckets: int, length: int):
    """Per block: the bytes around shared anchors, for the anchors' buckets."""
    def run(table: pa.Table) -> pa.Table:
        block, file = table["block"][0].as_py(), next((f for f in table["file"].to_pylist() if f), None)
        shared = np.sort(_joined(table, "hashes", np.uint64))
        out: dict[str, list] = {c: [] for c in ("bucket", "block", "hashes", "docs", "rows", "times", "firsts", "sizes", "bytes")}
        if len(shared):
            batch = files.read_block(file)
            data, starts, h, first, last, row = _of_block(batch, length)
            at = np.minimum(np.searchsorted(shared, h), len(shared) - 1)
            kept = np.flatnonzero(shared[at] == h)
            h, first, row, size = h[kept], first[kept], row[kept], last[kept] - first[kept] + length
            # Equal surroundings in one document are one entry with several places.
            raw = memoryview(data)
            digest = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:a + n]) for a, n in zip(first.tolist(), size.tolist())),
                                 np.uint64, len(h))
            key = words.mixed(words.mixed(digest + h * FACTORS[0]) + row.astype(np.uint64) * FACTORS[1])
            bucket = _bucket(h, buckets)
            order = np.lexsort((key, bucket))
            key, bucket, first = key[order], bucket[order], first[order]
            entry = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1]))) if len(key) else order
            h, row, size = (v[order][entry] for v in (h, row, size))
            times = np.diff(np.append(entry, len(key))).astype(np.uint32)
            doc = batch.column("doc_id").fill_null(0).to_numpy()[row]
            cuts = np.searchsorted(bucket[entry], np.arange(buckets + 1))
            places = np.append(entry, len(key))[cuts]
            for b in np.flatnonzero(np.diff(cuts)):
                s, p = slice(cuts[b], cuts[b + 1]), slice(places[b], places[b + 1])
                for name, value in (("bucket", int(b)), ("block", block), ("hashes", _blob(h[s])), ("docs", _blob(doc[s])),
                                    ("rows", _blob(row[s].astype(np.uint32))), ("times", _blob(times[s])),
                                    ("firsts", _blob((first[p] - np.repeat(starts[row[s]], times[s])).astype(np.uint32))),
                                    ("sizes", _blob(size[s].astype(np.uint16))),
                                    ("bytes", zstandard.compress(_blob(data[words.spread(first[entry[s]], size[s])]), 3))):
                    out[name].append(value)
        return pa.table({c: pa.array(v, pa.int64() if c in ("bucket", "block") else pa.binary()) for c, v in out.items()})

    return run


def _ranges(length: int):
    """Per bucket: the byte ranges that equal strings in earlier documents cover."""
    def run(table: pa.Table) -> pa.Table:
        h, doc, row, times, first, size = (_joined(table, c, k) for c, k in (
            ("hashes", np.uint64), ("docs", np.int64), ("rows", np.uint32), ("times", np.uint32), ("firsts", np.uint32),
            ("sizes", np.uint16)))
        size = size.astype(np.int64)
        first = first.astype(np.int64)  # a text in a row has fewer than 2 ** 31 bytes
        text = b"".join(map(zstandard.decompress, table["bytes"].to_pylist()))
        ends = words.offsets(size)
        owner = np.repeat(table["block"].to_numpy(), [len(v) // 8 for v in table["hashes"].to_pylist()])
        # Equal surroundings are one entry with the least doc_id.
        digest = np.fromiter(map(xxhash.xxh3_64_intdigest, (text[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist()))),
                             np.uint64, len(h))
        _, entry_at, entry = np.unique(words.mixed(digest + h * FACTORS[0]), return_index=True, return_inverse=True)
        least = np.full(len(entry_at), np.iinfo(np.int64).max)
        np.minimum.at(least, entry, doc)
        n_windows = size[entry_at] - length + 1
        window_at = words.offsets(n_windows)
        earliest = np.repeat(least, n_windows)  # of each window of each entry
        _, kind, several = np.unique(h[entry_at], return_inverse=True, return_counts=True)
        differ = np.flatnonzero(several[kind] > 1)
        if len(differ):
            # One text of the different surroundings, each with a zero behind it.
            begins = words.offsets(size[entry_at[differ]] + 1)
            data = np.zeros(begins[-1], np.uint8)
            raw = np.frombuffer(text, np.uint8)
            data[words.spread(begins[:-1], size[entry_at[differ]])] = raw[words.spread(ends[entry_at[differ]], size[entry_at[differ]])]
            window = np.full(len(data), -1, np.int64)
            window[words.spread(begins[:-1], n_windows[differ])] = words.spread(window_at[differ], n_windows[differ])
            order = suffix_array(data, length)
            order = order[window[order] >= 0]
            runs = np.flatnonzero(~same_as_before(data, order, length))
            docs = np.minimum.reduceat(earliest[window[order]], runs)
            earliest[window[order]] = np.repeat(docs, np.diff(np.append(runs, len(order))))
        # Windows of each entry of a document, then runs of covered windows, at each of its places.
        count = n_windows[entry]
        covered = earliest[words.spread(window_at[entry], count)] < np.repeat(doc, count)
        index = np.flatnonzero(covered)
        occurrence = np.repeat(np.arange(len(h)), count)[index]
        new = np.ones(len(index), bool)
        new[1:] = (np.diff(index) != 1) | (np.diff(occurrence) != 0)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(index)) - 1
        o = occurrence[begin]
        place = index - (np.cumsum(count) - count)[occurrence]
        times = times.astype(np.int64)
        at = words.spread((np.cumsum(times) - times)[o], times[o])
        start = first[at] + np.repeat(place[begin], times[o])
        stop = first[at] + np.repeat(place[end] + length, times[o])
        o = np.repeat(o, times[o])
        turn = np.argsort(owner[o], kind="stable")
        blocks, begins = np.unique(owner[o][turn], return_index=True)
        cuts = [*begins.tolist(), len(turn)]
        parts = [turn[a:b] for a, b in zip(cuts, cuts[1:])]
        return pa.table({
            "block": pa.array(blocks, pa.int64()), "rows": pa.array([_blob(row[o[p]]) for p in parts], pa.binary()),
            "starts": pa.array([_blob(start[p]) for p in parts], pa.binary()),
            "stops": pa.array([_blob(stop[p]) for p in parts], pa.binary())})

    return run


def _applied(names: list[str]):
    """Per block: its documents without the ranges."""
    def run(table: pa.Table) -> pa.Table:
        batch = files.read_block(next(f for f in table["file"].to_pylist() if f))
        data, starts = files.texts(batch.column("text"))
        row, start, stop = (_joined(table, c, k) for c, k in (("rows", np.uint32), ("starts", np.int64), ("stops", np.int64)))
        edge = np.zeros(len(data) + 1, np.int64)
        np.add.at(edge, starts[row] + start, 1)
        np.add.at(edge, starts[row] + stop, -1)
        gone = np.cumsum(edge[:-1]) > 0
        kept, spans = [], []
        for a, b in zip(starts.tolist(), starts[1:].tolist()):
            own = gone[a:b]
            step = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            spans.append([{"start": s, "end": e} for s, e in step.reshape(-1, 2).tolist()])
            kept.append(data[a:b][~own].tobytes())
        n_bytes = np.diff(starts)
        return pa.Table.from_arrays(
            [*(batch.column(c) for c in names), pa.array(n_bytes, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
            [*names, "n_bytes", "spans", "kept"])

    return run


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All rows and columns of documents but the text, with ``n_bytes``, the removed ``spans`` and the ``kept`` bytes."""
    if length < ANCHOR + 8:
        raise ValueError(f"strings of {ANCHOR + 8} bytes at least")
    docs = docs.drop("n_bytes", "spans", "kept")
    manifest = stage(files.write_blocks(docs, files.shared_folder(docs.sparkSession, "blocks")), "blocks")
    blocks = max(16, manifest.count())
    buckets = max(16, blocks // 2)
    manifest = manifest.select("block", "file").repartition(blocks, "block")
    asked = _ask(manifest, buckets, length)
    # Numbers of tasks are given: what is shuffled is little next to the work that it stands for.
    shared = asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_shared_anchors, "block long, hashes binary")
    sent = (shared.unionByName(manifest, allowMissingColumns=True).repartition(blocks, "block").groupBy("block").applyInArrow(
        _surroundings(buckets, length), "bucket long, block long, hashes binary, docs binary, rows binary, times binary, firsts binary, "
                                        "sizes binary, bytes binary"))
    ranges = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_ranges(length), "block long, rows binary, starts binary, stops binary")
    names = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("n_bytes", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.StructType([
                               T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField("kept", T.BinaryType())])
    both = ranges.unionByName(manifest, allowMissingColumns=True).repartition(blocks, "block")
    return both.groupBy("block").applyInArrow(_applied(names), schema)
