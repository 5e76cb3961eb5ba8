"""Splitting Arrow text columns into words without a Python object per word.

A batch is split and dictionary-encoded by Arrow, so per-word Python work is done
once for each distinct word of a batch, and the rest is numpy on the codes.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text bytes that one step holds; a longer single text makes a step of its own.
STEP_BYTES = 4 << 20


class Words(NamedTuple):
    """``codes`` index ``values``; text ``i`` owns ``codes[starts[i]:starts[i + 1]]``."""

    codes: np.ndarray
    starts: np.ndarray
    values: pa.Array


def steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    if not len(sizes):
        return
    group = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for begin, end in zip(cuts, cuts[1:]):
        yield batch.slice(begin, end - begin)


#: Functions that forget what an operator keeps for the next task of the same kind.
MEMORIES: list[Callable[[], None]] = []


def release(memories: bool = False) -> None:
    """Give free memory back to the system: a worker is used again, and keeps what earlier stages have left otherwise.

    With ``memories`` what operators remember between their tasks goes as well.
    """
    for forget in MEMORIES if memories else []:
        forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def few(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, for work that makes Python objects of nested columns."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def offsets(counts: np.ndarray) -> np.ndarray:
    """Starts of runs with these lengths, and the end of the last."""
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def split(text: pa.Array, separator: str | None = None) -> Words:
    """Words between ASCII white space (or ``separator``), without empty ones; null is an empty text."""
    text = pc.fill_null(text, "")
    lists = pc.ascii_split_whitespace(text) if separator is None else pc.split_pattern(text, separator)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:
        full = codes != empty
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[full], minlength=len(counts))
        codes = codes[full]
    return Words(codes, offsets(counts), coded.dictionary)


def strings(values: pa.Array) -> list[str]:
    """As ``to_pylist``, several times faster."""
    return values.to_numpy(zero_copy_only=False).tolist()


def hashed(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, strings(values)), np.uint64, len(values))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (a splitmix64 finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; fewer words give none."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + count]
    return mixed(out)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of many ranges, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def lower_ascii(text: pa.Array) -> pa.Array:
    """A to Z in lower case; all other characters as they are; null is empty."""
    return pc.ascii_lower(pc.fill_null(text, ""))


class Recent:
    """A memory of values by key in two generations: when the younger is full, the older is forgotten.

    What is asked for again moves to the younger one, so frequent keys stay, and at most ``size`` are held.
    """

    def __init__(self, size: int):
        self.half, self.young, self.old = max(1, size // 2), {}, {}

    def missing(self, keys: list) -> list:
        """The distinct keys that are not known; known ones are kept until the next call."""
        if len(self.young) > self.half:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        absent = [k for k in keys if k not in young]
        if not absent or not old:
            return absent if len(absent) < 2 else list(dict.fromkeys(absent))
        new = []
        for k in dict.fromkeys(absent):
            found = old.get(k)
            if found is None:
                new.append(k)
            else:
                young[k] = found
        return new

    def get(self, key):
        """The value of a key or None."""
        found = self.young.get(key)
        if found is None and self.old:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) > self.half:
            self.young, self.old = {}, self.young
        self.young[key] = value
