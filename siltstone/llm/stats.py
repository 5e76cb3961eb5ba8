"""Statistics of whole texts, computed by Arrow and numpy for many texts at once.

Words are runs without ASCII white space. Null is an empty text; an empty text has 0
everywhere. A text of any length is one unit of work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siltstone.llm import files, words

WINDOW = 8
#: Text bytes of a step; a task holds some twenty times as much while it counts.
STEP_BYTES = 1 << 20
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["words_log", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share",
            "stop_share", "comma_share", "bar_share", "digit_share", "wide_share", "distinct_share", "top_word_share",
            "words_per_line"]
_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"


def _per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many flags are set in each run."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def _is(data: np.ndarray, chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table[data]


def _repeated_words(codes: np.ndarray, starts: np.ndarray, values: pa.Array) -> np.ndarray:
    """Words in windows that occur twice or more in their text, the first one included."""
    n = len(starts) - 1
    windows = words.grams(words.hashed(values)[codes], WINDOW)
    doc = np.repeat(np.arange(n), np.diff(starts))
    if not len(windows):
        return np.zeros(n, np.int64)
    inside = doc[:len(windows)] == doc[WINDOW - 1:]
    at = np.flatnonzero(inside)
    keys = words.mixed(windows[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    edge = np.zeros(len(codes) + 1, np.int64)
    edge[at[twice]] += 1
    edge[at[twice] + WINDOW] -= 1
    return _per_text(np.cumsum(edge)[:-1] > 0, starts)


def _lines(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that are equal to an earlier line of their text."""
    lists = pc.split_pattern(text, "\n")
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    worded = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    full = worded[codes]
    doc = np.repeat(np.arange(len(counts)), counts)[full]
    distinct = np.unique(doc * max(len(coded.dictionary), 1) + codes[full]) // max(len(coded.dictionary), 1)
    n = np.bincount(doc, minlength=len(counts))
    return n, n - np.bincount(distinct, minlength=len(counts))


def statistics(text: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS as integers and FEATURES as floats, for each text."""
    text = pc.fill_null(text, "")
    data, at = files.texts(text)
    codes, starts, values = words.split(text)
    n = len(text)

    def of(flags):
        return _per_text(flags, at).astype(np.float64)

    chars = _per_text((data & 0xC0) != 0x80, at)
    n_words = np.diff(starts)
    word_chars = chars - _per_text(_is(data, _SPACE), at)
    symbols = _per_text(_is(data, _SYMBOLS), at)
    lines, dup_lines = _lines(text)
    repeated = _repeated_words(codes, starts, values)
    pairs, seen = np.unique(np.repeat(np.arange(n), n_words) * max(len(values), 1) + codes, return_counts=True)
    owner = pairs // max(len(values), 1)
    top = np.zeros(n)
    np.maximum.at(top, owner, seen)
    per_char, per_word = 1 / np.maximum(word_chars, 1), 1 / np.maximum(n_words, 1)
    upper = _is(data, bytes(range(65, 91)))
    if len(data) > 1:  # the capital letters of Latin-1, two bytes each
        upper[1:] |= (data[:-1] == 0xC3) & (data[1:] < 0x9F)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
        "n_repeat_words": repeated,
        "words_log": np.log1p(n_words), "word_length": word_chars * per_word, "symbol_share": symbols * per_char,
        "dup_line_share": dup_lines / np.maximum(lines, 1), "repeat_share": repeated * per_word,
        "upper_share": of(upper) * per_char, "mark_share": of(_is(data, b"!?")) * per_char,
        "stop_share": of(_is(data, b".;:")) * per_char, "comma_share": of(_is(data, b",")) * per_char,
        "bar_share": of(_is(data, b"|")) * per_word, "digit_share": of(_is(data, b"0123456789")) * per_char,
        "wide_share": of((data & 0xC0) == 0xC0) * per_char,
        "distinct_share": np.bincount(owner, minlength=n) * per_word, "top_word_share": top * per_word,
        "words_per_line": np.log1p(n_words / np.maximum(lines, 1)),
    }


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS, and FEATURES as one array, for each row of documents."""
    def run(batches):
        words.release(memories=True)
        for batch in batches:
            for step in words.steps(batch, limit=STEP_BYTES):
                found = statistics(step.column("text"))
                matrix = np.column_stack([found[f] for f in FEATURES]) if step.num_rows else np.empty((0, len(FEATURES)))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(matrix.ravel(), pa.float64()), len(FEATURES))
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), *(pa.array(found[c], pa.int64()) for c in COUNTS),
                     lists.cast(pa.list_(pa.float64()))], ["doc_id", *COUNTS, "features"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), *(T.StructField(c, T.LongType()) for c in COUNTS),
                           T.StructField("features", T.ArrayType(T.DoubleType()))])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def matrix(batch: pa.RecordBatch, column: str = "features") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
