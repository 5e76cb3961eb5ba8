"""Near duplicates by 64-bit fingerprints of word shingles, found with multi-index hashing.

A fingerprint bit is 1 where it is set in over half of a text's shingle hashes (XXH64, repeats
included). Two fingerprints that differ in at most ``distance`` bits are linked. To find them, the bits are cut
into two segments: the differing bits that fall into one of them are at most half, so a small ball around the
segment's value, 33 values or one, holds the partner's. The table of the distinct fingerprints by
segment value is joined with these values, and complete distances decide. A link is found from
both of its ends, so only the greater of two fingerprints is fetched.

Hot values: distinct fingerprints only are indexed, each with the count of its documents. A segment value
that more than ``BUCKET`` fingerprints share is not joined: the bits that are still free in it are cut into two segments
in the same way, down to eight free bits, where a bucket can't hold more than 256 fingerprints. A fingerprint
has at most 2,080 others within two bits, so links grow with the fingerprints.

Texts without words have fingerprint 0 and are linked like any other; a null text is empty; with fewer words than a shingle
the whole sequence is one. Rows without doc_id get a fingerprint, take no part in links and have no
component. Rows with the same doc_id are each judged by their own text. Other columns are left out; join
them by doc_id. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm import files, words
from siltstone.llm.components import components
from siltstone.operators import skew
from siltstone.sources.staging import stage

SEED = 42
BITS = 64
#: Fingerprints with the same segment value that are compared with each other's balls at most.
BUCKET = 512
#: Free bits at which a bucket is small by itself.
LEAST_FREE = 8
#: Shingles whose bits are counted at a time.
_CHUNK = 1 << 16


def _shingles(text: pa.Array, width: int) -> tuple[memoryview, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts with one space behind each, where the shingles begin and end, and how many each text has."""
    data, starts = files.texts(text)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    border = np.ones(len(data) + 1, bool)  # before each byte: white space or another text
    border[1:] = np.append(space, True)[:-1] if len(data) else True
    border[starts] = True
    begin = np.flatnonzero(~space & border[:-1])
    behind = np.append(space, True)[1:] if len(data) else np.empty(0, bool)
    behind[starts[(starts > 0)] - 1] = True
    end = np.flatnonzero(~space & behind) + 1
    keep = ~space
    inside = end[end < len(data)]
    keep[inside] = True  # one white space behind a word, or the next text's first byte
    place = np.cumsum(keep) - keep
    flat = np.where(space, np.uint8(32), data)[keep]
    first = np.searchsorted(begin, starts)
    n_words = np.diff(first)
    counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    a = words.spread(first[:-1], counts)
    b = a + np.repeat(np.minimum(n_words, width), counts) - 1
    return memoryview(np.ascontiguousarray(flat)), place[begin[a]], place[end[b] - 1] + 1, counts


def fingerprints(text: pa.Array, width: int = 3) -> np.ndarray:
    """The fingerprint of each text as an unsigned integer."""
    flat, begin, end, counts = _shingles(words.lower_ascii(text), width)
    owner = np.repeat(np.arange(len(counts)), counts)
    totals = np.zeros((len(counts), BITS), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(begin), _CHUNK):
        part = slice(at, at + _CHUNK)
        pairs = zip(begin[part].tolist(), end[part].tolist())
        hashes = np.fromiter((digest(flat[a:b], SEED) for a, b in pairs), np.uint64, len(begin[part]))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        new = np.flatnonzero(np.diff(owner[part], prepend=-1))
        totals[owner[part][new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    chosen = np.packbits(2 * totals > counts[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(chosen).view("<u8").ravel().astype(np.uint64)


def fingerprinted(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fingerprint): the 64 bits as a signed number, for each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in words.steps(batch):
                found = fingerprints(step.column("text"), width).view(np.int64)
                yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(found)], ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fingerprint long")


def _range(low: Column, width: int) -> Column:
    """The bits from ``low`` on."""
    ones = -1 if width == BITS else (1 << width) - 1
    return F.call_function("shiftleft", F.lit(ones).cast("long"), low)


def _entries(open_: DataFrame, width: int) -> DataFrame:
    """Table rows for the two segments of ``width`` bits each that are free from ``low`` on."""
    low, value, own = F.col("low"), F.col("value"), F.col("fingerprint")
    lower = F.struct((low + width).alias("low"), value.bitwiseOR(own.bitwiseAND(_range(low, width))).alias("value"))
    upper = F.struct(low.alias("low"), value.bitwiseOR(own.bitwiseAND(_range(low + width, width))).alias("value"))
    return open_.select("fingerprint", F.explode(F.array(lower, upper)).alias("e")).select("fingerprint", "e.low", "e.value")


def _probes(open_: DataFrame, width: int) -> DataFrame:
    """Values of the two segments to be looked up where ``rest`` bits may differ in both together.

    Of an even number half may differ in the lower segment, or else fewer in the upper one; of an odd number
    the smaller half in either.
    """
    low, value, own, rest = F.col("low"), F.col("value"), F.col("fingerprint"), F.col("rest")
    one = F.lit(1).cast("long")

    def around(at: Column, free: Column, flips: Column) -> Column:
        exact = value.bitwiseOR(own.bitwiseAND(_range(at, width)))
        near = F.transform(F.sequence(at, at + (width - 1)), lambda p: F.struct(
            free.alias("low"), exact.bitwiseXOR(F.call_function("shiftleft", one, p)).alias("value"), (rest - 1).alias("rest")))
        same = F.array(F.struct(free.alias("low"), exact.alias("value"), rest.alias("rest")))
        return F.when(flips < 0, F.slice(same, 1, 0)).when(flips == 0, same).otherwise(F.concat(same, near))

    half = F.floor(rest / 2).cast("int")
    lower = around(low, low + width, half)
    upper = around(low + width, low, F.when(rest % 2 == 0, half - 1).otherwise(half))
    return open_.select("fingerprint", F.explode(F.concat(lower, upper)).alias("e")).select(
        "fingerprint", "e.low", "e.value", "e.rest")


def links(distinct: DataFrame, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(a, b): pairs of different fingerprints, a < b, that differ in ``distance`` bits at most; some come twice.

    ``distinct`` has each ``fingerprint`` once and should be staged.
    """
    if not 0 <= distance <= 3:
        raise ValueError("segments are searched with balls of one bit, so three bits may differ at most")
    start = distinct.select("fingerprint", F.lit(0).alias("low"), F.lit(0).cast("long").alias("value"))
    table, probes, width, found = start, start.withColumn("rest", F.lit(distance)), BITS // 2, None
    key, apart = ["low", "value"], F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    while True:
        table, probes = _entries(table, width), _probes(probes, width)
        large = None
        if width > LEAST_FREE:
            counts = table.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > bucket)
            large = stage(counts.select(*key), "large-buckets")
            if large.isEmpty():
                large = None
        small = table if large is None else table.join(large, key, "left_anti")
        pairs = (small.withColumnRenamed("fingerprint", "a").join(probes.withColumnRenamed("fingerprint", "b"), key)
                 .filter(F.col("a") < F.col("b")).filter(apart).select("a", "b"))
        found = pairs if found is None else found.unionByName(pairs)
        if large is None:
            return found
        table = stage(table.join(large, key, "left_semi"), "table")
        probes = stage(probes.join(large, key, "left_semi"), "probes")
        width //= 2


def linked(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row; the fingerprint as 16 hexadecimal digits.

    ``component_id`` is the smallest doc_id that links lead to.
    """
    rows = stage(fingerprinted(docs, width), "fingerprints")
    distinct = stage(rows.filter("doc_id is not null").groupBy("fingerprint").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("least")), "distinct")
    labels = components(stage(links(distinct, distance), "links"))
    labelled = stage(distinct.join(labels.select(F.col("v").alias("fingerprint"), "label"), "fingerprint", "left").withColumn(
        "label", F.coalesce("label", "fingerprint")), "labels")
    least = labelled.groupBy("label").agg(F.count("*").alias("members"), F.min("least").alias("component_id"))
    named = skew.counted_join(labelled.select("fingerprint", "n", "label"), stage(least, "components"), ["label"], rows="members")
    named = stage(named.select("fingerprint", "n", "component_id"), "named")
    out = skew.counted_join(rows, named, ["fingerprint"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
