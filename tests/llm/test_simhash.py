"""Fingerprints and their links against plain versions."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import simhash
from siltstone.llm.queries import QUERIES
from tests.llm import plain

TABLES = "/root/testdata/sf0.001"


def fingerprint(text: str | None, width: int = 3) -> int:
    words = plain.ascii_words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows: list[tuple[int | None, str | None]], distance: int = 2) -> list[tuple]:
    prints = [fingerprint(t) for _, t in rows]
    known = sorted({p for p, (i, _) in zip(prints, rows) if i is not None})
    root = {p: p for p in known}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in known:
        for b in known:
            if a < b and (a ^ b).bit_count() <= distance:
                root[top(a)] = top(b)
    least: dict[int, int] = {}
    for p, (i, _) in zip(prints, rows):
        if i is not None:
            least[top(p)] = min(least.get(top(p), i), i)
    return [(i, f"{p:016x}", None if i is None else least[top(p)]) for p, (i, _) in zip(prints, rows)]


@settings(deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aB \n\té\x0b　", max_size=30), max_size=12))
def test_fingerprints(texts):
    assert simhash.fingerprints(pa.array(texts, pa.string())).tolist() == [fingerprint(t) for t in texts]


def test_long_text_and_slices():
    r = random.Random(2)
    long = " ".join(r.choice(["ab", "c", "def", "é"]) + str(r.randrange(99)) for _ in range(150_000))
    texts = pa.array(["x", None, long, "a b c d"])
    assert simhash.fingerprints(texts).tolist() == [fingerprint(t) for t in texts.to_pylist()]
    assert simhash.fingerprints(texts.slice(2)).tolist() == [fingerprint(long), fingerprint("a b c d")]


@pytest.mark.parametrize(("distance", "bucket"), [(0, 512), (1, 4), (2, 512), (2, 20), (2, 3), (3, 20)])
def test_links(spark, distance, bucket):
    """All pairs, also where one value of a segment is shared by many and its bucket is cut twice."""
    draw = np.random.default_rng(0)
    found = {7 << 32 | i for i in range(200)} | {i << 40 | 5 for i in range(100)}
    for base in draw.integers(0, 1 << 63, 20).tolist():
        for _ in range(20):
            x = base
            for p in draw.integers(0, 63, draw.integers(0, 4)).tolist():
                x ^= 1 << p
            found.add(x)
    found |= {-1, 0, 1, -(1 << 63), -(1 << 63) + 1}
    values = sorted(found)
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
    got = simhash.links(spark.createDataFrame([(v,) for v in values], "fingerprint long"), distance, bucket).collect()
    assert {tuple(r) for r in got} == want


def test_too_far(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fingerprint long"), 4)


def test_odd_rows(spark):
    """Nulls, empty and repeated texts and rows, clashing columns, no rows."""
    some = "one two three four five six seven eight nine ten " * 5
    rows = [(9, None), (4, ""), (None, some), (7, some), (3, some), (3, some), (5, some + "eleven"), (8, " \n "), (1, "one"), (2, "two"), (2, "one")]
    kind = "doc_id long, text string, component_id string, fingerprint int, n int, label long, low int"
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], kind)
    key = lambda r: (r[0] is None, r)
    got = simhash.linked(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expected(rows), key=key)
    assert simhash.linked(docs.limit(0)).collect() == []


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
def test_query(spark):
    docs = pd.read_parquet(f"{TABLES}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op13_simhash"](spark, TABLES).collect())
    assert got == sorted(expected(list(zip(docs["doc_id"].tolist(), docs["text"]))))
