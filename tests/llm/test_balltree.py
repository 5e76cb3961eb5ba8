"""Ranked search against a plain ranking of all documents, and odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import balltree, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text: str | None) -> list[str]:
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs: list[tuple], items: list[tuple], top: int = 10) -> list[tuple]:
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, []).extend(terms_of(t))
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, its in asked.items():
        scores = []
        for i, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in its if c[t])
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, k, i, -s) for k, (s, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=lambda r: (r[0] is None, r))


def got(frame) -> list[tuple]:
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0] is None, r))


@settings(deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aZ09@_`~é　\x7f\x00 \n", max_size=20), max_size=8), st.integers(0, 3))
def test_terms(texts, skipped):
    found = balltree.terms(pa.array(texts, pa.string()).slice(skipped))
    values = words.strings(found.values)
    for k, text in enumerate(texts[skipped:]):
        assert [values[c] for c in found.codes[found.starts[k]:found.starts[k + 1]]] == terms_of(text)


def prose(r: random.Random, n: int, language: int) -> str:
    return " ".join(f"{'xyz'[language]}{int(r.paretovariate(0.6)) % 3000}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(4)
    docs = [(i, prose(r, r.randint(1, 300), i % 3)) for i in range(3000)]
    items = [(i, prose(r, r.randint(5, 40), i % 3)) for i in range(30)]
    docs += [(5000 + k, prose(r, 20, 0) + " " + t + " " + prose(r, 9, 1)) for k, (_, t) in enumerate(items[:10])]
    docs += [(6000 + k, items[3][1]) for k in range(40)]  # ties
    return docs, items


def test_all_documents_ranked(spark, corpus, monkeypatch):
    docs, items = corpus
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain(docs, items)
    assert got(balltree.ranked(*frames)) == want
    assert got(balltree.ranked(*frames, top=3)) == plain(docs, items, 3)


def test_many_blocks_and_parts(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(balltree, "ITEM_BYTES", 1500)
    frames = spark.createDataFrame(docs[2000:], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(balltree.ranked(*frames)) == plain(docs[2000:], items)


def test_parts():
    block = balltree.Items(pa.array(range(700)), pa.array(["t"]), np.repeat(np.arange(700), 100), np.zeros(70_000, int), np.ones(70_000, int))
    steps = [(i.tolist(), len(e)) for i, e in block.parts()]
    assert [x for i, _ in steps for x in i] == list(range(700)) and sum(n for _, n in steps) == 70_000
    assert all(len(i) <= balltree.PART_ITEMS and n <= balltree.PART_TERMS for i, n in steps)


def test_bounds_hold_and_prune():
    """No document scores more than the bound of any node above it, and some leaves are never scored."""
    r = np.random.default_rng(1)
    n, width = 4000, 300
    lists = [np.unique(r.integers(0, 100, r.integers(1, 40)) + 100 * (i % 3)) for i in range(n)]
    docs = balltree.Vectors(r.permutation(n), words.offsets(np.array([len(x) for x in lists])), np.concatenate(lists),
                            r.integers(1, 10**6, sum(map(len, lists))))
    weights = r.integers(0, 12_000, width)
    tree = balltree.Tree(docs, np.sqrt(weights))
    asked = [np.sort(r.choice(100, 12, False)) + 100 * (i % 3) for i in range(12)]
    items, term = np.repeat(np.arange(12), 12), np.concatenate(asked)
    dense = np.zeros((n, width), np.int64)
    dense[np.repeat(np.arange(n), np.diff(tree.docs.starts)), tree.docs.term] = tree.docs.value
    seen = {}
    plain_best = balltree.Tree._best

    def spied(self, of, bounds, w, top):
        scores = dense[:, np.unique(term)] @ w
        for node in range(len(self.begin)):
            assert scores[self.begin[node]:self.end[node]].max() <= bounds[node]
        return plain_best(self, of, bounds, w, top)

    balltree.Tree._best = spied
    try:
        for item, best, scored in tree.search(items, term, weights[term], np.sqrt(weights), 10):
            scores = dense[:, term[items == item]] @ weights[term[items == item]]
            want = sorted(((int(s), -int(i)) for s, i in zip(scores, tree.docs.ids) if s > 0), reverse=True)[:10]
            assert sorted(best, reverse=True) == want
            seen[item] = scored
    finally:
        balltree.Tree._best = plain_best
    assert len(seen) == 12 and np.mean(list(seen.values())) < 0.5 * sum(c is None for c in tree.children)


def test_odd_rows(spark):
    """Nulls, texts without terms, a very long text, equal ids and texts, clashing columns, no rows."""
    long = " ".join(f"w{i % 5000} and" for i in range(200_000))
    docs = [(1, "A cat, a CAT!"), (1, "a dog"), (2, None), (3, ""), (None, "a cat"), (4, "?!"), (9, long), (7, "cat é　é"), (6, "cat é　é"), (6, "cat é　é")]
    items = [(1, "cat"), (1, "dog w77"), (2, None), (None, "a b c é"), (3, "..."), (4, "and " * 5000 + "w4999"), (5, "cat"), (5, "cat")]
    kind = "{} long, text string, score string, term int, n int"
    frames = [spark.createDataFrame([(*r, "s", 1, 2) for r in rows], kind.format(c)) for rows, c in ((docs, "doc_id"), (items, "item_id"))]
    assert got(balltree.ranked(*frames)) == plain(docs, items)
    assert got(balltree.ranked(frames[0].limit(0), frames[1])) == []
    assert got(balltree.ranked(frames[0], frames[1].limit(0))) == []
    named = spark.createDataFrame([("x", "cat")], "item_id string, text string")
    assert got(balltree.ranked(frames[0], named)) == plain(docs, [("x", "cat")])
