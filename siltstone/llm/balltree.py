"""Exact ranked lexical search by inner products, pruned with ball trees.

A document is a sparse vector over its terms, an item (a query) the weights of its own terms, and a score is their inner product
in 64-bit integers. Documents are dealt into trees of at most ``TREE``; a node is cut in two along
the line between two of its documents that lie far apart. For each node stand its centroid and, in each
group of terms, the radius around it. So no document below a node scores more than the centroid does, plus the sum over groups of
the item's length times the radius (Cauchy-Schwarz). An item's nodes are opened best bound first, until the bound falls below
the last of the scores found; what is left is pruned. Leaves are scored exactly.

The groups make the bound useful: a term belongs to the first item that has it, so documents without an item's terms,
of another language for instance, have radius 0 there. Vectors are scaled by the roots of the weights, which leaves
products as they are. Bounds are doubles, raised by more than their rounding errors; scores never pass through doubles.

Items are cut into blocks of ``ITEM_BYTES`` of text, as their terms are what a task holds; documents are tokenized
once for each block, and only what matches the block's terms is kept of them. The best of all trees meet by item, ten rows a tree,
ranked by Spark.

Terms are runs of letters and digits, of which A to Z are lower-cased, and of all characters beyond ASCII. Null texts and
those without a term are no documents to the counts and are never found. Rows with the same item_id are one item with the terms of
all of them; an item without terms has no rows. Documents with the same doc_id are ranked each for itself. Documents without
doc_id count in the statistics and are not ranked. Other columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm import files, words
from siltstone.sources.staging import stage

#: Documents of a tree at most, and postings at which it is full.
TREE = 8192
POSTINGS = 2_000_000
LEAF = 32
#: Text of a block of items, and items and terms whose bounds are computed together.
ITEM_BYTES = 4 << 20
PART_ITEMS = 256
PART_TERMS = 16_384
#: Relative room for rounding, thousands of times what sums of a million doubles can lose.
ROOM = 1e-9

_TERM = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)],
                 np.uint8).tobytes()


def terms(text: pa.Array) -> words.Words:
    """The terms of each text: all other characters are single bytes and become spaces."""
    text = pa.concat_arrays([text.fill_null("")])
    data = text.buffers()[2]
    plain = b"" if data is None else data.to_pybytes().translate(_TERM)
    return words.split(pa.StringArray.from_buffers(len(text), text.buffers()[1], pa.py_buffer(plain), offset=text.offset))


class Items(NamedTuple):
    """The items of a block: ``ids``, their distinct ``terms``, and (item, term, times) by item."""

    ids: pa.Array
    terms: pa.Array
    item: np.ndarray
    term: np.ndarray
    times: np.ndarray

    @classmethod
    def read(cls, file: str) -> Items:
        rows = files.read_block(file)
        found = terms(rows.column("text"))
        key, times = np.unique(np.repeat(np.arange(rows.num_rows), np.diff(found.starts)) * max(1, len(found.values)) + found.codes,
                               return_counts=True)
        return cls(rows.column("item_id"), found.values, key // max(1, len(found.values)), key % max(1, len(found.values)), times)

    def parts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The items and their entries in steps of limited numbers; one long item is a step of its own."""
        edges = np.searchsorted(self.item, np.arange(len(self.ids) + 1))
        begin = 0
        while begin < len(self.ids):
            end = begin + 1
            while end < min(len(self.ids), begin + PART_ITEMS) and edges[end + 1] - edges[begin] <= PART_TERMS:
                end += 1
            yield np.arange(begin, end), np.arange(edges[begin], edges[end])
            begin = end


def matched(docs: DataFrame, file: str) -> DataFrame:
    """(doc_id, n, terms, times) of each document with a term: the number of its terms, and those that the block's items have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Items.read(file).terms
        for batch in batches:
            for step in words.steps(batch):
                found = terms(step.column("text"))
                n = np.diff(found.starts)
                number = pc.fill_null(pc.index_in(found.values, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                number = number[found.codes]
                owner = np.repeat(np.arange(len(n)), n)
                key, times = np.unique(owner[number >= 0] * max(1, len(vocabulary)) + number[number >= 0], return_counts=True)
                owner, term = key // max(1, len(vocabulary)), key % max(1, len(vocabulary))
                ends = pa.array(np.searchsorted(owner, np.arange(len(n) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))],
                    ["doc_id", "n", "terms", "times"]).filter(pa.array(n > 0))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, times array<long>")


class Vectors(NamedTuple):
    """Documents as rows ``starts[i]:starts[i + 1]`` of ``term`` and ``value``."""

    ids: np.ndarray
    starts: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def take(self, order: np.ndarray) -> Vectors:
        lengths = np.diff(self.starts)[order]
        at = words.spread(self.starts[:-1][order], lengths)
        return Vectors(self.ids[order], words.offsets(lengths), self.term[at], self.value[at])


class Tree:
    """Documents in the order of their leaves; node ``i`` holds ``begin[i]:end[i]`` and has children or none."""

    def __init__(self, docs: Vectors, scale: np.ndarray):
        n, y = len(docs.ids), docs.value * scale[docs.term]
        squared = np.add.reduceat(y * y, docs.starts[:-1]) if n else np.empty(0)
        point = np.zeros(len(scale))
        order = np.arange(n)

        def distances(part: np.ndarray, to: int) -> np.ndarray:
            own = slice(docs.starts[to], docs.starts[to + 1])
            point[docs.term[own]] = y[own]
            lengths = docs.starts[part + 1] - docs.starts[part]
            at = words.spread(docs.starts[part], lengths)
            sums = np.add.reduceat(y[at] * point[docs.term[at]], words.offsets(lengths)[:-1])
            point[docs.term[own]] = 0
            return squared[part] + squared[to] - 2 * sums

        self.begin, self.end, self.children, self.depth = [0], [n], [], [0]
        for node in range(1 << 62):
            if node == len(self.begin):
                break
            a, b = self.begin[node], self.end[node]
            if b - a <= LEAF:
                self.children.append(None)
                continue
            part = order[a:b]
            far = distances(part, part[(b - a) // 2])
            one = distances(part, part[np.argmax(far)])
            other = distances(part, part[np.argmax(one)])
            order[a:b] = part[np.argsort(one - other, kind="stable")]
            middle = (a + b) // 2
            self.children.append((len(self.begin), len(self.begin) + 1))
            self.begin += [a, middle]
            self.end += [middle, b]
            self.depth += [self.depth[node] + 1] * 2
        self.docs = docs.take(order)

    def _balls(self, scale: np.ndarray, group: np.ndarray, docs: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """The centroid of each node, and its radius in each group of terms; ``docs`` has the terms that count."""
        n, width, groups = len(docs.ids), len(scale), int(group.max(initial=0)) + 1
        y, owner = docs.value * scale[docs.term], np.repeat(np.arange(n), np.diff(docs.starts))
        cell = owner * groups + group[docs.term]
        squared = np.bincount(cell, y * y, n * groups).reshape(n, groups)
        centers, radii = np.zeros((len(self.begin), width)), np.zeros((len(self.begin), groups))
        for node in range(len(self.begin) - 1, -1, -1):
            if self.children[node] is None:
                own = slice(docs.starts[self.begin[node]], docs.starts[self.end[node]])
                np.add.at(centers[node], docs.term[own], y[own])
            else:
                centers[node] = centers[list(self.children[node])].sum(0)
        centers /= np.maximum(1, np.subtract(self.end, self.begin))[:, None]
        length = np.zeros((len(self.begin), groups))
        order = np.argsort(group, kind="stable")
        edges = np.searchsorted(group[order], np.arange(groups))
        full = np.flatnonzero(np.diff(np.append(edges, width)))
        length[:, full] = np.add.reduceat(centers[:, order] ** 2, edges[full], axis=1) if width else 0
        begin, depth = np.array(self.begin), np.array(self.depth)
        for level in range(max(self.depth) + 1):
            nodes = np.flatnonzero(depth == level)
            nodes = nodes[np.argsort(begin[nodes])]
            sizes = np.subtract(self.end, self.begin)[nodes]
            rows = words.spread(begin[nodes], sizes)  # all, but for leaves that ended above
            at = words.spread(docs.starts[rows], docs.starts[rows + 1] - docs.starts[rows])
            local = np.repeat(np.arange(len(rows)), docs.starts[rows + 1] - docs.starts[rows])
            home = np.repeat(nodes, sizes)
            product = np.bincount(local * groups + group[docs.term[at]], y[at] * centers[home[local], docs.term[at]],
                                  len(rows) * groups).reshape(len(rows), groups)
            whole = squared[rows] + length[home]
            off = np.maximum(whole - 2 * product, 0) + ROOM * whole
            if len(rows):
                radii[nodes] = np.sqrt(np.maximum.reduceat(off, words.offsets(sizes)[:-1], axis=0))
        return centers, radii

    def search(self, items: np.ndarray, term: np.ndarray, weight: np.ndarray, scale: np.ndarray, top: int
               ) -> Iterator[tuple[int, list[tuple[int, int]], int]]:
        """(item, its best (score, -doc_id), leaves scored) of the items; entries ``item``, ``term``, ``weight`` by item."""
        names, first = np.unique(items, return_index=True)
        used, column = np.unique(term, return_inverse=True)
        new = np.full(len(scale), -1)
        new[used] = np.arange(len(used))
        inside = new[self.docs.term] >= 0
        docs = Vectors(self.docs.ids, words.offsets(np.bincount(
            np.repeat(np.arange(len(self.docs.ids)), np.diff(self.docs.starts))[inside], minlength=len(self.docs.ids))),
            new[self.docs.term[inside]], self.docs.value[inside])
        scale = scale[used]
        row = np.searchsorted(names, items)
        group = np.full(len(used), len(names))
        np.minimum.at(group, column, row)
        centers, radii = self._balls(scale, group, docs)
        scaled = np.divide(weight, scale[column], out=np.zeros(len(weight)), where=scale[column] > 0)
        dense = np.zeros((len(used), len(names)))
        dense[column, row] = scaled
        length = np.sqrt(np.bincount(group[column] * len(names) + row, scaled ** 2, radii.shape[1] * len(names)))
        bounds = (centers @ dense + radii @ length.reshape(radii.shape[1], len(names))) * (1 + ROOM)
        edges = np.append(first, len(items))
        weights = np.zeros(len(used), np.int64)
        for i, name in enumerate(names.tolist()):
            own = slice(edges[i], edges[i + 1])
            weights[column[own]] = weight[own]
            yield name, *self._best(docs, bounds[:, i], weights, top)
            weights[column[own]] = 0

    def _best(self, docs: Vectors, bounds: np.ndarray, weights: np.ndarray, top: int) -> tuple[list[tuple[int, int]], int]:
        best: list[tuple[int, int]] = []
        scored, least, open_ = 0, 1, [(-bounds[0], 0)]
        while open_:
            bound, node = heapq.heappop(open_)
            if -bound < least:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(open_, (-bounds[child], child))
                continue
            scored += 1
            a, b = self.begin[node], self.end[node]
            own = slice(docs.starts[a], docs.starts[b])
            sums = np.append(0, np.cumsum(weights[docs.term[own]] * docs.value[own]))
            scores = np.diff(sums[docs.starts[a:b + 1] - docs.starts[a]])
            for k in np.flatnonzero(scores >= least).tolist():
                entry = (int(scores[k]), -int(docs.ids[a + k]))
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == top:
                least = best[0][0]  # a document with the same score may still come first by its id
        return best, scored


def weights_of(df: np.ndarray, n_docs: int) -> np.ndarray:
    """The weight of terms that ``df`` of the documents hold."""
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def values_of(times: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to a score for each unit of its weight: ``times`` in a document of ``n`` terms."""
    m = {k: 100 - 75 + (75 * k * n_docs) // n_terms for k in np.unique(n).tolist()}  # Python's numbers don't overflow
    return (1_000_000_000 * times) // (1000 * times + 8 * np.array([m[k] for k in n.tolist()], np.int64))


def _found(postings: DataFrame, file: str, df: np.ndarray, n_docs: int, n_terms: int, top: int, kind: str) -> DataFrame:
    """(item_id, doc_id, score): the best of each tree."""
    def searched(batches: list[pa.RecordBatch], block: Items, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        lists = rows["terms"].combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        n = np.repeat(rows["n"].to_numpy(), sizes)
        times = rows["times"].combine_chunks().flatten().to_numpy()
        docs = Vectors(rows["doc_id"].to_numpy(), words.offsets(sizes), lists.flatten().to_numpy().astype(np.int64),
                       values_of(times, n, n_docs, n_terms))
        scale = np.sqrt(weights)
        tree = Tree(docs, scale)
        for _, entries in block.parts():
            weight = weights[block.term[entries]] * block.times[entries]
            found = [(i, -d, s) for i, best, _ in tree.search(block.item[entries], block.term[entries], weight, scale, top) for s, d in best]
            yield pa.RecordBatch.from_arrays(
                [block.ids.take(pa.array([f[0] for f in found], pa.int64())), *(pa.array([f[k] for f in found], pa.int64()) for k in (1, 2))],
                ["item_id", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Items.read(file)
        weights = weights_of(df, n_docs)
        kept: list[pa.RecordBatch] = []
        n_rows = n_postings = 0
        for step in words.few(batches):
            kept.append(step)
            n_rows += step.num_rows
            n_postings += pc.sum(pc.list_value_length(step.column("terms"))).as_py()
            if n_rows > TREE - 256 or n_postings >= POSTINGS:
                yield from searched(kept, block, weights)
                kept, n_rows, n_postings = [], 0, 0
        if kept:
            yield from searched(kept, block, weights)

    return postings.mapInArrow(run, f"item_id {kind}, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0, equal scores by doc_id."""
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    texts = items.select("item_id", F.col("text").cast("string").alias("text")).groupBy("item_id").agg(
        F.concat_ws("\n", F.sort_array(F.collect_list("text"))).alias("text"))
    texts = stage(texts, "item-texts")
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Each block costs a pass over the documents, so few tasks write full blocks.
    blocks = stage(files.write_blocks(texts.coalesce(1 + n_bytes // ITEM_BYTES), files.shared_folder(spark, "items"), ITEM_BYTES), "items")
    found = None
    for row in blocks.select("file").toLocalIterator():
        postings = stage(matched(docs, row["file"]), "postings")
        n_docs, n_terms = postings.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        counts = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
        df = np.zeros(len(Items.read(row["file"]).terms), np.int64)  # no more than the block's terms
        df[counts["term"].to_numpy()] = counts["df"].to_numpy()
        # A tree costs the same however few its documents are: no more tasks than full trees or cores ask for.
        tasks = max(spark.sparkContext.defaultParallelism, -(-n_docs // TREE))
        known = postings.filter("doc_id is not null and cardinality(terms) > 0").select("doc_id", "n", "terms", "times").coalesce(tasks)
        best = _found(known, row["file"], df, n_docs, n_terms, top, kind)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))
