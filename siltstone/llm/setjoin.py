"""Near duplicates by a chosen-path set similarity join.

A document is the set of its word shingles. Documents with equal sets are one from the
start. Each of several independent trees sends a document to the node of its least
shingle under the tree's own order. A node is compared exhaustively if few of its documents are
unsettled, that is, not yet known to be linked with the largest class of the node. Other nodes
branch: one or two further orders are chosen for the node, and each sends a document to the child
of its least shingle under that order. The number chosen is 1 / similarity on average, so pairs below
the similarity thin out from level to level and pairs above it stay together in enough trees.

Before the trees grow, each document is compared with the smallest document of its
nodes. That settles large groups of copies by one link for each copy, so no node has to compare the
pairs inside a group. The trees grow a second time from nodes that had to branch, with what is settled by then. Candidates
pass a test on sketches first, then the intersection of the full sets decides. Neither lists pairs: a comparison returns
which rows hang together, a row for each, and what hangs together over all trees is fetched and compared at once. The recall is that of the trees: see ``recall``.

Hot nodes: counts are summed before the shuffle, joins are split by adaptive execution, and
a comparison is dealt out in chunks of a node. Texts without words have an empty set and are linked with
nothing; null texts are empty. Rows without doc_id take no part and are kept. Rows with the same doc_id are one document.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import files, words
from siltstone.llm.components import components, smallest
from siltstone.sources.staging import stage

TREES = 16
SKETCH = 192  # 8-bit values
CHUNK = 1024
#: Shingles of the sets that a task compares with others at a time.
CHUNK_SHINGLES = 1 << 20
#: Pairs of sketches in memory at a time.
STEP_PAIRS = 1 << 15
#: Full sets sent at a time.
SENT_ROWS = 256
#: Chunks of asking rows beyond which a cluster is compared by its groups.
MANY = 16
ROUNDS = 2
LEVELS = 24
#: Standard deviations below the similarity at which a sketch rules a pair out.
MARGIN = 4.0


@dataclass(frozen=True)
class Rule:
    """Links sets of ``shingle``-word runs whose Jaccard similarity is ``percent`` or more."""

    shingle: int = 5
    percent: int = 80
    trees: int = TREES

    @property
    def least_equal(self) -> int:
        """Equal sketch values that a pair needs to be looked at; unequal minima agree in 8 bits now and then."""
        p = self.percent / 100
        p += (1 - p) / 256
        return max(1, int(SKETCH * p - MARGIN * np.sqrt(SKETCH * p * (1 - p))))


def recall(rule: Rule, similarity: float, depth: int) -> float:
    """The least chance that a pair of this similarity meets in a node at this depth of some tree."""
    more = 100 / rule.percent - 1  # chance of a second order
    stays = 1.0
    for _ in range(depth):
        one = similarity * stays
        stays = (1 - more) * one + more * (1 - (1 - one) ** 2)
    return 1 - (1 - similarity * stays) ** rule.trees


def shingle_sets(text: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``n`` are one shingle."""
    codes, starts, values = words.split(words.lower_ascii(text))
    hashes = words.hashed(values)[codes]
    out = []
    for a, b in zip(starts.tolist(), starts[1:].tolist()):
        out.append(np.unique(words.grams(hashes[a:b], min(n, b - a))) if b > a else np.empty(0, np.uint64))
    return out


def _orders(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(6)
    return draw.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 1 << 63, count, np.uint64)


def sketched(manifest: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, block, row, n_shingles, set_key, roots, sketch) of each row: the least hashes under all orders."""
    factors, shifts = _orders(rule.trees + SKETCH)

    def run(batches):
        words.release(memories=True)
        for rows in batches:
            for block, file in zip(rows.column("block").to_pylist(), rows.column("file").to_pylist()):
                step = files.read_block(file)
                sets = shingle_sets(step.column("text"), rule.shingle)
                sizes = np.fromiter(map(len, sets), np.int64, len(sets))
                full = np.flatnonzero(sizes)
                least = np.zeros((len(factors), len(sets)), np.uint64)
                if len(full):
                    flat = np.concatenate(sets)
                    begins = (np.cumsum(sizes) - sizes)[full]
                    for k, (factor, shift) in enumerate(zip(factors, shifts)):
                        least[k, full] = np.minimum.reduceat(flat * factor + shift, begins)
                roots = words.mixed(least[:rule.trees].T + np.arange(rule.trees, dtype=np.uint64) * factors[:rule.trees])
                sketch = words.mixed(least[rule.trees:].T).astype(np.uint8)
                none = sizes == 0
                yield pa.RecordBatch.from_pydict({
                    "doc_id": step.column("doc_id"), "block": pa.array(np.full(len(sets), block), pa.int64()),
                    "row": pa.array(np.arange(len(sets)), pa.int64()), "n_shingles": pa.array(sizes),
                    "set_key": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary(), mask=none),
                    "roots": pa.FixedSizeListArray.from_arrays(pa.array(roots.view(np.int64).ravel()), rule.trees).cast(pa.list_(pa.int64())),
                    "sketch": pa.array([s.tobytes() for s in sketch], pa.binary(), mask=none)})

    return manifest.mapInArrow(
        run, "doc_id long, block long, row long, n_shingles long, set_key binary, roots array<long>, sketch binary")


def _fits(rule: Rule, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be similar enough at all."""
    return 100 * np.minimum(a, b) >= rule.percent * np.maximum(a, b)


def _by_runs(compare):
    """Call ``compare`` with whole runs of (group, chunk), which may go on in the next batch."""
    def run(batches):
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group, chunk = batch.column("group").to_numpy(), batch.column("chunk").to_numpy()
            ends = np.flatnonzero((np.diff(group) != 0) | (np.diff(chunk) != 0))
            key = group[0], chunk[0]
            if rest and (rest[0].column("group")[-1].as_py(), rest[0].column("chunk")[-1].as_py()) != key:
                yield from compare(pa.Table.from_batches(rest))
                rest = []
            if len(ends):
                cut = int(ends[-1]) + 1
                yield from compare(pa.Table.from_batches([*rest, batch.slice(0, cut)]))
                rest, batch = [], batch.slice(cut)
            rest.append(batch)
        if rest:
            yield from compare(pa.Table.from_batches(rest))

    return run


def _runs(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of (group, chunk)."""
    group, chunk = t["group"].to_numpy(), t["chunk"].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(group) != 0) | (np.diff(chunk) != 0)]))
    return starts, np.diff([*starts, len(group)])


def _cells(rows: DataFrame, asks, asked, askers) -> DataFrame:
    """Deal the rows of each group over the cells (``chunk``) of ``asked`` by ``askers`` chunks: all rows by those that ask.

    A row is in a cell once; ``role`` tells whether it is asked there (1), asks (2) or both (3).
    """
    own, group = F.pmod(F.xxhash64("rep", F.lit(1)), asked), F.pmod(F.xxhash64("rep", F.lit(2)), askers)

    def cell(chunk, role):
        return F.struct(chunk.cast("long").alias("chunk"), role.cast("int").alias("role"))

    as_asked = F.transform(F.sequence(F.lit(0).cast("long"), askers - 1), lambda g: cell(
        own * askers + g, F.when(asks & (g == group), 3).otherwise(1)))
    as_asking = F.transform(F.filter(F.sequence(F.lit(0).cast("long"), asked - 1), lambda c: asks & (c != own)), lambda c: cell(
        c * askers + group, F.lit(2)))
    return rows.withColumn("place", F.explode(F.concat(as_asked, as_asking)))


def _candidates(rule: Rule):
    """Compare rows that ask with the rows of their cell by their sketches.

    What comes out is no list of pairs: rows that candidates lead from one to another are a group, a row for each of
    its rows, with one of them as ``hub``.
    """
    def compare(t: pa.Table):
        rep, label, role, size = (t[c].to_numpy() for c in ("rep", "label", "role", "n_shingles"))
        sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
        starts, sizes = _runs(t)
        run = np.repeat(np.arange(len(starts)), sizes)
        asking, found = np.flatnonzero(role & 2), [np.empty((0, 2), np.int64)]
        width = sizes[run[asking]]
        for part in np.split(np.arange(len(asking)), np.flatnonzero(np.diff(np.cumsum(width) // STEP_PAIRS)) + 1):
            a = np.repeat(asking[part], width[part])
            b = words.spread(starts[run[asking[part]]], width[part])
            differ = (label[a] != label[b]) & (role[b] & 1 > 0) & _fits(rule, size[a], size[b])
            a, b = a[differ], b[differ]
            close = (sketch[a] == sketch[b]).sum(1) >= rule.least_equal
            # A forest of the links is as good as all of them.
            a, b = a[close], b[close]
            ends, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            least = ends[smallest(len(ends), at[:len(a)], at[len(a):])]
            found.append(np.column_stack([least, ends])[least != ends])
        links = np.concatenate(found)
        hub = smallest(len(rep), links[:, 0], links[:, 1])
        out = np.flatnonzero(np.bincount(hub, minlength=len(rep))[hub] > 1)
        hub = hub[out]
        key = words.mixed(t["group"].to_numpy()[out].view(np.uint64) + words.mixed(t["chunk"].to_numpy()[out].view(np.uint64)))
        key = words.mixed(key + rep[hub].view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_pydict({
            "group": pa.array(key), "hub": pa.array(rep[hub]), "rep": pa.array(rep[out]), "label": pa.array(label[out]),
            "asks": pa.array((role[out] & 2) > 0)})

    return _by_runs(compare)


def _links(rule: Rule):
    """Compare the full sets of rows that ask with those of the rows of their cell; links come out as a star."""
    def compare(t: pa.Table):
        rep, label, role = (t[c].to_numpy() for c in ("rep", "label", "role"))
        shapes, found = t["shape"], []
        for start, count in zip(*(x.tolist() for x in _runs(t))):
            at = slice(start, start + count)
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in shapes.slice(start, count)]
            sizes = np.fromiter(map(len, sets), np.int64, count)
            codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
            begins, mine, asked = np.cumsum(sizes) - sizes, label[at], role[at] & 1 > 0
            held, pairs = np.zeros(codes.max() + 1, np.int32), []
            for i in np.flatnonzero(role[at] & 2).tolist():
                others = np.flatnonzero(asked & (mine != mine[i]) & _fits(rule, sizes, sizes[i]))
                if not len(others):
                    continue
                own = codes[begins[i]:begins[i] + sizes[i]]
                held[own] = 1
                each = sizes[others]
                both = np.add.reduceat(held[codes[words.spread(begins[others], each)]], np.cumsum(each) - each)
                held[own] = 0
                others = others[100 * both >= rule.percent * (each + sizes[i] - both)]
                pairs.append(np.column_stack([np.full(len(others), i), others]))
            if pairs:
                pairs = np.concatenate(pairs)
                least = smallest(count, pairs[:, 0], pairs[:, 1])
                rows = np.flatnonzero(least != np.arange(count))
                found.append(np.column_stack([rep[at][least[rows]], rep[at][rows]]))
        pairs = np.concatenate([*found, np.empty((0, 2), np.int64)])
        yield pa.RecordBatch.from_pydict({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return _by_runs(compare)


def _confirmed(rows: DataFrame, classes: DataFrame, manifest: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) inside groups: ``rows`` are (group, rep, label, asks), and those that ask are compared with all of other labels.

    A link is told as a way over other rows of the cell. The full sets are computed anew by the blocks that hold the
    texts and go from there to the cells.
    """
    rows = stage(rows.join(classes.select("rep", "block", "row", "n_shingles"), "rep"), "candidates")
    weight = F.when(F.col("asks"), F.col("n_shingles")).otherwise(0)

    def chunks(count, shingles):
        return F.greatest(F.lit(1), F.ceil(count / CHUNK), F.ceil(shingles / CHUNK_SHINGLES)).cast("long")

    groups = rows.groupBy("group").agg(chunks(F.count("*"), F.sum("n_shingles")).alias("asked"),
                                       chunks(F.count_if("asks"), F.sum(weight)).alias("askers"))
    dealt = _cells(rows.join(groups, "group"), F.col("asks"), F.col("asked"), F.col("askers"))

    def run(batches):
        for batch in batches:
            for file, cells in zip(batch.column("file").to_pylist(), batch.column("cells")):
                cells = pa.RecordBatch.from_struct_array(cells.values)
                # A few rows of the block at a time: a row may be sent to many cells.
                cells = cells.sort_by("row")
                text = files.read_block(file, ["text"]).column("text")
                for at in range(0, cells.num_rows, SENT_ROWS):
                    part = cells.slice(at, SENT_ROWS)
                    needed, place = np.unique(part.column("row").to_numpy(), return_inverse=True)
                    sets = [s.tobytes() for s in shingle_sets(text.take(pa.array(needed)), rule.shingle)]
                    shape = pa.array([sets[i] for i in place.tolist()], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in ("group", "chunk", "rep", "label", "role")), shape],
                        ["group", "chunk", "rep", "label", "role", "shape"])

    # A block lists those of its rows that are needed, so a list has few more entries than the block has rows.
    cells = F.struct("row", "group", "place.chunk", "rep", "label", "place.role")
    wanted = dealt.repartition(max(1, manifest.count()), "block").groupBy("block").agg(F.collect_list(cells).alias("cells"))
    sent = wanted.join(manifest, "block").select("file", "cells").mapInArrow(
        run, "group long, chunk long, rep long, label long, role int, shape binary")
    found = sent.repartition("group", "chunk").sortWithinPartitions("group", "chunk").mapInArrow(_links(rule), "a long, b long")
    return stage(found, "links")


def _grown(members: DataFrame, sketches: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame | None]:
    """Candidate groups of all trees (group, hub, rep, label, asks) and the members of root nodes that branched; members are (node, root, rep, label)."""
    found, branched = None, None
    for level in range(LEVELS + 1):
        classes = members.groupBy("node", "label").agg(F.count("*").alias("n"))
        nodes = (classes.groupBy("node").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top"))
                 .withColumn("open", F.col("n") - F.col("top.n")).filter("open > 0")
                 .select("node", "n", "open", F.col("top.label").alias("settled")))
        members = stage(members.join(nodes, "node"), "members")
        small = members if level == LEVELS else members.filter(F.col("open") <= CHUNK)
        # Each chunk of a node meets all of its unsettled rows, themselves in chunks if they are many.
        dealt = _cells(small.join(sketches, "rep"), F.col("label") != F.col("settled"),
                       F.ceil(F.col("n") / CHUNK).cast("long"), F.ceil(F.col("open") / CHUNK).cast("long"))
        dealt = (dealt.select(F.col("node").alias("group"), "place.chunk", "rep", "label", "sketch", "n_shingles", "place.role")
                 .repartition("group", "chunk").sortWithinPartitions("group", "chunk"))
        groups = dealt.mapInArrow(_candidates(rule), "group long, hub long, rep long, label long, asks boolean")
        found = groups if found is None else found.unionByName(groups)
        if level == LEVELS:
            break
        large = members.filter(F.col("open") > CHUNK)
        if large.isEmpty():
            break
        if branched is None:
            branched = large.select("node", "rep")
        # One order for each node, two for as many nodes as the similarity asks for.
        second = F.pmod(F.xxhash64("node", F.lit("two")), F.lit(1_000_000)) < int(1_000_000 * (100 / rule.percent - 1))
        picks = F.sequence(F.lit(0), F.when(second, 1).otherwise(0))
        pick = F.pmod(F.xxhash64("node", "k"), F.lit(SKETCH)).cast("int")
        members = (large.select("node", "rep", "label").join(sketches.select("rep", "sketch"), "rep")
                   .withColumn("k", F.explode(picks)).withColumn("pick", pick)
                   .select(F.xxhash64("node", "k", "pick", F.expr("substring(sketch, pick + 1, 1)")).alias("node"), "rep", "label"))
    return stage(found, "groups"), branched


def _clustered(groups: DataFrame) -> DataFrame:
    """(group, rep, label, asks): the groups that share rows as one, so that a row is looked at once for all trees.

    Rows of the largest class of a cluster don't ask. Clusters in which very many ask stay the groups that they are made of.
    """
    of = components(groups.select(F.col("hub").alias("a"), F.col("rep").alias("b"))).select(
        F.col("v").alias("rep"), F.col("label").alias("cluster"))
    rows = stage(groups.select("rep", "label").distinct().join(of, "rep"), "clusters")
    sizes = (rows.groupBy("cluster", "label").agg(F.count("*").alias("n")).groupBy("cluster")
             .agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top"))
             .select("cluster", F.col("top.label").alias("settled"), (F.col("n") - F.col("top.n") > MANY * CHUNK).alias("many")))
    rows = rows.join(sizes, "cluster")
    whole = rows.filter("not many").select(F.xxhash64("cluster").alias("group"), "rep", "label", (F.col("label") != F.col("settled")).alias("asks"))
    parts = groups.join(rows.filter("many").select("rep"), "rep").select("group", "rep", "label", "asks")
    return whole.unionByName(parts)


def linked(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of documents.

    ``component_id`` is the smallest doc_id that links lead to; null and empty sets, and rows
    without doc_id, keep their own. ``kept``: whether it is the row's own.
    """
    manifest = stage(files.write_blocks(docs.select("doc_id", "text"), files.shared_folder(docs.sparkSession, "blocks")), "blocks")
    manifest = manifest.select("block", "file")
    rows = stage(sketched(manifest.repartition(max(1, manifest.count()), "block"), rule), "sketches")
    known = rows.filter("set_key is not null and doc_id is not null")
    classes = stage(known.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "block", "row")).alias("least"), F.first("sketch").alias("sketch"),
        F.first("roots").alias("roots"), F.first("n_shingles").alias("n_shingles")).select(
            "set_key", F.col("least.doc_id").alias("rep"), "least.block", "least.row", "sketch", "roots", "n_shingles"), "classes")
    sketches = classes.select("rep", "sketch", "n_shingles")
    members = classes.select(F.explode("roots").alias("node"), "rep")
    shared = members.groupBy("node").agg(F.count("*").alias("n"), F.min("rep").alias("hub")).filter("n > 1").select("node", "hub")
    members = stage(members.join(shared, "node"), "members")

    hubs = sketches.select(F.col("rep").alias("hub"), F.col("sketch").alias("hub_sketch"), F.col("n_shingles").alias("hub_size"))
    met = members.filter("rep <> hub").groupBy("rep").agg(F.collect_set("hub").alias("hubs")).join(sketches, "rep")
    near = stage(met.withColumn("hub", F.explode("hubs")).drop("hubs").join(hubs, "hub").mapInArrow(_near(rule), "a long, b long"), "pairs")
    stars = near.select(F.col("a").alias("group"), F.col("b").alias("rep"), F.lit(False).alias("asks")).unionByName(
        near.select(F.col("a").alias("group"), F.col("a").alias("rep"), F.lit(True).alias("asks")).distinct())
    links = _confirmed(stars.withColumn("label", F.col("rep")), classes, manifest, rule)
    # Nodes that did not branch are done after the first round; the links found may settle the others.
    left = members.select("node", "rep")
    for _ in range(ROUNDS):
        labels = components(links)
        labelled = (left.join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left")
                    .select("node", "rep", F.coalesce("label", "rep").alias("label")))
        groups, left = _grown(labelled, sketches, rule)
        links = links.unionByName(_confirmed(_clustered(groups), classes, manifest, rule))
        if left is None:
            break
    # Rows of one doc_id are one document even where their sets differ.
    same = known.join(classes.select("set_key", "rep"), "set_key").filter("doc_id <> rep").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    repeated = same.join(classes.select(F.col("rep").alias("a")), "a", "left_semi")
    final = components(links.unionByName(repeated))
    found = classes.select("set_key", "rep").join(final.select(F.col("v").alias("rep"), "label"), "rep", "left").select(
        "set_key", F.coalesce("label", "rep").alias("component_id"))
    return (rows.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _near(rule: Rule):
    """Pairs of rows (rep, hub) whose sketches agree enough."""
    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH) for c in ("sketch", "hub_sketch"))
            fits = _fits(rule, *(batch.column(c).to_numpy() for c in ("n_shingles", "hub_size")))
            close = pa.array(fits & ((x == y).sum(1) >= rule.least_equal))
            yield pa.RecordBatch.from_arrays([batch.column("hub"), batch.column("rep")], ["a", "b"]).filter(close)
    return run
