"""Test items inside training documents, also edited ones.

A match is a local alignment (Smith-Waterman) that reaches SHARE of what the item scores against
itself, and all matches are found, as if every item were aligned with every document. A pair is left
out only where a bound on its score says so. With the scores below an alignment that reaches SHARE

- covers at most twice as many words of the text as the item has, and matches half of the item's words;
- holds three matching words in a row, or else matches all but a third of the item's words, since runs of at most
  two words need an edit between any two of them; then it misses at most one word more than it has runs of two.

So documents are looked up by all runs of three words of an item, and by its rarer words, of which, with the
runs of two, enough must be there; a first pass over the corpus counts in how many documents each word occurs, which
decides about cost only. Around what was found the item's words are counted, and where enough of them stand
close together the item is aligned. Both passes work on each document where it is read, so nothing is shuffled
and no word or passage can be hot.

The test items are a query set: the driver takes them in blocks of fixed size, and each block meets
all documents. Words are compared in lower case without marks. Null and empty texts match nothing;
an item without words has no match; an item of fewer than three words matches where it stands whole. Equal
items and equal documents are reported each. Other columns are kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import words

GRAM = 3
BLOCK_ITEMS = 20_000
#: An alignment reaches this share of what the item scores against itself.
SHARE = 0.5
#: The bounds of this module (``Items.of``, ``_near``) follow from these and from SHARE.
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
#: Entries that a step of the search expands at a time.
ROOM = 500_000


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the starts of each text."""
    codes, starts, values = words.split(text)
    bare = pc.replace_substring_regex(pc.utf8_lower(values), r"[^\p{L}\p{N}]+", "")
    full = pc.greater(pc.binary_length(bare), 0).to_numpy(zero_copy_only=False)[codes]
    kept = words.offsets(full)
    return words.hashed(bare)[codes[full]], kept[starts]


@dataclass
class Items:
    """A block of test items and what they are looked for by."""

    ids: list
    items: list[np.ndarray]
    sizes: np.ndarray
    seeds: np.ndarray  # runs of GRAM words, and short items; sorted, may repeat
    owner: np.ndarray  # the item of each seed
    short: bool  # whether some item is shorter than a seed
    vocabulary: np.ndarray  # words of the items, sorted
    entries: np.ndarray  # item and place in the vocabulary of each distinct word of an item, as one number, sorted
    times: np.ndarray  # how often the item has the word
    rare: np.ndarray  # entries of rarer words, by word
    weighed: np.ndarray  # how many words of an item these are
    couples: np.ndarray  # runs of two words, sorted, may repeat
    couple_owner: np.ndarray
    couple_times: np.ndarray  # how often the item has the run

    @classmethod
    def of(cls, ids: list, items: list[np.ndarray], counts: dict[int, int]) -> Items:
        """With the number of documents of each word."""
        sizes = np.array([len(i) for i in items], np.int64)
        grams = [np.unique(words.grams(i, min(GRAM, max(len(i), 1)))) for i in items]
        flat = np.concatenate([*grams, np.empty(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        vocabulary, word = np.unique(np.concatenate([*items, np.empty(0, np.uint64)]), return_inverse=True)
        entries, times = np.unique(np.repeat(np.arange(len(items)), sizes) * len(vocabulary) + word, return_counts=True)
        # In order of rarity, the words of an item up to a third more than an alignment without a seed can miss.
        item, word = np.divmod(entries, max(len(vocabulary), 1))
        found = np.array([counts.get(int(w), 0) for w in vocabulary], np.int64)
        rank = np.lexsort((word, found[word], item))
        first = words.offsets(np.bincount(item, minlength=len(items)))
        before = words.offsets(times[rank])
        before = before[:-1] - before[first[item[rank]]]
        missed = (sizes + 2) // 3
        taken = (before < missed[item[rank]] + np.maximum(sizes // 3, 1)[item[rank]]) & (sizes[item[rank]] >= GRAM)
        rare = rank[taken]
        weighed = np.bincount(item[rare], times[rare], minlength=len(items)).astype(np.int64)
        couples = [np.unique(words.grams(i, 2), return_counts=True) for i in items]
        couple = np.concatenate([*[c for c, _ in couples], np.empty(0, np.uint64)])
        by = np.argsort(couple, kind="stable")
        return cls(ids, items, sizes, flat[order], np.repeat(np.arange(len(items)), [len(g) for g in grams])[order],
                   bool(((sizes > 0) & (sizes < GRAM)).any()), vocabulary, entries, times,
                   rare[np.argsort(word[rare], kind="stable")], weighed, couple[by],
                   np.repeat(np.arange(len(items)), [len(c) for c, _ in couples])[by],
                   np.concatenate([*[n for _, n in couples], np.empty(0, np.int64)])[by])

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word in the vocabulary, -1 where it isn't there."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def hits(self, hashes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in the words and seeds that begin there, of all texts, by length of seed."""
        for n in range(1 if self.short else GRAM, GRAM + 1):
            found = words.grams(hashes, n)
            at = np.minimum(np.searchsorted(self.seeds, found), max(len(self.seeds) - 1, 0))
            place = np.flatnonzero(self.seeds[at] == found) if len(self.seeds) else np.empty(0, np.int64)
            doc = np.searchsorted(starts, place, side="right") - 1
            inside = place + n <= starts[doc + 1]
            yield place[inside], found[place[inside]]

    def met(self, known: np.ndarray, hashes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Texts and items without regard to seeds: enough of the item's rarer words stand in the text."""
        many, width = max(len(self.items), 1), max(len(self.vocabulary), 1)
        missed = (self.sizes + 2) // 3
        item, word = np.divmod(self.entries[self.rare], width)
        lists = words.offsets(np.bincount(word, minlength=width))
        place = np.flatnonzero(known >= 0)
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[place]
        doc, word = np.divmod(np.unique(owner * width + known[place]), width)
        # A run over the edge of two texts counts for the first: too many, never too few.
        at = place[:-1][np.diff(place) == 1]
        run_doc = owner[:-1][np.diff(place) == 1]
        run = words.grams(hashes, 2)[at]
        length = np.diff(lists)[word]
        doc, word, length = doc[length > 0], word[length > 0], length[length > 0]
        # Whole documents, about ROOM entries at a time.
        ends = np.cumsum(length)
        group = np.searchsorted(np.arange(0, ends[-1] if len(ends) else 0, ROOM), ends - length, side="right")
        group = group[np.searchsorted(doc, doc)]
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(doc)]
        for a, b in zip(cuts, cuts[1:]):
            entry = words.spread(lists[word[a:b]], length[a:b])
            key = np.repeat(doc[a:b], length[a:b]) * many + item[entry]
            order = np.argsort(key, kind="stable")
            key, weight = key[order], self.times[self.rare[entry[order]]]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            total = np.add.reduceat(weight, first) if len(first) else weight
            found, total = key[first], total if len(first) else total[:0]
            lacking = self.weighed[found % many] - total
            keep = lacking <= missed[found % many]
            found, lacking = found[keep], lacking[keep]
            # At most one word more is missed than there are runs of two.
            inside = np.isin(run_doc, found // many)
            low = np.searchsorted(self.couples, run[inside], "left")
            high = np.searchsorted(self.couples, run[inside], "right")
            mine = words.spread(low, high - low)
            span = max(len(self.couples), 1)
            on, mine = np.divmod(np.unique(np.repeat(run_doc[inside], high - low) * span + mine), span)
            key = on * many + self.couple_owner[mine]
            pair = np.searchsorted(found, key)
            same = found[np.minimum(pair, len(found) - 1)] == key if len(found) else np.zeros(len(key), bool)
            two = np.bincount(pair[same], self.couple_times[mine[same]], minlength=len(found))
            yield np.divmod(found[lacking <= two + 1], many)


def aligned(item: np.ndarray, text: np.ndarray) -> float:
    """The best local alignment score of two word sequences."""
    steps = -GAP * np.arange(1, len(text) + 1)
    row, best = np.zeros(len(text) + 1), 0.0
    for word in item:
        new = np.maximum(row[:-1] + np.where(text == word, MATCH, MISMATCH), row[1:] + GAP)
        new = np.maximum.accumulate(np.maximum(new, 0) + steps) - steps
        row[1:] = new
        best = max(best, float(new.max(initial=0.0)))
    return best


def _seeded(block: Items, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(text, item, begin, end) around seeds; seeds of one item that lie near each other share a row."""
    pairs = [np.empty((0, 2), np.int64)]
    for place, seed in block.hits(hashes, starts):
        low, high = np.searchsorted(block.seeds, seed, "left"), np.searchsorted(block.seeds, seed, "right")
        pairs.append(np.column_stack([np.repeat(place, high - low), block.owner[words.spread(low, high - low)]]))
    place, item = np.concatenate(pairs).T
    doc = np.searchsorted(starts, place, side="right") - 1
    order = np.lexsort((place, item, doc))
    place, item, doc = place[order], item[order], doc[order]
    reach = 2 * block.sizes[item]
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(place) > reach[1:])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place))[:len(first)] - 1
    return np.column_stack([doc[first], item[first], np.maximum(starts[doc[first]], place[first] - reach[first]),
                            np.minimum(starts[doc[first] + 1], place[last] + reach[first])])


def _near(block: Items, known: np.ndarray, ranges: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """The parts of ranges in which twice the item's length holds ``needed`` of its words, and so does the whole."""
    out = [np.empty((0, 4), np.int64)]
    length = ranges[:, 3] - ranges[:, 2]
    group = (np.cumsum(length) - length) // ROOM
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(ranges)]
    for a, b in zip(cuts, cuts[1:]):
        some, need = ranges[a:b], needed[a:b]
        owner = np.repeat(np.arange(b - a), length[a:b])
        at = words.spread(some[:, 2], length[a:b])
        key = some[owner, 1] * max(len(block.vocabulary), 1) + known[at]
        entry = np.minimum(np.searchsorted(block.entries, key), max(len(block.entries) - 1, 0))
        there = (known[at] >= 0) & (block.entries[entry] == key) if len(block.entries) else np.zeros(len(at), bool)
        met = np.unique(owner[there] * len(block.entries) + entry[there])
        whole = np.bincount(met // max(len(block.entries), 1), block.times[met % max(len(block.entries), 1)], minlength=b - a)
        before = words.offsets(there)
        reach = 2 * block.sizes[some[owner, 1]]
        begin = np.arange(len(at))
        end = np.minimum(begin + reach, np.cumsum(length[a:b])[owner])
        place = np.flatnonzero((before[end] - before[begin] >= need[owner]) & (whole >= need)[owner])
        # Starts with nothing between them make one part.
        new = np.ones(len(place), bool)
        new[1:] = (np.diff(owner[place]) != 0) | (np.diff(place) > reach[place[1:]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place))[:len(first)] - 1
        row = owner[place[first]]
        out.append(np.column_stack([some[row, :2], at[place[first]], at[end[place[last]] - 1] + 1]))
    return np.concatenate(out)


def _matches(block: Items, hashes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, float, int]]:
    """(text, item, share, first word) of all matches of a step; the best place of each pair."""
    known = block.places(hashes)
    seeded = _seeded(block, hashes, starts)
    # An item shorter than a seed stands whole where its seed is.
    parts = [_near(block, known, seeded, (block.sizes[seeded[:, 1]] + 1) // 2)]
    for doc, item in block.met(known, hashes, starts):
        whole = np.column_stack([doc, item, starts[doc], starts[doc + 1]])
        parts.append(_near(block, known, whole, -(-(2 * block.sizes[item] - 2) // 3)))
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for d, i, begin, end in np.concatenate(parts).tolist():
        share = aligned(block.items[i], hashes[begin:end]) / (MATCH * len(block.items[i]))
        if share >= SHARE and share > best.get((d, i), (0.0, 0))[0]:
            best[d, i] = share, int(begin - starts[d])
    return [(d, i, *found) for (d, i), found in sorted(best.items())]


def _blocks(benchmark: DataFrame, size: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Test items in blocks, streamed through the driver one block at a time."""
    ids, texts = [], []
    for row in benchmark.select("item_id", "text").toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"])
        if len(ids) == size:
            yield ids, _split(texts)
            ids, texts = [], []
    if ids:
        yield ids, _split(texts)


def _split(texts: list) -> list[np.ndarray]:
    hashes, starts = word_hashes(pa.array(texts, pa.string()))
    return [hashes[a:b] for a, b in zip(starts, starts[1:])]


def document_counts(docs: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """In how many documents each of the words occurs; as many rows as words at most."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        total = np.zeros(len(known), np.int64)
        for batch in batches if len(known) else ():
            for step in words.steps(batch):
                hashes, starts = word_hashes(step.column("text"))
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                place = np.flatnonzero(known[at] == hashes)
                doc = np.searchsorted(starts, place, side="right") - 1
                total += np.bincount(np.unique(doc * len(known) + at[place]) % len(known), minlength=len(known))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({
            "word": pa.array(known[seen].view(np.int64)), "n": pa.array(total[seen], pa.int64())})

    rows = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {int(np.int64(r["word"]).view(np.uint64)): r["n"] for r in rows}


def prepared(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> Iterator[Items]:
    """Blocks of test items with what finds them; one pass over the documents for each block."""
    for ids, items in _blocks(benchmark, block_items):
        vocabulary = np.unique(np.concatenate([*items, np.empty(0, np.uint64)]))
        yield Items.of(ids, items, document_counts(docs, vocabulary))


def find(docs: DataFrame, block: Items) -> DataFrame:
    """(doc_id, item_id, share, first_word): each document and item that align well enough."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        items = shared.value
        for batch in batches:
            for step in words.steps(batch):
                found = _matches(items, *word_hashes(step.column("text")))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": step.column("doc_id").take(pa.array([f[0] for f in found], pa.int64())),
                    "item_id": pa.array([items.ids[f[1]] for f in found], pa.int64()),
                    "share": pa.array([f[2] for f in found], pa.float64()),
                    "first_word": pa.array([f[3] for f in found], pa.int64())})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, share double, first_word long")


def matches(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """All matches of all test items."""
    out = None
    for block in prepared(docs, benchmark, block_items):
        found = find(docs, block)
        out = found if out is None else out.union(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, share double, first_word long")
    return out


def clean(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The documents in which no test item is found, with all their columns."""
    for block in prepared(docs, benchmark, block_items):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                for step in words.steps(batch):
                    found = {f[0] for f in _matches(shared.value, *word_hashes(step.column("text")))}
                    yield step.filter(pa.array([i not in found for i in range(step.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
