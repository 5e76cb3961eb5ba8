"""Cross-entropy difference under a target and a background bigram model.

Both models are counted over the corpus and share its whole vocabulary: the background over all
documents, the target over the documents that are named as such. The counts of a document
itself are left out when it is scored. A word follows another with the probability

    (count of the pair + MIXED * probability of the word) / (count of the first + MIXED)

where the word alone has (count + ADDED) / (words + ADDED * vocabulary). A document's score is the mean over
its words of the target's loss less the background's loss, in nats; low means near the target.

Blocks of documents send each distinct word and pair with their counts to a bucket of hashes, once for each
block, so a frequent pair costs one entry for each block and no more. The buckets add up and
answer in the same order, and the blocks, read again from their files, look the answers up by place.

Words are lower-cased runs between ASCII white space. Null and empty texts have no words: losses 0 and no words.
Rows without doc_id are scored and are never a target. Repeated rows count each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import files, words
from siltstone.llm.suffixes import _blob, _bucket, _joined
from siltstone.sources.staging import stage

MIXED = 2.0
ADDED = 0.5
#: Larger blocks than elsewhere: the larger, the fewer words and pairs are asked for twice.
BLOCK_BYTES = 8 << 20


def _small(values: np.ndarray) -> bytes:
    """Counts are mostly small numbers and shrink to an eighth."""
    return zstandard.compress(_blob(values), 1)


def _grown(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(zstandard.decompress(v) for v in table[column].to_pylist() if v is not None), kind)


class _Block:
    """The words and pairs of a block: keys of all, and the distinct ones in ascending order."""

    def __init__(self, file: str):
        batch = files.read_block(file)
        self.doc_ids = batch.column("doc_id")
        codes, self.starts, values = words.split(pc.utf8_lower(pc.fill_null(batch.column("text"), "")))
        word = words.hashed(values)[codes]
        self.doc = np.repeat(np.arange(batch.num_rows), np.diff(self.starts))
        self.first = np.zeros(len(word), bool)
        self.first[self.starts[:-1][np.diff(self.starts) > 0]] = True
        before = np.flatnonzero(~self.first)
        pair = words.mixed(word[before - 1] * np.uint64(0xD6E8FEB86659FD93) + word[before])
        self.keys, self.at = np.unique(np.concatenate([word, pair]), return_inverse=True)
        self.word, self.pair = self.at[:len(word)], np.full(len(word), -1, np.int64)
        self.pair[before] = self.at[len(word):]
        self.alone = np.zeros(len(self.keys), bool)
        self.alone[self.word] = True

    def counts(self, of: np.ndarray) -> np.ndarray:
        """How often each key occurs in the chosen documents."""
        mine = of[self.doc]
        return np.bincount(np.concatenate([self.word[mine], self.pair[mine & ~self.first]]), minlength=len(self.keys))

    def own(self, at: np.ndarray) -> np.ndarray:
        """How often each place's key occurs in the place's document."""
        pair, back, n = np.unique(self.doc * (len(self.keys) + 1) + at + 1, return_inverse=True, return_counts=True)
        return n[back]


def _targets(table: pa.Table, rows: int) -> np.ndarray:
    out = np.zeros(rows, bool)
    for own in table["targets"].to_pylist():
        out[own or []] = True
    return out


def _file(table: pa.Table) -> str:
    return next(f for f in table["file"].to_pylist() if f)


def _ask(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        block = _Block(_file(table))
        everything, target = np.ones(len(block.starts) - 1, bool), _targets(table, len(block.starts) - 1)
        n, of_target = block.counts(everything).astype(np.uint32), block.counts(target).astype(np.uint32)
        cuts = np.searchsorted(_bucket(block.keys, buckets), np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cuts))
        parts = [slice(cuts[b], cuts[b + 1]) for b in full]
        # The bucket tells the high bits; 48 bits of the rest are enough to tell the keys of a bucket apart.
        low, middle = block.keys.astype(np.uint32), (block.keys >> np.uint64(32)).astype(np.uint16)
        return pa.table({
            "bucket": pa.array(full, pa.int64()), "block": pa.array(np.full(len(full), table["block"][0].as_py()), pa.int64()),
            **{name: pa.array([pack(v[s]) for s in parts], pa.binary()) for name, v, pack in (
                ("low", low, _blob), ("middle", middle, _blob), ("alone", block.alone, _small), ("n", n, _small),
                ("of_target", of_target, _small))}})

    return run


def _added(table: pa.Table) -> pa.Table:
    """Per bucket: the sums over all blocks, for each block in the order in which it asked."""
    low, middle = (_joined(table, c, k) for c, k in (("low", np.uint32), ("middle", np.uint16)))
    alone, n, of_target = (_grown(table, c, k) for c, k in (("alone", bool), ("n", np.uint32), ("of_target", np.uint32)))
    keys = (middle.astype(np.uint64) << np.uint64(32)) | low
    distinct, first, at = np.unique(keys, return_index=True, return_inverse=True)
    total = np.bincount(at, n, len(distinct)).astype(np.int64)
    total_target = np.bincount(at, of_target, len(distinct)).astype(np.int64)
    ends = words.offsets([len(v) // 4 for v in table["low"].to_pylist()])
    own = alone[first]
    sums = (int(own.sum()), int(total[own].sum()), int(total_target[own].sum()))
    more = [0] * (len(ends) - 2)
    return pa.table({
        "bucket": table["bucket"], "block": table["block"],
        **{name: pa.array([_small(v[at[a:b]]) for a, b in zip(ends, ends[1:])], pa.binary())
           for name, v in (("sums", total), ("target_sums", total_target))},
        **{name: pa.array([s, *more], pa.int64()) for name, s in zip(("words", "tokens", "target_tokens"), sums)}})


def _scored(vocabulary: int, tokens: int, target_tokens: int):
    def run(table: pa.Table) -> pa.Table:
        block = _Block(_file(table))
        rows = len(block.starts) - 1
        table_rows = table.filter(pc.is_valid(table["bucket"])).sort_by("bucket")
        target = _targets(table, rows)[block.doc]
        own_word, own_pair = block.own(block.word), block.own(block.pair)
        # The context of a word is the word before it; the first word of a document has none.
        context = np.concatenate([[0], block.word[:-1]]) if len(block.word) else block.word
        own_context = np.concatenate([[0], own_word[:-1]]) if len(block.word) else own_word
        losses = []
        for column, total, mine in (("target_sums", target_tokens, target), ("sums", tokens, np.ones(len(target), bool))):
            count = _grown(table_rows, column, np.int64)
            size = np.diff(block.starts)[block.doc]

            def of(at, own):
                return count[at] - np.where(mine, own, 0)

            alone = (of(block.word, own_word) + ADDED) / (total - np.where(mine, size, 0) + ADDED * max(vocabulary, 1))
            pair = of(np.maximum(block.pair, 0), own_pair)
            after = (pair + MIXED * alone) / np.where(block.first, 1.0, of(context, own_context) + MIXED)
            losses.append(np.bincount(block.doc, -np.log(np.where(block.first, alone, after)), rows))
        n = np.diff(block.starts)
        target_loss, loss = (x / np.maximum(n, 1) for x in losses)
        return pa.table({"doc_id": block.doc_ids, "n_words": pa.array(n, pa.int64()), "target_loss": target_loss,
                         "background_loss": loss, "difference": target_loss - loss})

    return run


def score(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, difference) for each row of documents.

    ``targets`` has the doc_id of each document of the target; repeated ids count once.
    """
    spark = docs.sparkSession
    manifest = stage(files.write_blocks(docs.select("doc_id", "text"), files.shared_folder(spark, "blocks"), BLOCK_BYTES), "blocks")
    buckets = max(16, manifest.count())
    manifest = manifest.select("block", "file").repartition(buckets, "block")

    def places(batches):
        for batch in batches:
            for block, file in zip(batch.column("block").to_pylist(), batch.column("file").to_pylist()):
                ids = files.read_block(file, ["doc_id"]).column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids), dtype=np.int32))],
                    ["doc_id", "block", "row"])

    marked = (manifest.mapInArrow(places, "doc_id long, block long, row int")
              .join(targets.select("doc_id").filter("doc_id is not null").distinct(), "doc_id", "left_semi")
              .groupBy("block").agg(F.collect_list("row").alias("targets")))
    blocks = stage(manifest.join(marked, "block", "left"), "blocks")
    asked = blocks.repartition(buckets, "block").groupBy("block").applyInArrow(
        _ask(buckets), "bucket long, block long, low binary, middle binary, alone binary, n binary, of_target binary")
    answers = stage(asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(
        _added, "bucket long, block long, sums binary, target_sums binary, words long, tokens long, target_tokens long"), "answers")
    totals = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words", "tokens", "target_tokens"))).first()
    both = answers.drop("words", "tokens", "target_tokens").unionByName(blocks, allowMissingColumns=True)
    return both.repartition(buckets, "block").groupBy("block").applyInArrow(
        _scored(*totals), "doc_id long, n_words long, target_loss double, background_loss double, difference double")
