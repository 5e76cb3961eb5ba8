"""BPE encoding and decoding by dynamic programming over prefixes.

The encoding of every prefix of a word ends in exactly one token, and that token is
known when the shorter prefixes are: of the vocabulary entries that end there (an
automaton over the vocabulary lists them, longest suffix first), it is the one that
is compatible with the last token of the prefix before it. Two tokens are compatible
if merging their joint symbols gives just these two again, which the trees of their merges tell: undone from the last merge on,
no merge across the border may come before those that are still done. Following the last tokens
back from the end of the word gives the ids that applying the merges in order gives.

Null texts are empty; an empty text has no ids and decodes to an empty text. Texts are
encoded whole. Strings of special tokens inside a text become their ids, as the
tokenizer file asks for. Every row is on its own, so equal rows, hot sources and long
texts need no care beyond the size of a step; other columns of the input are kept.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siltstone.llm import words

#: Words and chunks that a worker remembers; those not met for longest are forgotten.
CACHE_ENTRIES = 250_000
#: Text bytes of a step, and those after which a task gives free memory back.
STEP_BYTES, RELEASE_BYTES = 1 << 20, 8 << 20
_END = "\n"  # marks the last symbol of a word; no byte is written as this character


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PrefixBpe:
    """Encoder of a BPE vocabulary whose words end in a suffix."""

    def __init__(self, path: str):
        with open(path) as file:
            spec = json.load(file)
        model, steps = spec["model"], [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if steps != ["NFC", "Replace", "Lowercase"] or not model["end_of_word_suffix"] or spec["decoder"]:
            raise ValueError("expected NFC, white space and lower case, words with a suffix, and no decoder")
        self.space = regex.compile(spec["normalizer"]["normalizers"][1]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.suffix = model["end_of_word_suffix"]
        self.bytes = str.maketrans({b: c for b, c in enumerate(_byte_alphabet())})
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.ids = {self._inner(t): i for t, i in model["vocab"].items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(self._inner(a), self._inner(b)): i for i, (a, b) in enumerate(pairs)}
        self.matches = ahocorasick.Automaton()
        for token in self.ids:
            self.matches.add_word(token, token)
        self.matches.make_automaton()
        self.trees: dict[str, tuple[int, str, str] | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words = words.Recent(CACHE_ENTRIES // 2)  # most are found as chunks
        self.chunks = words.Recent(CACHE_ENTRIES)

    def _inner(self, token: str) -> str:
        return token.removesuffix(self.suffix) + _END if token.endswith(self.suffix) else token

    @staticmethod
    def _symbols(token: str) -> list[str]:
        return [*token[:-2], token[-2:]] if token.endswith(_END) else [*token]

    def _merged(self, symbols: list[str]) -> list[str]:
        """Apply the merge of the lowest rank, leftmost first, until none is left."""
        while len(symbols) > 1:
            rank, at = min((self.rank.get(p, len(self.rank)), i) for i, p in enumerate(zip(symbols, symbols[1:])))
            if rank == len(self.rank):
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _tree(self, token: str) -> tuple[int, str, str] | None:
        """The rank of the merge that makes a token and its two parts; -1 for a symbol, None if merging never makes it."""
        found = self.trees.get(token, False)
        if found is False:
            symbols = self._symbols(token)
            found, rest = (-1, token, token), len(symbols)
            while rest > 1:
                rank, at = min((self.rank.get(p, len(self.rank)), i) for i, p in enumerate(zip(symbols, symbols[1:])))
                if rank == len(self.rank):
                    found = None
                    break
                found = rank, symbols[at], symbols[at + 1]
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
                rest -= 1
            self.trees[token] = found
        return found

    def _compatible(self, left: str, right: str) -> bool:
        """Whether merging the symbols of both gives just the two.

        Both are undone, the later merge first. A merge of what then stands beside the border comes first if its rank is below that
        of what was undone; of equal ranks the left one is done first.
        """
        rank, trees = self.rank, self.trees
        limit = len(rank)
        (r1, _, inner1), (r2, inner2, _) = trees[left], trees[right]
        while True:
            if rank.get((left, right), limit) < limit:
                return False
            if r1 > r2:
                limit, left = r1, inner1
                r1, _, inner1 = trees.get(left) or self._tree(left)
            elif r2 >= 0:
                limit, right = r2 + 1, inner2
                r2, inner2, _ = trees.get(right) or self._tree(right)
            else:
                return True

    def _word(self, word: str) -> bytes:
        """Ids of one word, 4 bytes each."""
        end = len(word) + 1
        final: list[str | None] = [None] * (end + 1)  # the last token of each prefix
        final[0] = ""
        trees, pairs = self.trees, self.pairs
        # The automaton goes through the prefixes and lists longer tokens first.
        for last, token in self.matches.iter(word + _END):
            last += 1
            if final[last] is None:
                left = final[last - len(token)]
                if left is None or (trees[token] if token in trees else self._tree(token)) is None:
                    continue
                if left:
                    pair = left, token
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self._compatible(left, token)
                    if not fits:
                        continue
                final[last] = token
        if len(pairs) > CACHE_ENTRIES:
            pairs.clear()
        out = []
        while end > 0:
            token = final[end]
            if token is None:
                raise ValueError(f"no token of the vocabulary ends prefix {end} of {word!r}")
            out.append(self.ids[token])
            end -= len(token)
        return np.array(out[::-1], np.uint32).tobytes()

    def _plain(self, text: str) -> bytes:
        text = self.space.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()
        out = []
        for word in self.word.findall(text):
            ids = self.words.get(word)
            if ids is None:
                ids = self._word(word.encode().decode("latin-1").translate(self.bytes))
                self.words.put(word, ids)
            out.append(ids)
        return b"".join(out)

    def _chunk(self, text: str) -> bytes:
        """Ids of a run without ASCII white space; special tokens are found before anything else."""
        out, at = [], 0
        for found in self.special_at.finditer(text) if self.special_at and "<" in text else ():
            out += [self._plain(text[at:found.start()]), np.uint32(self.special[found[0]]).tobytes()]
            at = found.end()
        return b"".join([*out, self._plain(text[at:])])

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the starts of each text."""
        codes, starts, values = words.split(text)
        chunks = words.strings(values)
        new = self.chunks.missing(chunks)
        known = self.chunks.young
        for chunk in new:
            known[chunk] = self._chunk(chunk)
        parts = list(map(known.__getitem__, chunks))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        at = np.cumsum(sizes) - sizes
        each = sizes[codes]
        ids = np.frombuffer(b"".join(parts), np.uint32)[words.spread(at[codes], each)]
        return ids, words.offsets(each)[starts]


@lru_cache(maxsize=2)
def token_names(path: str) -> list[str]:
    """The name of each id; a decoder needs nothing else."""
    with open(path) as file:
        spec = json.load(file)
    named = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [named.get(i, "") for i in range(max(named) + 1)]


@lru_cache(maxsize=2)
def prefix_bpe(path: str) -> PrefixBpe:
    """One encoder for each worker process."""
    return PrefixBpe(path)


words.MEMORIES.append(prefix_bpe.cache_clear)


def _encoded(coder: PrefixBpe, batches, column: str, ids: str):
    """The batches in steps, with their ids; what the steps leave behind is given back now and then."""
    held = 0
    for batch in batches:
        for step in words.steps(batch, column, STEP_BYTES):
            if held >= RELEASE_BYTES:
                words.release()
                held = 0
            held += step.nbytes
            flat, starts = coder.encode(step.column(column))
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*step.columns, lists], [*step.schema.names, ids])


def encode(docs: DataFrame, path: str, column: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each whole text as an array of integers."""
    def run(batches):
        words.release()
        yield from _encoded(prefix_bpe(path), batches, column, ids)
        words.release()

    kept = docs.drop(ids)
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that an array of ids stands for; null ids are none."""
    def run(batches):
        names = pa.array(token_names(path), pa.string())
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                lists = pc.fill_null(batch.column(ids), [])
                ends = pa.array(words.offsets(pc.list_value_length(lists).to_numpy(zero_copy_only=False)), pa.int32())
                out = pc.binary_join(pa.ListArray.from_arrays(ends, names.take(lists.flatten())), " ")
                yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, text])

    kept = encoded.drop(text)
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())]))
