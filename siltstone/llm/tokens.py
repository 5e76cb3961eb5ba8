"""Token ids of whole texts with a tokenizer file, fast enough for a whole corpus.

A byte-level tokenizer splits a text before every single space that a visible
character follows, so the pieces between spaces are encoded on their own: Arrow
finds the distinct pieces of a step, the tokenizers library encodes those that this
worker hasn't met, and numpy puts the ids together. Texts in which white space
stands next to a space go to the library as a whole.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from siltstone.llm import words

#: Pieces that a worker remembers; those not met for longest are forgotten.
CACHE_PIECES = 450_000
ODD_SPACE = r" (\s|\p{Z}|\x{1c}|\x{1d}|\x{1e}|\x{1f}|\x{85}|$)"


class ByteTokenizer:
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    ``special_as_text``: whether the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path) as file:
            spec = json.load(file)
        kinds = (spec["normalizer"], spec["pre_tokenizer"]["type"], spec["pre_tokenizer"]["add_prefix_space"])
        if kinds != (None, "ByteLevel", False):
            raise ValueError(f"not a plain byte-level tokenizer: {kinds}")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = special_as_text
        self.n_ids = self.library.get_vocab_size()
        self.spaced = np.zeros(self.n_ids, bool)
        self.spaced[[i for t, i in spec["model"]["vocab"].items() if t.startswith("Ġ")]] = True
        self.pieces = words.Recent(CACHE_PIECES)
        self.heads = words.Recent(CACHE_PIECES // 4)

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Ids as bytes, 4 for each."""
        encoded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in encoded]

    def _pieces(self, values: list[str]) -> list[bytes]:
        """Ids of each piece after a space; the space is part of it."""
        new = self.pieces.missing(values)
        known = self.pieces.young
        if new:
            ids = self._ids([" " + " ".join(new)])[0]
            cuts = [*(4 * np.flatnonzero(self.spaced[np.frombuffer(ids, np.uint32)])).tolist(), len(ids)]
            known.update(zip(new, map(ids.__getitem__, map(slice, cuts, cuts[1:]))))
        return list(map(known.__getitem__, values))

    def _heads(self, values: list[str]) -> list[bytes]:
        new = self.heads.missing(values)
        known = self.heads.young
        known.update(zip(new, self._ids(new)))
        return [known[v] for v in values]

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the starts of each text; null is an empty text."""
        text = pc.fill_null(text, "")
        odd = pc.match_substring_regex(text, ODD_SPACE).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", text) if odd.any() else text
        lists = pc.split_pattern(plain, " ")
        begins = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        rest = np.ones(len(codes), bool)
        rest[begins] = False
        used = np.unique(codes[rest])
        place = np.zeros(len(coded.dictionary), np.int64)
        place[used] = np.arange(len(used))
        known = self._pieces(words.strings(coded.dictionary.take(pa.array(used))))
        first = self._heads(words.strings(coded.dictionary.take(pa.array(codes[begins]))))
        for i in np.flatnonzero(odd):
            first[i] = self._ids([text[int(i)].as_py()])[0]
        codes = place[codes]
        codes[begins] = len(used) + np.arange(len(begins))
        parts = [*known, *first]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        at = np.cumsum(sizes) - sizes
        each = sizes[codes]
        ids = np.frombuffer(b"".join(parts), np.uint32)[words.spread(at[codes], each)]
        per_text = np.add.reduceat(each, begins) if len(begins) else np.empty(0, np.int64)
        return ids, words.offsets(per_text)


@lru_cache(maxsize=4)
def byte_tokenizer(path: str, special_as_text: bool = False) -> ByteTokenizer:
    """One tokenizer for each worker process."""
    return ByteTokenizer(path, special_as_text)


words.MEMORIES.append(byte_tokenizer.cache_clear)
