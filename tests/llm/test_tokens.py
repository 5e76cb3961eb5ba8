"""Encoding, token files and separators against the tokenizers library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltstone.llm import bpe, files, rans, separators, tokens
from siltstone.sources.staging import stage

_LIBRARY: dict = {}
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, "  ", "a  b", "x ", " y", "a \n b\n c", "it's 's WORLD'LL é x   y", "<|endoftext|> q <|startoftext|>",
         "ΑΣ ﬁ é \x1c\x85", "word " * 3000, "z" * 900, "same text", "same text", "中文字 한글 🎉!!"]


@pytest.fixture(scope="module")
def library():
    return {WORD: Tokenizer.from_file(WORD), BYTE: Tokenizer.from_file(BYTE)}


def ids_of(library, path, text):
    return library[path].encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcdeéßΣİ 's!?<|>.,12 \n\t\x1c\x85中🎉한"), max_size=40), max_size=4))
def test_encoders_give_the_library_s_ids(texts):
    for path, coder in ((WORD, bpe.prefix_bpe(WORD)), (BYTE, tokens.byte_tokenizer(BYTE))):
        reference = Tokenizer.from_file(path) if path not in _LIBRARY else _LIBRARY[path]
        _LIBRARY[path] = reference
        ids, starts = coder.encode(pa.array(texts, pa.string()))
        for text, a, b in zip(texts, starts, starts[1:]):
            assert ids[a:b].tolist() == reference.encode(text, add_special_tokens=False).ids





def test_long_words_of_common_letters(library):
    draw = random.Random(3)
    texts = ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(1, 40))) for _ in range(500)]
    ids, starts = bpe.prefix_bpe(WORD).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [ids_of(library, WORD, t) for t in texts]


def test_bpe_keeps_columns_and_decodes_as_the_library(spark, library):
    rows = [(i, t, f"s{i}", i) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids long")
    out = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs, WORD), WORD).collect()}
    assert len(out) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = ids_of(library, WORD, text)
        assert out[i]["ids"] == ids
        assert out[i]["decoded"] == library[WORD].decode(ids, skip_special_tokens=False)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, WORD), WORD).collect() == []
    tokenized = stage(rans.tokenize(docs, BYTE, 2), "ids")
    table = rans.table_of(rans.count(tokenized))
    assert rans.read(stage(rans.write(tokenized, table, files.shared_folder(spark, "rans")), "m"), table).collect() == []


@pytest.mark.parametrize("n", [0, 1, rans.LANES - 1, rans.LANES, 3 * rans.LANES + 5, 200 * rans.LANES + 77])
def test_rans_round_trip_and_checkpoints(n):
    ids = np.minimum(np.random.default_rng(n).geometric(0.02, n), 5000).astype(np.uint32)
    table = rans.Table(np.bincount(ids, minlength=6000))
    block = rans.pack(table, np.arange(1), np.zeros(1, bool), np.array([n]), ids)
    assert np.array_equal(rans.unpack(table, block)[3], ids)
    flat, states, places = rans.encode_tokens(table, ids)
    step = rans.CHECKPOINT_ROWS * rans.LANES
    parts = [rans.decode_tokens(table, n, flat, states, places, c, c + 1) for c in range(len(places))]
    assert all(np.array_equal(p, ids[c * step:(c + 1) * step]) for c, p in enumerate(parts))


def test_rans_sees_damage_and_unknown_ids():
    table = rans.Table(np.array([5, 0, 3]))
    block = bytearray(rans.pack(table, np.arange(1), np.zeros(1, bool), np.array([3]), np.array([0, 2, 0])))
    block[-1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.unpack(table, bytes(block))
    with pytest.raises(ValueError, match="table"):
        rans.encode_tokens(table, np.array([1]))


def test_rans_frequencies_sum_up_even_if_many_ids_are_rare():
    counts = np.ones(300_000, np.int64)
    counts[7] = 10**12
    table = rans.Table(counts)
    assert table.freq.sum() == 1 << rans.BITS and table.freq.min() == 1


def test_coded_files(spark, library):
    rows = [(i * 3 % 17, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (5, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    tokenized = stage(rans.tokenize(docs, BYTE, 2, block_tokens=500), "ids")
    table = rans.table_of(rans.count(tokenized))
    out = rans.read(stage(rans.write(tokenized, table, files.shared_folder(spark, "rans")), "m"), table).collect()
    out.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in out:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    want = sorted((-1 if i is None else i, zlib.crc32(np.array([*ids_of(library, BYTE, t), 2], "<u4").tobytes())) for i, t, _ in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], zlib.crc32(r["ids"])) for r in out) == want


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("ids", [[], [9], [1, 2], [9, 9, 1, 9, 2, 3, 4, 9], [1, 2, 3, 4, 5, 6, 9], [9, 9, 9]])
def test_separators_across_blocks(spark, block, ids):
    folder = files.shared_folder(spark, "flat")
    name = f"{folder}/a.bin"
    files.write_bytes(name, [np.array(ids, "<u4").tobytes()])
    sizes = spark.createDataFrame(files.file_sizes(folder), "file string, n_bytes long")
    got = sorted((r["place"], r["start"], r["n_tokens"], r["terminated"])
                 for r in separators.scan_flat(sizes, 9, 4, block).collect())
    want, start = [], 0
    for i, t in enumerate(ids):
        if t == 9:
            want.append((len(want), start, i - start, True))
            start = i + 1
    if start < len(ids):
        want.append((len(want), start, len(ids) - start, False))
    assert got == want


def test_flat_files(spark, library):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)
    folder = files.shared_folder(spark, "flat")
    written = stage(separators.write_flat(docs, folder, BYTE, 50256), "flat")
    sizes = spark.createDataFrame(files.file_sizes(folder), "file string, n_bytes long")
    found = written.join(separators.scan_flat(sizes, 50256, 2, 64), ["file", "place"]).collect()
    coder = tokens.byte_tokenizer(BYTE, special_as_text=True).library
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {
        i: len(coder.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(TEXTS)}


def test_a_worker_forgets_what_encoders_remember():
    """The classifier begins with it, as its workers may have encoded before."""
    from siltstone.llm import bpe, tokens, words

    kept = [(tokens.byte_tokenizer, "byte_bpe_50k.json"), (bpe.prefix_bpe, "word_bpe_49k.json")]
    for make, file in kept:
        make(public_tokenizers.path(file))
    words.release()
    assert all(make.cache_info().currsize for make, _ in kept)
    words.release(memories=True)
    assert not any(make.cache_info().currsize for make, _ in kept)


def test_word_encoding_gives_memory_back_in_a_long_task(monkeypatch):
    """Short steps, and free memory goes back between them: two tasks share what an executor may hold."""
    released, coder = [], bpe.prefix_bpe(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(bpe.words, "release", lambda memories=False: released.append(memories))
    text = ["some words " * 4_000] * 500
    out = list(bpe._encoded(coder, [pa.RecordBatch.from_pydict({"text": text})], "text", "ids"))
    assert sum(b.num_rows for b in out) == len(text) and all(b.column("text").nbytes < 2 << 20 for b in out)
    assert len(released) >= 2 and not any(released)
    assert {tuple(i[:4]) for b in out for i in b.column("ids").to_pylist()} == {tuple(out[0].column("ids")[0].as_py()[:4])}
