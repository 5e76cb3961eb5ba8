"""The prefix tree of conversations."""

from __future__ import annotations

import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st

from siltstone.llm import chat
from siltstone.llm.tokens import byte_tokenizer

BYTE = public_tokenizers.path("byte_bpe_50k.json")
STRINGS = st.text(st.sampled_from(list("\\#</turn>: \nab")), max_size=25)


@given(st.lists(st.tuples(STRINGS, STRINGS), max_size=4))
def test_marks_are_found_and_strings_come_back(turns):
    assert chat.parsed("".join("".join(chat.pieces(r, t)) for r, t in turns)) == turns


def conversations():
    shared = [("system", "Be brief."), ("user", "Hello ### Assistant: there")]
    out = {i: [*shared, ("assistant", f"Answer {i % 7}"), ("user", f"And {i}?")] for i in range(30)}
    out |= {40: shared, 41: shared[:1], 42: [("user", "")], 43: [("assistant", "")], 44: [("", "")], 45: shared}
    out |= {50: [("assistant", "\\### Assistant: </turn> ok <|endoftext|>"), ("a: b", "c")], 51: [("user", "x")] * 40}
    return out


def test_packed_and_read_back(spark):
    rows = [(i, k, r or None, t or None, "x") for i, c in conversations().items() for k, (r, t) in enumerate(c)]
    branches, ends = chat.packed(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, leaf string"), BYTE)
    found = {bytes(r["leaf"]): r for r in chat.turns(chat.unpacked(branches, BYTE)).collect()}
    leaf_of = {r["conv_id"]: bytes(r["leaf"]) for r in ends.collect()}
    assert leaf_of.keys() == conversations().keys()
    for i, turns in conversations().items():
        got = found[leaf_of[i]]
        assert [(t["role"], t["text"]) for t in got["turns"]] == turns
        assert got["learned"] == [t for r, t in turns if r == "assistant"]
        assert got["formatted"] == "".join("".join(chat.pieces(r, t)) for r, t in turns)


def test_shared_turns_are_emitted_once_and_ancestors_lie_before(spark):
    rows = [(i, k, r, t) for i, c in conversations().items() for k, (r, t) in enumerate(c)]
    branches, _ = chat.packed(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), BYTE)
    rows = sorted(branches.collect(), key=lambda r: r["block"])
    at = 0
    for r in rows:
        assert r["start"] == at
        at += len(r["ids"])
        assert r["position"] == sum(a["end"] - a["start"] for a in r["ancestors"])
        assert all(a["end"] <= r["start"] for a in r["ancestors"])
        assert all(x["end"] <= y["start"] for x, y in zip(r["ancestors"], r["ancestors"][1:]))
    coder = byte_tokenizer(BYTE, special_as_text=True).library
    prefixes = {tuple(c[:k + 1]) for c in conversations().values() for k in range(len(c))}
    tokens = sum(len(coder.encode(p, add_special_tokens=False).ids) for turns in prefixes for p in chat.pieces(*turns[-1]))
    assert at == tokens


def test_nothing_and_rows_without_an_id(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert chat.packed(spark.createDataFrame([], kind), BYTE)[0].collect() == []
    rows = [(None, 1, "user", "b"), (None, None, "user", "a"), (3, 1, "user", "z"), (3, 1, "user", "y")]
    branches, ends = chat.packed(spark.createDataFrame(rows, kind), BYTE)
    found = {bytes(r["leaf"]): [t["text"] for t in r["turns"]] for r in chat.turns(chat.unpacked(branches, BYTE)).collect()}
    assert {r["conv_id"]: found[bytes(r["leaf"])] for r in ends.collect()} == {None: ["a", "b"], 3: ["y", "z"]}
