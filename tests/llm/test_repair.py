"""Conversation repair against a plain programme over suffixes, and odd rows."""

from __future__ import annotations

import hashlib
import itertools
import re
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import repair
from siltstone.llm.queries import QUERIES, damaged

SPACE = " \t\n\x0b\x0c\r"


def plain_best(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Least cost and letters for (initial, fault) rows, by the best suffix of each place and output so far."""
    best: dict[tuple[int, str], tuple[int, str]] = {}
    accepted = re.compile("(s?(ua)+)?")
    for at in range(len(rows), -1, -1):
        for _ in range(4):  # insertions lead to the same place
            for last in ("", "s", "u", "a"):
                ways = [best[at, last]] if (at, last) in best else []
                if at == len(rows) and accepted.fullmatch({"": "", "s": "s", "u": "u", "a": "ua"}[last]):
                    ways.append((0, ""))
                turn = "a" if last == "u" else "u"
                if (at, turn) in best:
                    ways.append((3 + best[at, turn][0], "I" + best[at, turn][1]))
                if at < len(rows):
                    initial, fault = rows[at]
                    ways.append((4 + best[at + 1, last][0], "D" + best[at + 1, last][1]))
                    if fault not in ("blank", "duplicate"):
                        more = 3 * (fault == "truncated")
                        if initial == turn or (initial == "s" and last == ""):
                            ways.append((more + best[at + 1, initial][0], "K" + best[at + 1, initial][1]))
                        ways.append((3 + more + best[at + 1, turn][0], "R" + best[at + 1, turn][1]))
                if ways:
                    best[at, last] = min(ways)
    return best[0, ""]


FAULTS = {"": repair.SOUND, "truncated": repair.TRUNCATED, "duplicate": repair.DUPLICATE, "blank": repair.BLANK}
KINDS = [(i, f) for i in "sua-" for f in FAULTS]


def codes(rows) -> bytes:
    return bytes(4 * FAULTS[f] + "sua-".index(i) for i, f in rows)


def test_all_short_ones():
    for n in range(4):
        for rows in itertools.product(KINDS, repeat=n):
            assert repair.cheapest(codes(rows)) == plain_best(list(rows)), rows


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(KINDS), max_size=80))
def test_any(rows):
    assert repair.cheapest(codes(rows)) == plain_best(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(KINDS), max_size=100))
def test_estimate_never_exceeds(rows):
    estimate = repair._estimates(codes(rows))
    assert estimate[0] <= plain_best(rows)[0]
    assert estimate[-1] == 0


def test_long_conversation():
    rows = [KINDS[zlib.crc32(str(i).encode()) % len(KINDS)] for i in range(2000)]
    start = time.time()
    assert repair.cheapest(codes(rows)) == plain_best(rows)
    assert time.time() - start < 120


def plain_repair(rows: list[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, shapes = set(), []
    for _, role, text in rows:
        visible = text.strip(SPACE)
        fault = ("blank" if not visible else "duplicate" if (role, text) in seen else "" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
        shapes.append((role[:1], fault))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = plain_best(shapes)
    out, todo = [], iter(rows)
    for letter in audit:
        _, role, text = (None, None, "") if letter == "I" else next(todo)
        if letter != "D":
            turn = "assistant" if out and out[-1][0][:1] == "u" else "user"
            out.append((role if letter == "K" else turn, text))
    count = [sum(f == kind for _, f in shapes) for kind in ("blank", "duplicate", "truncated")]
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(shapes, shapes[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    lines = "\n".join(f"{r}:{t}" for r, t in out)
    return gaps, *count, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest()


def plain_damage(rows):
    for conv, turn, role, text in rows:
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        rule = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = "user" if rule == 4 else shown[2], "" if rule == 1 else re.sub("[.!?]", "", shown[3]) if rule == 2 else shown[3]
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(rule, 1)


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty texts, ties and repeated rows, clashing columns, one long conversation."""
    rows = [(c, t, r, x) for c in (*range(40), None) for t, r, x in [
        (0, "system", "Be kind."), (1, "user", "What?"), (1, "user", "What?"), (2, "assistant", "That. "), (2, "assistant", "Tha"),
        (None, "user", "No turn."), (7, None, "No role."), (8, "user", None), (9, "", "x."), (10, "assistant", ""), (12, "user", "é。"), (13, "Sue", " \n")][c % 7 if c else 0:]]
    rows += [(99, t, "user" if t % 3 else "assistant", f"Turn {t}" + "." * (t % 5 > 0)) for t in range(3000)]
    rows += [(98, None, None, None), (97, 5, "user", "long " * 300_000 + ".")]
    spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, code int") \
        .repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    want = {c: [] for c, *_ in rows}
    for conv, *rest in plain_damage(rows):
        want[conv].append(tuple(rest))
    assert got == {c: plain_repair(r) for c, r in want.items()}


def test_turns(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 2, "user", "More"), ("b", 0, "assistant", "First.")]
    edits, turns = repair.repaired(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    assert {r["conv_id"]: r["audit"] for r in edits.collect()} == {"a": "KR", "b": "IK"}
    assert sorted(tuple(r) for r in turns.collect()) == [
        ("a", 0, "user", "Hi."), ("a", 1, "assistant", "More"), ("b", 0, "user", ""), ("b", 1, "assistant", "First.")]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    edits, turns = repair.repaired(damaged(empty))
    assert edits.collect() == [] and turns.collect() == [] and repair.digests(turns).collect() == []


@pytest.mark.parametrize("limit", [1, 3])
def test_runs_go_on_in_the_next_batch(limit):
    import pyarrow as pa

    ids = pa.array([1, 1, 1, None, None, 2])
    batches = [pa.RecordBatch.from_arrays([ids.slice(a, limit)], ["conv_id"]) for a in range(0, 6, limit)]
    seen: dict = {}
    for conv, rows in repair._runs(iter(batches)):
        seen[conv] = seen.get(conv, 0) + rows.num_rows
    assert seen == {1: 3, None: 2, 2: 1}
