"""Structure repair of conversations by iterative-deepening A*.

A conversation's rows, in order, are faulty or not: blank (nothing but white space), duplicate (role and text of an
earlier row) or truncated (the last visible character ends no sentence); the first that applies counts. A repaired conversation
is empty or has an optional system turn and then pairs of a user and an assistant. Each row is kept (K, free),
given another role (R, 3) or deleted (D, 4, a must for blank and duplicate rows), and empty turns are inserted
anywhere (I, 3); a truncated row that stays costs 3 more. Only user and assistant turns are inserted or
given as roles, so what the letters stand for follows from the letters alone.

The cheapest edits are searched depth first, in ASCII order of their letters, under a bound on the cost that rises from
search to search to the least cost that the last one turned down. So the first way that is accepted is a cheapest one, and of those
the least as a string. A table remembers for each state (rows done, last role) where the search
has failed what it needs at least; it starts as an estimate that never exceeds the true cost: the
faults of the rows that follow, and for each later block of 32 rows the least cost of getting through it at all.

Rows come in the order of turn, role and text, nulls first. Null roles and texts are one space, an empty role has no initial
and can't be kept, roles differ in case. Rows without conv_id are one conversation. Equal rows are duplicates. Other columns are left out.

A conversation is streamed through one task in order, as its cost depends on all of it; a task holds a byte
of each row and a number for each state, never the texts of a conversation. Repeats are found before, by conversation, role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.sources.staging import stage

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
#: What a truncated row that stays costs more.
CUT = 3
VISIBLE = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
#: Rows of a block of which the estimate knows the least cost.
BLOCK = 32

# A row is a byte: four times the class of its fault and the class of its role.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
SOUND, TRUNCATED, DUPLICATE, BLANK = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# States: nothing yet, or the role of the last turn. For each the turn that may be inserted, and the state behind it.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
BEHIND = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)


@lru_cache(None)
def _moves(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """(letter, cost, next state) of the edits of a row, without insertions, in ASCII order."""
    fault, role = divmod(code, 4)
    moves = [("D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        more = CUT * (fault == TRUNCATED)
        if role == NEXT[state]:
            moves.append(("K", KEEP + more, BEHIND[state]))
        elif role == SYSTEM and state == START:
            moves.append(("K", KEEP + more, AFTER_SYSTEM))
        moves.append(("R", REROLE + more, BEHIND[state]))
    return tuple(moves)


@lru_cache(4096)
def _through(codes: bytes) -> int:
    """The least cost of getting from any state through these rows to any state."""
    costs = [0] * 4
    for code in codes:
        user = min(costs[AFTER_USER], min(costs) + INSERT)
        costs = [costs[START], costs[AFTER_SYSTEM], user, min(costs[AFTER_ASSISTANT], user + INSERT)]
        new = [10**9] * 4
        for state, cost in enumerate(costs):
            for _, more, behind in _moves(code, state):
                new[behind] = min(new[behind], cost + more)
        costs = new
    return min(costs)


def _estimates(codes: bytes) -> list[int]:
    """For each place what the rows from there on cost at least."""
    each = [(0, CUT, DELETE, DELETE)[c >> 2] for c in codes]
    whole = [_through(bytes(codes[at:at + BLOCK])) for at in range(0, len(codes), BLOCK)]
    later = [*accumulate(reversed(whole), initial=0)][::-1]
    out = [0] * (len(codes) + 1)
    for at in range(len(codes) - 1, -1, -1):
        inside = 0 if (at + 1) % BLOCK == 0 else out[at + 1] - later[at // BLOCK + 1]
        out[at] = max(each[at] + inside, 0) + later[at // BLOCK + 1]
    for at in range(0, len(codes), BLOCK):
        out[at] = max(out[at], later[at // BLOCK])
    return out


def cheapest(codes: bytes) -> tuple[int, str]:
    """The least cost of a repair and, of all repairs with it, the least letters."""
    n = len(codes)
    need = [e for e in _estimates(codes) for _ in range(4)]  # by 4 * rows done + state
    while True:
        bound = need[START]
        found = _search(codes, need, n, bound)
        if found is not None:
            return bound, found


def _search(codes: bytes, need: list[int], n: int, bound: int) -> str | None:
    """The first accepted letters that cost ``bound`` at most; ``need`` rises where there are none."""
    letters: list[str] = []
    # A frame: place, state, what may still be spent, its edits, the next of them, the least that a failed edit needs.
    stack = [[0, START, bound, None, 0, 10**9]]
    while stack:
        frame = stack[-1]
        at, state, left, moves, k, least = frame
        if moves is None:
            if at == n and state in (START, AFTER_ASSISTANT):
                return "".join(letters)
            moves = frame[3] = _edits(codes[at] if at < n else -1, state)
        if k == len(moves):
            need[4 * at + state] = max(need[4 * at + state], least)
            stack.pop()
            if stack:
                letters.pop()
                parent = stack[-1]
                cost = parent[3][parent[4] - 1][1]
                parent[5] = min(parent[5], cost + need[4 * at + state])
            continue
        letter, cost, behind = moves[k]
        frame[4] = k + 1
        there = at + (letter != "I")
        needed = cost + need[4 * there + behind]
        if needed > left:
            frame[5] = min(least, needed)
        else:
            letters.append(letter)
            stack.append([there, behind, left - cost, None, 0, 10**9])
    return None


@lru_cache(None)
def _edits(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """All edits in ASCII order; behind the last row only insertions are left."""
    moves = _moves(code, state) if code >= 0 else ()
    return tuple(sorted([*moves, ("I", INSERT, BEHIND[state])]))


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, code, again): rows with the class of their role and fault.

    ``again`` tells the first of equal rows from its copies. The result is to be staged.
    """
    rows = rows.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    same = Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy(F.asc_nulls_first("turn"))
    again = F.row_number().over(same) > 1
    first = F.substring("role", 1, 1)
    role = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)
    fault = (F.when(~F.col("text").rlike(VISIBLE), BLANK).when(F.col("again"), DUPLICATE)
             .when(~F.col("text").rlike(ENDED), TRUNCATED).otherwise(SOUND))
    return rows.withColumn("again", again).withColumn("code", (4 * fault + role).cast("int"))


def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    order = [F.asc_nulls_first(c) for c in ("conv_id", *before, "turn", "role", "text", "again")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, pa.RecordBatch]]:
    """Slices of one conversation each; a conversation may go on in the next slice."""
    for batch in batches:
        ids = batch.column("conv_id")
        if not len(ids):
            continue
        codes = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
        for a, b in zip(new, new[1:]):
            yield ids[a].as_py(), batch.slice(a, b - a)


_ILLEGAL = np.ones((4, 4), bool)
_ILLEGAL[SYSTEM, USER] = _ILLEGAL[USER, ASSISTANT] = _ILLEGAL[ASSISTANT, USER] = False
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    codes, turns = bytearray(), [None, None, 0]  # least, last and distinct turns

    def end():
        faults_ = np.frombuffer(bytes(codes), np.uint8) >> 2
        roles = np.frombuffer(bytes(codes), np.uint8) & 3
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
        kinds = np.bincount(faults_, minlength=4)
        cost, audit = cheapest(bytes(codes))
        done.append((gaps, kinds[BLANK], kinds[DUPLICATE], kinds[TRUNCATED], _ILLEGAL[roles[:-1], roles[1:]].sum(), cost, audit))

    def batch_of(ids: list) -> pa.RecordBatch:
        columns = [pa.array([int(x) for x in c], pa.int64()) for c in list(zip(*done))[:-1]]
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), *columns, pa.array([d[-1] for d in done], pa.string())],
                                          ["conv_id", *_COUNTS, "audit"])

    ids: list = []
    kind = None
    for conv, rows in _runs(batches):
        kind = rows.column("conv_id").type
        if not ids or ids[-1] != conv:
            if ids:
                end()
            if len(done) >= 1024:
                yield batch_of(ids)
                done.clear()
                ids.clear()
            ids.append(conv)
            codes, turns = bytearray(), [None, None, 0]
        codes += rows.column("code").to_numpy().astype(np.uint8).tobytes()
        there = rows.column("turn").drop_null().to_numpy()
        if len(there):
            if turns[0] is None:
                turns = [int(there[0]), int(there[0]), 1]
            turns = [turns[0], int(there[-1]), turns[2] + int((np.diff(there, prepend=turns[1]) != 0).sum())]
    if ids:
        end()
        yield batch_of(ids)


def audits(faulty: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation with rows."""
    kind = faulty.schema["conv_id"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in _COUNTS)
    rows = _in_order(faulty).select("conv_id", F.col("turn").cast("long").alias("turn"), "code")
    return rows.mapInArrow(_audited, f"conv_id {kind}, {longs}, audit string")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audit, at, state, place = "", 0, START, 0
    for _, rows in _runs(batches):
        out: list[tuple[int, str, str]] = []

        def insert():
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                out.append((place, ROLES[NEXT[state]], ""))
                at, state, place = at + 1, BEHIND[state], place + 1

        for edits, role, text in zip(*(rows.column(c).to_pylist() for c in ("audit", "role", "text"))):
            if edits is not None:  # the row with the edits comes before those that they are for
                audit, at, state, place = edits, 0, START, 0
                insert()
                continue
            letter, at = audit[at], at + 1
            if letter != "D":
                out.append((place, role if letter == "K" else ROLES[NEXT[state]], text))
                system = letter == "K" and state == START and role[0] == "s"
                state, place = AFTER_SYSTEM if system else BEHIND[state], place + 1
            insert()
        ids = pc.take(rows.column("conv_id"), pa.array(np.zeros(len(out), np.int64)))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([o[0] for o in out], pa.int64()), *(pa.array([o[k] for o in out], pa.string()) for k in (1, 2))],
            ["conv_id", "place", "role", "text"])


def applied(faulty: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the turns of the repaired conversations, those of one in order in one task."""
    kind = faulty.schema["conv_id"].dataType.simpleString()
    rows = _in_order(faulty.unionByName(edits.select("conv_id", "audit"), allowMissingColumns=True).withColumn(
        "later", F.col("audit").isNull()), "later")
    return rows.select("conv_id", "audit", "role", "text").mapInArrow(_applied, f"conv_id {kind}, place long, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, sha256): digest of ``role:text`` lines, of the frame that ``applied`` gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, digest, kind = None, 0, None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([n], pa.int64()), pa.array([digest.hexdigest()])],
                                              ["conv_id", "n_turns", "sha256"])

        for conv, rows in _runs(batches):
            kind = rows.column("conv_id").type
            if digest is None or conv != now:
                if digest is not None:
                    yield row()
                now, n, digest = conv, 0, hashlib.sha256()
            for role, text in zip(rows.column("role").to_pylist(), rows.column("text").to_pylist()):
                digest.update(f"{chr(10) if n else ''}{role}:{text}".encode())
                n += 1
        if digest is not None:
            yield row()

    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.mapInArrow(run, f"conv_id {kind}, n_turns long, sha256 string")


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The audits of all conversations and the turns that their repair gives; the audits are written out."""
    faulty = stage(faults(rows), "faulty")
    found = stage(audits(faulty), "audits")
    return found, applied(faulty, found)
