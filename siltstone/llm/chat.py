"""Conversations as a prefix tree of turns, packed once and depth first.

A turn is marked as ``### role: text</turn>`` and a line end. A backslash goes before every
backslash, ``###`` and ``</turn>`` inside roles and texts (in roles before ``: `` too), so
a reader finds the marks and gets the strings back.

Conversations that begin with the same turns share these nodes. Sorted by their paths of
digests, distinct conversations stand in depth-first order, and the first with a node owns it: a
branch is the run of nodes that a conversation owns. It holds the ids of its tokens, which follow each other
in positions from ``position`` on, its place ``start`` in the order of all branches, and the intervals of that order
that its ancestors take, which are what its tokens attend to besides their own branch. Texts of
assistants are under the loss mask, their marks are not.

A conversation is the unit of work, whatever its length; conversations are never gathered by a common
beginning. Null roles and texts are empty, a null turn comes first, equal turn numbers are ordered by role and text,
and rows without conv_id are one conversation. No rows give no branches.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import files, words
from siltstone.llm.tokens import byte_tokenizer
from siltstone.sources.staging import stage

_ESCAPED = r"\\(?:\\|###|</turn>|: )"
_TURN = re.compile(rf"### ((?:{_ESCAPED}|[^\\])*?): ((?:{_ESCAPED}|[^\\])*?)</turn>\n", re.S)
SPEAKER = "assistant"


def escaped(text: str, role: bool = False) -> str:
    return re.sub(r"\\|###|</turn>" + ("|: " if role else ""), lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\|###|</turn>|: )", r"\1", text)


def pieces(role: str, text: str) -> tuple[str, str, str]:
    """The mark before a text, the text, and the mark behind it."""
    return f"### {escaped(role, role=True)}: ", escaped(text), "</turn>\n"


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        out.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return out


def _paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, leaf, path, roles, texts): each conversation with the digests of all its beginnings."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
        "conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches):
        for batch in words.few(batches):
            paths = []
            for roles, texts in zip(batch.column("roles").to_pylist(), batch.column("texts").to_pylist()):
                path, last = [], b""
                for role, text in zip(roles, texts):
                    r, t = role.encode(), text.encode()
                    last = hashlib.sha256(b"%b%d:%b%b" % (last, len(r), r, t)).digest()[:16]
                    path.append(last)
                paths.append(path)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array([p[-1] for p in paths], pa.binary()), pa.array(paths, pa.list_(pa.binary())),
                 batch.column("roles"), batch.column("texts")], ["conv_id", "leaf", "path", "roles", "texts"])

    kind = conversations.schema["conv_id"].dataType.simpleString()
    return grouped.mapInArrow(
        run, f"conv_id {kind}, leaf binary, path array<binary>, roles array<string>, texts array<string>")


def _tokens(tokenizer: str):
    """Per distinct conversation: the ids of the turns that it owns, their ends and the spans under the loss mask."""
    def run(batches):
        coder = byte_tokenizer(tokenizer, special_as_text=True)
        for batch in words.few(batches):
            parts, shape = [], []
            for shared, roles, texts in zip(*(batch.column(c).to_pylist() for c in ("shared", "roles", "texts"))):
                own = list(zip(roles, texts))[shared:]
                shape.append([role == SPEAKER for role, _ in own])
                for role, text in own:
                    parts += pieces(role, text)
            ids, starts = coder.encode(pa.array(parts, pa.string()))
            at, out = 0, {"ids": [], "ends": [], "loss": []}
            for speakers in shape:
                edges = starts[at:at + 3 * len(speakers) + 1]
                out["ids"].append(ids[edges[0]:edges[-1]].astype(np.int32))
                edges = edges - edges[0]
                out["ends"].append(edges[3::3])
                out["loss"].append([{"start": int(edges[3 * i + 1]), "end": int(edges[3 * i + 2])}
                                    for i, speaks in enumerate(speakers) if speaks])
                at += 3 * len(speakers)
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("leaf"), batch.column("shared"),
                 pa.array(out["ids"], pa.list_(pa.int32())), pa.array(out["ends"], pa.list_(pa.int64())),
                 pa.array(out["loss"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["block", "leaf", "shared", "ids", "ends", "loss"])

    return run


def packed(conversations: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """Branches and the conversations that end in them, both written out.

    Branches: (block, leaf, start, position, ids, loss, ancestors), blocks in depth-first order; ``loss`` has spans of
    ``ids``; ``ancestors`` has (block, start, end) with places in the order of all branches, from the root on.
    Conversations: (conv_id, leaf).
    """
    built = stage(_paths(conversations), "paths")
    # Digests decide the order of siblings, so the ranges are even.
    leaves = built.select("leaf", "path", "roles", "texts").dropDuplicates(["leaf"])
    leaves = stage(leaves.repartitionByRange("path").sortWithinPartitions("path")
                   .withColumn("block", F.monotonically_increasing_id()), "leaves")
    nodes = leaves.select("block", F.posexplode("path").alias("depth", "node"))
    owners = stage(nodes.groupBy("node").agg(F.min("block").alias("owner")), "owners")
    runs = stage(nodes.join(owners, "node").groupBy("block", "owner").agg(
        F.min("depth").cast("long").alias("first"), F.max("depth").cast("long").alias("last")), "runs")
    own = runs.filter("block = owner").select("block", F.col("first").alias("shared"))
    coded = stage(leaves.join(own, "block").select("block", "leaf", "shared", "roles", "texts").mapInArrow(
        _tokens(tokenizer), "block long, leaf binary, shared long, ids array<int>, ends array<long>, "
                            "loss array<struct<start: long, end: long>>"), "tokens")
    placed = stage(files.with_starts(coded.select("block", "shared", "ends", F.element_at("ends", -1).alias("n")), "n", "start"), "places")
    # The part of an owner's tokens that lies on the way to a branch.
    owner = placed.select(F.col("block").alias("owner"), F.col("start").alias("at"), F.col("shared").alias("top"), "ends")
    before = F.when(F.col("first") > F.col("top"), F.get("ends", (F.col("first") - F.col("top") - 1).cast("int"))).otherwise(0)
    way = runs.join(owner, "owner").select(
        "block", "owner", "first", (F.col("at") + before).alias("start"),
        (F.col("at") + F.get("ends", (F.col("last") - F.col("top")).cast("int"))).alias("end"))
    above = (way.filter("block <> owner").groupBy("block")
             .agg(F.sort_array(F.collect_list(F.struct("first", F.col("owner").alias("block"), "start", "end"))).alias("a")))
    ancestors = F.transform("a", lambda x: F.struct(x["block"].alias("block"), x["start"].alias("start"), x["end"].alias("end")))
    branches = (coded.select("block", "leaf", "ids", "loss").join(placed.select("block", "start"), "block").join(above, "block", "left")
                .withColumn("ancestors", F.coalesce(ancestors, F.array()))
                .withColumn("position", F.aggregate("ancestors", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]))
                .select("block", "leaf", "start", "position", "ids", "loss", "ancestors"))
    return stage(branches, "branches"), built.select("conv_id", "leaf")


def unpacked(branches: DataFrame, tokenizer: str) -> DataFrame:
    """(leaf, formatted, learned): each distinct conversation read back along its ancestors.

    ``formatted`` is its whole text and ``learned`` the texts under the loss mask, as they were.
    """
    own = F.struct("block", "start", (F.col("start") + F.size("ids")).alias("end"))
    ways = branches.select("leaf", F.posexplode(F.concat("ancestors", F.array(own))).alias("step", "way")).select(
        "leaf", "step", F.col("way.block").alias("block"), F.col("way.start").alias("from"), F.col("way.end").alias("to"))
    length = (F.col("to") - F.col("from")).cast("int")
    begin = (F.col("from") - F.col("start")).cast("int")
    inside = F.transform(
        F.filter("loss", lambda s: (s["start"] >= begin) & (s["end"] <= begin + length)),
        lambda s: F.struct((s["start"] - begin).alias("start"), (s["end"] - begin).alias("end")))
    parts = stage(ways.join(branches.select("block", "start", "ids", "loss"), "block").select(
        "leaf", "step", F.slice("ids", begin + 1, length).alias("ids"), inside.alias("loss")), "parts")
    whole = parts.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("step", "ids", "loss"))).alias("parts"))

    def run(batches):
        library = byte_tokenizer(tokenizer, special_as_text=True).library
        for batch in words.few(batches):
            formatted, learned = [], []
            for steps in batch.column("parts").to_pylist():
                ids = [i for s in steps for i in s["ids"]]
                formatted.append(library.decode(ids, skip_special_tokens=False))
                learned.append([unescaped(library.decode(s["ids"][x["start"]:x["end"]], skip_special_tokens=False))
                                for s in steps for x in s["loss"]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("leaf"), pa.array(formatted, pa.string()), pa.array(learned, pa.list_(pa.string()))],
                ["leaf", "formatted", "learned"])

    return whole.mapInArrow(run, "leaf binary, formatted string, learned array<string>")


def turns(unpacked_: DataFrame) -> DataFrame:
    """Add ``turns``, the (role, text) of all turns found in the formatted text."""
    def run(batches):
        for batch in words.few(batches):
            found = [[{"role": r, "text": t} for r, t in parsed(f)] for f in batch.column("formatted").to_pylist()]
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "turns"])

    return unpacked_.mapInArrow(run, "leaf binary, formatted string, learned array<string>, "
                                     "turns array<struct<role: string, text: string>>")
