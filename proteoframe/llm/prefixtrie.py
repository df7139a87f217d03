"""Prefix trie of conversations from vertical bitmaps.

Conversations in order of their ids are cut into shards of ``SHARD`` conversations. In a
shard, an index maps (position, turn) to the bitset of the conversations that have
this turn there. From the root, which all conversations share, the bitset of a node
is intersected with the postings of its members' next turns, depth first: every
intersection is a child, its popcount the number of members; members without a next
turn are the node's end list. Nodes are named by a chained SHA-256 of their turns, so
the same prefix has the same name in all shards, and the shards' popcounts are added.

Sums over subtrees need no walk over the whole tree. A node belongs to its smallest
member. A shard that holds this member counts the node itself, the others do not; so
each shard adds its own nodes bottom up, and the sums of a node over all shards are the sums
over its whole subtree. A prefix shared by a third of all conversations costs one row
in each shard.

Turns of a conversation are ordered by ``turn`` (null first), rows of one ``turn`` by their
digest; null role or text counts as empty; rows that repeat a turn count each. Rows without a
``conv_id`` belong to no conversation and are left out. A conversation may have no
turns left once it is rebuilt; it ends at the root. An empty table gives no node.
Texts of any length are digested where they are read; only digests are shuffled. A
conversation is one row of digests. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proteoframe.llm.base import store

#: Conversations of a shard.
SHARD = 4096
#: Conversations share the first turns of the one that begins their hundred, up to five.
FAMILY, MOST_SHARED = 100, 5
ROOT = b""

NODES_SCHEMA = ("shard bigint, node binary, parent binary, depth bigint, width bigint, first bigint, members bigint, "
                "ends string")


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, turns, widths``: digests and code points of each conversation's turns, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The role's length keeps role and text apart.
    digest = F.unhex(F.sha2(F.concat_ws(":", F.length(role), role, text).cast("binary"), 256))
    each = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", digest.alias("digest"), F.length(text).cast("long").alias("width")).alias("t"))
    rows = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return rows.select("conv_id", F.col("t.digest").alias("turns"), F.col("t.width").alias("widths"))


def with_shared_starts(convs: DataFrame) -> DataFrame:
    """Every conversation c begins with the first crc32(c) % 6 turns of conversation c - c % 100."""
    def start(name: str) -> Column:
        return F.slice(name, 1, MOST_SHARED).alias(f"_{name}")

    def rebuilt(name: str) -> Column:
        none = F.array().cast("array<binary>" if name == "turns" else "array<bigint>")
        return F.concat(F.slice(F.coalesce(f"_{name}", none), F.lit(1), F.col("_h")),
                        F.slice(name, F.col("_h") + 1, F.size(name))).alias(name)

    heads = convs.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_family"), start("turns"), start("widths"))
    own = convs.withColumn("_family", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn(
        "_h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int"))
    return own.join(heads, "_family", "left").select("conv_id", rebuilt("turns"), rebuilt("widths"))


def shard_nodes(ids: list[int], turns: list[list[bytes]], widths: list[list[int]]) -> Iterator[tuple]:
    """Nodes of one shard, parents before children; ``ids`` ascend."""
    postings: dict[tuple[int, bytes], int] = defaultdict(int)
    ending: dict[int, int] = defaultdict(int)
    for i, path in enumerate(turns):
        ending[len(path)] |= 1 << i
        for at, turn in enumerate(path):
            postings[at, turn] |= 1 << i
    stack = [((1 << len(ids)) - 1, 0, ROOT, None, 0)]
    while stack:
        members, depth, node, parent, width = stack.pop()
        ends, rest = members & ending[depth], members
        rest ^= ends
        listed = []
        first = ids[(members & -members).bit_length() - 1]
        while ends:
            low = (ends & -ends).bit_length() - 1
            listed.append(str(ids[low]))
            ends ^= 1 << low
        yield ids[0], node, parent, depth, width, first, members.bit_count(), ",".join(listed) or None
        while rest:
            low = (rest & -rest).bit_length() - 1
            turn = turns[low][depth]
            child = rest & postings[depth, turn]
            rest ^= child
            stack.append((child, depth + 1, hashlib.sha256(node + turn).digest(), node, widths[low][depth]))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    many = pa.schema([("shard", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()),
                      ("width", pa.int64()), ("first", pa.int64()), ("members", pa.int64()), ("ends", pa.string())])

    def made(rows: list[dict]) -> pa.RecordBatch:
        found = shard_nodes(*([r[c] for r in rows] for c in ("conv_id", "turns", "widths")))
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*found), many)], schema=many)

    waiting: list[dict] = []
    for batch in batches:
        waiting += batch.to_pylist()
        while len(waiting) >= SHARD:
            yield made(waiting[:SHARD])
            waiting = waiting[SHARD:]
    if waiting:
        yield made(waiting)


def _own_sums(nodes: pd.DataFrame) -> pd.DataFrame:
    """What a shard adds to its nodes' subtree sums: only nodes whose smallest member it holds count themselves."""
    nodes = nodes.sort_values("depth", ascending=False)
    place = {node: i for i, node in enumerate(nodes["node"])}
    own = nodes["first"] == nodes["conv_id"]
    saved = ((nodes["members"] - own) * nodes["width"]).tolist()
    leaves = (own & (nodes["n_children"] == 0)).astype("int64").tolist()
    convs = nodes["conv_id"].tolist()
    parents = []
    for i, parent in enumerate(nodes["parent"]):
        up = None if parent is None else place[parent]
        parents.append(None if up is None else convs[up])
        if up is not None:
            saved[up] += saved[i]
            leaves[up] += leaves[i]
    return pd.DataFrame({"node": nodes["node"].tolist(), "parent_conv_id": pd.array(parents, dtype="Int64"),
                         "saved_tokens": saved, "n_leaves": leaves})


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's end lists; rows come by node, then shard, and a list may span batches."""
    node, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], type=pa.binary()), pa.array([state.hexdigest()])],
                                          names=["node", "ends_sha256"])

    for batch in batches:
        for own, ends in zip(batch.column(0).to_pylist(), batch.column(1)):
            if own != node or state is None:
                if state is not None:
                    yield done()
                node, state = own, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.as_py().encode())
    if state is not None:
        yield done()


def trie(convs: DataFrame) -> DataFrame:
    """One row for each distinct prefix of ``conv_id, turns, widths`` (ids are distinct).

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.
    """
    ordered = store(convs).repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    nodes = store(ordered.mapInArrow(_nodes, NODES_SCHEMA))
    total = nodes.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("first").alias("conv_id"),
        F.sum("members").alias("n_convs"))
    total = store(total)
    children = total.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    known = store(total.join(children, "node", "left").select(
        "node", "depth", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children")))
    parts = nodes.drop("ends", "depth").join(known, "node").groupBy("shard").applyInPandas(
        _own_sums, "node binary, parent_conv_id bigint, saved_tokens bigint, n_leaves bigint")
    sums = parts.groupBy("node").agg(F.max("parent_conv_id").alias("parent_conv_id"),
                                     F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    ends = (nodes.filter("ends is not null").repartition("node").sortWithinPartitions("node", "shard")
            .select("node", "ends").mapInArrow(_hashed_ends, "node binary, ends_sha256 string"))
    return known.join(sums, "node").join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
