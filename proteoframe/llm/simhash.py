"""Near-duplicates by SimHash and a segment-popcount embedding.

The 64 bits of a fingerprint are 32 segments of two bits; the counts of set bits
per segment embed it in a grid. The Manhattan distance of two embeddings never
exceeds the Hamming distance of the fingerprints. Of fingerprints at three or
fewer differing bits one half of the embedding (16 segments) is therefore at a
Manhattan distance of at most one, so the two lie in one cell of that half's
grid or in cells that differ by one in one coordinate. Every distinct
fingerprint is stored in its two cells and probes the cells above them; inside a
cell distances are verified exactly. What leaves a cell is a spanning forest of
its links, never its pairs; crowded cells are cut into blocks that are compared
block by block.

Null and empty texts have fingerprint zero and are linked like any others; texts
of fewer words than a shingle are one shingle. Rows with a null id take part,
but never name a component unless all its ids are null. Repeated rows come back
each. An empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proteoframe.llm import shingles
from proteoframe.llm.base import small, small_batches, store
from proteoframe.llm.components import components
from proteoframe.llm.textstats import encoded

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Stored fingerprints of one cell that a task compares at a time.
BLOCK = 2048
_PAIRS = 0x55555555
_CHUNK = 255 * 256


def bit_majority(hashes: np.ndarray) -> int:
    """Bits set in over half the 64-bit ``hashes``."""
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _CHUNK):
        raw = hashes[i:i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(raw, axis=1, bitorder="little").view("<u8")
        # 255 rows of bits add up inside a byte, eight bytes at a time.
        groups = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
        counts += groups.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    words = encoded(text).lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64)
    return bit_majority(hashes)


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))


def fingerprint_column(text: Column) -> Column:
    return _fingerprints(text)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def cells(fps: DataFrame) -> DataFrame:
    """Cells of the distinct fingerprints ``fp``: ``half``, ``cell``, ``probe`` (false: stored there)."""
    halves = F.array(F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32))
    both = fps.select("fp", F.posexplode(halves).alias("half", "bits"))
    counts = F.col("bits").bitwiseAND(_PAIRS) + F.shiftright("bits", 1).bitwiseAND(_PAIRS)
    own = both.select("fp", "half", counts.alias("cell"))
    above = F.array(*(F.when(F.shiftright("cell", 2 * i).bitwiseAND(3) < 2, F.col("cell") + (1 << 2 * i))
                      for i in range(16)))
    at = F.explode(F.array_compact(F.concat(F.array(F.col("cell")), above)))
    return own.select("fp", "half", F.col("cell").alias("_own"), at.alias("cell")).select(
        "fp", "half", "cell", (F.col("cell") != F.col("_own")).alias("probe"))


def _blocked(rows: DataFrame) -> DataFrame:
    """Adds blocks ``i``, ``j`` and ``side``: 0 left only, 1 both, 2 right only.

    A cell of at most BLOCK stored fingerprints is one block, its stored rows
    stand on both sides and its probes on the right. Otherwise stored rows of
    block i meet all rows of every block j.
    """
    crowded = (rows.filter("not probe").groupBy("half", "cell").count().filter(F.col("count") > BLOCK)
               .select("half", "cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("n")))
    df = rows.join(crowded, ["half", "cell"], "left").withColumn("b", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))

    def place(i, j, side):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))

    others = F.sequence(F.lit(0), F.col("n") - 1)
    right = F.transform(others, lambda k: place(k, F.col("b"), 2))
    left = F.transform(others, lambda k: place(F.col("b"), k, 0))
    zero = F.lit(0)
    places = (F.when(F.col("n").isNull() & F.col("probe"), F.array(place(zero, zero, 2)))
              .when(F.col("n").isNull(), F.array(place(zero, zero, 1)))
              .when(F.col("probe"), right).otherwise(F.concat(left, right)))
    return df.select("half", "cell", "fp", F.explode(places).alias("p")).select("half", "cell", "fp", "p.*")


def _forest(left: np.ndarray, right: np.ndarray, out: list) -> None:
    """Spanning forest of the links between ``left`` and ``right`` fingerprints: a breadth-first search
    that compares every reached fingerprint with those not reached yet."""
    todo_left, todo_right = left, right
    while len(todo_left) and len(todo_right):
        start, todo_left = todo_left[0], todo_left[1:]
        front = [(start, True)]
        while front:
            fp, is_left = front.pop()
            rest = todo_right if is_left else todo_left
            if not len(rest):
                continue
            near = np.bitwise_count(rest ^ fp) <= DISTANCE
            if not near.any():
                continue
            found = rest[near]
            if is_left:
                todo_right = rest[~near]
            else:
                todo_left = rest[~near]
            out.append((np.full(len(found), fp), found))
            front += [(x, not is_left) for x in found]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, block and side; links of every block."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    keys: np.ndarray | None = None
    fps = sides = None
    for batch in batches:
        k = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("half", "cell", "i", "j")], axis=1)
        f = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        s = batch.column("side").to_numpy(zero_copy_only=False)
        if keys is not None:
            k, f, s = np.concatenate([keys, k]), np.concatenate([fps, f]), np.concatenate([sides, s])
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)]) if len(k) else np.zeros(0, int)
        last = starts[-1] if len(starts) else 0
        yield from _emit(starts[:-1], starts[1:], f[:last], s[:last], schema)
        # The last block goes on. Its stored side is bounded; of its right side what was compared goes.
        keys, fps, sides = k[last:], f[last:], s[last:]
        if len(fps) > 64 * BLOCK:
            yield from _emit(np.array([0]), np.array([len(fps)]), fps, sides, schema)
            held = sides < 2
            keys, fps, sides = keys[held], fps[held], sides[held]
    if keys is not None and len(keys):
        yield from _emit(np.array([0]), np.array([len(fps)]), fps, sides, schema)


def _emit(starts, ends, fps, sides, schema) -> Iterator[pa.RecordBatch]:
    out: list = []
    size = ends - starts
    stored = np.add.reduceat((sides < 2).astype(np.int64), starts) if len(starts) else np.zeros(0, int)
    # One stored fingerprint: all its blocks at once. The stored row sorts first.
    one = (stored == 1) & (size > 1)
    if one.any():
        heads, n = starts[one], size[one]
        at = np.repeat(heads - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        a, b = fps[np.repeat(heads, n)], fps[at]
        near = (np.bitwise_count(a ^ b) <= DISTANCE) & (a != b)
        out.append((a[near], b[near]))
    for s, e in zip(starts[(stored > 1)], ends[(stored > 1)]):
        f, d = fps[s:e], sides[s:e]
        _forest(f[d < 2], f[d > 0], out)
    if out:
        a, b = np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)


def links(fps: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints that connect all that lie within DISTANCE."""
    keys = ["half", "cell", "i", "j"]
    dealt = _blocked(cells(fps)).repartition(*keys).sortWithinPartitions(*keys, "side")
    return dealt.mapInArrow(_links, "a long, b long")


def classes(prints: DataFrame) -> DataFrame:
    """``prints``: ``doc_id``, ``fp``. Per distinct fingerprint: ``fp``, ``component_id`` (smallest id reachable)."""
    fps = store(prints.groupBy("fp").agg(F.min("doc_id").alias("_first")))
    roots = components(links(fps.select("fp")))
    known = fps.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    linked = known.filter("root is not null")
    named = linked.groupBy("root").agg(F.min("_first").alias("component_id"))
    return (linked.join(named, "root").select("fp", "component_id", "root")
            .union(known.filter("root is null").select("fp", F.col("_first").alias("component_id"), F.col("fp").alias("root"))))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex) and ``component_id`` of every row of ``docs``."""
    small_batches(docs.sparkSession)
    prints = store(docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text)).alias("fp")))
    return (prints.join(classes(prints), "fp")
            .select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", near_copies: bool = True) -> DataFrame:
    """One row of every component, the one with the smallest id (then text hash); columns as in ``docs``.

    With ``near_copies`` the components of fingerprints are then linked further: texts at a
    Jaccard similarity of at least 0.8 on five-word shingles mostly differ in more than
    DISTANCE bits, so the first rows of the components meet in shingle bands and are compared
    exactly (:mod:`proteoframe.llm.shingles`).

    Fingerprints, bands, ids and text hashes decide; texts move when rows that repeat both
    id and text are reduced to one, those of candidates once more as sets. Rows with one id and equal
    64-bit hashes of their texts count as repeated. Null texts are one text; null ids come
    last. An empty table gives an empty result; extra columns of any name pass through.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("_row"), F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"))
    named = F.coalesce(F.col("_id").cast("string"), F.lit("null"))  # never null, so join and grouping share one exchange
    body = F.col("_text")
    prints = store(rows.select("_id", "_hash", F.col("_row")[text].alias("_text")).select(
        F.col("_id").alias("doc_id"), "_hash", fingerprint_column(body).alias("fp"),
        (shingles.signature(body) if near_copies else F.lit(None)).alias("shingles")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_hash")
    first = prints.join(classes(prints).select("fp", "root"), "fp").groupBy("root").agg(
        F.min_by(F.struct(order.alias("key"), "shingles"), order).alias("_first"))
    chosen = store(first.select(
        F.col("root").alias("node"), "_first.key", F.coalesce(F.col("_first.key.doc_id").cast("string"), F.lit("null")).alias("_name"),
        F.col("_first.key._hash").alias("_hash"), "_first.shingles"))
    if near_copies:
        pairs = store(shingles.candidates(chosen.select("node", "shingles.*")))
        involved = small(chosen.join(small(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "node", "left_semi")
                         .select("node", "_name", "_hash"))
        # Texts of candidates alone go on, and only as sets.
        sets = store(rows.select(named.alias("_name"), "_hash", F.col("_row")[text].alias("_text")).join(involved, ["_name", "_hash"])
                     .select("node", shingles.packed_set(F.col("_text")).alias("shingles"))
                     .groupBy("node").agg(F.first("shingles").alias("shingles")))
        known = components(shingles.links(pairs, sets))
        joined = chosen.join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
        best = joined.groupBy("root").agg(F.min_by(F.struct("_name", "_hash"), "key").alias("p"))
        picked = store(best.select("p.*"))
    else:
        picked = chosen.select("_name", "_hash")
    return (rows.withColumn("_name", named).drop("_id").join(picked, ["_name", "_hash"])
            .groupBy("_name", "_hash").agg(F.first("_row").alias("_row")).select("_row.*"))
