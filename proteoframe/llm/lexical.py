"""Ranked lexical search over bit-sliced Bloom signatures.

The index is a table of blocks of documents. A block holds documents of similar
size; each has a Bloom signature of its (term, frequency level) keys, and the
signatures stand on their side: slice ``j`` is a bitmap over the documents of the
block whose signature has bit ``j``. A term is at most as often in a document as
the slices of its levels say, since a Bloom signature only errs by claiming too
much. Summing the weights of an item's terms over these bitmaps, level by level,
gives every document an upper bound of its score. Documents whose bound is below
the score of the k-th best document found so far are left out; all others are
scored exactly from the block's own term counts and enter the item's list. Lists
of the tasks are merged by rank.

Nothing is dealt by a key: blocks are filled from the documents a task reads, so
a hot source, a hot term or a large group of copies costs no task more than
others, and no pair of item and document leaves a task unless it is among its k
best. Items go to the tasks in blocks of at most ``ITEMS`` items and about
``ITEM_TERMS`` terms, one pass over the index each, so what a task holds of them is
bounded (a single longer item is a block of its own).

Documents that are null, empty or without a term are no part of the statistics
and are never found. Rows that repeat a ``doc_id`` are documents of their own; a
null ``doc_id`` is kept and stands last among equal scores. Items without a term,
or with a null id, give no row; rows that repeat an ``item_id`` are one item with
the terms of all. Empty tables give an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proteoframe.llm.base import TEXTS_PER_BATCH, small_batches, store

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Byte table: A-Z lower-cased, every other ASCII byte outside letters and digits blank.
FOLD = bytes(i + 32 if 65 <= i <= 90 else i if i > 127 or chr(i).isalnum() else 32 for i in range(256))
#: Term frequencies that get a key of their own; between two of them the higher one bounds.
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 32, 64, 128, 256, 1024, 4096])
#: Bloom parameters: hash functions, signature bits for each key of a full signature.
HASHES, BITS_PER_KEY = 4, 12
#: A block ends at so many documents or keys; signatures are powers of two from 2^LEAST_CLASS keys on.
BLOCK_DOCS, BLOCK_KEYS, LEAST_CLASS = 1024, 1 << 18, 6
#: Items, and distinct terms of items, that one pass over the index looks up.
ITEMS, ITEM_TERMS = 1024, 16_384
#: Cells of a matrix of terms and documents that a task holds at once.
CELLS = 1 << 22
#: Lists of one item are merged in so many groups before they meet.
MERGE_GROUPS = 64

INDEX_SCHEMA = ("doc_ids array<bigint>, lengths array<bigint>, peaks array<bigint>, bits bigint, n_docs bigint, "
                "n_terms bigint, slices binary, words binary, starts binary, ids binary, counts binary")


def term_list(raw: bytes | None) -> list[bytes]:
    return raw.translate(FOLD).split() if raw else []


def positions(crc: np.ndarray, level: np.ndarray, bits: int) -> np.ndarray:
    """Signature bits of (term, level) keys, one column for each hash function."""
    x = crc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (level.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    for shift in (29, 32):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    first, step = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return ((first[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(bits)).astype(np.int64)


@dataclass
class Block:
    """Documents of one size class until they are sliced."""

    size_class: int
    dictionary: dict[bytes, int] = field(default_factory=dict)
    doc_ids: list = field(default_factory=list)
    ids: list[np.ndarray] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)
    n_keys: int = 0

    def add(self, doc_id: int | None, found: Counter, counts: np.ndarray, keys: int) -> None:
        number = self.dictionary
        self.doc_ids.append(doc_id)
        self.ids.append(np.fromiter((number.setdefault(t, len(number)) for t in found), dtype=np.int32, count=len(found)))
        self.counts.append(counts)
        self.n_keys += keys

    def full(self) -> bool:
        return len(self.doc_ids) >= BLOCK_DOCS or self.n_keys >= BLOCK_KEYS

    def row(self) -> dict:
        bits, n = BITS_PER_KEY << self.size_class, len(self.doc_ids)
        sizes = np.array([len(x) for x in self.ids])
        ids, counts = np.concatenate(self.ids), np.concatenate(self.counts)
        words = list(self.dictionary)
        crc = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
        levels = np.searchsorted(LEVELS, counts, side="right")
        ends = np.cumsum(levels)
        level = np.arange(ends[-1]) - np.repeat(ends - levels, levels)
        at = positions(np.repeat(crc[ids], levels), level, bits)
        doc = np.repeat(np.repeat(np.arange(n), sizes), levels)
        slices = np.zeros((bits, -(-n // 8)), dtype=np.uint8)
        for bit in range(8):
            own = doc & 7 == bit
            slices[at[own], (doc[own] >> 3)[:, None]] |= np.uint8(128 >> bit)
        lengths = [int(x.sum()) for x in self.counts]
        return {"doc_ids": self.doc_ids, "lengths": lengths, "peaks": [int(x.max()) for x in self.counts],
                "bits": bits, "n_docs": n, "n_terms": sum(lengths), "slices": slices.tobytes(),
                "words": b" ".join(words), "starts": np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64).tobytes(),
                "ids": ids.tobytes(), "counts": counts.astype(np.int32).tobytes()}


def _index_type() -> pa.Schema:
    many, one, raw = pa.list_(pa.int64()), pa.int64(), pa.binary()
    kinds = (many, many, many, one, one, one, raw, raw, raw, raw, raw)
    return pa.schema([(part.split()[0], kind) for part, kind in zip(INDEX_SCHEMA.split(", "), kinds)])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, open_blocks = _index_type(), {}
    for batch in batches:
        for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = Counter(term_list(raw.as_py()))
            if not found:
                continue
            counts = np.fromiter(found.values(), dtype=np.int64, count=len(found))
            keys = int(np.searchsorted(LEVELS, counts, side="right").sum())
            size_class = max(LEAST_CLASS, (keys - 1).bit_length())
            block = open_blocks.setdefault(size_class, Block(size_class))
            block.add(doc_id, found, counts, keys)
            if block.full():
                yield pa.RecordBatch.from_pylist([open_blocks.pop(size_class).row()], schema=schema)
    for block in open_blocks.values():
        yield pa.RecordBatch.from_pylist([block.row()], schema=schema)


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of bit-sliced signatures of all documents, with their exact term counts."""
    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    return rows.mapInArrow(_blocks, INDEX_SCHEMA)


@dataclass
class Items:
    """A block of items: their distinct terms, and each item's terms by number."""

    item_ids: list[int]
    words: list[bytes]
    terms: list[np.ndarray]
    weights: np.ndarray | None = None

    def numbers(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}


def items_of(rows: list) -> Items:
    """Rows ``item_id, term``, sorted."""
    number: dict[bytes, int] = {}
    own: dict[int, list[int]] = {}
    for r in rows:
        own.setdefault(r["item_id"], []).append(number.setdefault(bytes(r["term"]), len(number)))
    return Items(list(own), list(number), [np.array(x) for x in own.values()])


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def parts_of_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Best:
    """The k best documents of one item so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.floor = k, [], 1

    def add(self, scores: np.ndarray, docs: list) -> None:
        new = [(-s, d is None, d or 0) for s, d in zip(scores.tolist(), docs) if s >= self.floor]
        if new:
            self.rows = sorted(self.rows + new)[: self.k]
            if len(self.rows) == self.k:
                self.floor = max(1, -self.rows[-1][0])


def upper_bounds(slices: np.ndarray, bits: int, crc: np.ndarray, items: Items, m: np.ndarray, peaks: np.ndarray) -> np.ndarray:
    """Upper bound of each item's score in each document of a slice of a block."""
    n = len(m)
    bounds = np.zeros((len(items.terms), n))
    present, below = np.ones((len(crc), n), dtype=np.uint8), np.zeros(n)
    alive = np.arange(len(crc))
    for i, level in enumerate(LEVELS):
        if not (peaks >= level).any():
            break
        at = positions(crc[alive], np.full(len(alive), i), bits)
        maps = slices[at[:, 0]]
        for h in range(1, HASHES):
            maps &= slices[at[:, h]]
        present[alive] &= np.unpackbits(maps, axis=1, count=n)
        some = np.zeros(len(crc), dtype=bool)
        some[alive] = present[alive].any(axis=1)
        alive = np.flatnonzero(some)
        top = np.minimum(peaks, LEVELS[i + 1] - 1) if i + 1 < len(LEVELS) else peaks
        gain = np.maximum(parts_of_score(top, m) - below, 0)
        below = below + gain
        sums = present[alive].astype(np.float64)
        row = np.full(len(crc), -1)
        row[alive] = np.arange(len(alive))
        for j, terms in enumerate(items.terms):
            own = row[terms]
            own_w = items.weights[terms][own >= 0]
            own = own[own >= 0]
            if len(own):
                bounds[j] += (own_w @ sums[own]) * gain
    return bounds


def search_block(row: dict, items: Items, number: dict[bytes, int], crc: np.ndarray, n_docs: int, n_terms: int,
                 best: list[Best]) -> int:
    """Enter the documents of one block; returns how many pairs of item and document were scored exactly."""
    lengths, all_peaks = np.array(row["lengths"], dtype=np.int64), np.array(row["peaks"], dtype=np.int64)
    all_m = 50 + (50 * lengths * n_docs) // n_terms
    all_slices = np.frombuffer(row["slices"], dtype=np.uint8).reshape(row["bits"], -1)
    starts, ids = np.frombuffer(row["starts"], dtype=np.int64), np.frombuffer(row["ids"], dtype=np.int32)
    counts = np.frombuffer(row["counts"], dtype=np.int32)
    known = np.array([number.get(w, -1) for w in row["words"].split(b" ")])
    step = max(8, CELLS // max(1, len(items.words)) // 8 * 8)
    scored = 0
    for a in range(0, len(lengths), step):
        b = min(a + step, len(lengths))
        m, docs = all_m[a:b], row["doc_ids"][a:b]
        bounds = upper_bounds(all_slices[:, a // 8:-(-b // 8)], row["bits"], crc, items, m, all_peaks[a:b])
        tf = np.zeros((b - a, len(items.words)), dtype=np.int32)
        held = known[ids[starts[a]:starts[b]]]
        doc = np.repeat(np.arange(b - a), np.diff(starts[a:b + 1]))
        tf[doc[held >= 0], held[held >= 0]] = counts[starts[a]:starts[b]][held >= 0]
        for j, terms in enumerate(items.terms):
            left = np.flatnonzero(bounds[j] >= best[j].floor)
            # The most promising first: they raise the floor for the others.
            left = left[np.argsort(-bounds[j][left], kind="stable")]
            for part in (left[: best[j].k], left[best[j].k:]):
                part = part[bounds[j][part] >= best[j].floor]
                if len(part):
                    each = parts_of_score(tf[np.ix_(part, terms)].astype(np.int64), m[part][:, None])
                    best[j].add(each @ items.weights[terms].astype(np.int64), [docs[i] for i in part])
                    scored += len(part)
    return scored


def _document_counts(blocks: DataFrame, items: Items) -> dict[int, int]:
    """How many documents hold each term of the items."""
    words = items.words

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = {w: i for i, w in enumerate(words)}, np.zeros(len(words), dtype=np.int64)
        for batch in batches:
            for held, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = held.split(b" ")
                docs = np.bincount(np.frombuffer(ids, dtype=np.int32), minlength=len(held))
                known = np.array([number.get(w, -1) for w in held])
                total[known[known >= 0]] += docs[known >= 0]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    found = blocks.select("words", "ids").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in found.collect()}


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Lists of the tasks, cut to k in groups of tasks first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item_id", "group").orderBy(*order)
    best = found.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    every = Window.partitionBy("item_id").orderBy(*order)
    return (best.withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def search(blocks: DataFrame, items: Items, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``item_id, rank, doc_id, score`` of one block of items."""
    df = _document_counts(blocks, items)
    items.weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(items.words))], dtype=np.float64)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = np.fromiter(map(zlib.crc32, items.words), dtype=np.uint32, count=len(items.words))
        number, best = items.numbers(), [Best(k) for _ in items.item_ids]
        for batch in batches:
            for row in batch.to_pylist():
                search_block(row, items, number, crc, n_docs, n_terms, best)
        rows = [(item, None if none else doc, -s) for item, one in zip(items.item_ids, best) for s, none, doc in one.rows]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    found = blocks.drop("n_docs", "n_terms").mapInArrow(look_up, "item_id long, doc_id long, score long")
    return _ranked(found.withColumn("group", F.spark_partition_id() % MERGE_GROUPS), k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item."""
    spark = docs.sparkSession
    small_batches(spark)
    blocks = store(index(docs), **{"parquet.block.size": 8 << 20})
    low = F.translate(F.col(text), UPPER, LOWER)
    own = items.filter(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("long").alias("item_id"), F.explode(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("term"))
    own = store(own.distinct())
    sums = blocks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    size = own.agg(F.countDistinct("item_id").alias("items"), F.count("*").alias("terms")).first()
    if not sums["l"] or not size["items"]:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    # A block row is some megabytes: few go to Python at a time.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    passes = max(-(-size["items"] // ITEMS), -(-size["terms"] // ITEM_TERMS))
    out = None
    for i in range(passes):
        part = own.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i).orderBy("item_id", "term")
        rows = part.select("item_id", F.col("term").cast("binary").alias("term")).collect()
        if rows:
            found = store(search(blocks, items_of(rows), sums["n"], sums["l"], k))
            out = found if out is None else out.union(found)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))
    return out
