"""Nearest neighbours by a block matrix join with int8 product tiles.

Query rows and candidate rows are dealt into blocks; every query block meets
every candidate block in one task. There both sides are scaled to unit length
and quantised to int8, and their products come tile by tile. With
``x = s q + e`` the error of a product is at most
``|s_x q_x||e_y| + |e_x||s_y q_y| + |e_x||e_y|``, so a pair whose upper bound lies
below the k-th lower bound known for its query is dropped; the others are
recomputed from the original vectors in double precision and enter the query's
heap. Heaps of the blocks are merged by rank.

Vectors that are null, zero, empty, or hold null or non-finite components take no
part; vectors of different lengths do not meet. Rows that repeat an id count
once, with the smallest vector. Ties go to the smaller id. Fewer candidates than
``k`` give fewer rows; empty tables give an empty result. Extra columns are not
read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a candidate and of a query block, and candidates of one tile.
BLOCK, QUERY_BLOCK, TILE = 8192, 1024, 1024
#: Longest vector whose int8 products sum exactly in float32.
EXACT_LENGTH = 2 ** 24 // 127 ** 2


def usable(vector: Column) -> Column:
    def bad(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and norms of the errors of unit vectors."""
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, error


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 codes, exact: float32 holds every partial sum of a slice of the length."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], EXACT_LENGTH):
        out += a[:, i:i + EXACT_LENGTH].astype(np.float32) @ b[:, i:i + EXACT_LENGTH].astype(np.float32).T
    return out


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component near one.

    Cosines do not change, not even in their last bit, and squares of any finite components neither overflow nor vanish.
    """
    exponent = np.frexp(np.abs(vectors).max(axis=1))[1]
    return np.ldexp(vectors, -exponent[:, None])


def cosine(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Cosines in double precision, summed in order: the same for equal vectors wherever they stand."""
    def total(x: np.ndarray) -> np.ndarray:
        return np.add.accumulate(x, axis=1)[:, -1]

    norms = total(candidates * candidates) * total((query * query)[None, :])
    return np.clip(total(candidates * query) / np.sqrt(norms), -1.0, 1.0)


def block_search(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple]:
    """The k nearest candidates of every query of one pair of blocks, as (query, candidate, score)."""
    heaps: list[list] = [[] for _ in q_ids]
    floor = np.full(len(q_ids), -np.inf)
    qc, qs, qe = quantised(_unit(q))
    q_norm = 1.0 + qe
    for start in range(0, len(c_ids), TILE):
        ids, tile = c_ids[start:start + TILE], c[start:start + TILE]
        tc, ts, te = quantised(_unit(tile))
        about = _products(qc, tc) * qs[:, None] * ts[None, :]
        slack = q_norm[:, None] * te[None, :] + qe[:, None] * (1.0 + te)[None, :] + (qe[:, None] * te[None, :]) + 1e-12
        about[q_ids[:, None] == ids[None, :]] = -np.inf
        if len(ids) >= k:
            # A lower bound of the k-th best of this tile; the own row stands at minus infinity.
            floor = np.maximum(floor, np.partition(about - slack, len(ids) - k, axis=1)[:, len(ids) - k])
        rows, cols = np.nonzero((about + slack >= floor[:, None]) & (about > -np.inf))
        cuts = np.searchsorted(rows, np.arange(len(q_ids) + 1))
        for r in np.unique(rows):
            near = cols[cuts[r]:cuts[r + 1]]
            scores = cosine(q[r], tile[near])
            heaps[r] = heapq.nlargest(k, heaps[r] + [(s, -i) for s, i in zip(scores.tolist(), ids[near].tolist())])
            if len(heaps[r]) == k:
                floor[r] = max(floor[r], heaps[r][-1][0] - 1e-12)
    return [(int(a), -i, s) for a, heap in zip(q_ids, heaps) for s, i in heap]


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 5, vec_id: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest candidates of every query, its own id excluded."""
    def side(df: DataFrame) -> DataFrame:
        one = df.select(F.col(vec_id).alias("id"), F.col(vector).alias("v")).filter(usable(F.col("v")))
        one = one.filter("id is not null").groupBy("id").agg(F.min("v").alias("v"))
        return one.select("id", F.col("v").cast("array<double>").alias("v"), F.size("v").alias("n"))

    q, c = side(queries), side(candidates)
    q_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    c_blocks = max(1, -(-candidates.count() // BLOCK))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int")
        return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    left = dealt(q, "i", q_blocks, "j", c_blocks).groupBy("n", "i", "j")
    right = dealt(c, "j", c_blocks, "i", q_blocks).groupBy("n", "i", "j")

    def tile(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows: list = []
        if len(a) and len(b):
            a, b = a.sort_values("id"), b.sort_values("id")
            rows = block_search(a["id"].to_numpy(), scaled(np.stack(a["v"].to_list())), b["id"].to_numpy(),
                                scaled(np.stack(b["v"].to_list())), k)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = left.cogroup(right).applyInPandas(tile, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
