"""Near copies by shingle bands and exact similarity.

A text is the set of its five-word shingles (lower-cased A-Z, words between ASCII white
space; a shorter text is one shingle). ``BANDS`` bands of ``ROWS`` minima of the set under
seeded multiplications name its buckets; each row of a bucket is a candidate of the
bucket's first row only, so a bucket of any size gives one pair for each row. The
sets of candidates are compared whole, and pairs with a Jaccard similarity of at least
``SIMILARITY`` are linked. Two texts at that similarity share no band with a chance of
(1 - 0.8^4)^16, or 2 in 10,000.

Texts without a word have no shingle and no bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proteoframe.llm.base import small, store
from proteoframe.llm.textstats import encoded

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 16, 4
_FACTORS = np.random.default_rng(5).integers(1, 2 ** 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 4096


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = encoded(text).lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    if not width:
        return hashes
    out = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for i in range(width):
        out = _mixed(out * _MIX + hashes[i:len(words) - width + 1 + i])
    return np.unique(out)


def band_names(shingles: np.ndarray) -> np.ndarray:
    """One bucket name for each band."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), _CHUNK):
        least = np.minimum(least, _mixed(shingles[i:i + _CHUNK, None] * _FACTORS[None, :]).min(axis=0))
    name = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        name = _mixed(name * _MIX + column)
    return name.view(np.int64)


@F.pandas_udf(T.StructType([T.StructField("n", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]))
def signature(texts: pd.Series) -> pd.DataFrame:
    """Number of shingles and bucket names of each text."""
    sets = [shingle_set(t) for t in texts]
    return pd.DataFrame({"n": [len(s) for s in sets], "bands": [band_names(s).tolist() if len(s) else [] for s in sets]})


@F.pandas_udf(T.BinaryType())
def packed_set(texts: pd.Series) -> pd.Series:
    """The set in 32 bits a shingle: two of a text fall together once in millions of pairs."""
    return pd.Series([np.unique(shingle_set(t).astype(np.uint32)).tobytes() for t in texts], dtype=object)


def candidates(named: DataFrame) -> DataFrame:
    """``named``: ``node``, ``n``, ``bands``. Pairs ``a``, ``b``: each node with the first node of its buckets.

    Sets whose sizes are further apart than SIMILARITY allows are no candidates.
    """
    rows = named.select("node", "n", F.explode("bands").alias("bucket"))
    first = (rows.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("f"), F.count("*").alias("rows")).filter("rows > 1")
             .select("bucket", F.col("f.node").alias("a"), F.col("f.n").alias("m")))
    return (rows.join(first, "bucket").filter("a <> node and 5 * least(n, m) >= 4 * greatest(n, m)")
            .select("a", F.col("node").alias("b")).distinct())


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for left, right in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(s.as_py(), dtype=np.uint32) for s in (left, right))
            both = len(np.intersect1d(x, y, assume_unique=True))
            # In whole numbers: both / (all of either) against 4 / 5.
            kept.append(5 * both >= 4 * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays(
            [batch.column(i).filter(pa.array(kept, type=pa.bool_())) for i in (0, 1)], names=["a", "b"])


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` whose sets (``node``, ``shingles``) are similar enough."""
    firsts = sets.join(small(pairs.select(F.col("a").alias("node")).distinct()), "node", "left_semi")
    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
            .join(firsts.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").select("a", "b", "x", "y"))
    return store(both.mapInArrow(_similar, "a long, b long"))
