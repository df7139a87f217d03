"""Packing by optimal length buckets.

A histogram of the lengths of all rows is reduced to cells (exact up to EXACT
words, above that 2048 for each power of two), which bounds
what reaches the driver at any size. Dynamic programming over it chooses the
bucket boundaries that minimise padding. Inside a bucket rows are numbered in a
seeded order and cut into batches of ``budget // boundary`` rows, so a batch
padded to its boundary holds at most ``budget`` words; a row longer than the
budget is a batch of its own.

Null and empty texts have length 0 and form batches like any others. Repeated
rows are packed once each; equal keys are ordered by length, then by their
other columns' hash. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proteoframe.llm.base import piece_digits, running_sum, seeded_key, store, word_count

EXACT = 4096
BUCKETS = 16
BUDGET = 65_536
RESULT = ("n_tokens", "bucket", "bucket_len", "batch", "slot", "padding")


def cell(length: Column) -> Column:
    """Lengths up to EXACT stand alone; longer ones keep 12 leading bits."""
    bits = F.greatest(F.floor(F.log2(length.cast("double"))).cast("int") - 11, F.lit(0))
    width = F.pow(F.lit(2.0), bits)
    return F.when(length <= EXACT, length).otherwise(F.floor(length / width) * width).cast("long")


def boundaries(histogram: list[tuple[int, int, int]], buckets: int = BUCKETS) -> list[int]:
    """Longest length of each bucket, rising, so that the padding of all rows is least.

    ``histogram``: (longest length, rows, words) per cell, rising. Padding of
    cells i..j in one bucket is ``b_j (N_j - N_i) - (S_j - S_i)``: for a fixed
    number of buckets every start i gives a line over b_j, so the lower hull of
    those lines answers all j in one sweep.
    """
    n = len(histogram)
    if n == 0:
        return []
    longest = [h[0] for h in histogram]
    rows, words = [0], [0]
    for _, c, s in histogram:
        rows.append(rows[-1] + c)
        words.append(words[-1] + s)
    best = [longest[j] * rows[j + 1] - words[j + 1] for j in range(n)]
    starts = [[0] * n]
    for _ in range(1, min(buckets, n)):
        hull: deque = deque()
        now, start = [0] * n, [0] * n
        for j in range(n):
            if j:
                # The bucket starts at cell j: what lies before costs best[j - 1].
                line = (-rows[j], best[j - 1] + words[j], j)
                while len(hull) > 1 and _useless(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
            b = longest[j]
            while len(hull) > 1 and hull[1][0] * b + hull[1][1] <= hull[0][0] * b + hull[0][1]:
                hull.popleft()
            fixed = b * rows[j + 1] - words[j + 1]
            now[j], start[j] = best[j], starts[-1][j]
            if hull and hull[0][0] * b + hull[0][1] + fixed < best[j]:
                now[j], start[j] = hull[0][0] * b + hull[0][1] + fixed, hull[0][2]
            else:
                start[j] = -1  # one bucket less is as good
        best = now
        starts.append(start)
    out, j, k = [], n - 1, len(starts) - 1
    while j >= 0:
        while k > 0 and starts[k][j] == -1:
            k -= 1
        out.append(longest[j])
        j = starts[k][j] - 1
        k -= 1
    return out[::-1]


def _useless(a: tuple, b: tuple, c: tuple) -> bool:
    """Line b is nowhere below both a and c (slopes fall)."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def packed(docs: DataFrame, budget: int = BUDGET, buckets: int = BUCKETS, seed: int = 42,
           doc_id: str = "doc_id", text: str = "text", length: Column | None = None) -> DataFrame:
    """Every row with ``n_tokens, bucket, bucket_len, batch, slot, padding``; own columns of these names go.

    ``n_tokens`` counts white-space words unless ``length`` is given, so ``budget``
    is one of words: an unspaced text counts as one. Lengths above EXACT share
    cells of 2048 for each power of two. A boundary is the longest length of its cell, so it lies
    above the optimal one by less than a 2048th of itself: a row of such a bucket is padded
    by less than that share more than in the optimum, and the total by less than 0.05 %
    of the padded words of these buckets. Shorter rows are packed optimally.
    """
    size = word_count(F.col(text)) if length is None else length
    row = F.struct(*(c for c in docs.columns if c not in RESULT)).alias("_row")
    df = docs.select(row, size.alias("n_tokens"), seeded_key(seed, doc_id).alias("_key"))
    lengths = store(df.groupBy("n_tokens").count())
    grid = (lengths.groupBy(cell(F.col("n_tokens")).alias("_cell"))
            .agg(F.max("n_tokens").alias("b"), F.sum("count").alias("c"),
                 F.sum(F.col("count") * F.col("n_tokens")).alias("s")).collect())
    histogram = sorted((r["b"], r["c"], r["s"]) for r in grid)
    ends = boundaries(histogram, buckets)
    total = sum(h[1] for h in histogram)
    bucket = F.lit(0)
    for i, end in enumerate(ends[:-1]):
        bucket = bucket + (F.col("n_tokens") > end).cast("int")
    tops = F.array(*(F.lit(e).cast("long") for e in ends or [0]))
    df = (df.withColumn("bucket", bucket.cast("int"))
          .withColumn("bucket_len", F.element_at(tops, F.col("bucket") + 1))
          .withColumn("_piece", F.substring("_key", 1, piece_digits(total)))
          .withColumn("_tie", F.xxhash64("_row")).withColumn("_one", F.lit(1).cast("long")))
    numbered = running_sum(df, ["bucket"], "_piece", ["_key", "n_tokens", "_tie"], "_one", "_no")
    per_batch = F.greatest(F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1)), F.lit(1)).cast("long")
    return (numbered.withColumn("_per", per_batch)
            .select("_row.*", "n_tokens", "bucket", "bucket_len",
                    F.expr("_no div _per").alias("batch"), F.expr("_no % _per").alias("slot"),
                    (F.col("bucket_len") - F.col("n_tokens")).alias("padding")))
