import random
from itertools import combinations

from pyspark.sql import functions as F

from proteoframe.llm import packing


def padding(lengths, ends):
    return sum(min(e for e in ends if e >= x) - x for x in lengths)


def test_boundaries_are_optimal():
    rng = random.Random(3)
    for _ in range(60):
        lengths = [rng.choice([1, 2, 3, 5, 8, 13, 40, 41, 90, 200]) for _ in range(rng.randint(1, 40))]
        histogram = [(x, lengths.count(x), x * lengths.count(x)) for x in sorted(set(lengths))]
        for k in (1, 2, 3, 4, 12):
            distinct = sorted(set(lengths))
            best = min(padding(lengths, {*c, distinct[-1]})
                       for n in range(min(k, len(distinct))) for c in combinations(distinct[:-1], n))
            ends = packing.boundaries(histogram, k)
            assert len(ends) <= k and ends == sorted(set(ends)) and padding(lengths, ends) == best


def test_batches(docs):
    rng = random.Random(4)
    rows = [(i, "w " * int(rng.expovariate(0.02)), "s") for i in range(700)] + [(5000, "w " * 9000, "s"), (None, None, None),
                                                                              (5001, "", "s"), (3, "w w", "s"), (3, "w w", "s")]
    df = docs(rows).withColumn("batch", F.lit("clash")).withColumn("_key", F.lit(1))
    got = packing.packed(df, budget=2000, buckets=6).collect()
    assert len(got) == len(rows)
    assert sorted(r.n_tokens for r in got) == sorted(len((t or "").split()) for _, t, _ in rows)
    batches = {}
    for r in got:
        assert 0 <= r.padding == r.bucket_len - r.n_tokens
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for rows_ in batches.values():
        assert len(rows_) == 1 or len(rows_) * rows_[0].bucket_len <= 2000
        assert sorted(r.slot for r in rows_) == list(range(len(rows_)))
    for bucket in {b for b, _ in batches}:
        sizes = [len(batches[bucket, i]) for i in range(sum(b == bucket for b, _ in batches))]
        top = batches[bucket, 0][0].bucket_len
        assert all(s == max(1, 2000 // max(1, top)) for s in sizes[:-1])
    lengths = [r.n_tokens for r in got]
    histogram = [(x, lengths.count(x), x * lengths.count(x)) for x in sorted(set(lengths)) if x <= packing.EXACT]
    assert {r.bucket_len for r in got if r.bucket_len <= packing.EXACT} <= {h[0] for h in histogram}


def test_pieces_number_alike(docs, monkeypatch):
    from proteoframe.llm import base
    rows = [(i, "w " * (i % 9 + 1), "s") for i in range(300)]
    one = sorted((r.doc_id, r.bucket, r.batch, r.slot) for r in packing.packed(docs(rows), 60, 3).collect())
    monkeypatch.setattr(base, "PIECE_ROWS", 5)
    assert one == sorted((r.doc_id, r.bucket, r.batch, r.slot) for r in packing.packed(docs(rows), 60, 3).collect())


def test_empty(docs):
    assert packing.packed(docs([])).count() == 0
    assert packing.boundaries([]) == []


def test_cells_are_bounded(spark):
    got = spark.range(1, 200_000).select("id", packing.cell(F.col("id")).alias("c")).collect()
    assert all(r.c == r.id for r in got if r.id <= packing.EXACT)
    assert all(r.c <= r.id < r.c * (1 + 1 / 1024) for r in got)
    assert len({r.c for r in got}) <= packing.EXACT + 2048 * 6
