import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from proteoframe.llm import nearest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, is_query, k):
    """Cosines in double precision, ties to the smaller id."""
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        ok[i] = np.array(v, dtype=np.float32).astype(float)
    out = []
    for q in filter(is_query, ok):
        scores = []
        for c, v in ok.items():
            if c != q and len(v) == len(ok[q]):
                a, b, d = sum(x * x for x in ok[q]), sum(x * x for x in v), sum(x * y for x, y in zip(ok[q], v))
                scores.append((-min(1.0, d / math.sqrt(a * b)), c))
        out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def check(spark, rows, k=5, every=10):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("clash"))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score)
                 for r in nearest.nearest(df.filter(f"vec_id % {every} = 0"), df, k).collect())
    want = brute(rows, lambda i: i % every == 0, k)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-14)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 64)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(300)]
    check(spark, rows)


def test_copies_and_scaled_vectors(spark):
    rng = np.random.default_rng(1)
    common = rng.normal(size=12).astype(np.float32)
    rows = [(i, (common * (2.0 if i % 3 else 1.0)).tolist()) for i in range(150)]
    rows += [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(150, 200)]
    check(spark, rows)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]),
            (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0, 2.0, 3.0]), (9, [1e-30, 1e-30]),
            (10, [1.0, 0.0]), (20, [-1.0, 0.0]), (None, [1.0, 0.0])]
    check(spark, rows)


def test_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert nearest.nearest(df, df).count() == 0
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [(r.query_id, r.vec_id) for r in nearest.nearest(df.filter("vec_id = 0"), df).collect()] == [(0, 1)]


@pytest.mark.parametrize("length", [3, 64, 2500])
def test_error_bounds_hold(length):
    rng = np.random.default_rng(2)
    a, b = (nearest._unit(rng.normal(size=(40, length)) ** 3) for _ in range(2))
    (ca, sa, ea), (cb, sb, eb) = nearest.quantised(a), nearest.quantised(b)
    about = nearest._products(ca, cb) * sa[:, None] * sb[None, :]
    slack = (1 + ea)[:, None] * eb[None, :] + ea[:, None] * (1 + eb)[None, :] + ea[:, None] * eb[None, :]
    assert (np.abs(about - a @ b.T) <= slack + 1e-12).all()
    assert (nearest._products(ca, cb) == ca.astype(np.int64) @ cb.astype(np.int64).T).all()


def test_vectors_of_any_finite_size(spark):
    """Doubles whose squares overflow or vanish take part and are ranked as their multiples are."""
    rng = np.random.default_rng(3)
    base = [rng.normal(size=8) for _ in range(60)]
    sizes = [2.0 ** rng.integers(-560, 560) for _ in base]
    plain = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    huge = spark.createDataFrame([(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(base, sizes))] + [
        (70, [1e160] * 8), (71, [1e-170] * 8), (72, [5e-324] + [0.0] * 7)], "vec_id long, embedding array<double>")
    a, b = ({(r.query_id, r.rank): (r.vec_id, r.score) for r in nearest.nearest(df.filter("vec_id % 10 = 0"), df.filter(
        "vec_id < 60"), 5).collect()} for df in (plain, huge))
    assert {k: v for k, v in b.items() if k[0] < 60} == a
    near = {r.query_id: (r.vec_id, r.score) for r in nearest.nearest(huge.filter("vec_id = 70"), huge.filter("vec_id >= 70"), 1).collect()}
    assert near[70][0] == 71 and near[70][1] == pytest.approx(1.0)
