"""Operators that iterate or solve, against plain Python on small data."""

import itertools
import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from proteoframe.operators import library, scan, structure
from proteoframe.operators.ranking import full_rank
from proteoframe.streaming import scans


def test_greedy_diversity(spark):
    rng = random.Random(5)
    data = [(pid, r, "".join(rng.choice("AC") for _ in range(rng.choice((6, 7)))))
            for pid in (1, 2) for r in range(1, 61)]
    df = spark.createDataFrame(data, "pid long, rank long, sequence string")
    for cap in (5, 50):
        got = sorted(tuple(r) for r in library.diversify(df, 3, cap, batch=7).collect())
        want = []
        for pid in (1, 2):
            kept = []
            for _, r, s in (d for d in data if d[0] == pid):
                if len(kept) < cap and all(sum(x != y for x, y in zip(s, k[2])) >= 3 for k in kept):
                    kept.append((pid, r, s))
            want += kept
        assert got == sorted(want)


def test_full_rank_of_a_hot_key(spark):
    rng = random.Random(3)
    data = [(1 if i % 3 else 2, i, rng.choice([None, 0.5, 0.5, rng.random()])) for i in range(400)]
    df = spark.createDataFrame(data, "k long, id long, v double")
    got = {r["id"]: r["rank"] for r in full_rank(df, ["k"], "v", "id").collect()}
    for k in (1, 2):
        part = sorted((d for d in data if d[0] == k), key=lambda d: (d[2] is None, -(d[2] or 0), d[1]))
        assert [got[d[1]] for d in part] == list(range(1, len(part) + 1))


def test_components(spark):
    rng = random.Random(9)
    nodes = [(s, p) for s in (1, 2) for p in range(1, 41)]
    edges = [(s, *sorted(rng.sample(range(1, 41), 2))) for s in (1, 2) for _ in range(30)]
    edges += [(1, p, p + 1) for p in range(1, 20)]  # a long chain
    got = {(r[0], r[1]): r[2] for r in structure.components(
        spark.createDataFrame(nodes, "structure_id long, position long"),
        spark.createDataFrame(edges, "structure_id long, u long, v long")).collect()}
    label = {n: n[1] for n in nodes}
    changed = True
    while changed:
        changed = False
        for s, u, v in edges:
            m = min(label[(s, u)], label[(s, v)])
            for p in (u, v):
                if label[(s, p)] != m:
                    label[(s, p)], changed = m, True
    assert got == label


def test_rmsd_against_svd(spark):
    rng = np.random.default_rng(1)
    clouds = {s: rng.normal(size=(12, 3)) * 5 for s in (1, 2)}
    clouds[3] = clouds[1] * np.array([-1, 1, 1])  # mirror image: no proper rotation fits
    clouds[4] = clouds[1][:9]
    rows = [(s, i + 1, tuple(map(float, xyz))) for s, c in clouds.items() for i, xyz in enumerate(c)]
    pts = spark.createDataFrame(rows, "structure_id long, position long, ca struct<x:double,y:double,z:double>")
    pairs = spark.createDataFrame(list(itertools.combinations(range(1, 5), 2)) + [(1, 1)], "structure_a long, structure_b long")
    got = {(r[0], r[1]): r["rmsd"] for r in structure.ca_rmsd(pts, pairs).collect()}
    for (a, b), value in got.items():
        n = min(len(clouds[a]), len(clouds[b]))
        if n < 10:
            assert value is None
            continue
        p, q = (clouds[x][:n] - clouds[x][:n].mean(0) for x in (a, b))
        _, s, _ = np.linalg.svd(p.T @ q)
        s[2] *= np.sign(np.linalg.det(p.T @ q))
        want = math.sqrt(max(0.0, (np.sum(p * p) + np.sum(q * q) - 2 * s.sum()) / n))
        assert value == pytest.approx(want, abs=1e-5)


def test_sasa_of_a_lone_atom_and_a_pair(spark):
    cols = "structure_id long, position long, aa string, het boolean, atom string, element string, x double, y double, z double"
    df = spark.createDataFrame([(1, 1, "A", False, "CA", "C", 0.0, 0.0, 0.0), (2, 1, "A", False, "CA", "C", 0.0, 0.0, 0.0),
                                (2, 2, "A", False, "CA", "C", 3.0, 0.0, 0.0)], cols)
    got = {(r[0], r[1]): r[2] for r in structure.atom_sasa(df, 120).select("structure_id", "position", "sasa").collect()}
    full = 4 * math.pi * 3.1 ** 2
    assert got[(1, 1)] == pytest.approx(full)
    # a plane at distance 1.5 from the centre hides the cap beyond it
    assert got[(2, 1)] == pytest.approx(full * (1 + 1.5 / 3.1) / 2, rel=0.03)


def test_spatial_pairs_equal_all_pairs(spark):
    rng = random.Random(2)
    pts = [(1, i, *(rng.uniform(-9, 9) for _ in range(3))) for i in range(60)]
    df = spark.createDataFrame(pts, "structure_id long, position long, x double, y double, z double")
    got = {(r.position_a, r.position_b) for r in structure.grid_pairs(df, df, 4.0).collect()}
    assert got == {(a[1], b[1]) for a in pts for b in pts if sum((x - y) ** 2 for x, y in zip(a[2:], b[2:])) <= 16.0}


def test_scans_do_not_depend_on_partitions(spark, seqs):
    rng = random.Random(4)
    df = seqs(*("".join(rng.choice("ACDEGKMNPRSW") for _ in range(rng.randint(0, 200))) for _ in range(30)))
    results = []
    for n in (1, 4, 64):
        part = df.repartition(n)
        results.append((sorted(map(tuple, scan.motif_hits(part).collect())),
                        sorted(map(tuple, scan.complexity_flags(part).collect()))))
    assert results[0] == results[1] == results[2]


def test_combinations(spark):
    rng = random.Random(8)
    top = [(1, r, rng.randint(1, 6), "A", "CDEFG"[r % 5], 10.0 - r) for r in range(1, 9)]
    df = spark.createDataFrame(top, "pid long, rank int, position long, wt string, mut string, best double")
    got = [tuple(r) for r in library.combine_variants(df, 3, 40).orderBy("combo_no").select("components", "combo_sum").collect()]
    want = []
    for order in (2, 3):
        for c in itertools.combinations(top, order):
            if len({x[2] for x in c}) == order:
                want.append(([f"A{x[2]}{x[4]}" for x in c], sum(x[5] for x in c)))
    assert got == want[:40]


def test_streaming_scan(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1\tMACVCKGGG\n2\tRRR\n")
    stream = scans.stream_sequences(spark, str(tmp_path / "in"))
    scans.write_hits(scan.motif_hits(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("pid", "pattern").collect()
    assert sorted(map(tuple, got)) == [(1, "Met1"), (2, "RR")]


def test_self_pairs_and_hidden_points(spark):
    """Half the shell finds every pair once; areas equal counting free test points one by one."""
    rng = random.Random(12)
    rows = [(s, i // 2, "CA" if i % 2 else "N", "C" if i % 2 else "N", *(rng.uniform(-9, 9) for _ in range(3))) for s in (1, 2) for i in range(60)]
    rows += [(3, 1, "CA", "C", 0.0, 0.0, 0.0), (3, 1, "CA", "C", 0.5, 0.0, 0.0), (3, 2, "CA", "C", -1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "structure_id int, position int, atom string, element string, x double, y double, z double")
    got = [(r.structure_id, r.position_a, r.atom_a, r.x_a, r.position_b, r.atom_b, r.x_b)
           for r in structure.self_pairs(df, 4.0, ("position", "atom")).collect()]
    sides = [frozenset(((s, pa, aa, xa), (s, pb, ab, xb))) for s, pa, aa, xa, pb, ab, xb in got]
    want = {frozenset(((a[0], *a[1:3], a[4]), (b[0], *b[1:3], b[4]))) for a in rows for b in rows
            if a[0] == b[0] and a[1:3] != b[1:3] and sum((p - q) ** 2 for p, q in zip(a[4:], b[4:])) <= 16.0}
    met = {x for x in sides if len({y[1:3] for y in x}) == 2}
    assert met == want and len(sides) == len(set(sides))
    radii = {r[:3]: {"N": 1.55, "C": 1.7}[r[3]] + 1.4 for r in rows}
    areas = {(r.structure_id, r.position, r.atom): r.sasa for r in structure.atom_sasa(
        df.filter("structure_id < 3").withColumns({"aa": F.lit("A"), "het": F.lit(False)})).collect()}
    for row in rows[:20]:
        r, free = radii[row[:3]], 0
        for u in structure.sphere_points(100):
            p = [c + r * v for c, v in zip(row[4:], u)]
            free += all(sum((m - n) ** 2 for m, n in zip(p, o[4:])) >= radii[o[:3]] ** 2
                        for o in rows if o[0] == row[0] and o[1:3] != row[1:3])
        assert areas[row[:3]] == pytest.approx(free * 4 * math.pi / 100 * r * r)
