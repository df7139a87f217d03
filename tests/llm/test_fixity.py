import hashlib

import pytest

from proteoframe.llm import fixity

SCHEMA = "file string, offset long, payload string"


def replicas(spark, a, b):
    return [fixity.digested(spark.createDataFrame(r, SCHEMA)) for r in (a, b)]


def rows_of(spark, a, b):
    return sorted((r.file, r.offset, r.kind, r.length_a, r.length_b) for r in fixity.audit(*replicas(spark, a, b)).collect())


@pytest.fixture(scope="module")
def records():
    out = []
    for f in "xy":
        at = 0
        for i in range(400):
            body = f"record {f}{i} " * (i % 50 + 90)
            out.append((f, at, body))
            at += len(body)
    return out


def test_equal_replicas(spark, records):
    assert rows_of(spark, records, list(reversed(records))) == []


def test_located_damage(spark, records):
    hurt = list(records)
    hurt[7] = (hurt[7][0], hurt[7][1], hurt[7][2].replace("record", "rec0rd", 1))
    hurt[501] = (hurt[501][0], hurt[501][1], hurt[501][2][:-1])
    lost = hurt.pop(333)
    extra = ("z", 0, "new file")
    want = [("x", records[7][1], "changed", len(records[7][2]), len(records[7][2])),
            ("x", lost[1], "missing", len(lost[2]), None),
            ("y", records[501][1], "changed", len(records[501][2]), len(records[501][2]) - 1),
            ("z", 0, "extra", None, 8)]
    assert rows_of(spark, records, [*hurt, extra]) == sorted(want)


def test_tree_levels_and_roots(spark, records):
    first, second = replicas(spark, records, records)
    from pyspark.sql import functions as F
    both = first.withColumn("replica", F.lit("a")).unionByName(second.withColumn("replica", F.lit("b")))
    top = max(r[1] for r in records)
    levels = fixity._levels(top)
    assert fixity.RANGE * fixity.FANOUT ** levels > top
    nodes = fixity.tree(both, levels)
    roots = fixity.roots(nodes, levels).collect()
    assert len(roots) == 4 and len({r.hash for r in roots}) == 2
    # A leaf range is the hash of its records in order.
    mine = sorted((at, len(p), hashlib.sha256(p.encode()).hexdigest()) for f, at, p in records
                  if f == "x" and at < fixity.RANGE)
    want = hashlib.sha256("\n".join(f"{a}:{n}:{d}" for a, n, d in mine).encode()).hexdigest()
    got = nodes.filter("replica = 'a' and level = 0 and file = 'x' and node = 0").first().hash
    assert got == want


def test_null_offsets_take_part(spark):
    rows = [("f", None, "a"), ("f", None, "b"), ("f", 0, "c"), (None, None, "d")]
    assert rows_of(spark, rows, rows) == []
    assert rows_of(spark, rows, rows[2:3]) == [("", None, "missing", 1, None), ("f", None, "missing", 1, None)]
    assert rows_of(spark, rows[:1], [("f", None, "x")]) == [("f", None, "changed", 1, 1)]


def test_edge_cases(spark):
    rows = [(None, 0, "a"), ("f", 0, None), ("f", 0, "twice"), ("f", 10, "r"), ("f", 10, "r")]
    assert rows_of(spark, rows, rows) == []
    assert rows_of(spark, [], []) == []
    assert rows_of(spark, rows[:1], []) == [("", 0, "missing", 1, None)]
    assert rows_of(spark, rows, rows[:-1]) == [("f", 10, "changed", 1, 1)]
