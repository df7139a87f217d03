"""The trie of all shards against a plain trie."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from proteoframe.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        convs[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    nodes = {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in below)]
        ends = ",".join(str(c) for c in sorted(members) if convs[c] == path)
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children), len(leaves),
                    sum((len(nodes[p]) - 1) * (len(p[-1][1]) if p else 0) for p in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    out = prefixtrie.trie(prefixtrie.with_shared_starts(prefixtrie.paths(df))).select(*COLUMNS)
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.fixture
def rows():
    rng = random.Random(2)
    out = []
    for c in [*range(0, 40), *range(100, 140), *range(205, 220), 1000]:
        for t in range(rng.randint(1, 7)):
            out.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["yes", "no", "é" * 3])))
    return out


@pytest.mark.parametrize("shard", [1, 7, 4096])
def test_equals_plain_trie(spark, rows, shard, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SHARD", shard)
    assert got(spark, rows) == plain(rows)


def test_edges(spark):
    said = ("user", "hello")
    rows = [(c, 0, *said) for c in range(300, 360)]  # copies
    rows += [(400 + i, 0, None, None) for i in range(5)] + [(7, None, "user", ""), (7, 1, "", "user"), (7, 1, "", "user")]
    rows += [(500, t, "user", "x" * 60_000) for t in range(50)] + [(None, 0, *said), (599, 0, "a", "b:c"), (598, 0, "a:b", "c")]
    assert got(spark, rows) == plain(rows)


def test_conversations_without_turns_end_at_the_root(spark):
    rows = [(c, 0, "user", "hi") for c in range(101, 160)]  # no conversation 100
    out = got(spark, rows)
    assert out == plain(rows)
    assert next(r for r in out if r[1] == 0)[7] != hashlib.sha256(b"").hexdigest()


def test_empty_table_and_extra_columns(spark):
    assert got(spark, []) == []
    df = spark.createDataFrame([(100, 0, "user", "a", 5, "z")], SCHEMA + ", depth long, node string")
    assert prefixtrie.trie(prefixtrie.with_shared_starts(prefixtrie.paths(df.withColumn("shard", F.lit(1))))).count() == 2


def test_end_lists_over_batches(spark):
    rows = [(c, 0, "user", "same") for c in range(1_000_000, 1_000_900)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        old, prefixtrie.SHARD = prefixtrie.SHARD, 10
        assert got(spark, rows) == plain(rows)
    finally:
        prefixtrie.SHARD = old
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
