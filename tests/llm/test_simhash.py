import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from proteoframe.llm import queries, simhash
from proteoframe.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs):
    """pairs of (id, fingerprint) -> smallest id reachable, by comparing all."""
    fps = list({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    a = np.array(fps, dtype=np.uint64)
    for f in fps:
        for g in a[np.bitwise_count(a ^ np.uint64(f)) <= 3]:
            root[find(f)] = find(int(g))
    first = {}
    for i, f in pairs:
        if i is not None:
            first[find(f)] = min(i, first.get(find(f), i))
    return {(i, f"{f:016x}", first.get(find(f))) for i, f in pairs}


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in queries.op9_simhash(spark, SF).select("doc_id", "fingerprint", "component_id").collect()}
    assert got == classes([(r.doc_id, brute_print(r.text)) for r in rows])


def test_long_texts_and_spark_hash(spark):
    text = " ".join(f"W{i % 977}É" for i in range(150_000))
    assert simhash.fingerprint(text[:4000]) == brute_print(text[:4000])
    assert simhash.fingerprint(text) == brute_print(text)
    got = spark.sql("select xxhash64('a b c') h").first().h
    assert got % 2 ** 64 == xxhash.xxh64_intdigest(b"a b c", seed=42) == simhash.fingerprint("A  b\tC")


def near(rng, base, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def prints(spark, pairs):
    return spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in pairs], "doc_id long, fp long")


def compare(spark, pairs):
    got = prints(spark, pairs).join(simhash.classes(prints(spark, pairs)), "fp")
    have = {(r.doc_id, f"{r.fp % 2 ** 64:016x}", r.component_id) for r in got.collect()}
    assert have == classes(pairs)


def some(rng, n):
    seeds = [rng.getrandbits(64) for _ in range(8)] + [0, 2 ** 64 - 1]
    out = [rng.getrandbits(64) for _ in range(50)]
    for _ in range(n):
        out.append(near(rng, rng.choice(seeds), rng.randint(0, 5)))
    for s in seeds[:3]:
        f = s
        for _ in range(40):
            f = near(rng, f, 3)
            out.append(f)
    return list(enumerate(out))


def test_links_equal_all_pairs(spark):
    compare(spark, some(random.Random(5), 400))


def test_crowded_cells_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rng = random.Random(6)
    pairs = some(rng, 250)
    base = rng.getrandbits(64)
    pairs += [(1000 + i, near(rng, base, 2)) for i in range(150)]
    compare(spark, pairs)


def test_edge_cases(spark, docs):
    text = "one two three four five six seven"
    rows = [(5, text, "s"), (3, text.upper(), "s"), (5, text, "s"), (9, None, "s"), (8, " ", "s"), (None, text, "s"), (11, "solo", None),
            (None, "quite other words stand in here", "s")]
    df = docs(rows).withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (5, 3), (9, 8), (8, 8), (None, 3), (11, 11), (None, None)], key=str)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("3", text.upper()), ("8", " "), ("11", "solo"), ("None", "quite other words stand in here")])
    assert simhash.near_duplicates(docs([])).count() == 0 and simhash.keep_one(docs([])).count() == 0


def test_components_of_long_paths(spark):
    rng = random.Random(7)
    names = rng.sample(range(10 ** 6), 300)
    edges = list(zip(names, names[1:])) + [(1, 1), (names[0], names[3])] + [(-1, i) for i in range(-60, -2)]
    rng.shuffle(edges)
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(n, min(names)) for n in names} | {(n, -60) for n in [*range(-60, -2), -1]}
