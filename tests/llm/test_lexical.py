"""Bit-sliced search against a plain ranking of all documents."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from proteoframe.llm import lexical

TERM = re.compile(lexical.TERM)
LOW = str.maketrans(lexical.UPPER, lexical.LOWER)


def plain(docs, items, k):
    """Rows (item, rank, doc, score) by scoring every document for every item."""
    tfs = [(d, Counter(TERM.findall((t or "").translate(LOW)))) for d, t in docs]
    tfs = [(d, c) for d, c in tfs if c]
    n, total = len(tfs), sum(sum(c.values()) for _, c in tfs)
    terms = {}
    for i, t in items:
        if i is not None:
            terms.setdefault(i, set()).update(TERM.findall((t or "").translate(LOW)))
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for i, own in terms.items():
        scores = []
        for d, c in tfs:
            m = 50 + (50 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in own)
            if s > 0:
                scores.append((-s, d is None, d))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(scores[:k], 1)]
    return sorted(out, key=lambda x: x[:2])


def got(spark, docs, items, k=50, schema="doc_id long, text string"):
    df = lexical.ranked(spark.createDataFrame(docs, schema), spark.createDataFrame(items, "item_id long, text string"), k)
    return sorted((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect())


def test_equals_plain_ranking(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ärger", "niño", "ÉTÉ"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 40, 200])))) for i in range(400)]
    docs += [(900 + i, docs[7][1].upper()) for i in range(60)]  # ties
    docs += [(990, "x" * 50_000), (991, "w3 " * 50_000), (992, None), (993, ""), (994, " .,;"), (7, "w1 w399"), (None, docs[7][1])]
    items = [(i, " ".join(rng.choices(vocabulary, k=12))) for i in range(20)]
    items += [(50, docs[7][1]), (51, "nothing here"), (52, None), (53, ""), (54, "W3, w3. É"), (None, "w1"), (0, "w2 w399")]
    assert got(spark, docs, items, 10) == plain(docs, items, 10)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == []
    assert got(spark, [(1, "a")], []) == []
    assert got(spark, [(1, " "), (2, None)], [(1, "a")]) == []


def test_more_items_than_one_pass(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 3)
    docs = [(i, f"a b{i % 7} c{i % 3}") for i in range(50)]
    items = [(i, f"b{i % 9} c{i % 4} a") for i in range(11)]
    assert got(spark, docs, items, 5) == plain(docs, items, 5)


def test_extra_columns_pass_by(spark):
    docs = spark.createDataFrame([(1, "a b", 3, "x")], "doc_id long, text string, score long, rank string")
    items = spark.createDataFrame([(1, "b", 9)], "item_id long, text string, doc_id long")
    assert [tuple(r)[:3] for r in lexical.ranked(docs, items).collect()] == [(1, 1, 1)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=300), min_size=1, max_size=20), st.integers(0, 3))
def test_bounds_hold_and_few_are_rescored(texts, shift):
    docs = [(i, Counter(t.encode() for t in x)) for i, x in enumerate(texts)]
    block = lexical.Block(lexical.LEAST_CLASS + shift)
    for d, c in docs:
        block.add(d, c, np.array(list(c.values())), 1)
    row = block.row()
    items = lexical.Items([0, 1], [b"a", b"c", b"zz", b"h"], [np.array([0, 1]), np.array([1, 2, 3])], np.array([5.0, 700.0, 9.0, 31.0]))
    lengths = np.array(row["lengths"])
    m = 50 + (50 * lengths * len(docs)) // lengths.sum()
    slices = np.frombuffer(row["slices"], dtype=np.uint8).reshape(row["bits"], -1)
    crc = np.array([zlib.crc32(w) for w in items.words], dtype=np.uint32)
    bounds = lexical.upper_bounds(slices, row["bits"], crc, items, m, np.array(row["peaks"]))
    for j, terms in enumerate(items.terms):
        for d, c in docs:
            tf = np.array([c[items.words[t]] for t in terms])
            assert bounds[j, d] >= lexical.parts_of_score(tf, m[d]) @ items.weights[terms]


def test_signatures_exclude_most_documents(spark):
    """The bounds are worth their name: of many documents few are scored exactly."""
    rng = random.Random(1)
    docs = [(i, Counter(f"w{rng.randrange(5000)}".encode() for _ in range(80))) for i in range(1000)]
    block = lexical.Block(7)
    for d, c in docs:
        block.add(d, c, np.array(list(c.values())), len(c))
    words = [f"w{i}".encode() for i in range(40)]
    items = lexical.Items([0], words, [np.arange(40)], np.full(40, 1000.0))
    crc = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
    scored = lexical.search_block(block.row(), items, items.numbers(), crc, 1000, 80_000, [lexical.Best(10)])
    assert scored < 400
