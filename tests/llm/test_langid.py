"""Cross-parsing against a plain search for longest matches, and held-out accuracy."""

import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from proteoframe.llm import langid

SCHEMA = "doc_id long, text string, lang string"


def plain_phrases(text, sample):
    count = i = 0
    while i < len(text):
        n = 1
        while i + n < len(text) and text[i:i + n + 1] in sample:
            n += 1
        i += n
        count += 1
    return count


@settings(max_examples=300, deadline=None)
@given(st.text("abc ", max_size=60), st.text("abcd ", max_size=80))
def test_phrases_equal_plain_longest_matches(sample, text):
    start = langid.suffix_automaton(sample)
    assert langid.phrases(text, start) == plain_phrases(text, sample)


@given(st.text("ab", max_size=40))
def test_automaton_knows_all_substrings(text):
    start = langid.suffix_automaton(text)
    for i in range(len(text)):
        assert langid.phrases(text[i:], start) == 1
    assert langid.phrases(text + "b" * (len(text) + 1), start) > 1 or not text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcde ", min_size=1, max_size=60), min_size=1, max_size=4), st.text("abcdez 1", max_size=300))
def test_early_stop_changes_nothing(samples, text):
    samples = tuple((f"l{i}", s) for i, s in enumerate(samples))
    low = langid.folded(text)
    name, score = langid.best_language(text, samples)
    if not low:
        assert (name, score) == ("und", 0.0)
        return
    counts = [plain_phrases(low, s) for _, s in samples]
    assert name == samples[counts.index(min(counts))][0]
    assert 0.0 < score <= 1.0


def text_of(rng, words, n):
    return " ".join(rng.choices(words, k=n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    parts = {"xx": ["th", "er", "ing", "and", "ou"], "yy": ["ción", "es", "ar", "que", "lo"], "zz": ["sch", "ung", "ein", "keit", "zu"]}
    words = {k: ["".join(rng.choices(v, k=rng.randint(1, 3))) for _ in range(300)] for k, v in parts.items()}
    out = []
    for i in range(600):
        lang = rng.choice(["xx"] * 8 + ["yy", "zz"])
        out.append((i, text_of(rng, words[lang], rng.choice([4, 20, 200])), lang))
    return out


def test_held_out_accuracy(spark, rows):
    got = langid.identified(spark.createDataFrame(rows, SCHEMA)).collect()
    truth = {i: (t, lang) for i, t, lang in rows}
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == truth[r.doc_id][1] for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_do_not_matter(spark, rows):
    changed = [(i, t, "qq" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
    a, b = (sorted(langid.identified(spark.createDataFrame(x, SCHEMA)).collect()) for x in (rows, changed))
    assert a == b


def test_edges(spark, rows):
    extra = [(1000, None, "xx"), (1001, "", "yy"), (1002, "123 !?", "zz"), (1003, rows[0][1] * 400, None), (None, rows[1][1], "xx"),
             (5, rows[5][1], None), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame(rows + extra, SCHEMA).withColumn("score", F.lit("clash")).withColumn("held_out", F.lit(3))
    got = langid.identified(df).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    assert [(by[i].lang_pred, by[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by[None].held_out is False and by[1003].lang_pred == rows[0][2]
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 5}) == 1


def test_nothing_to_learn(spark):
    assert langid.identified(spark.createDataFrame([], SCHEMA)).collect() == []
    got = langid.identified(spark.createDataFrame([(1, "some words", None)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_copies_do_not_crowd_out_other_texts(spark, rows):
    copies = [(10_000 + i, "the same text", "yy") for i in range(5000)]
    samples = dict(langid.learn(spark.createDataFrame(rows + copies, SCHEMA)))
    assert samples["yy"].count("the same text") <= 1 and len(samples["yy"]) > 2000
