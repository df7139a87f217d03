"""Texts that are parsed side by side have the phrases of a plain search, and the same languages and scores."""

from hypothesis import given, settings
from hypothesis import strategies as st
from test_langid import plain_phrases

from proteoframe.llm import langid

TEXTS = st.lists(st.text("abcdé z", max_size=70), min_size=1, max_size=25)
SAMPLES = st.lists(st.text("abcdé ", min_size=1, max_size=50), min_size=1, max_size=4)


@settings(max_examples=200, deadline=None)
@given(SAMPLES, TEXTS, st.integers(1, 60))
def test_phrases_side_by_side(samples, texts, lookups):
    samples = tuple((f"l{i}", s) for i, s in enumerate(samples))
    old, langid.LOOKUPS = langid.LOOKUPS, lookups  # few letters at a time
    try:
        known = langid.side_by_side(texts, samples)
    finally:
        langid.LOOKUPS = old
    assert sum(map(bool, known)) == max(0, sum(map(bool, texts)) - langid.ALONE)
    for text, counts in zip(texts, known):
        assert all(n == plain_phrases(text, samples[i][1]) for i, n in counts.items())
        assert not counts or len(counts) == len(samples)


@settings(max_examples=100, deadline=None)
@given(SAMPLES, TEXTS, st.sampled_from([0, 300, langid.CELLS]))
def test_languages_and_scores_do_not_depend_on_company(samples, texts, cells):
    samples = tuple((f"l{i}", s) for i, s in enumerate(samples))
    want = [langid.best_language(t, samples) for t in texts]
    old, langid.CELLS = langid.CELLS, cells  # none, some or all languages have a table
    langid.automata.cache_clear()
    try:
        lows = [langid.folded(t) for t in texts]
        assert [langid.best_of(low, samples, k) for low, k in zip(lows, langid.side_by_side(lows, samples))] == want
    finally:
        langid.CELLS = old
        langid.automata.cache_clear()
