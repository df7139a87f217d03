"""Quality rules by weak supervision: rules vote or abstain, EM weighs them.

Every rule votes 1 (good), 0 (bad) or abstains. Votes of a document are packed
into one pattern; patterns are counted over all documents (at most
3 ** len(RULES) rows, so they fit the driver at any size) and
expectation-maximisation estimates, from the counts alone, the share of good
documents and what each rule votes on good and on bad ones. A document is kept
if no base rule fails and the posterior probability of good is large enough.

Null and empty texts have no words and fail the base rule. Repeated rows, ties
and extra columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proteoframe.llm.base import small_batches, store
from proteoframe.llm.textstats import RULE_COUNTS, rule_counts

#: Least posterior probability of good for a document to be kept.
KEEP = 0.5
ABSTAIN, BAD, GOOD = 2, 0, 1
COUNTS = T.StructType([T.StructField(c, T.LongType()) for c in RULE_COUNTS])


@F.pandas_udf(COUNTS)
def counts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([rule_counts(t) for t in texts], columns=list(RULE_COUNTS), dtype="int64")


def _count(name: str) -> Column:
    return F.col(f"_counts.{name}")


def _rules() -> dict[str, tuple[Column, Column]]:
    """The rules over ``_counts``: when a document looks good, and when bad (which goes first)."""
    c = _count
    words, lines = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1))
    chars = F.greatest(c("word_chars"), F.lit(1))

    def rule(good: Column, bad: Column) -> tuple[Column, Column]:
        return good, bad | (c("n_words") == 0)

    symbols, repeats = c("n_symbols") / words, c("n_repeat_words") / words
    length, upper, stops = c("word_chars") / words, c("n_upper") / chars, c("n_stops") / words
    bangs, dups, distinct = c("n_bangs") / words, c("n_dup_lines") / lines, c("n_distinct") / words
    marks = c("n_marks") / words
    return {
        "marks": rule(marks < 0.02, marks > 0.15),
        "symbols": rule(symbols < 0.01, symbols > 0.1),
        "repeats": rule(repeats < 0.05, repeats > 0.15),
        "word_length": rule(length.between(3.8, 6.2), ~length.between(3.0, 7.2)),
        "capitals": rule(upper < 0.1, upper > 0.4),
        "stops": rule(stops.between(0.02, 0.5), (stops < 0.005) & (c("n_words") >= 20)),
        "bangs": rule(bangs < 0.05, bangs > 0.3),
        "lines": rule((dups == 0) & (c("n_lines") >= 4), dups > 0.3),
        "distinct": rule(distinct > 0.5, distinct < 0.2),
    }


RULES = ("marks", "symbols", "repeats", "word_length", "capitals", "stops", "bangs", "lines", "distinct")


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_counts``."""
    small_batches(docs.sparkSession)
    return docs.withColumn("_counts", counts(F.col(text)))


def base_failed() -> Column:
    return (_count("n_words") < 10) | (100 * _count("n_repeat_words") > 20 * _count("n_words"))


def pattern() -> Column:
    """The votes packed into one number, three values for each rule."""
    out = F.lit(0)
    for i, (good, bad) in enumerate(_rules()[r] for r in RULES):
        out = out + F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN) * 3 ** i
    return out


def fit(patterns: np.ndarray, weights: np.ndarray, rounds: int = 100, tolerance: float = 1e-9) -> dict:
    """EM over vote patterns and their counts.

    Starts from documents without a bad vote as good ones, which also fixes which
    class is which: rules are written to vote bad rarely and for cause. Accuracies
    are smoothed by one vote of each kind. Returns the share of good documents and
    table[rule, class, vote].
    """
    n_rules = len(RULES)
    votes = (patterns[:, None] // 3 ** np.arange(n_rules)) % 3
    good = np.where((votes == BAD).any(1), 0.1, np.where((votes == GOOD).any(1), 0.9, 0.5))
    prior, table, last = 0.5, np.ones((n_rules, 2, 3)), -np.inf
    for _ in range(rounds):
        total = weights.sum()
        prior = (weights @ good + 1) / (total + 2)
        for k, w in ((GOOD, weights * good), (BAD, weights * (1 - good))):
            hits = np.stack([[w[votes[:, r] == v].sum() for v in (BAD, GOOD)] for r in range(n_rules)])
            table[:, k, :ABSTAIN] = (hits + 1) / (hits.sum(1, keepdims=True) + 2)
        good, likelihood = _posterior(votes, prior, table)
        now = float(weights @ likelihood) / max(total, 1)
        if abs(now - last) < tolerance:
            break
        last = now
    return {"prior": float(prior), "table": table.copy()}


def _posterior(votes: np.ndarray, prior: float, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rules = np.arange(len(RULES))
    # The table holds 1 for an abstention, which so tells nothing about the class.
    logs = [np.log(p) + np.log(table[rules, k, votes]).sum(1) for k, p in ((GOOD, prior), (BAD, 1 - prior))]
    both = np.logaddexp(*logs)
    return np.exp(logs[0] - both), both


def posterior(model: dict, patterns: np.ndarray) -> np.ndarray:
    votes = (patterns[:, None] // 3 ** np.arange(len(RULES))) % 3
    return _posterior(votes, model["prior"], model["table"])[0]


def learn(docs: DataFrame) -> dict:
    """Fit the model on the vote patterns of all rows of ``docs`` (with ``_counts``) that the base rules leave."""
    rows = docs.filter(~base_failed()).groupBy(pattern().alias("_pattern")).count().collect()  # at most 3 ** len(RULES)
    rows = sorted((r[0], r[1]) for r in rows)
    if not rows:
        return {"prior": 0.5, "table": np.ones((len(RULES), 2, 3))}
    return fit(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float))


def probability(model: dict) -> Column:
    """Posterior of good over ``_counts``: the sum of the votes' log odds."""
    known = np.log(model["table"][:, GOOD, :]) - np.log(model["table"][:, BAD, :])
    odds = F.lit(float(np.log(model["prior"] / (1 - model["prior"]))))
    for r, row in zip(RULES, known):
        good, bad = _rules()[r]
        odds = odds + F.when(bad, float(row[BAD])).when(good, float(row[GOOD])).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judged(docs: DataFrame, text: str = "text", keep: float = KEEP) -> DataFrame:
    """``_counts``, ``base_failed``, ``posterior`` and ``kept`` of every row, beside all columns but the text."""
    df = store(counted(docs, text).drop(text))
    return (df.withColumn("base_failed", base_failed()).withColumn("posterior", probability(learn(df)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep)))


def keep_good(docs: DataFrame, text: str = "text", keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    Texts are counted twice, once for the model and once for the verdict: none
    is shuffled or stored.
    """
    df = counted(docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), "_text")
    model = learn(df)
    return df.filter(~base_failed() & (probability(model) >= keep)).select("_row.*")
