"""Quality classifier by positive-unlabelled learning.

A linear model is fitted to the non-negative unbiased risk
``p E_pos[l(f)] + max(0, E_unl[l(-f)] - p E_pos[l(-f)])`` with the logistic loss,
over trusted positives and all unlabelled texts, ``p`` being the class prior.
Every sum over texts is taken by Spark over a stored feature table, in steps of
Newton's method; only sums (a few thousand numbers) reach the driver. When the
negative part falls below zero the step goes the other way along it, as the
non-negative estimator asks.

The prior is the share of good texts among the labelled training rows that occur
in the table, smoothed by one of each kind; where labels mark good texts only,
``prior`` must be given.

Null and empty texts have features of their own and are scored like any others.
Rows with a null id are scored, and never have a label. Labels that contradict
each other for one id count as not positive. Without a positive, or with an
empty table, the score is the prior. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proteoframe.llm.base import small_batches, store
from proteoframe.llm.textstats import N_FEATURES, features

THRESHOLD = 0.7
ROUNDS = 12
#: Ridge on the weights: RIDGE, and RIDGE_TEXTS over the number of unlabelled texts on top, which matters
#: in small tables, where chance differences between positives and unlabelled texts would be learnt.
RIDGE, RIDGE_TEXTS = 0.1, 100.0
D = N_FEATURES + 1  # with the constant
_UPPER = np.triu_indices(D)


@F.pandas_udf(T.ArrayType(T.FloatType()))
def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([features(t) for t in texts])


def feature_column(text: Column) -> Column:
    return _features(text)


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sums(table: DataFrame, per_batch, rows: int) -> np.ndarray:
    """Sum of the vectors that ``per_batch`` gives for feature matrices; one vector per task is shuffled."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(rows)
        for b in batches:
            if len(b):
                total += per_batch(np.stack(b["x"].to_list()).astype(np.float64))
        yield pd.DataFrame({"i": np.arange(rows), "v": total})

    out = table.select("x").mapInPandas(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    got = np.zeros(rows)
    for i, v in out.collect():  # a few thousand rows at any input size
        got[i] = v
    return got


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


@dataclass(frozen=True)
class Model:
    """Linear model over standardised features, cut at six deviations; the constant is last."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.c_[np.clip((x - self.mean) / self.scale, -6, 6), np.ones(len(x))]


def fit(unlabelled: DataFrame, positive: DataFrame, prior: float, rounds: int = ROUNDS,
        ridge: float = RIDGE) -> Model | None:
    """Both tables hold feature arrays ``x``."""
    moments = _sums(unlabelled, lambda x: np.r_[len(x), x.sum(0), (x * x).sum(0)], 1 + 2 * N_FEATURES)
    n = moments[0]
    if n == 0:
        return None
    mean = moments[1:1 + N_FEATURES] / n
    scale = np.sqrt(np.maximum(moments[1 + N_FEATURES:] / n - mean ** 2, 0))
    scale = np.where(scale > 1e-6, scale, 1.0)

    z = Model(mean, scale, np.zeros(D)).inputs
    first = _sums(positive, lambda x: np.r_[len(x), z(x).sum(0)], 1 + D)
    if first[0] == 0:
        return None
    centre, n_pos = first[1:] / first[0], first[0]

    def unlabelled_side(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def batch(x: np.ndarray) -> np.ndarray:
            x = z(x)
            f = x @ w
            s = _sigmoid(f)
            return np.r_[_softplus(f).sum(), s @ x, ((x.T * (s * (1 - s))) @ x)[_UPPER]]

        got = _sums(unlabelled, batch, 1 + D + len(_UPPER[0])) / n
        hess = np.zeros((D, D))
        hess[_UPPER] = got[1 + D:]
        return got[0], got[1:1 + D], hess + np.triu(hess, 1).T

    def positive_side(w: np.ndarray) -> tuple[float, np.ndarray]:
        def batch(x: np.ndarray) -> np.ndarray:
            x = z(x)
            f = x @ w
            return np.r_[_softplus(f).sum(), _sigmoid(f) @ x]

        got = _sums(positive, batch, 1 + D) / n_pos
        return got[0], got[1:]

    w = np.zeros(D)
    w[-1] = np.log(prior / (1 - prior))
    keep = np.full(D, ridge + RIDGE_TEXTS / n)
    keep[-1] = 0.0
    for _ in range(rounds):
        loss_u, grad_u, hess = unlabelled_side(w)
        loss_p, grad_p = positive_side(w)
        negative = loss_u - prior * loss_p  # risk of calling bad texts good
        grad = grad_u - prior * centre + keep * w
        if negative < 0:
            grad = -(grad_u - prior * grad_p)
        step = np.linalg.solve(hess + np.diag(keep + 1e-4), grad)
        step *= min(1.0, 4.0 / max(np.linalg.norm(step), 1e-12))
        w = w - step
        if np.linalg.norm(step) < 1e-3:
            break
    return Model(mean, scale, w)


def score_column(x: Column, model: Model | None, prior: float) -> Column:
    """Probability of a good text from its features."""
    if model is None:
        return F.lit(float(prior))

    @F.pandas_udf("double")
    def score(xs: pd.Series) -> pd.Series:
        if not len(xs):
            return pd.Series([], dtype="float64")
        x = model.inputs(np.stack(xs.to_list()).astype(np.float64))
        return pd.Series(_sigmoid((x * model.weights).sum(axis=1)))

    return score(x)


def train(table: DataFrame, labels: DataFrame, prior: float | None = None) -> tuple[Model | None, float]:
    """Model and prior from a stored table ``doc_id, x`` and ``labels`` (``doc_id, quality``)."""
    marks = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    if prior is None:
        seen = marks.join(table.select("doc_id").distinct(), "doc_id", "left_semi")
        n, good = seen.agg(F.count("quality"), F.coalesce(F.sum("quality"), F.lit(0))).first()
        prior = (good + 1) / (n + 2)
    prior = min(max(float(prior), 0.02), 0.98)
    ours = table.filter(~held_out(F.col("doc_id")))
    positive = store(ours.join(marks.filter("quality = 1"), "doc_id", "left_semi").select("x"))
    return fit(ours, positive, prior), prior


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    small_batches(docs.sparkSession)
    table = store(docs.select(F.col(doc_id).alias("doc_id"), feature_column(F.col(text)).alias("x")))
    model, prior = train(table, labels)
    return (table.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         score_column(F.col("x"), model, prior).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with their own columns; texts are not shuffled."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("_row"), F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    table = store(rows.select(F.col("_id").alias("doc_id"), feature_column(F.col("_text")).alias("x")))
    model, prior = train(table, labels)
    score = score_column(feature_column(F.col("_text")), model, prior)
    return rows.filter(score >= threshold).select("_row.*")
