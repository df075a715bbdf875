"""Operator 5: quality by positive-unlabelled learning.

Trusted positives are labelled 1; the unlabelled set is web text as it
comes, whatever its label.  The class prior is estimated from a first
classifier of positives against unlabelled text: where its score is highest the unlabelled
share over the positive share approaches the prior (best bin, on a half that
the classifier didn't see).  Then a logistic model over hinges of dense
features minimises the non-negative unbiased risk

    prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)]).

Both sets are bounded samples of ``SAMPLE`` rows, the smallest by a hash of
``doc_id``; everything else covers all rows.

Defined results: null and empty texts are scored by the features of the empty
text; a null ``doc_id`` counts as the empty text in the split; without
positives or unlabelled text every score is 0.5; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.dense_features import all_features
from loanlens.llm.labelled import (collect_features, hash_sample, remainder, sample_frame, score_documents,
                                   training_labels)

#: Rows of the positive and of the unlabelled sample.
SAMPLE = 15_000
KNOTS = 8
THRESHOLD = 0.5


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Hinges:
    """x -> (x, max(0, x - knot) for quantile knots), standardised."""

    knots: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray) -> Hinges:
        knots = np.quantile(x, np.linspace(0.02, 0.98, KNOTS), axis=0)
        self = cls(knots, np.zeros(1), np.ones(1))
        wide = self(x)
        self.mean, self.scale = wide.mean(axis=0), np.maximum(wide.std(axis=0), 1e-9)
        return self

    def __call__(self, x: np.ndarray) -> np.ndarray:
        parts = [x, *(np.maximum(0.0, x - k) for k in self.knots)]
        return (np.concatenate(parts, axis=1) - self.mean) / self.scale


def _adam(gradient, width: int, steps: int, rate: float) -> np.ndarray:
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def best_bin_prior(positive: np.ndarray, unlabelled: np.ndarray, slack: float = 0.02) -> float:
    """Least ratio of unlabelled to positive share above a score, with slack for small bins."""
    cuts = np.quantile(positive, np.linspace(0.0, 0.95, 60))
    above_p = np.array([(positive >= c).mean() for c in cuts])
    above_u = np.array([(unlabelled >= c).mean() for c in cuts])
    spread = np.sqrt(np.log(1 / slack) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    best = np.argmin((above_u + spread) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 500, ridge: float = 1e-3) -> np.ndarray:
    """Weights that minimise the non-negative risk with the logistic loss."""

    def gradient(w):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        as_positive = -prior * p.T @ (1 - sp) / len(p)
        negative = u.T @ su / len(u) - prior * p.T @ sp / len(p)
        zp, zu = np.clip(p @ w, -40, 40), np.clip(u @ w, -40, 40)
        risk = np.log1p(np.exp(zu)).mean() - prior * np.log1p(np.exp(zp)).mean()
        # a negative part of the risk is climbed out of, not followed down
        return (as_positive + negative if risk >= 0 else -negative) + ridge * w

    return _adam(gradient, p.shape[1], steps, 0.05)


@dataclass
class QualityModel:
    """Score of raw features; ``prior`` is the estimated class prior."""

    hinges: Hinges | None
    weights: np.ndarray
    prior: float

    @classmethod
    def fit(cls, positive: np.ndarray, unlabelled: np.ndarray) -> QualityModel:
        if not len(positive) or not len(unlabelled):
            return cls(None, np.zeros(0), 0.5)
        hinges = Hinges.fit(np.concatenate([positive, unlabelled]))
        p, u = _with_one(hinges(positive)), _with_one(hinges(unlabelled))
        # prior 0.5 of either set: an ordinary classifier of the two
        half_p, half_u = len(p) // 2, len(u) // 2
        if half_p and half_u:
            fit_p, fit_u = p[:half_p], u[:half_u]
            first = _adam(lambda w: (-fit_p.T @ (1 - _sigmoid(fit_p @ w)) / len(fit_p)
                                     + fit_u.T @ _sigmoid(fit_u @ w) / len(fit_u)) / 2 + 1e-3 * w,
                          p.shape[1], 300, 0.05)
            prior = best_bin_prior(p[half_p:] @ first, u[half_u:] @ first)
        else:
            prior = 0.5
        return cls(hinges, fit_nnpu(p, u, prior), prior)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.hinges is None:
            return np.full(len(x), 0.5)
        return _sigmoid(_with_one(self.hinges(x)) @ self.weights)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Fit on a bounded sample of trusted positives and of unlabelled documents."""
    positive = hash_sample(training_labels(labels, "quality").where("label = 1").select("doc_id"), sample)
    ids = docs.where(remainder() != 1).where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"))
    unlabelled = hash_sample(ids.distinct(), sample)
    chosen = positive.withColumn("label", F.lit(1)).union(unlabelled.withColumn("label", F.lit(0)))
    _, label, x = collect_features(sample_frame(docs, chosen), all_features)
    rng = np.random.default_rng(5)
    rows = rng.permutation(len(x))
    return QualityModel.fit(x[rows][label[rows] == 1], x[rows][label[rows] == 0])


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    return score_documents(docs, all_features, fit_quality(docs, labels), THRESHOLD)
