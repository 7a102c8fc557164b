"""Bounded, repeatable samples of labelled documents, and calibration of votes."""

from __future__ import annotations

from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, train: Column,
                    per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(``key``, ``text``, ``label``) of up to ``per_class`` labelled rows of each class, and the rows of each class.

    ``train`` says which rows of ``labels`` may be learnt from. Rows are chosen by the hash of their key, so the sample
    is the same on every run. A key labelled twice takes the larger label, a key with two texts the one with the smaller
    hash; null keys, null labels and labels other than 0 and 1 take no part.
    """
    known = (labels.where(train & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("key")).agg(F.max(F.col(label_col)).cast("int").alias("label")))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    sides = [known.where(F.col("label") == c).orderBy(F.xxhash64("key"), "key").limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(sides[0].union(sides[1]))  # at most 2 * per_class narrow rows
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = (docs.select(F.col(id_col).alias("key"), text.alias("text")).join(chosen, "key")
            .groupBy("key", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
    return rows, totals


def class_weights(labels: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """How many labelled rows each sampled row stands for."""
    sampled = np.bincount(labels, minlength=2)
    share = np.array([totals.get(c, 0) / max(sampled[c], 1) for c in (0, 1)])
    return share[labels]


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_logistic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that turn the logit of a vote into a calibrated probability (smoothed targets, Newton steps)."""
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return 0.0, log(share / (1 - share))
    pos, neg = weights[labels == 1].sum(), weights[labels == 0].sum()
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([logit(votes), np.ones(len(votes))])
    beta, prior = np.array([1.0, 0.0]), np.array([0.01, 1e-4]) * weights.sum()  # holds separable votes back
    for _ in range(steps):
        p = 1 / (1 + np.exp(-beta @ x))
        gradient = x @ (weights * (p - target)) + prior * (beta - [1, 0])
        hessian = (x * (weights * p * (1 - p))) @ x.T + np.diag(prior)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def calibrated(votes: np.ndarray, fit: tuple[float, float]) -> np.ndarray:
    return 1 / (1 + np.exp(-(fit[0] * logit(votes) + fit[1])))
