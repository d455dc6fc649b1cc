"""Operator 9 - quality by Bradley-Terry pairwise ranking.

A document's score is linear in its features (quantile steps of the dense
features of its whole text).  The weights are learned from preference pairs
(a text of label 1 is preferred to one of label 0) by the logistic loss on the
feature difference, with a ridge, by Newton's method.  The decision is a
quantile of the scores: the one that separates the training labels best; the
reported score is the document's quantile among the training scores, stretched
so that the deciding quantile falls on ``THRESHOLD``.

Bounds: at most ``SAMPLE`` labelled documents (none held out) and ``PAIRS``
preference pairs are used for fitting.  Scoring uses the text alone and covers
all rows.

Defined results: null and empty texts get the score of a text without words;
without labels of both classes every score is the share of label 1 (0 without
labels); a text under several labels counts once, by the majority (even: 1);
repeated rows get equal scores; the fit does not depend on how rows are dealt; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, documents, prepare
from .text_features import NAMES, Features, labelled_sample, sample_numbers
from .toxicity import features_udf, score_udf

SAMPLE = 20_000
PAIRS = 40_000
STEPS = 8
RIDGE = 1.0
THRESHOLD = 0.3
HELD_OUT = (5, 0)


def pair_gradient(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the mean log-probability (times 100, with the ridge) of the stated
    preferences, whose feature differences are ``d``; and those probabilities."""
    p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
    return d.T @ (1 - p) / len(d) * 100 - RIDGE * w, p


def pair_weights(d: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Bradley-Terry weights by Newton's method."""
    w = np.zeros(d.shape[1])
    for _ in range(rounds):
        grad, p = pair_gradient(d, w)
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) * 100 + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


class PairwiseRanker:
    def __init__(self, x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 9):
        self.prior = float(y.mean()) if len(y) else 0.0
        self.weights = None
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        if not len(good) or not len(bad):
            return
        # steps between quantiles of all texts and of the smaller class
        few = x[bad if len(bad) < len(good) else good]
        grid = np.linspace(0, 1, STEPS + 2)[1:-1]
        self.cuts = [np.unique(np.concatenate((np.quantile(x[:, j], grid), np.quantile(few[:, j], grid))))
                     for j in range(x.shape[1])]
        phi = self.steps(x)
        self.mean, self.scale = phi.mean(axis=0), phi.std(axis=0) + 0.05
        rng = np.random.default_rng(seed)
        z = (phi - self.mean) / self.scale
        d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]  # preferred minus other
        w = self.weights = pair_weights(d)
        s = z @ w
        self.sorted = np.sort(s)
        # the quantile that separates the labels best, each class weighing alike
        order = np.argsort(s, kind="stable")
        wrong = np.cumsum(np.where(y[order] == 1, 1 / len(good), -1 / len(bad)))
        k = int(np.argmin(wrong))
        cut = s[order[k]]
        nxt = self.sorted[min(np.searchsorted(self.sorted, cut, "right"), len(s) - 1)]
        self.cut = (cut + nxt) / 2

    def steps(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x[:, j:j + 1] > c[None, :]).astype(float) for j, c in enumerate(self.cuts)], axis=1)

    def features(self) -> Features:
        return Features()

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        s = ((self.steps(x) - self.mean) / self.scale) @ self.weights
        below = self.sorted[self.sorted <= self.cut]
        above = self.sorted[self.sorted > self.cut]
        low = np.searchsorted(below, s, "right") / (len(below) + 1) * THRESHOLD * 0.999
        high = THRESHOLD + np.searchsorted(above, s, "right") / (len(above) + 1) * (1 - THRESHOLD)
        return np.where(s > self.cut, high, low)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_size: int = SAMPLE) -> PairwiseRanker:
    spark = prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, HELD_OUT, sample_size)
    rows = sample_numbers(sample, "label", features_udf(spark, {})("text").alias("x"))
    x = np.array([r["x"] for r in rows], float).reshape(-1, len(NAMES))
    return PairwiseRanker(x, np.array([r["label"] for r in rows], float))


def quality(docs: DataFrame, labels: DataFrame, model: PairwiseRanker | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    spark = prepare(docs.sparkSession)
    model = model or train(docs, labels)
    mod, rest = HELD_OUT
    return (docs.select("doc_id", (crc_mod(F.col("doc_id"), mod) == rest).alias("held_out"),
                        score_udf(spark, model)("text").alias("score"))
                .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def op9_quality(spark, sf_dir):
    return quality(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
