"""Operator 5 - toxicity by gradient-boosted trees over dense features, calibrated.

Features of a whole text: densities and weights of a lexicon, its words near a
second-person word, shares of capitals, exclamations, symbols, digits and bare
punctuation, and lexicon words that show only after undoing letter
substitutions, inserted marks and stretched letters.  The lexicon is a short
list of insults plus the words and word beginnings whose smoothed log-odds
between toxic and other training texts are high; equal texts count once.

The trees minimise the logistic loss on quantile bins (numpy, on a bounded
sample); a slice of the sample that neither the lexicon nor the trees see fits an
isotonic map from their score to a probability.

Bounds: at most ``SAMPLE`` labelled documents are used for fitting, none of
them held out, and at most ``LEXICON`` learned words.  Scoring uses the text
alone and covers all rows.

Defined results: null and empty texts get the model's score of a text without
words; without labels of both classes every score is the share of label 1
(0 without labels); a text under several labels counts once, by the majority
(even: 1); repeated rows get equal scores; the fit does not depend on how rows
are dealt; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, documents, prepare
from .text_features import EDGE, NAMES, STEMS, Features, labelled_sample, sample_numbers

SAMPLE = 20_000
LEXICON = 1000
#: A learned word occurs in at least this share of the toxic sample.
MIN_SHARE = 0.01
HELD_OUT = (5, 0)
TIE = 1e-6
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
# Common insults of the corpus' languages, the start of the lexicon.
INSULTS = """idiot idiots moron morons stupid dumb fool loser losers pathetic worthless trash scum clown
disgusting garbage jerk vermin filth creep imbecile retard
dumm dummkopf trottel depp abschaum versager widerlich
imbécile stupide crétin débile ordure minable abruti
estúpido idiota imbécil tonto basura asqueroso patético""".split()


class Trees:
    """Boosted regression trees on quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        n, m = x.shape
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
        # rare features are 0 almost everywhere: their positive values get bins of their own
        for j in range(m):
            pos = x[x[:, j] > 0, j]
            if len(pos):
                self.edges[j] = np.unique(np.concatenate((self.edges[j], [0.0], np.quantile(pos, [0.25, 0.5, 0.75]))))
        b = self.bins(x)
        top = max(len(e) for e in self.edges) + 1
        p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base, self.rate, self.trees = math.log(p / (1 - p)), rate, []
        f = np.full(n, self.base)
        for _ in range(trees):
            q = 1 / (1 + np.exp(-f))
            grad, hess = y - q, q * (1 - q) + 1e-6
            node, splits = np.zeros(n, np.int64), []
            for d in range(depth):
                width = 1 << d
                best = [(0.0, -1, 0)] * width
                for j in range(m):
                    at = (node * top + b[:, j])
                    g = np.bincount(at, grad, width * top).reshape(width, top).cumsum(axis=1)
                    h = np.bincount(at, hess, width * top).reshape(width, top).cumsum(axis=1)
                    gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                    gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
                    gain[(hl < 1) | (ht - hl < 1)] = 0
                    cut = gain.argmax(axis=1)
                    for k in range(width):
                        if gain[k, cut[k]] > best[k][0] + 1e-9:
                            best[k] = (gain[k, cut[k]], j, int(cut[k]))
                feature = np.array([s[1] for s in best])
                cut = np.array([s[2] if s[1] >= 0 else 1 << 30 for s in best])
                splits.append((np.maximum(feature, 0), cut))
                node = node * 2 + (b[np.arange(n), splits[-1][0][node]] > cut[node])
            leaves = np.bincount(node, grad, 1 << depth) / (np.bincount(node, hess, 1 << depth) + 1)
            f += rate * leaves[node]
            self.trees.append((splits, leaves))

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.bins(x), np.arange(len(x))
        f = np.full(len(x), self.base)
        for splits, leaves in self.trees:
            node = np.zeros(len(x), np.int64)
            for feature, cut in splits:
                node = node * 2 + (b[rows, feature[node]] > cut[node])
            f += self.rate * leaves[node]
        return f


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: (scores, fitted non-decreasing values)."""
    order = np.argsort(score, kind="stable")
    s, v = score[order], y[order].astype(float)
    # equal scores are one point
    keys, first, count = np.unique(s, return_index=True, return_counts=True)
    value = np.add.reduceat(v, first) / count
    stack: list[list[float]] = []
    for val, c in zip(value, count):
        stack.append([val, c, 1])
        while len(stack) > 1 and stack[-2][0] >= stack[-1][0]:
            b, a = stack.pop(), stack.pop()
            stack.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return keys, np.repeat([x[0] for x in stack], [x[2] for x in stack])


class ToxicityModel:
    def __init__(self, lexicon: dict[str, float], x: np.ndarray, y: np.ndarray, slice_: np.ndarray):
        """``slice_`` marks the rows that only calibrate."""
        self.lexicon, self.prior = lexicon, float(y.mean()) if len(y) else 0.0
        self.trees = None
        fit = ~slice_
        if len(np.unique(y[fit])) < 2:
            return
        self.trees = Trees(x[fit], y[fit])
        own = slice_ if len(np.unique(y[slice_])) == 2 else fit
        self.at, self.value = isotonic(self.trees.raw(x[own]), y[own])

    def features(self) -> Features:
        return Features(self.lexicon)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.prior)
        f = self.trees.raw(x)
        # the isotonic fit; a millionth of the raw score keeps the order inside a step
        return np.clip((1 - TIE) * np.interp(f, self.at, self.value) + TIE / (1 + np.exp(-f)), 0, 1)


def learned_lexicon(sample: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Words of the sample by smoothed log-odds of label 1 (aggregated by Spark, ``size`` rows collected)."""
    n1, n0 = sample.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    n1, n0 = n1 or 0, n0 or 0
    edge = "".join("\\" + chr(c) for c in EDGE)
    words = F.transform(F.split(F.lower("text"), "[\\x20\\x09-\\x0D]+"),
                        lambda w: F.regexp_replace(w, f"^[{edge}]+|[{edge}]+$", ""))
    stems = [F.transform(F.filter("_w", lambda w, n=n: F.length(w) > n),
                         lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in STEMS]
    words = (sample.select("label", F.array_distinct(words).alias("_w"))
                   .select("label", F.explode(F.array_distinct(F.concat("_w", *stems))).alias("word")))
    odds = F.log((F.col("ones") + 0.1) / (n1 + 0.2)) - F.log((F.col("zeros") + 0.1) / (n0 + 0.2))
    top = (words.filter(F.length("word").between(2, 40)).groupBy("word")
                .agg(F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros"))
                .filter(F.col("ones") >= max(4, n1 * MIN_SHARE)).withColumn("odds", odds)
                .filter(F.col("odds") > 2.5).orderBy(F.desc("ones"), "word").limit(size).collect())
    return {r["word"]: min(float(r["odds"]), 8.0) for r in top}


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_size: int = SAMPLE) -> ToxicityModel:
    spark = prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, HELD_OUT, sample_size).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(4)))
    # a quarter of the sample calibrates: neither the lexicon nor the trees see its labels
    lexicon = {w: 3.0 for w in INSULTS} | learned_lexicon(sample.filter("part <> 0"))
    rows = sample_numbers(sample, "label", "part", features_udf(spark, lexicon)("text").alias("x"))
    x = np.array([r["x"] for r in rows], float).reshape(-1, len(NAMES))
    return ToxicityModel(lexicon, x, np.array([r["label"] for r in rows], float), np.array([r["part"] == 0 for r in rows], bool))


def features_udf(spark, lexicon: dict[str, float]):
    shared = spark.sparkContext.broadcast(Features(lexicon))  # at most LEXICON words and the fixed list

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series(list(shared.value.matrix(texts.tolist())))

    return features


def score_udf(spark, model):
    shared = spark.sparkContext.broadcast((model, model.features()))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        m, f = shared.value
        return pd.Series(m.scores(f.matrix(texts.tolist())))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, model: ToxicityModel | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    spark = prepare(docs.sparkSession)
    model = model or train(docs, labels)
    mod, rest = HELD_OUT
    return (docs.select("doc_id", (crc_mod(F.col("doc_id"), mod) == rest).alias("held_out"),
                        score_udf(spark, model)("text").alias("score"))
                .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op5_toxicity(spark, sf_dir):
    return toxicity(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
