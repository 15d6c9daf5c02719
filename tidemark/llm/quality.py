"""Text quality from positive-unlabelled learning.

Trusted positives are the texts labelled good; everything else the model sees is unlabelled web text. An additive model over
binned surface features minimises the non-negative unbiased risk

    prior * E_positive[loss(+)] + max(0, E_unlabelled[loss(-)] - prior * E_positive[loss(-)])

and the class prior is estimated beforehand as the smallest ratio of unlabelled to positive mass above a threshold of a
positive-against-unlabelled model on held-back rows, with a confidence margin (best-bin estimation). Labels of bad texts are
never used.

Defined results: null and empty texts have a bin of their own and are scored by it; a text is read whole; repeated rows are
scored alike; without positives every score is 0.5 and nothing is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import labelled, texts_of, unlabelled
from .workspace import fresh

SYMBOLS = re.compile(r"[^\w\s]+")
PLAIN = re.compile(r"[\w\s.,;:'\"()?-]+")
TAILS = re.compile(r"[^\w\s]{2,}(?!\S)")
DIGITS = re.compile(r"\d")
BINS = 16


def features(text: str | None) -> tuple[float, ...]:
    """Surface measures of one text; all zero for an empty one."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * 12
    size = sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    return (
        float(np.log(n + 1)),
        size / n,
        sum(map(len, SYMBOLS.findall(text))) / size,
        (len(text) - sum(map(len, PLAIN.findall(text)))) / size,
        len(TAILS.findall(text)) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(str.istitle, words)) / n,
        len(DIGITS.findall(text)) / (size + 100),  # a number or a doubled word in a short text is no sign yet
        sum(map(eq, words, words[1:])) / (n + 20),
        len(set(words)) / n ** 0.8,
        len(set(lines)) / len(lines),
        sum(len(w) == 1 and not w.isalnum() for w in words) / n,
    )


class QualityModel:
    """An additive score over bins of the features."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, intercept: float, prior: float) -> None:
        self.edges, self.weights, self.intercept, self.prior = edges, weights, intercept, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[_columns(x, self.edges)].sum(axis=1) + self.intercept, -30, 30)))


def _edges(x: np.ndarray) -> list[np.ndarray]:
    """Quantiles of each feature, after zero as a bin of its own."""
    out = []
    for k in range(x.shape[1]):
        own = x[:, k][x[:, k] > 0]
        out.append(np.unique(np.concatenate([[1e-12], np.quantile(own, np.linspace(0.05, 0.95, BINS - 2)) if len(own) else []])))
    return out


def _columns(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], side="right") + k * BINS for k, e in enumerate(edges)], axis=1)


def _descend(pos: np.ndarray, unl: np.ndarray, size: int, prior: float | None, steps: int = 300, rate: float = 0.05, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk; with no prior, on plain logistic loss of positive against unlabelled."""
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        zp, zu = w[pos].sum(axis=1) + b, w[unl].sum(axis=1) + b
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        if prior is None:
            gp, gu = (sp - 1) / len(zp), su / len(zu)
        else:  # sigmoid loss: bounded, so confident positives can't outweigh the rest
            dp, du = sp * (1 - sp) / len(zp), su * (1 - su) / len(zu)
            if su.mean() - prior * sp.mean() >= 0:
                gp, gu = -2 * prior * dp, du
            else:  # the corrected risk has run below zero: undo that part only
                gp, gu = prior * dp, -du
        grad = np.bincount(pos.ravel(), weights=np.repeat(gp, pos.shape[1]), minlength=size) + np.bincount(unl.ravel(), weights=np.repeat(gu, unl.shape[1]), minlength=size)
        grad = np.append(grad + l2 * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def class_prior(pos: np.ndarray, unl: np.ndarray, confidence: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores of rows held back from training."""
    if not len(pos) or not len(unl):
        return 0.5
    at = np.unique(pos)
    above = lambda x: 1 - np.searchsorted(np.sort(x), at, side="left") / len(x)
    p, u = above(pos), above(unl)
    margin = np.sqrt(np.log(4 / confidence) / (2 * len(unl))) + np.sqrt(np.log(4 / confidence) / (2 * len(pos)))
    best = np.argmin((u + margin) / p)
    return float(np.clip(u[best] / p[best], 0.02, 0.98))


def fit(pos: np.ndarray, unl: np.ndarray) -> QualityModel:
    if not len(pos) or not len(unl):
        return QualityModel([np.zeros(0)] * 12, np.zeros(12 * BINS), 0.0, 0.5)
    edges = _edges(np.concatenate([pos, unl]))
    p, u, size = _columns(pos, edges), _columns(unl, edges), len(edges) * BINS
    prior = 0.5
    if len(p) > 1 and len(u) > 1:
        w, b = _descend(p[::2], u[::2], size, None, steps=150)
        prior = class_prior(w[p[1::2]].sum(axis=1) + b, w[u[1::2]].sum(axis=1) + b)
    return QualityModel(edges, *_descend(p, u, size, prior), prior)


def train(documents: DataFrame, labels: DataFrame, learn: Column, target: str = "quality", positive_rows: int = 8_000, unlabelled_rows: int = 8_000) -> QualityModel:
    """Fit on bounded samples; only their measures reach the driver."""
    positive = labelled(labels, target, learn, positive_rows, least=0.5).select("doc_id").withColumn("kind", F.lit(1))
    chosen = positive.unionByName(unlabelled(documents, unlabelled_rows).withColumn("kind", F.lit(0)))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "kind": b["kind"], "x": [list(features(t)) for t in b["text"]]})

    rows = texts_of(documents, chosen).mapInPandas(measure, "doc_id long, kind int, x array<double>").toPandas().sort_values(["kind", "doc_id"], kind="stable")
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), 12)
    good = rows["kind"].to_numpy() == 1
    return fit(x[good], x[~good])


def score_quality(documents: DataFrame, model: QualityModel, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """documents with the columns score and predicted, which replace columns of the same names. No shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(np.array([features(t) for t in texts], dtype=float).reshape(len(texts), 12)), index=texts.index)

    return documents.withColumn(score, F.pandas_udf(scores, "double")("text")).withColumn(predicted, (F.col(score) >= 0.5).cast("int"))


def accepted(documents: DataFrame, model: QualityModel) -> DataFrame:
    """The documents that the model does not reject, with their own columns only."""
    score, predicted = fresh(documents, "_score"), fresh(documents, "_predicted")
    return score_quality(documents, model, score, predicted).where(F.col(predicted) == 1).drop(score, predicted)
