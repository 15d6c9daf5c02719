"""Toxicity scores from a counterfactually regularised classifier.

The model is a sparse logistic regression on the distinct words of a text and on how often its words begin alike (stems of
four to seven letters, as a share of all words). Besides the labels it is shown, for every training
text that names a group of people, the same text with that name swapped for another of its kind; the squared change of the
score is penalised. A group's name alone therefore moves no score, so neutral mentions stay clean. Names begin no stem, so
that the name's word is all that a swap changes, however often it stands in the text.

Defined results: null and empty texts are scored as texts without words (the intercept); a text is read whole; repeated rows
are scored alike, one by one; without any usable label, or with one class only, every score is the smoothed share of label 1;
score and predicted replace columns of the same names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import exp

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import labelled, texts_of
from .workspace import Workspace

# Names of groups of people by kind; each is swapped for others of its kind.
IDENTITY_TERMS = (
    "women men woman man girls boys females males transgender nonbinary".split(),
    "muslim christian jewish hindu buddhist atheist catholic protestant muslims christians jews hindus buddhists atheists catholics".split(),
    "black white asian latino hispanic african european arab native".split(),
    "gay straight lesbian bisexual queer heterosexual homosexual".split(),
    "american mexican chinese indian german french spanish russian british turkish polish italian".split(),
    "old young elderly teenage disabled deaf blind".split(),
)
#: With their plurals by rule.
KINDS = tuple(tuple(dict.fromkeys(x for w in kind for x in ((w,) if w.endswith(("s", "men", "ese", "sh")) else (w, w + "s")))) for kind in IDENTITY_TERMS)
NAMES = frozenset(w for kind in KINDS for w in kind)
WORD = re.compile(r"[^\W\d_]+")


def word_id(word: str) -> int:
    return xxhash.xxh32_intdigest(word)


#: Lengths of the stems; a stem's value reaches 1 when one word in STEM_SHARE begins with it.
STEMS, STEM_SHARE = (4, 5, 6, 7), 50


def stem_lengths(word: str) -> tuple[int, ...]:
    return () if word in NAMES else STEMS[: max(0, len(word) - 3)]


def stem_value(n: int, n_words: int) -> float:
    """The scaled share of the words that begin with a stem; a stem of one word counts by half."""
    return min(1.0, STEM_SHARE * n / n_words) * (1 if n > 1 else 0.5)


def text_features(text: str | None) -> tuple[list[int], list[float]]:
    """Ids and values: 1 for each distinct lower-case word, stem_value for each stem. Training and scoring use the same."""
    words = WORD.findall((text or "").lower())
    counts = Counter(words)
    stems: Counter[str] = Counter()
    for w, n in counts.items():
        for k in stem_lengths(w):
            stems[w[:k]] += n
    return [word_id(w) for w in counts] + [word_id("^" + s) for s in stems], [1.0] * len(counts) + [stem_value(n, len(words)) for n in stems.values()]


#: The model has at most so many words and stems, each seen so often (a stem by the sum of its values).
FEATURES, LEAST_SEEN = 3000, 3


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class ToxicityModel:
    """Weights of word ids and an intercept."""

    def __init__(self, weights: dict[int, float], intercept: float) -> None:
        self.weights, self.intercept = weights, intercept

    def scorer(self):
        """text -> score, for one worker: remembers which weights a word touches, up to a bound."""
        known: dict[str, tuple[float, tuple[tuple[int, float], ...]]] = {}

        def look_up(w: str) -> tuple[float, tuple[tuple[int, float], ...]]:
            stems = ((k, self.weights.get(word_id("^" + w[:k]), 0.0)) for k in stem_lengths(w))
            found = self.weights.get(word_id(w), 0.0), tuple((k, v) for k, v in stems if v)
            if len(known) < 200_000:
                known[w] = found
            return found

        def score(text: str | None) -> float:
            z, words = self.intercept, WORD.findall((text or "").lower())
            stems: dict[str, list[float]] = {}
            for w, n in Counter(words).items():
                own, parts = known.get(w) or look_up(w)
                z += own
                for k, v in parts:
                    stems.setdefault(w[:k], [0, v])[0] += n
            z += sum(v * stem_value(n, len(words)) for n, v in stems.values())
            return 1 / (1 + exp(-min(30.0, max(-30.0, z))))

        return score


def fit(ids: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, features: int = FEATURES, l1: float = 1e-4, positive_weight: float = 4.0, swap_penalty: float = 32.0, steps: int = 500) -> ToxicityModel:
    """Proximal gradient descent on log loss + swap_penalty * mean squared score change + l1 * |w|.

    Rows of label 1 weigh positive_weight times as much: they are few, and one telling word should be enough.
    """
    base = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    start = float(np.log(base / (1 - base)))
    if len(y) == 0 or y.min() == y.max():
        return ToxicityModel({}, start)
    row = np.repeat(np.arange(len(ids)), [len(a) for a in ids])
    words, col = np.unique(np.concatenate(ids), return_inverse=True)
    x = np.concatenate(values).astype(float)
    seen = np.bincount(col, weights=x, minlength=len(words))
    toxic = np.bincount(col, weights=x * y[row], minlength=len(words))
    # Words by how far their share of label 1 lies from the mean, in standard errors.
    strength = np.abs(toxic - base * seen) / np.sqrt(seen * base * (1 - base) + 1)
    strength[seen < LEAST_SEEN] = 0
    kinds = [np.array([word_id(w) for w in kind], dtype=words.dtype) for kind in KINDS]
    names = np.isin(words, np.concatenate(kinds))
    strength[names] = np.inf
    chosen = np.argsort(-strength, kind="stable")[:features]
    chosen = chosen[strength[chosen] > 2]
    place = np.full(len(words), -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[col] >= 0
    row, col, x = row[keep], place[col[keep]], x[keep]
    n, d = len(ids), len(chosen)
    # Two swaps for each (text, name): to the next name of its kind that the corpus knows, and to one that it doesn't know,
    # which has no weight. A text that holds the other name already only loses its own.
    at = {int(w): int(place[k]) for k, w in enumerate(words) if names[k] and place[k] >= 0}
    other = {}
    for kind in kinds:
        own = [at[int(w)] for w in kind if int(w) in at]
        other |= {a: (own[(k + 1) % len(own)] if len(own) > 1 else -1) for k, a in enumerate(own)}
    named = {(r, c) for r, c in zip(row.tolist(), col.tolist(), strict=True) if c in other}
    pairs = [(r, c, to) for r, c in sorted(named) for to in (-1 if (r, other[c]) in named else other[c], -1)]
    swap_row, out, into = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 3
    w, b, v, c = np.zeros(d), start, np.zeros(d), start
    # The step is bounded by the largest eigenvalue of X'X / 4n, found by a few power iterations, and the penalty's curvature.
    probe = np.ones(d + 1)
    for _ in range(8):
        z = np.bincount(row, weights=x * probe[col], minlength=n) + probe[d]
        probe = np.append(np.bincount(col, weights=x * z[row], minlength=d), z.sum())
        norm = np.linalg.norm(probe)
        probe /= norm or 1
    rate, t = 1 / (max(1.0, positive_weight) * norm / (4 * n) * 1.3 + (swap_penalty * 2 if len(swap_row) else 0) + 1e-9), 1.0
    for _ in range(steps):
        z = np.bincount(row, weights=x * v[col], minlength=n) + c
        p = _sigmoid(z)
        error = (p - y) * np.where(y > 0, positive_weight, 1.0) / n
        grad, grad_b = np.bincount(col, weights=x * error[row], minlength=d), error.sum()
        if len(swap_row):
            change = np.where(into >= 0, v[into], 0.0) - v[out]
            q0, q1 = p[swap_row], _sigmoid(z[swap_row] + change)
            gap = 2 * swap_penalty * (q1 - q0) / len(swap_row)
            d0, d1 = gap * q0 * (1 - q0), gap * q1 * (1 - q1)
            both = np.bincount(swap_row, weights=d1 - d0, minlength=n)
            grad += np.bincount(col, weights=x * both[row], minlength=d)
            grad_b += both.sum()
            grad -= np.bincount(out, weights=d1, minlength=d)
            grad += np.bincount(into[into >= 0], weights=d1[into >= 0], minlength=d)
        new = v - rate * grad
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        new_b = c - rate * grad_b
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, c = new + (last - 1) / t * (new - w), new_b + (last - 1) / t * (new_b - b)
        w, b = new, new_b
    return ToxicityModel({int(words[chosen[k]]): float(w[k]) for k in np.flatnonzero(w)}, float(b))


def _telling(rows: DataFrame, base: float, most: int) -> set[int]:
    """Ids of the names and of the most words and stems by strength. Summed on the executors, so all stems can take part."""

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list[float]] = {}

        def part() -> pd.DataFrame:
            return pd.DataFrame({"id": list(sums), "seen": [a for a, _ in sums.values()], "toxic": [b for _, b in sums.values()]})

        for b in batches:
            for text, y in zip(b["text"], b["y"], strict=True):
                for i, v in zip(*text_features(text), strict=True):
                    own = sums.setdefault(i, [0.0, 0.0])
                    own[0] += v
                    own[1] += v if y >= 0.5 else 0.0
                if len(sums) > 500_000:
                    yield part()
                    sums.clear()
        yield part()

    sums = rows.select("text", "y").mapInPandas(total, "id long, seen double, toxic double").groupBy("id").agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic"))
    strength = F.abs(F.col("toxic") - base * F.col("seen")) / F.sqrt(F.col("seen") * (base * (1 - base)) + 1)
    best = sums.where(F.col("seen") > LEAST_SEEN - 0.01).orderBy(strength.desc(), "id").limit(most).select("id").collect()
    return {r["id"] for r in best} | {word_id(w) for w in NAMES}


def train(documents: DataFrame, labels: DataFrame, learn: Column, target: str = "toxic", training_rows: int = 12_000) -> ToxicityModel:
    """Fit on at most training_rows labelled documents for which learn holds. Only ids of telling words reach the driver."""
    spark = documents.sparkSession
    chosen = texts_of(documents, labelled(labels, target, learn, training_rows)).select("doc_id", "y", "text")
    work = Workspace(spark, "toxicity")
    chosen = work.stage(chosen.dropDuplicates(), "chosen")
    whole = chosen.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("y") >= 0.5).cast("long")).alias("toxic")).first()
    base = ((whole["toxic"] or 0) + 0.5) / (whole["n"] + 1)
    telling = spark.sparkContext.broadcast(_telling(chosen, base, FEATURES + FEATURES // 4))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            both = [[(i, v) for i, v in zip(*text_features(t), strict=True) if i in telling.value] for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "ids": [np.array([i for i, _ in r], dtype=np.uint32).tobytes() for r in both], "x": [np.array([v for _, v in r], dtype=np.float32).tobytes() for r in both]})

    rows = chosen.mapInPandas(measure, "doc_id long, y double, ids binary, x binary").toPandas().sort_values(["doc_id", "ids", "x", "y"], kind="stable")
    work.drop()
    return fit([np.frombuffer(i, dtype=np.uint32) for i in rows["ids"]], [np.frombuffer(v, dtype=np.float32) for v in rows["x"]], (rows["y"] >= 0.5).to_numpy(float))


def score_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """documents with the columns score and predicted. No shuffle; the model goes out once per executor."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = shared.value.scorer()
        for texts in batches:
            yield texts.map(score, na_action=None).astype(float)

    return documents.withColumn("score", F.pandas_udf(scores, "double")("text")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
