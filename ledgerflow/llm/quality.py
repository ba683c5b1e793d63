"""Quality classifier: a support vector machine on naive-Bayes-scaled n-gram indicators.

Features of a text are indicators - present or not - of hashed byte trigrams (spelling,
case, symbols, separators) and of four-grams of the sequence "this word repeats the one
before". Each indicator is scaled by the log ratio of its smoothed share among good and
among bad texts; the scaled vector, divided by the root of its number of features, goes to
a linear hinge-loss model that is fitted by dual coordinate descent. The final weights lie
between the fitted weights and their mean size (``BLEND``). A logistic scale and offset
turn margins into scores.

The model is fitted on at most about ``SAMPLE`` labelled texts per class, chosen by a hash
of the id; whole texts are read and scored, and nothing but the text enters a score.

Defined results: NULL counts as empty, and an empty text gets the score of a text without
features; rows that repeat an id are scored each; ids labelled both ways teach nothing;
with labels of one class only, every score is that class (0 or 1), with none it is 1; an
empty table gives an empty result; other columns are kept or ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerflow.llm.logistic import scale_and_offset
from ledgerflow.llm.sampling import fold, sample_per_class

BITS = 18
DIMS = (1 << BITS) + 16  # byte trigrams, then four-grams of repeats
SAMPLE = 2000  # labelled texts per class that the model is fitted on
SMOOTH = 1.0
COST = 1.0
BLEND = 0.75
EPOCHS = 30
_AT_ONCE = 1 << 20


def features(text: str | None) -> np.ndarray:
    """Sorted numbers of the features that a text has."""
    raw = (text or "").encode("utf-8", "replace")
    seen = []
    for at in range(0, len(raw), _AT_ONCE):
        b = np.frombuffer(raw[at:at + _AT_ONCE + 2], np.uint8).astype(np.uint32)
        if len(b) >= 3:
            h = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(0x9E3779B1)
            seen.append(np.unique(h >> np.uint32(32 - BITS)))
    words = raw.split()
    if len(words) >= 5:
        same = np.fromiter(map(bytes.__eq__, words, words[1:]), np.uint8, len(words) - 1).astype(np.uint32)
        four = same[:-3] << 3 | same[1:-2] << 2 | same[2:-1] << 1 | same[3:]
        seen.append(np.unique(four) + np.uint32(1 << BITS))
    return np.unique(np.concatenate(seen)).astype(np.int64) if seen else np.zeros(0, np.int64)


class Model:
    """Feature weights with the class ratios folded in, offset, and the logistic map."""

    def __init__(self, weights: np.ndarray, bias: float, scale: float, offset: float):
        self.weights, self.bias, self.scale, self.offset = weights.astype(np.float32), bias, scale, offset

    def margin(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum(dtype=np.float64)) / np.sqrt(max(1, len(found))) + self.bias

    def score(self, text: str | None) -> float:
        z = self.scale * self.margin(features(text)) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    """Log ratio of each feature's smoothed share among the good and the bad texts."""
    total = {s: np.full(DIMS, smooth) for s in (1, -1)}
    for found, s in zip(rows, y):
        total[int(s)][found] += 1
    return np.log(total[1] / total[1].sum()) - np.log(total[-1] / total[-1].sum())


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray,
                 epochs: int = EPOCHS, seed: int = 0, tol: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 plus cost times the hinge losses.

    One dual variable per text, between 0 and its cost, is set to its best value in turn;
    the bias is the weight of a constant feature."""
    w, bias, rng = np.zeros(DIMS), 0.0, np.random.default_rng(seed)
    alpha = np.zeros(len(y))
    square = np.array([v @ v + 1.0 for _, v in rows])
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)):
            at, v = rows[i]
            gradient = y[i] * (w[at] @ v + bias) - 1.0
            wanted = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if (change := wanted - alpha[i]) != 0.0:
                worst = max(worst, abs(change))
                alpha[i] = wanted
                w[at] += change * y[i] * v
                bias += change * y[i]
        if worst < tol:
            break
    return w, bias


def fit_rows(rows: list[np.ndarray], y: np.ndarray) -> Model:
    """``y``: 1 for good and -1 for bad texts."""
    if len(set(y.tolist())) < 2:
        only = 1.0 if not len(y) or y[0] > 0 else -1.0
        return Model(np.zeros(DIMS), 0.0, 0.0, 500.0 * only)
    ratio = ratios(rows, y)
    scaled = [(at, ratio[at] / np.sqrt(max(1, len(at)))) for at in rows]
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    w, bias = dual_descent(scaled, y, COST * 0.5 / share)
    w = BLEND * w + (1 - BLEND) * np.abs(w).mean()
    model = Model(w * ratio, bias, 1.0, 0.0)
    margins = np.array([model.margin(at) for at in rows])
    model.scale, model.offset = scale_and_offset(margins, (y > 0).astype(float))
    return model


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
        label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from labelled ids outside the held-out fold (:func:`held_out`)."""
    known = labels.select(labels[key].alias("id"), labels[label].alias("label")).where("label is not null")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(
        F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    chosen = sample_per_class(known, "label", "id", sample)  # a few thousand rows

    @pandas_udf("array<int>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).astype(np.int32) for t in texts])

    rows = docs.select(docs[key].alias("doc"), docs[text].alias("text")).join(
        F.broadcast(chosen), F.col("doc") == F.col("id")).select("id", "label", found("text").alias("found"))
    seen = sorted(rows.collect(), key=lambda r: (r["id"], r["found"] or []))  # the bounded sample
    return fit_rows([np.array(r["found"], np.int64) for r in seen],
                    np.array([1 if r["label"] == 1 else -1 for r in seen]))


def held_out(key: Column) -> Column:
    """The third of all ids whose labels never teach."""
    return fold(key, 3) == 1


def score(model: Model, text: Column) -> Column:
    """The quality score of a text column, between 0 and 1."""

    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return scored(text)
