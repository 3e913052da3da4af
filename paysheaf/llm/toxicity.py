"""Toxicity: a character n-gram linear classifier with features scaled by naive Bayes log-count ratios.

N-grams do not cross word borders. Those that fewer than ``LEAST_ROWS`` training rows hold, or that toxic and
other rows hold about equally often, get no weight. Each other feature (hashed, present or not) is multiplied by the log ratio of its smoothed
frequency in toxic and in other texts; a logistic regression with L2 penalty is fitted on the scaled
features. The penalty and the intercept come from training rows that a fit has not seen (``FOLDS`` parts in
turn): the cut lets ``FALSE_RATE`` of the unseen rows without the label pass for toxic. Training uses at most ``TRAIN_ROWS`` labelled rows, chosen by the hash of their id; scoring
reads every whole text.

Defined results: a null or empty text has no features and gets the score of the intercept;
without labelled rows, or with one class only, every text gets the smoothed rate of the label (below
0.5 without rows); null ids and repeated rows are scored like others; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textfeat import Rows, adam, char_ngrams, fitted, held_out, scored, sigmoid, training_rows

#: Labelled rows that the model is fitted on, at most.
TRAIN_ROWS = 6000
SIZES = (4, 5, 6)
BITS = 18
STEPS = 40
#: Training rows that hold an n-gram, at least, and standard deviations between its count in toxic rows and chance.
LEAST_ROWS, LEAST_DEVIATION = 4, 3
PENALTIES = (1e-5, 1e-4)
FOLDS = 5
FALSE_RATE = 0.005
#: Rows of each class without which nothing is held back.
LEAST_OF_CLASS = 25


def features(text: str | None) -> np.ndarray:
    return char_ngrams(text, SIZES, BITS, words=True)


def telling(y: np.ndarray, x: Rows) -> np.ndarray:
    """The features that enough rows hold, and toxic rows more or less often than chance."""
    held, toxic, rate = x.by_feature(np.ones(len(y))), x.by_feature(y), y.mean()
    deviation = np.abs(toxic - held * rate) / np.sqrt(held * rate * (1 - rate) + 1)
    return (held >= LEAST_ROWS) & (deviation >= LEAST_DEVIATION)


def fit(y: np.ndarray, rows: list[np.ndarray]) -> list[np.ndarray]:
    """Weights by feature (regression weight times log-count ratio) and the intercept, moved to the cut."""
    y = y.astype(np.float64)
    if min(y.sum(), (1 - y).sum()) < LEAST_OF_CLASS:
        return regression(y, rows, PENALTIES[0])
    # Equal texts fall into the same part.
    part = np.array([zlib.crc32(r.tobytes()) % FOLDS for r in rows])
    best = (-1.0, 0.0, PENALTIES[0])
    for penalty in PENALTIES:
        z = np.zeros(len(y))
        for k in range(FOLDS):
            weight, bias = regression(y[part != k], [r for r, p in zip(rows, part) if p != k], penalty)
            for i in np.flatnonzero(part == k):
                z[i] = weight[rows[i]].sum() / np.sqrt(max(len(rows[i]), 1)) + bias[0]
        other = np.sort(z[y == 0])[::-1]
        edge = other[int(FALSE_RATE * len(other))]
        over = z[z > edge]
        cut = (edge + over.min()) / 2 if len(over) else edge + 1e-6
        best = max(best, ((z[y == 1] >= cut).mean(), -cut, penalty), key=lambda b: b[0])
    weight, bias = regression(y, rows, best[2])
    return [weight, bias + best[1]]


def regression(y: np.ndarray, rows: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    size = 1 << BITS
    prior = (y.sum() + 0.5) / (len(y) + 2.0)
    bias = np.array([np.log(prior / (1 - prior))])
    if len(set(y.tolist())) < 2:
        return [np.zeros(size), bias]
    x = Rows(rows, size)
    toxic, other = x.by_feature(y) + 1, x.by_feature(1 - y) + 1
    kept = telling(y, x)
    ratio = (np.log(toxic / (y.sum() + 2)) - np.log(other / ((1 - y).sum() + 2))) * kept
    used = kept[x.index]
    x.index, x.row = x.index[used], x.row[used]
    weight = np.zeros(size)

    def gradient(p: list[np.ndarray]) -> list[np.ndarray]:
        miss = (sigmoid(x.dot(p[0] * ratio) + p[1]) - y) / len(y)
        return [x.by_feature(miss * x.scale) * ratio + penalty * p[0], np.array([miss.sum()])]

    adam([weight, bias], gradient, STEPS, 0.3)
    return [weight * ratio, bias]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", rows: int = TRAIN_ROWS) -> list[np.ndarray]:
    sample = training_rows(docs, labels, F.col(label_col), rows, id_col, text_col, features)
    return fitted(sample, fit, rows)


def score(docs: DataFrame, model: list[np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), float(model[1][0])))

    def one(text: str | None) -> tuple[float]:
        weight, bias = shared.value
        f = features(text)
        return (float(sigmoid(weight[f].sum(dtype=np.float64) / np.sqrt(max(len(f), 1)) + bias)),)

    out = scored(docs, id_col, text_col, ["score"], one)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: list[np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), float(model[1][0])))
    schema = docs.schema

    def run(batches):
        import pyarrow as pa

        weight, bias = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [features(t) for t in part.column(text_col).to_pylist()]
                z = [weight[f].sum(dtype=np.float64) / np.sqrt(max(len(f), 1)) + bias for f in found]
                yield part.filter(pa.array([float(sigmoid(v)) < 0.5 for v in z], pa.bool_()))

    return docs.mapInArrow(run, schema)
