"""Quality: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed character n-grams (as written, case kept) is shared by all grades, and
ordered thresholds cut its score into grades: P(grade <= k) = sigmoid(threshold_k - w.x). The expected
grade ranks texts, and the tail probability P(grade >= g) selects them. Training uses at most
``TRAIN_ROWS`` rated rows outside the held-out fifth, chosen by the hash of their id; scoring reads
every whole text.

Defined results: a null or empty text is scored by its blanks; without rated rows, or with one grade
only, all texts get the smoothed grade frequencies; null ids and repeated rows are scored like others;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textfeat import Rows, adam, char_ngrams, fitted, held_out, scored, sigmoid, training_rows

#: Rated rows that the model is fitted on, at most.
TRAIN_ROWS = 6000
SIZES = (3,)
BITS = 17
STEPS = 60


def features(text: str | None) -> np.ndarray:
    return char_ngrams(text, SIZES, BITS, lower=False)


def thresholds(raw: np.ndarray) -> np.ndarray:
    """Ordered by construction: the first, then positive steps."""
    return np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def fit(grades: int):
    def run(y: np.ndarray, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Weights by feature and the thresholds."""
        size = 1 << BITS
        share = np.cumsum(np.bincount(y.astype(np.int64), minlength=grades) + 0.5) / (len(y) + 0.5 * grades)
        start = np.log(share[:-1] / (1 - share[:-1]))
        raw = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
        weight = np.zeros(size)
        if len(set(y.tolist())) < 2:
            return [weight, thresholds(raw)]
        x, y = Rows(rows, size), y.astype(np.int64)
        at = np.arange(len(y))

        def gradient(p: list[np.ndarray]) -> list[np.ndarray]:
            cut = thresholds(p[1])
            below = sigmoid(cut[None, :] - x.dot(p[0])[:, None])
            edge = np.hstack([np.zeros((len(y), 1)), below, np.ones((len(y), 1))])
            slope = edge * (1 - edge)
            likely = np.maximum(edge[at, y + 1] - edge[at, y], 1e-9)
            by_score = (slope[at, y + 1] - slope[at, y]) / likely / len(y)
            by_cut = np.zeros((len(y), grades + 1))
            by_cut[at, y + 1] -= slope[at, y + 1] / likely / len(y)
            by_cut[at, y] += slope[at, y] / likely / len(y)
            total = by_cut[:, 1:-1].sum(axis=0)
            steps = np.cumsum(total[::-1])[::-1]  # a step moves its threshold and all later ones
            return [x.by_feature(by_score * x.scale) + 1e-6 * p[0], np.concatenate([steps[:1], steps[1:] * np.exp(p[1][1:])])]

        adam([weight, raw], gradient, STEPS, 0.3)
        return [weight, thresholds(raw)]

    return run


def train(docs: DataFrame, labels: DataFrame, grade: Column, grades: int, id_col: str = "doc_id",
          text_col: str = "text", rows: int = TRAIN_ROWS) -> list[np.ndarray]:
    """``grade``: a column of ``labels`` from 0 to grades - 1."""
    sample = training_rows(docs, labels, grade, rows, id_col, text_col, features)
    return fitted(sample, fit(grades), rows)


def score(docs: DataFrame, model: list[np.ndarray], at_least: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, expected_grade, tail (probability of a grade of ``at_least`` or more), selected (tail >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    def one(text: str | None) -> tuple[float, float]:
        weight, cut = shared.value
        f = features(text)
        above = 1 - sigmoid(cut - weight[f].sum(dtype=np.float64) / np.sqrt(max(len(f), 1)))
        return float(above.sum()), float(above[at_least - 1])

    out = scored(docs, id_col, text_col, ["expected_grade", "tail"], one)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "expected_grade", "tail", (F.col("tail") >= 0.5).alias("selected"))
