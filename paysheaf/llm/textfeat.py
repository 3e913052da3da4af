"""Hashed character n-gram features and linear training shared by the classifiers (numpy inside tasks)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIX = np.uint64(0x9E3779B97F4A7C15)

#: Characters hashed at once; longer texts are taken in overlapping blocks, to their end.
BLOCK = 1 << 20

FEATURES = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("features", T.ArrayType(T.IntegerType()))])


@lru_cache(maxsize=1)
def _word_characters() -> np.ndarray:
    """By code point: letter or digit."""
    return np.array([chr(k).isalnum() for k in range(0x110000)])


def _ngrams(c: np.ndarray, sizes: tuple[int, ...], bits: int, gaps: np.ndarray | None = None) -> np.ndarray:
    out = [np.empty(0, np.int32)]
    for n in sizes:
        if len(c) >= n:
            h = np.full(len(c) - n + 1, np.uint64(n))
            for k in range(n):
                h = (h ^ c[k:len(c) - n + 1 + k]) * MIX
                h ^= h >> np.uint64(32)
            if gaps is not None:
                inside = np.zeros(len(h), bool)
                for k in range(1, n - 1):
                    inside |= gaps[k:len(c) - n + 1 + k]
                h = h[~inside]
            out.append((h >> np.uint64(64 - bits)).astype(np.int32))
    return np.unique(np.concatenate(out))


def char_ngrams(text: str | None, sizes: tuple[int, ...], bits: int, lower: bool = True, words: bool = False) -> np.ndarray:
    """Sorted distinct buckets of the character n-grams of the whole text, with a blank before and after it.

    With ``words``, all but letters and digits counts as a blank, and an n-gram has blanks at its ends only.
    """
    t = f" {text or ''} "
    c = np.frombuffer((t.lower() if lower else t).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    gaps = ~_word_characters()[c] if words else None
    c = np.where(gaps, np.uint32(32), c) if words else c
    step, overlap = BLOCK, max(sizes) - 1
    blocks = [_ngrams(c[lo:lo + step + overlap].astype(np.uint64), sizes, bits, gaps[lo:lo + step + overlap] if words else None)
              for lo in range(0, len(c), step)]
    return blocks[0] if len(blocks) == 1 else np.unique(np.concatenate(blocks))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Rows:
    """Binary sparse rows; each row's values are divided by the root of its number of features."""

    def __init__(self, features: list[np.ndarray], size: int) -> None:
        lengths = np.array([len(f) for f in features], dtype=np.int64)
        self.n, self.size = len(features), size
        self.index = np.concatenate([*features, np.empty(0, np.int32)]).astype(np.int64)
        self.row = np.repeat(np.arange(self.n), lengths)
        self.scale = 1.0 / np.sqrt(np.maximum(lengths, 1))

    def by_feature(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, weights=per_row[self.row], minlength=self.size)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.index], minlength=self.n) * self.scale


def adam(params: list[np.ndarray], gradient: Callable[[list[np.ndarray]], list[np.ndarray]], steps: int, rate: float) -> None:
    """Full-batch steps, in place; the same rows in the same order give the same parameters."""
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        for p, g, a, b in zip(params, gradient(params), m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate / (1 + t / 20) * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.99 ** t)) + 1e-8)


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text (null: empty), modulo 5, is 0."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, y: Column, rows: int, id_col: str, text_col: str,
                  features: Callable[[str | None], np.ndarray]) -> DataFrame:
    """y and features of at most ``rows`` labelled documents outside the held-out fifth, in hash order of the id.

    The ids are chosen from the narrow table of labels first; that choice, of a known size, is broadcast.
    A document labelled twice counts with its largest label; labels that are null are left out.
    """
    chosen = (labels.select(F.col(id_col).alias("label_id"), y.cast("int").alias("y"))
              .filter(F.col("y").isNotNull() & F.col("label_id").isNotNull() & ~held_out(F.col("label_id")))
              .groupBy("label_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("label_id"), "label_id").limit(rows))
    texts = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text"))
    picked = texts.join(F.broadcast(chosen), "label_id").select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [features(t) for t in part.column("text").to_pylist()]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), pa.ListArray.from_arrays(ends, np.concatenate([*found, np.empty(0, np.int32)]))],
                    names=["y", "features"])

    return picked.mapInArrow(run, FEATURES)


def fitted(rows: DataFrame, fit: Callable[[np.ndarray, list[np.ndarray]], list[np.ndarray]], most: int) -> list[np.ndarray]:
    """Run ``fit`` in one task on the bounded training rows and return its arrays (of fixed sizes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, features = [], []
        for batch in batches:
            y.append(batch.column("y").to_numpy(zero_copy_only=False))
            column = batch.column("features")
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
            features += [flat[a:b].copy() for a, b in zip(ends, ends[1:])]
        # A fixed order, so that sums of floats, and the rows beyond ``most`` where ids repeat, are the same in every run.
        y_all = np.concatenate([*y, np.empty(0, np.int32)])
        order = sorted(range(len(y_all)), key=lambda i: (features[i].tobytes(), y_all[i]))[:most]
        arrays = fit(y_all[order], [features[i] for i in order])
        yield pa.RecordBatch.from_arrays([pa.array([np.asarray(a, np.float64).tobytes() for a in arrays], pa.binary())], names=["weights"])

    model = rows.repartition(1).mapInArrow(run, "weights binary").collect()
    return [np.frombuffer(r[0], np.float64) for r in model]


def scored(docs: DataFrame, id_col: str, text_col: str, columns: list[str],
           score: Callable[[str | None], tuple[float, ...]]) -> DataFrame:
    """id and the double ``columns`` that ``score`` gives for each whole text."""
    schema = T.StructType([docs.schema[id_col], *(T.StructField(c, T.DoubleType(), False) for c in columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                got = np.array([score(t) for t in part.column(text_col).to_pylist()], dtype=np.float64).reshape(-1, len(columns))
                yield pa.RecordBatch.from_arrays([part.column(id_col), *(pa.array(got[:, k].copy()) for k in range(len(columns)))],
                                                 names=[id_col, *columns])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
