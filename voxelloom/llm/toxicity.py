"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case. The
features of a text are its distinct words, pairs of neighbours and pairs with one or two
words between, hashed to `dims` places. Training visits a bounded sample of labelled rows in
a fixed order; each coordinate has its own rate, and L1 keeps only weights that evidence
supports, so that what is broadcast is a short list.

Defined cases: null and empty texts have no features and get the score of the intercept;
rows without a label, or with a null one, aren't learned from; of several labels of one
doc_id the highest holds, and of several rows of one doc_id the least text is learned from, once;
repeated rows score alike; a very long text is scored whole, and learned from only if the bound
on bytes leaves room; without any usable label every score is 0; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import bounded, labelled
from .textkit import LOWER, NOT_ALNUM, U64, Words, mix, slices


@dataclass(frozen=True)
class Settings:
    """positives, negatives: the most labelled documents of each kind that training reads. train_bytes: the most text."""

    positives: int = 4000
    negatives: int = 8000
    train_bytes: int = 48 << 20
    dims: int = 1 << 20
    skips: tuple[int, ...] = (1, 2, 3)
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.1
    epochs: int = 5


@dataclass(frozen=True)
class Weights:
    places: np.ndarray
    values: np.ndarray
    intercept: float
    dims: int
    skips: tuple[int, ...]

    def dense(self) -> np.ndarray:
        out = np.zeros(self.dims, np.float32)
        out[self.places] = self.values
        return out


def features(words: Words, dims: int, skips: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of each word and each pair of words at the given distances in one row."""
    rows = words.rows()
    places, owners = [words.hash & U64(dims - 1)], [rows]
    for gap in skips:
        if len(rows) > gap:
            same = np.flatnonzero(rows[gap:] == rows[:-gap])
            h = words.hash[same] * U64(0x9E3779B97F4A7C15) + words.hash[same + gap] * U64(2 * gap + 1)
            places.append(mix(h) & U64(dims - 1))
            owners.append(rows[same])
    return np.concatenate(owners), np.concatenate(places).astype(np.int64)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(np.asarray(x) / 2))


def train(rows: list[np.ndarray], labels: np.ndarray, importance: np.ndarray, s: Settings) -> Weights:
    """One pass an epoch over the rows, in the order given."""
    z, n = np.zeros(s.dims), np.zeros(s.dims)
    if not len(rows) or not labels.any() or labels.all():
        return Weights(np.zeros(0, np.int64), np.zeros(0, np.float32), (30.0 if len(rows) and labels.all() else -1000.0), s.dims, s.skips)
    rate = float(np.average(labels, weights=importance))
    b, nb = float(np.log(rate / (1 - rate))), 1.0
    for _ in range(s.epochs):
        for at, y, v in zip(rows, labels, importance, strict=True):
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) > s.l1, (np.sign(zi) * s.l1 - zi) / ((s.beta + root) / s.alpha + s.l2), 0.0)
            g = float(sigmoid(w.sum() + b) - y) * v
            z[at] = zi + g - (np.sqrt(ni + g * g) - root) / s.alpha * w
            n[at] = ni + g * g
            nb += g * g
            b -= s.alpha * g / np.sqrt(nb)
    w = np.where(np.abs(z) > s.l1, (np.sign(z) * s.l1 - z) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2), 0.0)
    places = np.flatnonzero(w)
    return Weights(places, w[places].astype(np.float32), b, s.dims, s.skips)


def _sample(docs: DataFrame, labels: DataFrame, learn: Column, s: Settings) -> tuple[DataFrame, int, int]:
    """Text and label of at most the set number of labelled documents of each kind, and how many there are of each."""
    known = labelled(docs, labels, "toxic", "max", learn)
    counts = {r[0]: r[1] for r in known.groupBy("y").count().collect()}  # a row a label
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.filter("y = 1").orderBy(*order).limit(s.positives).union(known.filter("y = 0").orderBy(*order).limit(s.negatives))
    return bounded(docs, picked, s.train_bytes), counts.get(1, 0), counts.get(0, 0)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, s: Settings = Settings()) -> Weights:
    """Weights from the labelled documents that `learn`, a condition on doc_id, lets through."""
    sample, ones, zeros = _sample(docs, labels, learn, s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            owner, place = features(Words(data, offsets, NOT_ALNUM, LOWER), s.dims, s.skips)
            both = np.unique(owner << 32 | place)
            first = np.searchsorted(both >> 32, np.arange(rows.num_rows + 1)).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(first), pa.array((both & 0xFFFFFFFF).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), places], names=["doc_id", "toxic", "places"])

    found = sample.select("doc_id", "text", F.col("y").alias("toxic")).mapInArrow(run, "doc_id long, toxic int, places array<int>").toArrow()
    ids = found["doc_id"].to_numpy()
    order = np.lexsort((ids, mix(ids.astype(U64))))
    rows = []
    for part in found["places"].chunks:  # views, so that the features are held once
        at, ends = part.values.to_numpy(), part.offsets.to_numpy()
        rows += [at[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    rows = [rows[i] for i in order]
    y = found["toxic"].to_numpy().astype(float)[order]
    n1, n0 = max(1, int(y.sum())), max(1, int(len(y) - y.sum()))
    importance = np.where(y == 1, max(1, ones) / n1, max(1, zeros) / n0)
    return train(rows, y, importance * (len(y) / max(1.0, importance.sum())), s)


def scores(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, w: Weights) -> np.ndarray:
    owner, place = features(Words(data, offsets, NOT_ALNUM, LOWER), w.dims, w.skips)
    heard = np.flatnonzero(table[place])  # most places have no weight
    both = np.unique(owner[heard] << 32 | place[heard])
    total = np.bincount(both >> 32, weights=table[both & 0xFFFFFFFF], minlength=len(offsets) - 1)
    return sigmoid(total + w.intercept)


def score(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id and score of each document."""
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        table = w.dense()
        for rows, data, offsets in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores(data, offsets, table, w))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, weights: Weights, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with all their columns; no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        table = w.dense()
        for rows, data, offsets in slices(batches, "text"):
            yield rows.filter(pa.array(scores(data, offsets, table, w) < threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out() -> Column:
    """Rows that the contract keeps from learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
