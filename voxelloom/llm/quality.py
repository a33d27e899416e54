"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = logistic(threshold_k - w.x): one vector of weights over hashed text features
is shared by all grades, and the thresholds are kept in order by learning their gaps. The
expected grade and the probability of a grade of at least `cut` serve for selection.

Features of a text, hashed to `dims` places and scaled to unit length: its words in lower
case, the shapes of its words (letters, capitals, digits and marks with runs collapsed), and
how often a word repeats the one before it.

Defined cases: null and empty texts have no features and score as the thresholds alone say;
rows without a grade aren't learned from; of several grades of one doc_id the lowest holds, and
of several rows of one doc_id the least text is learned from, once; repeated rows are rated
alike; a very long text is rated whole, and learned from only if the bound on bytes leaves
room; texts tie where their features do; with fewer than two grades every text gets the one
there is (0 if none); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import bounded, labelled
from .textkit import AS_IS, LOWER, SPACE, U64, Words, mix, slices


@dataclass(frozen=True)
class Settings:
    """train_rows: the most rated documents that training reads. train_bytes: the most text."""

    train_rows: int = 8000
    train_bytes: int = 32 << 20
    dims: int = 1 << 16
    epochs: int = 12
    batch: int = 64
    rate: float = 0.3
    l2: float = 1e-5


@dataclass(frozen=True)
class Model:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray


_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x61:0x7B] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x30:0x3A] = ord("0")


def features(data: np.ndarray, offsets: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value), sorted by row; values of a row have unit length."""
    words = Words(data, offsets, SPACE, LOWER)
    rows = words.rows()
    shape = _SHAPE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    shapes = Words(shape[keep], np.concatenate([[0], np.cumsum(keep)])[offsets], SPACE, AS_IS)
    again = np.zeros(len(rows), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (rows[1:] == rows[:-1])
    hashes = [words.hash, mix(shapes.hash + U64(1)), np.full(int(again.sum()), 0x5DEECE66D, U64)]
    owner = np.concatenate([rows, shapes.rows(), rows[again]])
    key = owner << 32 | (np.concatenate(hashes) & U64(dims - 1)).astype(np.int64)
    key, n = np.unique(key, return_counts=True)
    row, place = key >> 32, key & 0xFFFFFFFF
    norm = np.bincount(row, weights=n, minlength=len(offsets) - 1)
    return row, place, np.sqrt(n / norm[row])


def _logistic(x):
    return 0.5 * (1 + np.tanh(x / 2))


def train(row: np.ndarray, place: np.ndarray, value: np.ndarray, grade: np.ndarray, s: Settings = Settings(), seed: int = 7) -> Model:
    """Adaptive gradient steps on small batches. grade: the rating of each row."""
    grades = sorted(int(g) for g in np.unique(grade))
    if len(grades) < 2:
        return Model(grades or [0], np.zeros(s.dims, np.float32), np.zeros(0))
    y, cuts = np.searchsorted(grades, grade), len(grades) - 1
    share = np.clip(np.cumsum(np.bincount(y, minlength=len(grades)))[:-1] / len(y), 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    raw = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    w, gw, gr = np.zeros(s.dims), np.full(s.dims, 1e-8), np.full(cuts, 1e-8)
    first = np.searchsorted(row, np.arange(len(y) + 1))
    rng = np.random.default_rng(seed)
    for _ in range(s.epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), s.batch):
            own = order[lo : lo + s.batch]
            at = np.concatenate([np.arange(first[i], first[i + 1]) for i in own])
            local = np.repeat(np.arange(len(own)), first[own + 1] - first[own])
            p, v = place[at], value[at]
            margin = np.bincount(local, weights=v * w[p], minlength=len(own))
            theta = np.concatenate([raw[:1], raw[0] + np.cumsum(np.exp(raw[1:]))])
            c = _logistic(theta[None, :] - margin[:, None])
            full = np.column_stack([np.zeros(len(own)), c, np.ones(len(own))])
            k = y[own]
            i = np.arange(len(own))
            up, down = full[i, k + 1], full[i, k]
            prob = np.maximum(up - down, 1e-9)
            dup, ddown = up * (1 - up) / prob, down * (1 - down) / prob  # the slopes of log P in its two thresholds
            slope = dup - ddown
            g = np.bincount(p, weights=v * slope[local], minlength=s.dims) / len(own) if len(p) > s.dims // 4 else None
            if g is None:
                touched, inverse = np.unique(p, return_inverse=True)
                g = np.bincount(inverse, weights=v * slope[local]) / len(own)
            else:
                touched = np.arange(s.dims)
            g = g + s.l2 * w[touched]
            gw[touched] += g * g
            w[touched] -= s.rate * g / np.sqrt(gw[touched])
            dtheta = np.zeros(cuts)
            np.add.at(dtheta, k[k < cuts], -dup[k < cuts])
            np.add.at(dtheta, k[k > 0] - 1, ddown[k > 0])
            tail = np.cumsum(dtheta[::-1])[::-1]
            draw = np.concatenate([tail[:1], tail[1:] * np.exp(raw[1:])]) / len(own)
            gr += draw * draw
            raw -= s.rate * draw / np.sqrt(gr)
    return Model(grades, w.astype(np.float32), np.concatenate([raw[:1], raw[0] + np.cumsum(np.exp(raw[1:]))]))


def predict(data: np.ndarray, offsets: np.ndarray, model: Model, dims: int, cut: int) -> tuple[np.ndarray, np.ndarray]:
    """(expected grade, probability of a grade of at least `cut`) of each row."""
    n = len(offsets) - 1
    row, place, value = features(data, offsets, dims)
    margin = np.bincount(row, weights=value * model.weights[place], minlength=n)
    below = np.column_stack([np.zeros(n), _logistic(model.thresholds[None, :] - margin[:, None]), np.ones(n)])
    each = np.diff(below, axis=1)
    grades = np.array(model.grades)
    return each @ grades, each[:, grades >= cut].sum(axis=1)


def fit(docs: DataFrame, ratings: DataFrame, learn: Column, s: Settings = Settings(), grade: str = "quality") -> Model:
    """Model from the rated documents that `learn`, a condition on doc_id, lets through; a bounded sample in hash order."""
    known = labelled(docs, ratings, grade, "min", learn)
    sample = bounded(docs, known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.train_rows), s.train_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            row, place, value = features(data, offsets, s.dims)
            first = pa.array(np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.ListArray.from_arrays(first, pa.array(place.astype(np.int32))), pa.ListArray.from_arrays(first, pa.array(value.astype(np.float32)))], names=["doc_id", "grade", "places", "values"])

    found = sample.select("doc_id", "text", F.col("y").alias("grade")).mapInArrow(run, "doc_id long, grade int, places array<int>, values array<float>").toArrow()
    found = found.append_column("o", pa.array(mix(found["doc_id"].to_numpy().astype(U64)))).sort_by([("o", "ascending"), ("doc_id", "ascending")]).combine_chunks()
    if not found.num_rows:
        return Model([0], np.zeros(s.dims, np.float32), np.zeros(0))
    places, values = found["places"].chunk(0), found["values"].chunk(0)
    row = np.repeat(np.arange(found.num_rows), np.diff(places.offsets.to_numpy()))
    return train(row, places.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy().astype(float), found["grade"].to_numpy(), s)


def rate(docs: DataFrame, model: Model, s: Settings = Settings(), cut: int | None = None) -> DataFrame:
    """doc_id, expected_grade and tail_probability (of a grade of at least `cut`; the top grade if None)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    least = max(model.grades) if cut is None else cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for rows, data, offsets in slices(batches, "text"):
            expected, tail = predict(data, offsets, m, s.dims, least)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(expected), pa.array(tail)], names=["doc_id", "expected_grade", "tail_probability"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, expected_grade double, tail_probability double")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
