"""Language identification by mixture inference.

Every word is a draw from one of the learned languages, with the likelihood of its byte
trigrams under that language. Expectation-maximisation estimates the proportions of the
languages in each document; sets of its most probable languages grow one by one, and the
set with the best likelihood, less half the logarithm of the number of words for each
further language, is taken. The prediction is the language of the largest share.

Models are counted over a sample of labelled rows. Each language has the same bound, so
that the expected size is at most `train_docs`, or `least_docs` a language if that is more;
languages below the bound are learned from whole. A table has `dims` numbers for each language and is broadcast.

Defined cases: null text and text without a letter are `und` with score 0, as is every
text if nothing was learned; rows with a null lang aren't learned from; repeated rows are
judged alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import LOWER, slices, table

LETTERS = table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
ASCII_LETTERS = table((0x41, 0x5A), (0x61, 0x7A))


@dataclass(frozen=True)
class Settings:
    train_docs: int = 40_000
    least_docs: int = 200
    dims: int = 1 << 15
    smoothing: float = 0.3
    rounds: int = 10


@dataclass(frozen=True)
class Model:
    names: list[str]
    logs: np.ndarray


def trigrams(data: np.ndarray, offsets: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each trigram, first trigram of each word, first word of each row); words are runs of letters."""
    n = len(data)
    inside = LETTERS[data]
    at = np.flatnonzero(inside)
    now = np.where(inside, LOWER[data], 32).astype(np.uint32)
    before, after = np.full(n, 32, np.uint32), np.full(n, 32, np.uint32)
    before[1:], after[:-1] = now[:-1], now[1:]
    if n:
        before[offsets[:-1][offsets[:-1] < n]] = 32
        ends = offsets[1:] - 1
        after[ends[ends >= 0]] = 32
    code = (before[at] << np.uint32(16)) | (now[at] << np.uint32(8)) | after[at]
    place = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - (dims.bit_length() - 1))
    start = np.flatnonzero(before[at] == 32)
    return place, start, np.searchsorted(at[start], offsets)


def _bound(sizes: list[int], s: Settings) -> float:
    """The bound of each language at which all take `train_docs`, from their ascending sizes."""
    rest = s.train_docs
    for k, n in enumerate(sizes):
        if n * (len(sizes) - k) > rest:
            return max(rest / (len(sizes) - k), s.least_docs)
        rest -= n
    return s.train_docs


def fit(docs: DataFrame, learn: Column, s: Settings = Settings()) -> Model:
    """Trigram models of each lang from the documents that `learn`, a condition on doc_id, lets through."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").filter(learn).filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row a language
    bound = _bound(sorted(sizes.values()), s)
    rates = [(lang, int(bound / n * (1 << 53))) for lang, n in sizes.items() if n > bound]
    part = known
    if rates:
        told = docs.sparkSession.createDataFrame(rates, "lang string, rate long")
        part = known.join(F.broadcast(told), "lang", "left").filter(F.col("rate").isNull() | (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 53)) < F.col("rate")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for rows, data, offsets in slices(batches, "text"):
            place, start, first = trigrams(data, offsets, s.dims)
            bound = np.append(start, len(place))[first]
            for i, lang in enumerate(rows.column(0).to_pylist()):
                own = counts.setdefault(lang, np.zeros(s.dims, np.int64))
                own += np.bincount(place[bound[i] : bound[i + 1]], minlength=s.dims)
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], names=["lang", "place", "n"])

    found = part.select("lang", "text").mapInArrow(run, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()  # at most dims rows a language
    names = sorted(found.lang.unique())
    counts = np.full((s.dims, len(names)), s.smoothing)
    if names:
        counts[found.place.to_numpy(), np.searchsorted(names, found.lang.to_numpy(str))] += found.n.to_numpy()
    return Model(names, np.log(counts / counts.sum(axis=0)).astype(np.float32) if names else counts)


def _mixture(p: np.ndarray, top: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages in each row, and the log likelihood. p, top: word likelihoods over their maximum, and its log."""
    sizes = np.diff(first)
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    for k in range(rounds + 1):
        joint = p * np.repeat(shares, sizes, axis=0)
        total = joint.sum(axis=1)
        np.maximum(total, 1e-30, out=total)
        if k == rounds:
            break
        joint /= total[:, None]
        shares = np.add.reduceat(joint, first[:-1], axis=0) / sizes[:, None]
    return shares, np.add.reduceat(np.log(total) + top, first[:-1])


def infer(data: np.ndarray, offsets: np.ndarray, model: Model, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(shares, rows with words): the shares of the selected languages of each row that has words."""
    place, start, first = trigrams(data, offsets, s.dims)
    rows = np.flatnonzero(np.diff(first))
    if not len(rows):
        return np.zeros((0, len(model.names))), rows
    words = np.add.reduceat(model.logs[place], start, axis=0)
    top = words.max(axis=1)
    p = np.exp(words - top[:, None])
    first = np.append(first[rows], len(start))  # rows without words hold none, so the others adjoin
    single = np.add.reduceat(words, first[:-1], axis=0)
    n_lang = len(model.names)
    shares, full = _mixture(p, top, first, np.ones((len(rows), n_lang), np.float32), s.rounds)
    rank = np.argsort(-shares, axis=1, kind="stable")
    best = single.max(axis=1)
    chosen = (np.arange(n_lang) == single.argmax(axis=1)[:, None]).astype(np.float32)
    penalty = 0.5 * np.log(np.maximum(2, np.diff(first)))
    open_ = np.flatnonzero(full - best > penalty)  # no set can gain more than all languages do
    sizes = np.diff(first)
    for k in range(2, n_lang + 1):
        if not len(open_):
            break
        own = np.concatenate([np.arange(first[i], first[i + 1]) for i in open_])
        allowed = np.zeros((len(open_), n_lang), np.float32)
        np.put_along_axis(allowed, rank[open_, :k], 1, axis=1)
        got, like = _mixture(p[own], top[own], np.concatenate([[0], np.cumsum(sizes[open_])]), allowed, s.rounds)
        like = like - (k - 1) * penalty[open_]
        better = like > best[open_]
        best[open_[better]] = like[better]
        chosen[open_[better]] = got[better]
        open_ = open_[full[open_] - k * penalty[open_] > best[open_]]
    return chosen, rows


def identify(docs: DataFrame, model: Model, s: Settings = Settings()) -> DataFrame:
    """doc_id, lang_pred, score (the predicted language's share), and shares, a map of the selected set."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for rows, data, offsets in slices(batches, "text"):
            n = rows.num_rows
            names, score, sets = ["und"] * n, np.zeros(n), [[] for _ in range(n)]
            if m.names:
                heard = np.concatenate([[0], np.cumsum(ASCII_LETTERS[data])])
                plain = heard[offsets[1:]] > heard[offsets[:-1]]
                shares, at = infer(data, offsets, m, s)
                for i, own in zip(at.tolist(), shares, strict=True):
                    if plain[i] or any(c.isalpha() for c in rows.column(1)[i].as_py()):
                        k = int(own.argmax())
                        names[i], score[i] = m.names[k], min(1.0, float(own[k]))
                        sets[i] = [(m.names[j], float(own[j])) for j in np.flatnonzero(own)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names), pa.array(score), pa.array(sets, pa.map_(pa.string(), pa.float64()))], names=["doc_id", "lang_pred", "score", "shares"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, shares map<string,double>")


def held_out() -> Column:
    """Rows that the contract keeps from learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
