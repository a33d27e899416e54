"""Benchmark decontamination with suffix arrays of the training text.

Each task turns bounded shards of its documents into a suffix array of words, looks up
every window of every benchmark item by binary search, and reads the documents and
positions of all verbatim matches from the ranges found. Runs of adjacent matches on one
diagonal give the longest match of an item in a document.

Words are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z in lower
case. A window is `width` consecutive words of an item, or the whole item if that is
shorter. The benchmark goes to tasks in blocks of about `block_words` words, one in memory
at a time and `together` in a pass at most. A larger benchmark takes further passes over the
documents, each of which carries on the marks that the one before wrote; its broadcasts are
dropped in between, so that driver and executors never hold more than those of one pass.

Defined cases: null and empty texts have no words and no hits; items without words match
nothing; an item with a null id marks words but isn't listed; repeated items count once
by id; repeated documents are judged alike; a very long text is a shard of its own; of equal
longest matches the first place in the item and then in the document is told; an empty
benchmark hits nothing, and no documents give no rows; extra columns are ignored by
`contamination` and passed on by `drop_contaminated`, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written
from .textkit import LOWER, NOT_ALNUM, U64, Words, slices

SHARD_BYTES = 1 << 20
_RESULT = "doc_id long, n_words long, n_hit long, items array<string>, longest array<long>, item_at array<long>, doc_at array<long>"


@dataclass(frozen=True)
class Queries:
    """Windows of a block of benchmark items: padded word hashes, lengths, item numbers and offsets in the item."""

    words: np.ndarray
    length: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    ids: list


def prepare(ids: list, texts: list, width: int) -> Queries:
    column = pa.array([x or "" for x in texts], pa.string())
    data = np.frombuffer("".join(column.to_pylist()).encode(), np.uint8)
    sizes = [len((x or "").encode()) for x in texts]
    words = Words(data, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), NOT_ALNUM, LOWER)
    rows, lengths, items, offsets = [], [], [], []
    for i in range(len(ids)):
        own = words.hash[words.first[i] : words.first[i + 1]]
        for at in range(max(1, len(own) - width + 1) if len(own) else 0):
            part = own[at : at + width]
            rows.append(np.concatenate([part, np.zeros(width - len(part), U64)]))
            lengths.append(len(part))
            items.append(i)
            offsets.append(at)
    table = np.array(rows, U64).reshape(-1, width)
    return Queries(table, np.array(lengths, np.int64), np.array(items, np.int64), np.array(offsets, np.int64), [None if x is None else str(x) for x in ids])


def passes(benchmark: DataFrame, width: int, block_words: int, together: int) -> Iterator[list[Broadcast]]:
    """The benchmark as broadcast blocks of about `block_words` words, `together` at a time; those of a pass go with the next."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // (4 * block_words)))
    for k in range(0, n, together):
        held = []
        for j in range(k, min(n, k + together)):
            rows = (items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == j) if n > 1 else items).collect()
            held.append(spark.sparkContext.broadcast(prepare([r[0] for r in rows], [r[1] for r in rows], width)))
        yield held
        if len(held) == together < n:
            for x in held:
                x.destroy()


def _sorted(major: np.ndarray, minor: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, pair keys) in order of (major, minor), both below 2**bits."""
    n = len(major)
    if 2 * bits + n.bit_length() <= 63:  # one plain sort of packed numbers
        place = n.bit_length()
        packed = ((major << bits | minor) << place) | np.arange(n)
        packed.sort()
        return packed & ((1 << place) - 1), packed >> place
    key = major << bits | minor
    order = np.argsort(key, kind="stable")
    return order, key[order]


class SuffixArray:
    """Order of all word suffixes of a shard, to a depth of at least `depth` words.

    The first rounds sort all suffixes by one and by two words; each later round doubles
    the depth and sorts only those that are still tied.
    """

    def __init__(self, words: np.ndarray, depth: int):
        self.words, n = words, len(words)
        by_hash = np.argsort(words)
        sorted_ = words[by_hash]
        fresh = np.ones(n, bool)
        np.not_equal(sorted_[1:], sorted_[:-1], out=fresh[1:])
        self.known = sorted_[fresh]
        self.codes = codes = np.empty(n, np.int64)  # codes keep the order of the hashes; 0 ends a row
        codes[by_hash] = np.cumsum(fresh) - 1
        self.bits = bits = max(1, (n + 1).bit_length())
        follow = np.zeros(n, np.int64)
        follow[:-1] = codes[1:] + 1
        self.order, self.pairs = _sorted(codes, follow, bits)
        order = self.order
        new = np.ones(n, bool)
        np.not_equal(self.pairs[1:], self.pairs[:-1], out=new[1:])
        slot = np.arange(n)
        rank = np.empty(n, np.int64)  # the first slot of a suffix's group of ties
        rank[order] = np.maximum.accumulate(np.where(new, slot, 0))
        reach = 2
        while reach < depth and n > 1:
            alone = new.copy()
            alone[:-1] &= new[1:]
            tied = np.flatnonzero(~alone)
            if not len(tied):
                break
            suffix = order[tied]
            beyond = suffix + reach
            place, key = _sorted(rank[suffix], np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0), bits)
            suffix = suffix[place]
            order[tied] = suffix
            first = np.ones(len(tied), bool)
            np.not_equal(key[1:], key[:-1], out=first[1:])
            new[tied] = first
            rank[suffix] = np.maximum.accumulate(np.where(first, tied, 0))
            reach *= 2

    def _bound(self, q: np.ndarray, length: np.ndarray, lo: np.ndarray, hi: np.ndarray, after: bool) -> np.ndarray:
        lo, hi, n, width = lo.copy(), hi.copy(), len(self.codes), q.shape[1]
        steps = np.arange(width)
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            at = self.order[mid][:, None] + steps
            have = np.where(at < n, self.codes[np.minimum(at, n - 1)], -1)
            want = q[open_]
            apart = (have != want) & (steps < length[open_][:, None])
            first = apart.argmax(axis=1)
            some = apart.any(axis=1)
            rows = np.arange(len(open_))
            below = np.where(some, have[rows, first] < want[rows, first], after)
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)
        return lo

    def find(self, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of each verbatim occurrence."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(queries.length) or not len(self.order):
            return none
        width = queries.words.shape[1]
        q = np.searchsorted(self.known, queries.words)
        there = (self.known[np.minimum(q, len(self.known) - 1)] == queries.words) | (np.arange(width) >= queries.length[:, None])
        live = np.flatnonzero(there.all(axis=1))  # any word that the shard lacks rules a window out
        if not len(live):
            return none
        q, length = q[live], queries.length[live]
        one = length == 1
        second = q[:, 1] + 1 if width > 1 else np.zeros(len(q), np.int64)
        lo = np.searchsorted(self.pairs, q[:, 0] << self.bits | np.where(one, 0, second), side="left")
        hi = np.searchsorted(self.pairs, q[:, 0] << self.bits | np.where(one, (1 << self.bits) - 1, second), side="right")
        a = self._bound(q, length, lo, hi, False)
        b = self._bound(q, length, a, hi, True)
        n = b - a
        window = np.repeat(live, n)
        at = self.order[np.arange(n.sum()) + np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n)]
        return window, at


def _matches(data: np.ndarray, offsets: np.ndarray, held: list[Broadcast], width: int) -> tuple[np.ndarray, np.ndarray, list[dict]]:
    """How many words each row has, whether each word is hit and, by item, (longest match, its place in the item, in the document) of each row."""
    words = Words(data, offsets, NOT_ALNUM, LOWER)
    counts, rows = words.counts, len(offsets) - 1
    begins = words.first[:-1] + np.arange(rows)  # each row is followed by an end mark
    line = np.zeros(len(words.hash) + rows, U64)
    line[np.arange(len(words.hash)) + words.rows()] = np.where(words.hash == 0, U64(1), words.hash)
    index = SuffixArray(line, width)
    cover = np.zeros(len(line) + 1, np.int64)
    found: list[dict] = [{} for _ in range(rows)]
    for b in held:
        queries = b.value
        window, at = index.find(queries)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + queries.length[window], -1)
        item, offset, length = queries.item[window], queries.offset[window], queries.length[window]
        order = np.lexsort((at, at - offset, item))
        item, offset, length, at = item[order], offset[order], length[order], at[order]
        if len(at):
            new = np.ones(len(at), bool)
            new[1:] = (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (offset[1:] != offset[:-1] + 1)
            s = np.flatnonzero(new)
            e = np.concatenate([s[1:], [len(at)]]) - 1
            run = at[e] + length[e] - at[s]
            row = np.searchsorted(begins, at[s], side="right") - 1
            for r, i, n, o, p in zip(row.tolist(), item[s].tolist(), run.tolist(), offset[s].tolist(), (at[s] - begins[row]).tolist(), strict=True):
                name, own = queries.ids[i], found[r]
                if name not in own or (-n, o, p) < (-own[name][0], *own[name][1:]):
                    own[name] = (n, o, p)
        if len(held) > 1:
            b.__dict__.pop("_value", None)  # one block in memory at a time
    return counts, (np.cumsum(cover[:-1]) > 0)[np.arange(len(words.hash)) + words.rows()], found


def _by_row(counts: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Where each row's hit words begin among all hit words."""
    return np.concatenate([[0], np.cumsum(hit)])[np.concatenate([[0], np.cumsum(counts)])]


_MARKED = "doc_id long, text string, n_words long, marks array<int>, items array<string>, longest array<long>, item_at array<long>, doc_at array<long>"


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_words: int = 1 << 18, together: int = 8) -> DataFrame:
    """One row a document: words, hit words, and for each item met (sorted by id) the longest verbatim match and its places."""
    cells = ["items", "longest", "item_at", "doc_at"]
    state = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for held in passes(benchmark, width, block_words, together):
        state = _marked(state, held, width)
        if len(held) == together:  # another pass may follow, and this one's blocks go
            state = written(state, "marked")
    return state.select("doc_id", "n_words", F.size("marks").cast("long").alias("n_hit"), *cells)


def _marked(state: DataFrame, held: list[Broadcast], width: int) -> DataFrame:
    """The rows of `state` (doc_id, text and, after the first pass, the marks and matches so far) with those of the held blocks."""
    first = "marks" not in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text", SHARD_BYTES):
            counts, hit, found = _matches(data, offsets, held, width)
            if not first:
                begins = np.concatenate([[0], np.cumsum(counts)])
                old = rows.column("marks")
                hit[old.flatten().to_numpy() + np.repeat(begins[:-1], np.diff(old.offsets.to_numpy()))] = True
                for own, *cells in zip(found, *(rows.column(c).to_pylist() for c in ("items", "longest", "item_at", "doc_at")), strict=True):
                    for name, n, o, p in zip(*cells, strict=True):
                        if name not in own or (-n, o, p) < (-own[name][0], *own[name][1:]):
                            own[name] = (n, o, p)
            names = [sorted(k for k in own if k is not None) for own in found]
            cells = [pa.array([[own[k][j] for k in ks] for own, ks in zip(found, names, strict=True)], pa.list_(pa.int64())) for j in range(3)]
            at = np.flatnonzero(hit)
            bounds = _by_row(counts, hit)
            starts = np.repeat(np.concatenate([[0], np.cumsum(counts)])[:-1], np.diff(bounds))
            marks = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array((at - starts).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("text"), pa.array(counts), marks, pa.array(names, pa.list_(pa.string())), *cells], names=["doc_id", "text", "n_words", "marks", "items", "longest", "item_at", "doc_at"])

    return state.mapInArrow(run, _MARKED)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_words: int = 1 << 18, together: int = 8) -> DataFrame:
    """The documents that hold no window of the benchmark, with all their columns; no shuffle."""

    def clean(df: DataFrame, held: list[Broadcast]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, data, offsets in slices(batches, "text", SHARD_BYTES):
                counts, hit, _ = _matches(data, offsets, held, width)
                yield rows.filter(pa.array(np.diff(_by_row(counts, hit)) == 0))

        return df.mapInArrow(run, df.schema)

    for held in passes(benchmark, width, block_words, together):
        docs = clean(docs, held)
        if len(held) == together:  # another pass may follow, and this one's blocks go
            docs = written(docs, "clean")
    return docs


def digest(found: DataFrame) -> DataFrame:
    items = F.array_join("items", ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.coalesce(F.array_max("longest"), F.lit(0)).alias("longest_match"))


def item_digest(ids: list[str]) -> str:
    """The digest of a list of item ids, as the query has it."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
