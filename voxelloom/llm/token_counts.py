"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary's matches at each end in a chunk;
dynamic programming carries the best score and the number of pieces on that path, and
never builds the pieces. The rules are those of the usual unigram encoder: the matches of
an end compete from the longest to the shortest, a later one must score strictly more, and
a character without a match of its own may be unknown, at the lowest score less ten; an
unknown character counts as its bytes where the vocabulary has byte pieces, else unknown
neighbours count as one.

Spaces become the mark U+2581, one is put in front, and chunks begin at each mark. Equal
short chunks are counted once a worker while its memory of them, bounded in bytes, lasts.

Defined cases: null and empty texts have no tokens; repeated rows are counted alike; a very
long text is counted whole, one chunk at a time; ties go by the order above; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 400_000
#: Longer chunks are counted anew, so that what is remembered is at most REMEMBERED times this many characters.
SHORT = 48


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[tuple[str, float]]
    bytes_known: bool

    @cached_property
    def key(self) -> str:
        """Tells vocabularies apart by all their pieces."""
        return hashlib.sha256(repr((self.pieces, self.bytes_known)).encode("utf-8", "surrogatepass")).hexdigest()

    @property
    def unknown(self) -> float:
        return min((s for _, s in self.pieces), default=0.0) - UNKNOWN_PENALTY


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces of a SentencePiece model file. Files of merges hold ranks for scores; those become
    log frequencies by Zipf's law, -ln(rank + 2), with the file's order as ranks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    scores = [model.get_score(i) for i in range(n)]
    ranked = all(float(x).is_integer() for x in scores)
    pieces = [(model.id_to_piece(i), -float(np.log(i + 2)) if ranked else float(scores[i])) for i in range(n)]
    return Vocabulary(pieces, sum(model.is_byte(i) for i in range(n)) == 256)


class Counter:
    """Counts of chunks, remembered up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown, self.bytes_known = vocabulary.unknown, vocabulary.bytes_known
        self.memory: dict[str, int] = {}

    def chunk(self, text: str) -> int:
        """Pieces of the best path."""
        n = len(text)
        best: list[float] = [0.0] * (n + 1)
        count = [0] * (n + 1)
        open_ = [False] * (n + 1)  # whether the path ends with an unknown character
        done, single, have = 0, False, False  # ends up to `done` are settled; the rest is about the next one

        def settle(e: int, single: bool, have: bool) -> None:
            if not single:
                score = best[e - 1] + self.unknown
                if not have or score > best[e]:
                    best[e] = score
                    if self.bytes_known:
                        count[e] = count[e - 1] + len(text[e - 1].encode("utf-8", "surrogatepass"))
                    else:
                        count[e] = count[e - 1] + (not open_[e - 1])
                    open_[e] = True

        if len(self.automaton):
            for at, (length, score) in self.automaton.iter(text):
                while done < at:
                    settle(done + 1, single, have)
                    done, single, have = done + 1, False, False
                e = at + 1
                score += best[e - length]
                if not have or score > best[e]:
                    best[e], count[e], open_[e], have = score, count[e - length] + 1, False, True
                single = single or length == 1
        while done < n:
            settle(done + 1, single, have)
            done, single, have = done + 1, False, False
        return count[n]

    def text(self, text: str) -> int:
        if not text:
            return 0
        chunks = text.replace(MARK, " ").split(" ")
        if not chunks[0]:
            chunks = chunks[1:]  # a leading space is the mark itself
        memory = self.memory
        long = [x for x in chunks if len(x) > SHORT]
        total = sum(self.chunk(MARK + x) for x in long)
        if long:
            chunks = [x for x in chunks if len(x) <= SHORT]
        for at in range(0, len(chunks), REMEMBERED):
            some = chunks[at : at + REMEMBERED]
            new = set(some).difference(memory)
            if len(memory) + len(new) > REMEMBERED:
                memory.clear()
                new = set(some)
            for x in new:
                memory[x] = self.chunk(MARK + x)
            total += sum(map(memory.__getitem__, some))
        return total


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and n_tokens of each document's whole text."""
    held, key = docs.sparkSession.sparkContext.broadcast(vocabulary), vocabulary.key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held.value
        if key not in _counters:
            _counters.clear()
            _counters[key] = Counter(vocabulary)
        counter = _counters[key]
        for rows in batches:
            counts = [counter.text(t.as_py() or "") for t in rows.column(1)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long")
