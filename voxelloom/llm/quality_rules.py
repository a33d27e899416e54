"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Counts that every row must report are computed for every row. The rules on top of them run
as one CASE expression, which stops at the first rule that rejects; on a sample of rows each
rule's rejections and its time are measured, and rules with more rejections for their cost
come first. The order changes the work and never the verdict.

Defined cases: null and empty texts, and texts without a word, have all counts 0 and fail;
repeated rows are judged alike, with or without an id; a very long text is counted whole, in one row; an empty table
gives no rows and leaves the rules in their order; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import discard, written

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: 13 bits of a number hold the place, so that 51 are left to the hash.
PACKED_WORDS = (1 << 13) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _share(part: Column, percent: int, whole: Column) -> Column:
    return 100 * part > percent * whole


@dataclass(frozen=True)
class Rule:
    """rejects: a condition on text and the counts; a rule must never be null where a text has words."""

    name: str
    rejects: Column | Callable[[], Column]


def rules() -> list[Rule]:
    """The default rules; their limits leave ordinary prose alone."""
    c = F.col
    kept = lambda pattern: F.length(F.regexp_replace("text", pattern, ""))
    return [
        Rule("symbols", _share(c("n_symbols"), 10, c("word_chars"))),
        Rule("duplicate_lines", (c("n_dup_lines") >= 3) & _share(c("n_dup_lines"), 30, c("n_lines"))),
        Rule("word_length", (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words"))),
        Rule("capitals", _share(kept("[^A-Z]+"), 50, c("word_chars"))),
        Rule("letters", 100 * kept(r"[^\p{L}]+") < 50 * c("word_chars")),
        Rule("digits", _share(kept("[^0-9]+"), 30, c("word_chars"))),
    ]


def _covered(places: Column) -> Column:
    """Words under runs of three at ascending places; runs at neighbouring places share words."""
    gap = lambda p, i: F.coalesce(F.least(F.lit(3), F.get(places, i + 1) - p), F.lit(3))
    return F.aggregate(F.transform(places, gap), F.lit(0), lambda a, x: a + x)


def _tied(ordered: Column, same: Callable[[Column, Column], Column]) -> Column:
    """The elements of a sorted array that equal a neighbour."""
    return F.filter(ordered, lambda x, i: F.coalesce(same(x, F.get(ordered, i + 1)), F.lit(False)) | F.coalesce(same(x, F.get(ordered, i - 1)), F.lit(False)))


def _repeated(words: Column) -> Column:
    """Words inside runs of three that occur more than once.

    Hash and place of a run share one number, the hash above as many bits as the places need, so that plain numbers
    are sorted. A text of more than PACKED_WORDS words would leave the hash too few bits; there, pairs are sorted.
    """
    n = F.size(words)
    shift = lambda f, x, by: F.call_function(f, x, by)

    def packed(runs: Column, bits: Column) -> Column:
        ordered = F.sort_array(F.transform(runs, lambda h, i: shift("shiftleft", h, bits).bitwiseOR(i.cast("long"))))
        tied = lambda s: _tied(s, lambda x, y: shift("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0)
        low = lambda x: x.bitwiseAND(shift("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")
        return _let(_let(ordered, lambda s: F.sort_array(F.transform(tied(s), low))), _covered)

    def paired(runs: Column) -> Column:
        ordered = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return _let(_let(ordered, lambda s: F.sort_array(F.transform(_tied(s, lambda x, y: x["h"] == y["h"]), lambda x: x["p"]))), _covered)

    def of_runs(runs: Column) -> Column:
        return F.when(F.size(F.array_distinct(runs)) == F.size(runs), 0).when(n <= PACKED_WORDS, _let(F.length(F.bin(n.cast("long"))), lambda bits: packed(runs, bits))).otherwise(paired(runs))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    runs = _let(hashes, lambda h: F.transform(F.slice(h, F.lit(1), F.greatest(F.lit(0), n - 2)), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))))
    return F.when(n < 3, 0).otherwise(_let(runs, of_runs))


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, text and the counts of each document."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    split = base.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
    return split.select(
        "doc_id", "text", F.size("words").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("words")).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | _share(F.col("n_repeat_words"), 50, F.col("n_words"))


def measure(sample: DataFrame, each: list[Rule], times: int = 8) -> list[tuple[Rule, float, float]]:
    """(rule, share rejected, seconds a row) on the rows of a sample that the base conditions let through.

    Each row is judged `times` over inside one job; the time of a job that judges nothing is taken off.
    """
    reach = sample.filter(~base_failed())
    again = reach.withColumn("_time", F.explode(F.sequence(F.lit(1), F.lit(times))))

    def timed(condition: Column) -> tuple[int, float]:
        took, hits = [], 0
        for _ in range(2):
            began = time.perf_counter()
            hits = again.agg(F.count_if(condition & (F.col("_time") > 0))).first()[0]
            took.append(time.perf_counter() - began)
        return hits, min(took)

    n = max(1, reach.count() * times)
    idle = timed(F.lit(True))[1]
    out = []
    for rule in each:
        hits, took = timed(rule.rejects)
        out.append((rule, hits / n, max(took - idle, 1e-6) / n))
    return out


def plan(docs: DataFrame, each: list[Rule], sample_rows: int = 2000) -> list[Rule]:
    """The rules by rejections for their cost, on a sample of expected `sample_rows` documents at most; rows are drawn
    one by one, whatever their ids."""
    rows = docs.count()
    if not rows or len(each) < 2:
        return each
    part = docs if rows <= sample_rows else docs.sample(fraction=sample_rows / rows, seed=20)
    sample = written(counted(part), "rules")
    measured = measure(sample, each)
    discard(sample)
    return [r for r, share, cost in sorted(measured, key=lambda m: -m[1] / m[2])]


def cascade(ordered: list[Rule]) -> Column:
    """The name of the first rule that rejects, or null."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in ordered:
        out = out.when(rule.rejects, F.lit(rule.name))
    return out


def judge(docs: DataFrame, each: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """doc_id, the counts, base_failed and kept."""
    ordered = plan(docs, rules() if each is None else each, sample_rows)
    rows = counted(docs).withColumn("base_failed", base_failed())
    kept = F.when(F.col("base_failed"), False).otherwise(cascade(ordered).isNull())
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
