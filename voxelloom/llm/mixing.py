"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The documents of a source fall into permuted blocks by a keyed hash. A source's target says
how often each block is drawn: every block whole as often as the target covers the source,
then blocks in permuted order until the rest is met, the last one down to the word (or, with
`whole_documents`, to the nearer end of the document at the limit). A tree
that halves the set of output shards splits the drawn blocks of all sources at each node by
a multivariate-hypergeometric draw, so that the quotas of a shard are those of a uniform
deal without replacement, and sum exactly. Each shard then takes its quota as the next
disjoint range of each source's permuted blocks, and is shuffled locally.

The hash is of doc_id and text, so that rows without an id spread as others do. Nothing is as
large as a source in one task: blocks are summed where they lie, and only the different
documents of the one block at a source's limit (1/4096 of it) are put in order.

Beyond `most_leaves` shards the tree deals to that many leaves, and each leaf's draws fall
evenly into its shards by a keyed hash, so that no number of shards is the last.

Defined cases: a null or empty text has size 0 and takes 0; a null source is a source, the
last; equal rows (id and text) are separate rows that are dealt alike, and at a source's
limit each takes an even part of what is left for them, rounded down; a very long text is one
document, drawn as others; ties of targets go by the sources' order; an empty table gives an
empty mix; extra columns are ignored by `mixture` and passed on by `mixed`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import discard, written

WORD = r"[^\x20\x09-\x0D]+"
#: Columns that a mix adds; those of an earlier mix are replaced.
MIX = ("mix_shard", "mix_place", "mix_words")


@dataclass(frozen=True)
class Recipe:
    """weights repeat over the sources by code point. share: of all words, what the mix takes. most: times a source
    may be taken. shard_words: words of an output shard. most_leaves: leaves of the tree. colours: the most groups of sources in the tree. broadcast_rows:
    plans of more blocks are joined by a shuffle. whole_documents: the document at a source's limit is drawn whole or not
    at all, whichever is nearer to the target."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    most: float = 2.0
    block_bits: int = 12
    shard_words: int = 1 << 22
    most_leaves: int = 8192
    colours: int = 4096
    seed: int = 20240229
    broadcast_rows: int = 400_000
    whole_documents: bool = False


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """(source, source_size) with weight and target: `share` of all sizes by weight, no source above `most` times
    its own, the excess going to the others by weight until none is above.

    The limit of that sharing is one level L with target = min(most * size, L * weight): sources in order of
    size / weight fill up until the rest, at L each, makes the total.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = sources.withColumn("i", F.row_number().over(by_name) - 1)
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, recipe.weights)), (F.col("i") % len(recipe.weights) + 1).cast("int")))
    w = w.withColumn("cap", recipe.most * F.col("source_size"))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "i").rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("goal", recipe.share * F.sum("source_size").over(everything))
    w = w.withColumn("level", (F.col("goal") - F.coalesce(F.sum("cap").over(fill), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fill), F.lit(0.0))))
    w = w.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything))
    return w.select("source", "source_size", "weight", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def split_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """[shard, colour]: exact quotas of each shard, by halving the shards and drawing the left half's share."""
    out = np.zeros((shards, len(quotas)), np.int64)
    total = int(quotas.sum())
    ends = [total * k // shards for k in range(shards + 1)]
    todo = [(0, shards, quotas.astype(np.int64))]
    while todo:
        lo, hi, own = todo.pop()
        if hi - lo == 1:
            out[lo] = own
            continue
        mid = (lo + hi) // 2
        draw = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(own, ends[mid] - ends[lo], method="marginals") if own.sum() else own
        todo += [(lo, mid, draw), (mid, hi, own - draw)]
    return out


def _hashed(docs: DataFrame, recipe: Recipe) -> DataFrame:
    """doc_id, source, size, h and block of each row, with all its columns in row."""
    out = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_of(F.col("text")).alias("size"), F.xxhash64(F.lit(recipe.seed), F.col("doc_id").cast("long"), "text").alias("h"))
    return out.withColumn("block", F.shiftrightunsigned("h", 64 - recipe.block_bits).cast("int"))


def _sizes(docs: DataFrame, recipe: Recipe) -> DataFrame:
    """A narrow row a document: doc_id, source, size, h, block."""
    return _hashed(docs.select("doc_id", "source", "text"), recipe).drop("row")


def _block_plan(rows: DataFrame, recipe: Recipe) -> DataFrame:
    """What is drawn of each block: source, block, block_words, left, whole, source_size, target, draws, parts (shards of a leaf)."""
    spark = rows.sparkSession
    blocks = written(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "blocks")
    goals = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), recipe)
    whole = F.least(F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)), F.lit(int(recipe.most)))
    goals = written(goals.withColumn("whole", whole.cast("int")).withColumn("rest", F.greatest(F.lit(0), F.round("target").cast("long") - F.col("whole") * F.col("source_size"))), "goals")

    # how much of each block is drawn once more
    order = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    joined = blocks.join(goals, same(blocks, goals)).select(blocks["source"], "block", "words", "whole", "rest", "source_size", "target")
    before = F.coalesce(F.sum("words").over(order), F.lit(0))
    drawn = joined.withColumn("left", F.greatest(F.lit(0), F.least(F.col("words"), F.col("rest") - before)))

    # blocks to shards
    n = goals.count()
    colour = F.col("source") if n <= recipe.colours else F.pmod(F.xxhash64("source"), F.lit(recipe.colours)).cast("string")
    copies = F.filter(F.transform(F.sequence(F.lit(1), F.lit(int(recipe.most) + 1)), lambda k: F.struct(k.alias("copy"), F.when(k <= F.col("whole"), F.col("words")).when(k == F.col("whole") + 1, F.col("left")).otherwise(0).alias("of"))), lambda x: x["of"] > 0)
    placed = drawn.withColumn("colour", F.coalesce(F.concat(F.lit("+"), colour), F.lit("-"))).withColumn("each", F.explode_outer(copies))
    placed = written(placed.select("source", "block", "words", "left", "whole", "source_size", "target", "colour", F.col("each.copy").alias("copy"), F.col("each.of").alias("of")), "draws")
    quotas = placed.filter("copy is not null").groupBy("colour").agg(F.count(F.lit(1)).alias("n"), F.sum("of").alias("of")).orderBy("colour").collect()  # at most `colours` + 1 rows
    total = sum(int(r["of"]) for r in quotas)
    wanted = max(1, -(-total // recipe.shard_words))
    shards = min(recipe.most_leaves, wanted)
    split = split_tree(np.array([r["n"] for r in quotas], np.int64), shards, recipe.seed)
    bounds = spark.createDataFrame([(r["colour"], np.cumsum(split[:, k]).tolist()) for k, r in enumerate(quotas)], "colour string, bounds array<long>")
    at = F.row_number().over(Window.partitionBy("colour").orderBy(F.when(F.col("copy").isNull(), 1).otherwise(0), F.xxhash64(F.lit(recipe.seed + 1), "source", "block", "copy"), "source", "block", "copy")) - 1
    dealt = placed.withColumn("at", at).join(bounds, "colour", "left").withColumn("shard", F.when(F.col("copy").isNotNull(), F.size(F.filter("bounds", lambda b: b <= F.col("at")))))
    plan = dealt.groupBy("source", "block").agg(
        F.first("words").alias("block_words"), F.first("left").alias("left"), F.first("whole").alias("whole"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.filter(F.sort_array(F.collect_list(F.struct("copy", "shard"))), lambda x: x["copy"].isNotNull()).alias("draws"),
    )  # a block has at most `most` + 1 draws
    out = written(plan.withColumn("parts", F.lit(-(-wanted // shards))), "plan")
    discard(blocks, goals, placed)
    return out


def _points(rows: DataFrame, plan: DataFrame, recipe: Recipe) -> DataFrame:
    """The plan with, in the block at each source's limit, `end`: the last documents the limit reaches, and what each
    row of them takes. Those before it in the block are drawn whole. Equal rows are one before anything is ordered."""
    cut = plan.filter("left > 0 and left < block_words").select(F.col("source").alias("_s"), F.col("block").alias("_b"), "left")
    cut = F.broadcast(cut) if cut.count() <= recipe.broadcast_rows else cut  # a row a source
    own = rows.join(cut, rows["source"].eqNullSafe(cut["_s"]) & (rows["block"] == cut["_b"])).groupBy("source", "h", "doc_id", "size").agg(F.first("left").alias("left"), F.count(F.lit(1)).alias("k"))
    before = F.coalesce(F.sum(F.col("size") * F.col("k")).over(Window.partitionBy("source").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    all_ = F.col("size") * F.col("k")
    part = F.greatest(F.lit(0), F.least(all_, F.col("left") - before))
    each = F.when(2 * part >= all_, F.col("size")).otherwise(F.lit(0)) if recipe.whole_documents else F.floor(part / F.col("k"))
    end = F.struct("h", _key(F.col("doc_id")).alias("id"), "size", F.col("each").alias("extra"))
    reached = own.withColumn("part", part).withColumn("each", each.cast("long")).filter("part > 0").groupBy("source").agg(F.max(end).alias("end"))
    out = written(plan.join(reached, plan["source"].eqNullSafe(reached["source"]), "left").select(plan["source"].alias("_s"), plan["block"].alias("_b"), "block_words", "left", "whole", "source_size", "target", "draws", "parts", "end"), "points")
    discard(plan)
    return F.broadcast(out) if out.count() <= recipe.broadcast_rows else out


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(-(1 << 63)))


def _dealt(rows: DataFrame, points: DataFrame, recipe: Recipe) -> DataFrame:
    """The rows with their plan, `extra` (words drawn once more) and `drawn`, a struct (copy, shard, words, place) for each draw."""
    joined = rows.join(points, rows["source"].eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
    me, last = F.struct("h", _key(F.col("doc_id")).alias("id"), "size"), F.struct(F.col("end.h").alias("h"), F.col("end.id").alias("id"), F.col("end.size").alias("size"))
    limited = F.when(me < last, F.col("size")).when(me == last, F.col("end.extra")).otherwise(F.lit(0))
    extra = F.when(F.col("left") <= 0, F.lit(0)).when(F.col("left") >= F.col("block_words"), F.col("size")).otherwise(F.coalesce(limited, F.lit(0)))
    keyed = lambda k, d: F.xxhash64(F.lit(recipe.seed + k), "h", d["copy"])
    shard = lambda d: d["shard"] * F.col("parts") + F.pmod(keyed(3, d), F.col("parts")).cast("int")
    words = lambda d: F.when(d["copy"] <= F.col("whole"), F.col("size")).otherwise(F.col("extra")).cast("long")
    drawn = F.filter(F.transform("draws", lambda d: F.struct(d["copy"].alias("copy"), shard(d).alias("shard"), words(d).alias("words"), keyed(2, d).alias("place"))), lambda d: d["words"] > 0)
    return joined.withColumn("extra", extra.cast("long")).withColumn("drawn", drawn)


def _planned(docs: DataFrame, recipe: Recipe) -> tuple[DataFrame, DataFrame]:
    rows = written(_sizes(docs, recipe), "sizes")
    return rows, _points(rows, _block_plan(rows, recipe), recipe)


def mixture(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, taken, and for each draw of it a struct
    (copy, shard, words, place) in draws; `place` is its order in the shard."""
    rows, points = _planned(docs, recipe)
    taken = (F.col("size") * F.col("whole") + F.col("extra")).cast("long")
    return _dealt(rows, points, recipe).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), F.col("drawn").alias("draws"))


def mixed(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """The mix itself: the documents' columns, once for each draw of `mixture`, and mix_shard, mix_place, mix_words.

    Each shard is one range of partitions in local random order; a draw of part of a document
    holds its first mix_words words, joined by spaces. Texts move once, to their shard: the plan
    of the blocks, and the last document a source's limit reaches, meet them where they lie.
    """
    rows, points = _planned(docs, recipe)
    discard(rows)
    each = _dealt(_hashed(docs, recipe), points, recipe).select("row", "size", F.explode("drawn").alias("draw"))
    text = F.col("row").getField("text")
    part = F.concat_ws(" ", F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("draw.words").cast("int")))
    cut = F.when(F.col("draw.words") < F.col("size"), part).otherwise(text)
    out = each.select(*[(cut if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns if c not in MIX], F.col("draw.shard").alias("mix_shard"), F.col("draw.place").alias("mix_place"), F.col("draw.words").alias("mix_words"))
    return out.repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_place")
