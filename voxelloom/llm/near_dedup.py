"""Near-duplicate groups by b-bit MinHash.

Minima of 128 hash functions give 21 bands of 6 for candidates; the two low bits of
every minimum, packed as bit planes, estimate the similarity of a candidate pair by
bit counts, corrected for chance collisions; links are confirmed on the full sets.

Groups of any size stay distributed. Equal sets are one class before anything else.
A bucket's leader is the class whose buckets are most populous (a template that
thousands of copies derive from leads all of them). Each class first meets the foremost
of its leaders; then, where a bucket still holds several components, the members of
others meet its leader. What is left of a bucket of a few members meets in a join; the
members of larger buckets meet on the rarest of their shingles only: of two sets that
link, the shingles that one has alone can't fill the rarest of both, so a passage that makes
thousands of texts alike pairs none of them. Both joins keep only pairs of different components whose estimate allows a link and whose parity bits, a bound
that is never wrong, don't rule it out. Pairs inside one component can't change it and are
never made. Hot buckets, leaders and shingles are dealt over salts.

Defined cases: null or empty text, or one without words, has an empty set, is its own
component and is kept. A text shorter than five words is one shingle. Rows that share a
doc_id with unequal texts are separate rows. Rows with a null doc_id are grouped like
others; component_id is the least doc_id that isn't null, and null if there is none
(then kept is true). Repeated rows are one class. A very long text is read whole, as a
slice of its own. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType
from pyspark.sql.window import Window

from .graph import components
from .storage import discard, written
from .textkit import U64, Words, binary16, lists, mix, slices, windows

_SIGNED = "doc_id long, n_shingles long, cls binary, sig array<long>, bits array<long>, bands array<long>"


@dataclass(frozen=True)
class Plan:
    """width: words of a shingle. percent: least similarity. bands of rows of the minima. slack: how far below
    the threshold an estimate may lie, at five standard errors of the estimate. filter_bits: the most bits of a filter
    that is broadcast, as a million numbers; it has 32 for each key, and passes more rows beyond that. few: the members of a bucket that may
    meet directly. hot_rows: rows of a key that one salt holds."""

    width: int = 5
    percent: int = 85
    minima: int = 128
    bands: int = 21
    rows: int = 6
    slack: float = 0.19
    filter_bits: int = 1 << 26
    parity_bits: int = 2048
    few: int = 32
    hot_rows: int = 1024


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(1, n + 1, dtype=U64)
    return mix(k * U64(0xA24BAED4963EE407)) | U64(1), mix(k * U64(0x9FB21C651E98DF25))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each row, flat, with row offsets."""
    flat, first = windows(Words(data, offsets), width)
    parts, sizes = [], np.zeros(len(first), np.int64)
    for row in range(len(first) - 1):
        own = flat[first[row] : first[row + 1]]
        if len(own) > 1:
            own = np.sort(own)
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        parts.append(own)
        sizes[row + 1] = len(own)
    return (np.concatenate(parts) if parts else flat), np.cumsum(sizes)


def set_keys(flat: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that identify a set of shingles, whatever its order."""
    sizes = np.diff(first).astype(U64)
    out = []
    for c in (U64(0x2545F4914F6CDD1D), U64(0x8CB92BA72F3D8DD7)):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(flat ^ c))])
        out.append(mix(total[first[1:]] - total[first[:-1]] + sizes * c))
    return out[0], out[1]


def signatures(flat: np.ndarray, first: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(packed bit planes, band keys) of each row whose set isn't empty; empty rows hold zeros."""
    rows = len(first) - 1
    full = np.flatnonzero(np.diff(first))
    minima = np.zeros((plan.minima, rows), U64)
    if len(full):
        a, b = _coefficients(plan.minima)
        block = 1 << 15  # stays in cache
        starts = first[:-1][full]
        cuts = [0]
        for i in range(1, len(full)):
            if starts[i] - starts[cuts[-1]] >= block:
                cuts.append(i)
        for lo, hi in zip(cuts, [*cuts[1:], len(full)], strict=True):
            own = flat[starts[lo] : (starts[hi] if hi < len(full) else len(flat))]
            at = starts[lo:hi] - starts[lo]
            buffer = np.empty_like(own)
            for k in range(plan.minima):
                np.multiply(own, a[k], out=buffer)
                buffer += b[k]
                minima[k, full[lo:hi]] = np.minimum.reduceat(buffer, at)
    low = mix(minima)
    planes = []
    for bit in (0, 1):
        bits = (low >> U64(bit) & U64(1)).astype(np.uint8)
        planes.append(np.ascontiguousarray(np.packbits(bits, axis=0, bitorder="little").T).view(np.int64))
    keys = np.empty((rows, plan.bands), U64)
    for band in range(plan.bands):
        acc = np.full(rows, band + 1, U64)
        for k in range(band * plan.rows, (band + 1) * plan.rows):
            acc = mix(acc * U64(0x9E3779B97F4A7C15) + minima[k])
        keys[:, band] = acc
    return np.concatenate(planes, axis=1), keys.view(np.int64)


def parities(flat: np.ndarray, first: np.ndarray, n: int, block: int = 256) -> np.ndarray:
    """n bits a row: whether an odd number of its shingles falls on each place. Rows are counted in small blocks."""
    rows = len(first) - 1
    out = np.zeros((rows, n // 8), np.uint8)
    for lo in range(0, rows, block):
        hi = min(rows, lo + block)
        key = np.repeat(np.arange(hi - lo) * n, np.diff(first[lo : hi + 1])) + (flat[first[lo] : first[hi]] & U64(n - 1)).astype(np.int64)
        odd = (np.bincount(key, minlength=(hi - lo) * n) & 1).astype(np.uint8).reshape(hi - lo, n)
        out[lo:hi] = np.packbits(odd, axis=1, bitorder="little")
    return out.view(np.int64)


def signed(docs: DataFrame, plan: Plan) -> DataFrame:
    """Set size, class key, packed signature and band keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            flat, first = shingle_sets(data, offsets, plan.width)
            planes, keys = signatures(flat, first, plan)
            n, bits = rows.num_rows, parities(flat, first, plan.parity_bits)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(first)), binary16(*set_keys(flat, first)), lists(planes.ravel(), np.arange(n + 1) * planes.shape[1]), lists(bits.ravel(), np.arange(n + 1) * bits.shape[1]), lists(keys.ravel(), np.arange(n + 1) * plan.bands)],
                names=["doc_id", "n_shingles", "cls", "sig", "bits", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SIGNED)


def estimate(a: Column, b: Column, plan: Plan) -> Column:
    """Similarity from the bit planes: equal low bits, less those that are equal by chance."""
    words = plan.minima // 64
    apart = sum((F.bit_count(a[i].bitwiseXOR(b[i]).bitwiseOR(a[i + words].bitwiseXOR(b[i + words]))) for i in range(1, words)), F.bit_count(a[0].bitwiseXOR(b[0]).bitwiseOR(a[words].bitwiseXOR(b[words]))))
    return ((1 - apart / F.lit(plan.minima)) - 0.25) / 0.75


def possible(a: Column, b: Column, na: Column, nb: Column, plan: Plan) -> Column:
    """False only where a link can't be: each place whose parity differs, and each shingle of a difference in size, is a
    shingle that only one of the sets has, and a link allows (100 - percent) / (100 + percent) of both sizes of those."""
    apart = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, plan.parity_bits // 64)), F.bit_count(a[0].bitwiseXOR(b[0])))
    return (100 - plan.percent) * (na + nb) >= (100 + plan.percent) * F.greatest(apart.cast("long"), F.abs(na - nb))


def _bits(keys: int, plan: Plan) -> int:
    return min(plan.filter_bits, 1 << max(12, (32 * keys).bit_length()))


def _sieved(docs: DataFrame, ids: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """The documents whose doc_id is surely not among `ids`, and the others: row (all columns), text, _id.

    A bit filter of bounded size is joined where the texts lie, so that only the others have to move or be read again;
    what is joined after it decides.
    """
    bits = _bits(ids.count(), plan)
    place = lambda x: F.pmod(F.xxhash64(x), F.lit(bits))
    words = ids.select(place(F.col("doc_id")).alias("p")).groupBy(F.floor(F.col("p") / 64).cast("long").alias("_w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("_m"))
    told = docs.select(F.struct(*docs.columns).alias("row"), "text", F.col("doc_id").cast("long").alias("_id"))
    told = told.withColumn("_p", place(F.col("_id"))).withColumn("_w", F.floor(F.col("_p") / 64).cast("long")).join(F.broadcast(written(words, "mask")), "_w", "left")
    hit = F.expr("_m is not null and shiftright(_m, cast(_p % 64 as int)) & 1 = 1")
    # the id depends on the mask, so that no later join on it can be moved below the filter, to all texts
    return told.filter(~hit), told.filter(hit).select("row", "text", F.when(F.col("_m") != 0, F.col("_id")).alias("_id"))


def _sets(docs: DataFrame, wanted: DataFrame, plan: Plan) -> DataFrame:
    """(cls, shingles) of the wanted (cls, doc_id), from the texts that have a wanted doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            flat, first = shingle_sets(data, offsets, plan.width)
            one, two = set_keys(flat, first)
            yield pa.RecordBatch.from_arrays([binary16(one, two), lists(flat.view(np.int64), first)], names=["cls", "shingles"])

    some = _sieved(docs.select("doc_id", "text"), wanted, plan)[1].select("text").mapInArrow(run, "cls binary, shingles array<long>")
    return some.filter(F.size("shingles") > 0).join(wanted.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"])


def _hot(rows: DataFrame, key: str, plan: Plan) -> DataFrame | None:
    """(key, _s): over how many salts the rows of a hot key go; None if no key is hot."""
    found = written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > plan.hot_rows).select(key, F.ceil(F.col("c") / plan.hot_rows).cast("int").alias("_s")), "hot")
    return None if found.isEmpty() else found


def _dealt(left: DataFrame, right: DataFrame, key: str, by: str, hot: DataFrame | None, condition: Column | None = None) -> DataFrame:
    """Inner join on `key`; rows of a hot key on the left are dealt over its salts by `by`, those on the right repeated for each."""
    if hot is None:
        out = left.join(right, key)
    else:
        told = lambda df: df.join(hot, key, "left").withColumn("_s", F.coalesce("_s", F.lit(1)))
        one = told(left).withColumn("_k", F.pmod(F.xxhash64(by), F.col("_s")).cast("int")).drop("_s")
        two = told(right).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_s") - 1))).drop("_s")
        out = one.join(two, [key, "_k"]).drop("_k")
    return out if condition is None else out.filter(condition)


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) of classes whose full sets meet the threshold; many pairs may share b."""
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    wanted = written(ends.join(classes.select("cls", F.col("first_id").alias("doc_id")), "cls"), "wanted")
    sets = written(_sets(docs, wanted, plan), "sets")
    one = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    hot = _hot(pairs, "b", plan)
    both = _dealt(pairs.select("a", "b").join(one, "a"), two, "b", "a", hot)
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    sized = both.select("a", "b", shared.alias("s"), (F.size("sa") + F.size("sb")).cast("long").alias("t"))
    links = written(sized.filter(100 * F.col("s") >= plan.percent * (F.col("t") - F.col("s"))).select("a", "b"), "links")
    discard(wanted, sets, *([hot] if hot is not None else []))
    return links


def _led(members: DataFrame, plan: Plan, *more: str) -> DataFrame:
    """(a, b, sa, sb, weight, la, lb): the members of each bucket and its leader b, the class of the greatest weight."""
    label = F.col("label") if "label" in more else F.lit(None)
    told = members.select("bucket", "weight", "cls", "sig", label.alias("label"))
    lead = told.groupBy("bucket").agg(F.max(F.struct("weight", "cls", "sig", "label")).alias("l")).select("bucket", F.col("l.weight").alias("weight"), F.col("l.cls").alias("b"), F.col("l.sig").alias("sb"), F.col("l.label").alias("lb"))
    return _dealt(told.select("bucket", F.col("cls").alias("a"), F.col("sig").alias("sa"), F.col("label").alias("la")), lead, "bucket", "a", _hot(members, "bucket", plan), F.col("a") != F.col("b"))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their components, of the buckets that hold more than one, and how many members those have.

    The buckets are written before the join, so that it has no aggregate in its stage and hot ones can be split.
    """
    placed = written(members.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls")), "placed")
    several = written(placed.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("c")).filter("lo <> hi").select("bucket", "c"), "several")
    out = written(placed.join(several, "bucket"), "open")
    discard(placed, several)
    return out


def _sides(members: DataFrame, key: str, *more: str) -> tuple[DataFrame, DataFrame]:
    names = ("sig", "label", "n", "bits", *more)
    return tuple(members.select(key, F.col("cls").alias(k), *(F.col(n).alias(f"{n}_{k}") for n in names)) for k in ("a", "b"))


def _fits(plan: Plan) -> Column:
    """Whether a and b are of different components and their estimate and parity allow a link."""
    c = F.col
    alike = estimate(c("sig_a"), c("sig_b"), plan) >= plan.percent / 100 - plan.slack
    return (c("label_a") != c("label_b")) & alike & possible(c("bits_a"), c("bits_b"), c("n_a"), c("n_b"), plan)


def _across(members: DataFrame, plan: Plan) -> DataFrame:
    """(a, b) under one bucket that may link, each pair once."""
    one, two = _sides(members, "bucket")
    return one.join(two, "bucket").filter((F.col("a") < F.col("b")) & _fits(plan)).select("a", "b")


def _rare(docs: DataFrame, classes: DataFrame, some: DataFrame, plan: Plan) -> DataFrame:
    """Pairs of the classes of `some` (cls, label, sig) that may link and share a rare shingle of both.

    The shingles of a class are in order of how many classes of `some` have them, and `at` is their place, from 1. Two
    sets of n and m that link share `least` = percent / (100 + percent) of n + m at least. The first they share has
    no more than n - at shared ones after it, so n - at + 1 >= least, and as much for m; in the smaller set, where least
    is 2 * percent / (100 + percent) of n or more, that leaves few places, and those of shingles that one class alone
    has meet nothing.
    """
    p = plan.percent
    wanted = written(some.select("cls").join(classes.select("cls", F.col("first_id").alias("doc_id")), "cls"), "wanted")
    sets = written(_sets(docs, wanted, plan), "sets")
    tokens = sets.select("cls", F.size("shingles").cast("long").alias("size"), F.explode("shingles").alias("token"))
    often = written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f")).filter("f > 1"), "often")
    own = Window.partitionBy("cls")
    at = F.col("size") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("f", "token"))
    left = (F.col("size") - F.col("at") + 1).alias("left")
    rare = written(tokens.join(often, "token").withColumn("at", at).select("cls", "token", left, "size").filter(F.col("left") * 100 >= F.col("size") * p).withColumn("small", F.col("left") * (100 + p) >= F.col("size") * 2 * p), "rare")
    several = rare.join(some.select("cls", "label"), "cls").groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("small").alias("small"))
    meet = written(several.filter("lo <> hi and small").select("token"), "meet")
    met = written(rare.join(meet, "token").select("cls", "token", "left", "small").join(some.join(classes.select("cls", "n", "bits"), "cls"), "cls"), "met")
    one, two = _sides(met, "token", "left", "small")
    c = F.col
    least = (F.least("left_a", "left_b") * (100 + p) >= p * (c("n_a") + c("n_b"))) & (F.struct("n_a", "a") < F.struct(c("n_b").alias("n_a"), c("b").alias("a")))
    hot = _hot(met, "token", plan)
    pairs = written(_dealt(one.filter("small_a"), two, "token", "a", hot, least & _fits(plan)).select("a", "b").distinct(), "pairs")
    discard(wanted, sets, often, rare, meet, met, *([hot] if hot is not None else []))
    return pairs


def _joined(docs: DataFrame, classes: DataFrame, pairs: DataFrame, links: DataFrame, labels: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """Links and components with those of the pairs that are confirmed."""
    pairs = written(pairs, "pairs")
    if pairs.isEmpty():
        return links, labels
    more = _confirmed(docs, classes, pairs, plan)
    discard(pairs)
    if more.isEmpty():
        return links, labels
    links = links.union(more)
    return links, components(links)


def _grouped(docs: DataFrame, plan: Plan) -> DataFrame:
    """The rows of near_duplicates, with the class and the label of the group, both null for an empty set."""
    every = written(signed(docs, plan), "signed")
    rows = written(every.select("doc_id", "n_shingles", "cls"), "rows")
    classes = written(every.filter("n_shingles > 0").groupBy("cls").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("class_size"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bits").alias("bits"), F.first("bands").alias("bands")), "classes")
    discard(every)
    spread = classes.select("cls", F.explode("bands").alias("bucket"))
    busy = written(spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "busy")
    plain = written(spread.join(busy, "bucket"), "members")  # both sides are plain reads, so that a hot bucket can be split
    weight = plain.groupBy("cls").agg(F.sum("c").alias("weight")).join(classes.select("cls", "sig"), "cls")
    members = written(plain.select("bucket", "cls").join(weight, "cls"), "members")
    discard(plain, busy)
    best = plan.percent / 100 - plan.slack
    alike = estimate(F.col("sa"), F.col("sb"), plan) >= best

    # each class and the foremost of its buckets' leaders
    first = written(_led(members, plan).filter(alike).groupBy("a").agg(F.max(F.struct("weight", "b")).alias("l")).select("a", F.col("l.b").alias("b")), "pairs")
    links = _confirmed(docs, classes, first, plan)
    labels = components(links)
    discard(first)

    # where a bucket still holds several components: its leader and the members of others
    open_ = _open(members, labels)
    links, labels = _joined(docs, classes, _led(open_, plan, "label").filter((F.col("la") != F.col("lb")) & alike).select("a", "b").distinct(), links, labels, plan)
    discard(open_)

    # and then members of different components: any two of a small bucket, those with a rare shingle in common of others
    rest = _open(members, labels)
    told = rest.filter(F.col("c") <= plan.few).select("bucket", "cls", "label", "sig").join(classes.select("cls", "n", "bits"), "cls")
    pairs = [_across(told, plan)]
    large = written(rest.filter(F.col("c") > plan.few).select("cls", "label", "sig").distinct(), "large")
    if not large.isEmpty():
        pairs.append(_rare(docs, classes, large, plan))
    links, labels = _joined(docs, classes, reduce(DataFrame.union, pairs).distinct(), links, labels, plan)
    discard(rest, large, members, *pairs[1:])

    # from classes to documents
    own = classes.select("cls", "first_id", "class_size").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    least = own.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = own.join(least, "label").select("cls", "component_id", "class_size", "label")
    out = rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("cls")).alias("cls")).join(named, "cls", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"), F.coalesce("class_size", F.lit(1)).alias("class_size"), "cls", "label")


def near_duplicates(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept, and class_size (documents with an equal set)."""
    return _grouped(docs, plan).drop("cls", "label")


def _keyed(docs: DataFrame, plan: Plan) -> DataFrame:
    """The rows with the class of their text in _cls, null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            flat, first = shingle_sets(data, offsets, plan.width)
            keys = pc.if_else(pa.array(np.diff(first) > 0), binary16(*set_keys(flat, first)), pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([*rows.columns, keys], names=[*rows.schema.names, "_cls"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("_cls", BinaryType())]))


def drop_near_duplicates(docs: DataFrame, plan: Plan = Plan(), once: bool = True) -> DataFrame:
    """The documents without near copies: of each component the row of its least doc_id stays.

    Rows with a null doc_id stay. Rows that share a doc_id are decided one by one, by the class of their
    text: of each component one of its rows stays, as does each row of an empty set. With `once`, one row
    of each doc_id is left of those.
    """
    found = written(_grouped(docs, plan), "dedup")
    gone = found.filter("not kept and doc_id is not null").select("doc_id")
    again = written(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again")
    named = written(gone.union(again).distinct(), "named")
    clear, held = _sieved(docs, named, plan)
    kept = held.join(gone, held["_id"] == gone["doc_id"], "left_anti").join(again, held["_id"] == again["doc_id"], "left_anti")
    out = clear.select("row").union(kept.select("row"))
    if again.isEmpty():
        return out.select("row.*")
    own = found.filter("kept and cls is not null").join(again, "doc_id", "left_semi")
    chosen = own.groupBy("label").agg(F.min(F.struct("doc_id", "cls")).alias("c")).select(F.col("c.doc_id").alias("_id"), F.col("c.cls").alias("_cls"))
    several = _keyed(held.join(again, held["_id"] == again["doc_id"], "left_semi"), plan)
    some = several.filter("_cls is not null").join(chosen, ["_id", "_cls"], "left_semi").dropDuplicates(["_id", "_cls"]).unionByName(several.filter("_cls is null"))
    if once:
        some = some.dropDuplicates(["_id"])
    return out.union(some.select("row")).select("row.*")
