"""Placing stacks and merging what overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.scratch import written
from .spatial import overlap_join


def offset_chain(displacements: DataFrame) -> DataFrame:
    """(row, col, y, x, z) of stacks from the displacements to their first neighbours.

    displacements: row, col, west_v, west_h, west_d, north_v, north_h, north_d. Row 0 adds up west displacements,
    further rows north ones; what is missing is 0; the least offsets become 0.
    """
    west = Window.partitionBy("row").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    north = Window.partitionBy("col").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy()
    out = displacements
    for c, d in (("y", "v"), ("x", "h"), ("z", "d")):
        step_w = F.when((F.col("row") == 0) & (F.col("col") > 0), -F.coalesce(f"west_{d}", F.lit(0))).otherwise(0)
        out = out.withColumn(f"_w{c}", F.sum(step_w).over(west))
    for c, d in (("y", "v"), ("x", "h"), ("z", "d")):
        step_n = F.when(F.col("row") == 0, F.col(f"_w{c}")).otherwise(-F.coalesce(f"north_{d}", F.lit(0)))
        out = out.withColumn(f"_s{c}", F.sum(step_n).over(north))
    return out.select("row", "col", *((F.col(f"_s{c}") - F.min(f"_s{c}").over(all_)).cast("long").alias(c) for c in ("y", "x", "z")))


def scanner_z(stacks: DataFrame) -> DataFrame:
    """z0 and z1 of chained stacks (x, y, z, depth, offset, row_offset): each begins at the end of the one before plus its
    offset; row offsets add up along x of a row and shift all of a stack."""
    along = Window.partitionBy("x", "y").orderBy("z").rowsBetween(Window.unboundedPreceding, 0)
    rows = stacks.groupBy("y", "x").agg(F.first("row_offset").alias("ro")).withColumn("base", F.sum("ro").over(Window.partitionBy("y").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)))
    end = F.sum(F.col("depth") + F.col("offset")).over(along)
    return stacks.withColumn("_end", end).join(rows.select("y", "x", "base"), ["y", "x"]).withColumn("z1", F.col("_end") + F.col("base")).withColumn("z0", F.col("z1") - F.col("depth")).drop("_end", "base")


def scanner_x(columns: DataFrame, x_off_y: Column | float) -> DataFrame:
    """x0 of stacks (x, y, x_off_x): offsets of the columns before, less the row's skew."""
    before = Window.partitionBy("y").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    skew = x_off_y if isinstance(x_off_y, Column) else F.lit(x_off_y)
    return columns.withColumn("x0", F.coalesce(F.sum("x_off_x").over(before), F.lit(0)) - F.col("y") * skew)


def rebased(boxes: DataFrame) -> DataFrame:
    """Corners less the least ones."""
    all_ = Window.partitionBy()
    out = boxes
    for c in ("x", "y", "z"):
        low = F.min(f"{c}0").over(all_)
        out = out.withColumn(f"_{c}", low)
    for c in ("x", "y", "z"):
        out = out.withColumn(f"{c}0", F.col(f"{c}0") - F.col(f"_{c}")).withColumn(f"{c}1", F.col(f"{c}1") - F.col(f"_{c}"))
    return out.drop("_x", "_y", "_z")


def mosaic_max(px: DataFrame) -> DataFrame:
    """The greatest value of all stacks at each place; px: (stack, z, y, x, v) in the volume's coordinates."""
    return px.groupBy("z", "y", "x").agg(F.greatest(F.lit(0), F.max("v")).alias("v"))


def edge_rules(stacks: DataFrame, size: int) -> DataFrame:
    """Pairs (s_: a stack, o_: another that meets it) with the box they share (x0 .. z1), which faces of either lie inside the
    other (s_xmin ..), and the most that a distance to those may be, `far`.

    `far` is the least extent of the shared box along x and y, of those where neither face agrees; if both have one that
    does, the extent along z, and only then z faces count; infinite if one agrees there as well.
    stacks: stack, x0, x1, y0, y1, z0, z1.
    """
    c = F.col
    side = lambda p: stacks.select(c("stack").alias(f"{p}stack"), *(c(f"{a}{k}").alias(f"{p}{a}{k}") for a in "xyz" for k in (0, 1)))
    pairs = overlap_join(side("s_"), side("o_"), "s_", "o_", size).filter("s_stack <> o_stack")
    shared = pairs.select("*", *(f(f"s_{a}{k}", f"o_{a}{k}").alias(f"{a}{k}") for a in "xyz" for k, f in ((0, F.greatest), (1, F.least))))
    apart = lambda a: (c(f"s_{a}0") != c(f"o_{a}0")) & (c(f"s_{a}1") != c(f"o_{a}1"))
    extent = lambda a: F.when(apart(a), (c(f"{a}1") - c(f"{a}0")).cast("double"))
    flat = ~(apart("x") | apart("y"))
    far = F.coalesce(F.when(flat, extent("z")).otherwise(F.least(extent("x"), extent("y"))), F.lit(float("inf")))
    flags = []
    for p, q in (("s_", "o_"), ("o_", "s_")):
        for a in "xyz":
            counts = flat & apart("z") if a == "z" else F.lit(True)
            flags += [(counts & (c(f"{q}{a}1") > c(f"{p}{a}0")) & (c(f"{p}{a}0") > c(f"{q}{a}0"))).alias(f"{p}{a}min"), (counts & (c(f"{q}{a}0") < c(f"{p}{a}1")) & (c(f"{p}{a}1") < c(f"{q}{a}1"))).alias(f"{p}{a}max")]
    return shared.select("*", far.alias("far"), *flags)


def _greatest_distance(p: str) -> Column:
    """The greatest distance inside the shared box: distances along the axes are independent, so that it is the least of theirs."""
    c, far = F.col, F.lit(float("inf"))
    out = [c("far")]
    for a in "xyz":
        lo, hi = c(f"{a}0"), c(f"{a}1")
        n = (hi - lo).cast("double")
        out.append(F.when(c(f"{p}{a}min") & c(f"{p}{a}max"), F.floor((n + 1) / 2).cast("double")).when(c(f"{p}{a}min") | c(f"{p}{a}max"), n).otherwise(far))
    return F.least(*out)


def mosaic_cosine(px: DataFrame, stacks: DataFrame, size: int, most_broadcast: int = 500_000) -> DataFrame:
    """Weighted mean of overlapping stacks: against each overlapped neighbour a pixel weighs d^2 / (d^2 + o^2), with d and o
    its distances (from 1) to the nearest cut edge of its own stack and of the neighbour; weights multiply. In doubles.

    Where one of the two has no cut edge, its distance is the greatest of the other's; where neither has, both weigh a half.
    A stack's neighbours travel as one array: broadcast up to `most_broadcast` stacks, by a shuffle beyond, so that the
    pixels move once, to their place.
    """
    c = F.col
    pairs = edge_rules(stacks, size).select("*", _greatest_distance("s_").alias("s_most"), _greatest_distance("o_").alias("o_most"))
    rule = F.struct(*(f"{a}{k}" for a in "xyz" for k in (0, 1)), "far", "s_most", "o_most", *(f"{p}{a}{e}" for p in ("s_", "o_") for a in "xyz" for e in ("min", "max")))
    near = written(pairs.groupBy(c("s_stack").alias("stack")).agg(F.collect_list(rule).alias("_near")), "near")  # a stack has few neighbours
    near = F.broadcast(near) if near.count() <= most_broadcast else near.hint("merge")
    far = F.lit(float("inf"))

    def distance(r: Column, p: str) -> Column:
        ends = [(F.when(r[f"{p}{a}min"], c(a) - r[f"{a}0"] + 1).cast("double"), F.when(r[f"{p}{a}max"], r[f"{a}1"] - c(a)).cast("double")) for a in "xyz"]
        return F.least(r["far"], *(F.coalesce(x, far) for e in ends for x in e))

    def weight(r: Column) -> Column:
        inside = F.lit(True)
        for a in "xyz":
            inside = inside & (c(a) >= r[f"{a}0"]) & (c(a) < r[f"{a}1"])
        d = F.when(r["s_most"] == far, r["o_most"]).otherwise(distance(r, "s_"))
        o = F.when(r["s_most"] == far, distance(r, "o_")).when(r["o_most"] == far, r["s_most"]).otherwise(distance(r, "o_"))
        both = (r["s_most"] == far) & (r["o_most"] == far)
        return F.when(~inside, 1.0).when(both, 0.5).otherwise(d * d / (d * d + o * o))

    w = F.coalesce(F.aggregate("_near", F.lit(1.0), lambda acc, r: acc * weight(r)), F.lit(1.0))
    each = px.select("stack", "z", "y", "x", "v").join(near, "stack", "left").select("z", "y", "x", "v", w.alias("w"))
    return each.groupBy("z", "y", "x").agg((F.sum(c("v") * c("w")) / F.sum("w")).alias("v"))


def sinusoidal(left: Column, right: Column, angle: Column) -> Column:
    """Cosine cross-fade of two pixels; where one is 0 the other counts alone."""
    w = (F.cos(angle) + 1) / 2
    return F.when((left == 0) | (right == 0), F.greatest(left, right)).otherwise(w * left + (1 - w) * right)


def no_blend(left: Column, right: Column, angle: Column) -> Column:
    return F.when(angle <= F.lit(1.5707963267948966), left).otherwise(right)


def margin_blend(left: Column, right: Column, angle: Column, step: Column) -> Column:
    """As no_blend, with a line of ones at the first place past the middle, unless a place lies on the middle itself."""
    middle = F.lit(1.5707963267948966)
    return F.when((angle > middle) & (angle - step < middle), 1).otherwise(no_blend(left, right, angle))


def enhanced_blend(left: Column, right: Column, angle: Column) -> Column:
    """The cross-fade of `sinusoidal` with its sides exchanged, and blank places counted."""
    w = (F.cos(angle) + 1) / 2
    return w * right + (1 - w) * left


#: By name: functions of left, right, angle and the angle between two places.
BLENDS = {"sinusoidal": lambda a, b, t, _: sinusoidal(a, b, t), "none": lambda a, b, t, _: no_blend(a, b, t), "margin": margin_blend, "enhanced": lambda a, b, t, _: enhanced_blend(a, b, t)}


def stripe(px: DataFrame, tiles: DataFrame, blend: str = "sinusoidal") -> DataFrame:
    """One row of tiles merged left to right by neighbouring pairs: (row, y, x, v).

    tiles: row, col, x0, x1 (each tile overlaps only the next). px: row, col, y, x, v.
    """
    w = Window.partitionBy("row").orderBy("col")
    t = tiles.withColumn("_next", F.lead("x0").over(w)).withColumn("_last", F.lag("x1").over(w))
    p = px.join(t.select("row", "col", "x0", "x1", "_next", "_last"), ["row", "col"])
    right = F.coalesce(F.col("x") < F.col("_last"), F.lit(False))
    lo, hi = F.when(right, F.col("x0")).otherwise(F.col("_next")), F.when(right, F.col("_last")).otherwise(F.col("x1"))
    step = F.when(hi - lo > 1, F.lit(3.141592653589793) / (hi - lo - 1)).otherwise(F.lit(0.0))
    p = p.withColumn("_angle", F.when(right | F.coalesce(F.col("x") >= F.col("_next"), F.lit(False)), (F.col("x") - lo) * step)).withColumn("_right", right).withColumn("_step", step)
    both = p.groupBy("row", "y", "x").agg(F.max(F.when(~F.col("_right"), F.col("v"))).alias("l"), F.max(F.when(F.col("_right"), F.col("v"))).alias("r"), F.max("_angle").alias("a"), F.max("_step").alias("s"))
    return both.select("row", "y", "x", F.when(F.col("l").isNull(), F.col("r")).when(F.col("r").isNull(), F.col("l")).otherwise(BLENDS[blend](F.col("l"), F.col("r"), F.col("a"), F.col("s"))).alias("v"))


def volume_dims(stacks: DataFrame, height: int, width: int, slices: int) -> DataFrame:
    """V and H from the outermost tiles; D from the greatest start to the least end."""
    return stacks.agg(F.min("abs_v").alias("v0"), (F.max("abs_v") + height).alias("v1"), F.min("abs_h").alias("h0"), (F.max("abs_h") + width).alias("h1"), F.max("abs_d").alias("d0"), (F.min("abs_d") + slices).alias("d1"))


def diagnostic(px: DataFrame, stacks: list[int]) -> DataFrame:
    """A channel for each of up to three stacks."""
    return px.groupBy("z", "y", "x").agg(*(F.coalesce(F.max(F.when(F.col("stack") == s, F.col("v"))), F.lit(0)).alias(f"c{k}") for k, s in enumerate(stacks[:3])))


def output_tiles(size: int, slice_: int, least: int = 100) -> list[tuple[int, int]]:
    """Near-equal ranges of at most `slice_` places, never under `least` wide."""
    n = -(-size // max(slice_, least))
    base, more = divmod(size, n)
    ends = [0]
    for k in range(n):
        ends.append(ends[-1] + base + (k < more))
    return list(zip(ends[:-1], ends[1:], strict=True))
