"""Displacements between neighbouring tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.pixel import reliability

INFINITE_WIDTH = 1_000_000


def neighbours(stacks: DataFrame, axis: str, keys: tuple[str, ...] = ("xi", "yi", "zi")) -> DataFrame:
    """Pairs (a_<k>, b_<k>) of grid stacks that follow each other on an axis; a missing neighbour makes none."""
    others = [c for c in stacks.columns if c not in keys]
    a = stacks.select(*(F.col(c).alias(f"a_{c}") for c in (*keys, *others)), *(F.col(k).alias(f"_{k}") for k in keys))
    b = stacks.select(*(F.col(c).alias(f"b_{c}") for c in (*keys, *others)), *((F.col(k) - (1 if k == axis else 0)).alias(f"_{k}") for k in keys))
    return a.join(b, [f"_{k}" for k in keys]).drop(*[f"_{k}" for k in keys])


def offsets(spark, dy: int, dx: int) -> DataFrame:
    """All candidate offsets of a window, numbered in row order."""
    w = 2 * dx + 1
    return spark.range((2 * dy + 1) * w).select((F.floor(F.col("id") / w) - dy).cast("int").alias("dy"), (F.col("id") % w - dx).cast("int").alias("dx"), F.col("id").cast("int").alias("ord"))


def pearson(a: Column, b: Column) -> Column:
    """Correlation of the rows where both are there; 0 where one side is flat."""
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.coalesce(F.when(spread > 0, F.covar_pop(a, b) / spread), F.lit(0.0))


def correlations(a: DataFrame, b: DataFrame, cand: DataFrame, key: str, dark: float | None = None) -> DataFrame:
    """(key, ord, dy, dx, score, n): Pearson correlation of two planes (key, y, x, v) at each offset of b.

    Each pixel of b goes to every candidate and meets its partner in a by an equi-join. With `dark`, only pairs above
    it count, and an offset with fewer than sqrt(pairs) of them scores nothing. A flat overlap scores 0.
    """
    moved = b.select(key, (F.col("y")).alias("by"), F.col("x").alias("bx"), F.col("v").cast("double").alias("bv")).crossJoin(F.broadcast(cand))  # the candidates are a window of fixed size
    pairs = moved.withColumn("y", F.col("by") + F.col("dy")).withColumn("x", F.col("bx") + F.col("dx")).join(a.select(key, "y", "x", F.col("v").cast("double").alias("av")), [key, "y", "x"])
    if dark is None:
        out = pairs.groupBy(key, "ord", "dy", "dx").agg(pearson(F.col("av"), F.col("bv")).alias("score"), F.count(F.lit(1)).alias("n"))
    else:
        lit = (F.col("av") > dark) & (F.col("bv") > dark)
        out = pairs.groupBy(key, "ord", "dy", "dx").agg(pearson(F.when(lit, F.col("av")), F.when(lit, F.col("bv"))).alias("score"), F.count(F.lit(1)).alias("all"), F.count_if(lit).alias("n")).filter(F.col("n") >= F.sqrt(F.col("all"))).drop("all")
    return out


def best_offset(scores: DataFrame, key: str, digits: int | None = None) -> DataFrame:
    """The offset of the greatest score; the first in order of ties."""
    s = F.col("score") if digits is None else F.round("score", digits)
    best = scores.withColumn("_s", s).groupBy(key).agg(F.max_by(F.struct("dy", "dx", "_s"), F.struct(F.col("_s"), -F.col("ord"))).alias("b"))
    return best.select(key, "b.dy", "b.dx", F.col("b._s").alias("score"))


def peak_width(scores: DataFrame, key: str, axis: str, fraction: float = 0.8) -> DataFrame:
    """Distance from the peak, along one axis through it, to the first place at or under a fraction of it; the wider of the
    two sides, and INFINITE_WIDTH if neither falls so far."""
    other = "dx" if axis == "dy" else "dy"
    peak = best_offset(scores, key).select(key, F.col("dy").alias("py"), F.col("dx").alias("px"), F.col("score").alias("peak"))
    line = scores.join(peak, key).filter(F.col(other) == F.col("py" if other == "dy" else "px"))
    d = F.col(axis) - F.col("py" if axis == "dy" else "px")
    low = F.col("score") <= fraction * F.col("peak")
    return line.groupBy(key).agg(F.min(F.when(low & (d > 0), d)).alias("after"), F.min(F.when(low & (d < 0), -d)).alias("before")).select(key, F.coalesce(F.greatest("after", "before"), F.lit(INFINITE_WIDTH)).cast("int").alias("width"))


def combine(a: dict[str, Column], b: dict[str, Column], least_peak: float = 0.10) -> Column:
    """Two estimates (displ, peak, width) of one displacement as one struct.

    Both valid and close: their mean weighted by peak, and so the peak; both valid and apart: the better ratio of peak to
    width, the second of ties; one valid: that one; none: displacement 0, peak 0 and no width. A width of 1 counts as infinite.
    """
    fix = lambda w: F.when(w == 1, INFINITE_WIDTH).otherwise(w)
    wa, wb = fix(a["width"]), fix(b["width"])
    ok = lambda e, w: (e["peak"] >= least_peak) & (w < INFINITE_WIDTH)
    est = lambda d, p, w: F.struct(d.cast("int").alias("displ"), p.cast("double").alias("peak"), w.cast("int").alias("width"))
    near = F.abs(a["displ"] - b["displ"]) < F.least(wa, wb)
    mean = F.floor((a["displ"] * a["peak"] + b["displ"] * b["peak"]) / (a["peak"] + b["peak"]) + 0.5)
    both = F.when(near, est(mean, (a["peak"] * a["peak"] + b["peak"] * b["peak"]) / (a["peak"] + b["peak"]), F.greatest(wa, wb))).when(a["peak"] / wa > b["peak"] / wb, est(a["displ"], a["peak"], wa)).otherwise(est(b["displ"], b["peak"], wb))
    return F.when(ok(a, wa) & ok(b, wb), both).when(ok(a, wa), est(a["displ"], a["peak"], wa)).when(ok(b, wb), est(b["displ"], b["peak"], wb)).otherwise(est(F.lit(0), F.lit(0.0), F.lit(INFINITE_WIDTH)))


def sub_volumes(slices: int, step: int) -> list[tuple[int, int]]:
    """z ranges for alignment: near-equal parts of about `step` planes, the first ones a plane longer."""
    n = -(-slices // step)
    base, more = divmod(slices, n)
    ends = [0]
    for k in range(n):
        ends.append(ends[-1] + base + (k < more))
    return list(zip(ends[:-1], ends[1:], strict=True))


def project(edges: DataFrame, keys: list[str], pairs: DataFrame | None = None) -> DataFrame:
    """The most reliable displacement of each edge and direction, to nine digits; the earliest layer of ties, and of one layer
    the greatest values.

    pairs (keys, default_displ, inv_width): edges that must be there; one without any displacement gets the nominal one,
    with no peak, the invalid width and reliability 0.
    """
    rel = reliability(F.col("peak").cast("double"), F.col("width"), F.col("inv_width"))
    cells = [c for c in edges.columns if c not in keys]
    best = edges.withColumn("_r", rel).groupBy(*keys).agg(F.max(F.struct(F.round("_r", 9).alias("_k"), (-F.col("layer")).alias("_l"), *cells, "_r")).alias("b"))
    out = best.select(*keys, *(F.col(f"b.{c}") for c in cells), F.col("b._r").alias("reliability"))
    if pairs is None:
        return out
    none = pairs.join(out.select(*keys), keys, "left_anti")
    told = {"displ": F.col("default_displ"), "default_displ": F.col("default_displ"), "inv_width": F.col("inv_width"), "width": F.col("inv_width"), "peak": F.lit(0.0)}
    return out.unionByName(none.select(*keys, *(told.get(c, F.lit(None)).cast(edges.schema[c].dataType).alias(c) for c in cells), F.lit(0.0).alias("reliability")))


def displacement_of(pairs: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Each pair with its displacement; a pair with none or with several fails."""
    cells = [c for c in edges.columns if c not in keys]
    told = edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *(F.first(c).alias(c) for c in cells))
    wrong = F.raise_error(F.concat(F.lit("a pair has "), F.coalesce("_n", F.lit(0)).cast("string"), F.lit(" displacements")))
    first = cells[0]
    return pairs.join(told, keys, "left").withColumn(first, F.when(F.coalesce("_n", F.lit(0)) == 1, F.col(first)).otherwise(wrong.cast(edges.schema[first].dataType))).drop("_n")


def threshold(projected: DataFrame, least: float) -> DataFrame:
    """Unreliable displacements fall back to the nominal one with reliability 0."""
    weak = F.col("reliability") < least
    return projected.withColumn("displ", F.when(weak, F.col("default_displ")).otherwise(F.col("displ"))).withColumn("peak", F.when(weak, F.lit(0.0)).otherwise(F.col("peak"))).withColumn("width", F.when(weak, F.col("inv_width")).otherwise(F.col("width"))).withColumn("reliability", F.when(weak, 0.0).otherwise(F.col("reliability")))


def stitchable(edges: DataFrame, tile: list[str], least: float) -> DataFrame:
    """Tiles with a neighbour that is reliable enough in some direction."""
    return edges.groupBy(*tile).agg((F.max("reliability") >= least).alias("stitchable"))


def stitchable_range(tiles: DataFrame, row: str, col: str) -> DataFrame:
    """The tiles without the outer rows and columns that hold no stitchable tile; none if no tile is stitchable."""
    ends = tiles.filter("stitchable").agg(F.min(row).alias("_r0"), F.max(row).alias("_r1"), F.min(col).alias("_c0"), F.max(col).alias("_c1"))
    inside = F.col(row).between(F.col("_r0"), F.col("_r1")) & F.col(col).between(F.col("_c0"), F.col("_c1"))
    return tiles.crossJoin(F.broadcast(ends)).filter(inside).select(tiles.columns)


def best_alignment(records: DataFrame, keys: list[str]) -> DataFrame:
    """Offsets of the greatest score above 0, the first of ties; zeros where there is none."""
    good = F.col("score") > 0
    best = records.groupBy(*keys).agg(F.max_by(F.when(good, F.struct("score", "xoff", "yoff", "zoff")), F.when(good, F.struct(F.col("score"), -F.col("z")))).alias("b"))
    return best.select(*keys, *(F.coalesce(F.col(f"b.{c}"), F.lit(0).cast(records.schema[c].dataType)).alias(c) for c in ("score", "xoff", "yoff", "zoff")))


def consensus_z(records: DataFrame, least: float, support: int, columns: int) -> DataFrame:
    """Median z offset of each height over scores above `least`, 0 without enough support; an offset of -1 counts as 0, and
    every record once for each of the columns."""
    good = records.filter(F.col("score") > least).withColumn("zoff", F.when(F.col("zoff") == -1, 0).otherwise(F.col("zoff")))
    return good.groupBy("z").agg((F.count(F.lit(1)) * columns).alias("n"), F.percentile("zoff", F.lit(0.5)).alias("m")).select("z", F.when(F.col("n") > support, F.col("m")).otherwise(0.0).alias("zoff"))


def row_delta(records: DataFrame, support: int) -> DataFrame:
    """Median z step of each row with at least `support` records, else 0."""
    return records.groupBy("yidx").agg(F.count(F.lit(1)).alias("n"), F.percentile("zoff", F.lit(0.5)).alias("m")).select("yidx", F.when(F.col("n") >= support, F.col("m")).otherwise(0.0).alias("zoff"))


def next_round(records: DataFrame, least: float, stds: float = 3.0, factor: float = 1.25, decimate: int = 1) -> DataFrame:
    """One row: how far the next round must look in x, y and z (x_slop ..), and the drift it starts from (xoff_x: of x, from
    alignments along x).

    records: axis (x, y or z: along which the two tiles are neighbours), score, xoff, yoff, zoff. Offsets of a score of at
    least `least` count, less those beyond `stds` deviations from their median; a slop is the greatest deviation from the
    median of what is left, of the three axes, times `factor`, cut to a whole number, and the decimation.
    """
    names = ("xoff", "yoff", "zoff")
    long = records.filter(F.col("score") >= least).select("axis", F.explode(F.array(*(F.struct(F.lit(n).alias("off"), F.col(n).cast("double").alias("v")) for n in names))).alias("o")).select("axis", "o.off", "o.v")
    keys = ["axis", "off"]
    ends = long.groupBy(*keys).agg(F.percentile("v", F.lit(0.5)).alias("m"), (F.stddev_pop("v") * stds).alias("s"))  # nine rows at most
    kept = long.join(F.broadcast(ends), keys).filter((F.col("v") >= F.col("m") - F.col("s")) & (F.col("v") <= F.col("m") + F.col("s")))
    each = kept.groupBy(*keys).agg(F.percentile("v", F.lit(0.5)).alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    reach = F.greatest(F.col("hi") - F.col("m"), F.col("m") - F.col("lo"))
    slops = [((F.max(F.when(F.col("off") == n, reach)) * factor).cast("int") + decimate).alias(f"{n[0]}_slop") for n in names]
    drift = [F.max(F.when((F.col("off") == n) & (F.col("axis") == a), F.col("m"))).cast("int").alias(f"{n}_{a}") for a in "xyz" for n in names]
    return each.agg(*slops, *drift)


def cheapest_path(edges: DataFrame) -> DataFrame:
    """The best of the direct step in z and four detours over a neighbour column, by total (1 - score).

    edges: x, y, z, dx, dy, dz, score, zoff, xoff, yoff: the alignment of (x, y, z) with (x+dx, y+dy, z+dz).
    Only paths whose z offset isn't positive and whose cost is under 1000 count; the first of ties wins.
    """
    up = edges.filter("dx = 0 and dy = 0 and dz = 1")
    flat = edges.filter("dz = 0")
    both = flat.select("x", "y", "z", "dx", "dy", "score", "zoff").unionByName(flat.select((F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"), "z", (-F.col("dx")).alias("dx"), (-F.col("dy")).alias("dy"), "score", (-F.col("zoff")).alias("zoff")))
    paths = up.select("x", "y", "z", F.lit(0).alias("ord"), (1 - F.col("score")).alias("cost"), "zoff")
    for k, (dx, dy) in enumerate(((-1, 0), (1, 0), (0, -1), (0, 1)), 1):
        out = both.filter((F.col("dx") == dx) & (F.col("dy") == dy)).alias("o")
        mid = up.alias("m")
        back = both.filter((F.col("dx") == -dx) & (F.col("dy") == -dy)).alias("b")
        way = out.join(mid, (F.col("m.x") == F.col("o.x") + dx) & (F.col("m.y") == F.col("o.y") + dy) & (F.col("m.z") == F.col("o.z")))
        way = way.join(back, (F.col("b.x") == F.col("o.x") + dx) & (F.col("b.y") == F.col("o.y") + dy) & (F.col("b.z") == F.col("o.z") + 1))
        paths = paths.unionByName(way.select(F.col("o.x"), F.col("o.y"), F.col("o.z"), F.lit(k).alias("ord"), (3 - F.col("o.score") - F.col("m.score") - F.col("b.score")).alias("cost"), (F.col("o.zoff") + F.col("m.zoff") + F.col("b.zoff")).alias("zoff")))
    ok = paths.filter("zoff <= 0 and cost < 1000")
    return ok.groupBy("x", "y", "z").agg(F.min_by(F.struct("ord", "cost", "zoff"), F.struct("cost", "ord")).alias("p")).select("x", "y", "z", "p.ord", "p.cost", "p.zoff")


def restore_profile(px: DataFrame, axis: str, keys: list[str]) -> DataFrame:
    """Even out intensity along an axis: each pixel over its profile's mean, scaled by the lesser of the overall mean and
    one over the greatest ratio."""
    profile = px.groupBy(*keys, axis).agg(F.avg("v").alias("p"))
    whole = px.groupBy(*keys).agg(F.avg("v").alias("m"))
    ratio = px.join(profile, [*keys, axis]).join(whole, keys).withColumn("r", F.col("v") / F.when(F.col("p") > 0, F.col("p")).otherwise(1e-5))
    top = ratio.groupBy(*keys).agg(F.max("r").alias("t"))
    return ratio.join(top, keys).withColumn("v", F.col("r") * F.least(F.col("m"), 1 / F.when(F.col("t") > 0, F.col("t")).otherwise(1.0))).drop("p", "m", "r", "t")


def layers(edges: DataFrame) -> DataFrame:
    """Placement of layers from the displacement to the one before (layer, v, h, d): running sums, V and H from their minimum."""
    w, all_ = Window.orderBy("layer").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    out = edges.select("layer", *(F.sum(c).over(w).alias(c) for c in ("v", "h", "d")))
    return out.select("layer", *((F.col(c) - F.least(F.lit(0), F.min(c).over(all_))).alias(c) for c in ("v", "h")), "d", *((F.greatest(F.lit(0), F.max(c).over(all_)) - F.least(F.lit(0), F.min(c).over(all_))).alias(f"grow_{c}") for c in ("v", "h")))


def most_reliable_layer(edges: DataFrame, keys: list[str]) -> DataFrame:
    """The layer of the greatest total reliability of each edge; the last one of ties."""
    total = edges.groupBy(*keys, "layer").agg(F.sum("reliability").alias("total"))
    return total.groupBy(*keys).agg(F.max(F.struct("total", "layer")).alias("b")).select(*keys, "b.layer", "b.total")
