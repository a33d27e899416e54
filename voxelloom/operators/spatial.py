"""Joins of boxes, points, blocks and regions on equal bins, with the exact condition after them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geometry import AXES, intersects


def _bins(df: DataFrame, prefix: str, axes: tuple[str, ...], size: int) -> DataFrame:
    """A row for each bin that a half-open box meets; empty boxes meet none."""
    for c in axes:
        lo, hi = F.floor(F.col(f"{prefix}{c}0") / size), F.floor((F.col(f"{prefix}{c}1") - 1) / size)
        df = df.withColumn(f"_{prefix}{c}", F.explode(F.when(hi >= lo, F.sequence(lo, hi))))
    return df


def overlap_join(a: DataFrame, b: DataFrame, pa: str, pb: str, size: int, axes: tuple[str, ...] = AXES, keys: list[str] | None = None) -> DataFrame:
    """Pairs of boxes (columns <prefix>x0..) that share a voxel, each once, by an equi-join on bins.

    A pair is reported by the bin of the shared box's low corner only, so that no distinct is needed. `keys`
    pairs (same names with both prefixes) must agree as well.
    """
    left, right = _bins(a, pa, axes, size), _bins(b, pb, axes, size)
    on = F.lit(True)
    for c in axes:
        on = on & (F.col(f"_{pa}{c}") == F.col(f"_{pb}{c}"))
    for k in keys or []:
        on = on & (F.col(f"{pa}{k}") == F.col(f"{pb}{k}"))
    owner = F.lit(True)
    for c in axes:
        owner = owner & (F.col(f"_{pa}{c}") == F.floor(F.greatest(F.col(f"{pa}{c}0"), F.col(f"{pb}{c}0")) / size))
    return left.join(right, on).filter(intersects(pa, pb, axes) & owner).drop(*[f"_{p}{c}" for p in (pa, pb) for c in axes])


def bounding_box(boxes: DataFrame, axes: tuple[str, ...] = AXES) -> DataFrame:
    return boxes.agg(*(f(f"{c}{k}").alias(f"{c}{k}") for c in axes for k, f in ((0, F.min), (1, F.max))))


def block_grid(shape: dict[str, int], block: dict[str, int], spark) -> DataFrame:
    """Blocks of a volume (1-based inclusive corners p1, p2 in x, y, z), numbered with x fastest."""
    out = spark.range(1).select()
    for c in ("z", "y", "x"):
        n = -(-shape[c] // block[c])
        out = out.withColumn(f"i{c}", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    for c in AXES:
        out = out.withColumn(f"{c}1", F.col(f"i{c}") * block[c] + 1).withColumn(f"{c}2", F.least(F.lit(shape[c]), (F.col(f"i{c}") + 1) * block[c]))
    nx, ny = -(-shape["x"] // block["x"]), -(-shape["y"] // block["y"])
    return out.withColumn("block", F.col("ix") + nx * (F.col("iy") + ny * F.col("iz")))


def halo(px: DataFrame, block: dict[str, int], pad: dict[str, int], shape: dict[str, int]) -> DataFrame:
    """Each voxel once for every block whose padded extent holds it: (bz, by, bx, z, y, x, v)."""
    for c in ("z", "y", "x"):
        last = -(-shape[c] // block[c]) - 1
        lo = F.greatest(F.lit(0), F.floor((F.col(c) - pad[c]) / block[c]).cast("int"))
        hi = F.least(F.lit(last), F.floor((F.col(c) + pad[c]) / block[c]).cast("int"))
        px = px.withColumn(f"b{c}", F.explode(F.sequence(lo, hi)))
    return px


def coverage_faults(blocks: DataFrame, shape: dict[str, int]) -> DataFrame:
    """(fault, n): corners out of order or bounds, planes of z that no block covers, pairs that overlap by more than a voxel on
    every axis, and voxels of the volume's six faces that no block covers."""
    bad = F.lit(False)
    for c in AXES:
        bad = bad | (F.col(f"{c}1") < 1) | (F.col(f"{c}2") > shape[c]) | (F.col(f"{c}1") > F.col(f"{c}2"))
    corners = blocks.filter(bad).agg(F.lit("corners").alias("fault"), F.count(F.lit(1)).alias("n"))
    covered = blocks.select(F.explode(F.sequence("z1", "z2")).alias("z")).distinct()
    gaps = blocks.sparkSession.range(1, shape["z"] + 1).withColumnRenamed("id", "z").join(covered, "z", "left_anti").agg(F.lit("uncovered z").alias("fault"), F.count(F.lit(1)).alias("n"))
    side = lambda p: blocks.select(F.col("block").alias(f"{p}block"), *(e for c in AXES for e in (F.col(f"{c}1").alias(f"{p}{c}0"), (F.col(f"{c}2") + 1).alias(f"{p}{c}1"))))
    size = max(2, max(shape.values()) // 16)
    deep = F.lit(True)
    for c in AXES:
        deep = deep & (F.least(f"a_{c}1", f"b_{c}1") - F.greatest(f"a_{c}0", f"b_{c}0") > 1)
    pairs = overlap_join(side("a_"), side("b_"), "a_", "b_", size).filter(F.col("a_block") < F.col("b_block")).filter(deep).agg(F.lit("overlap").alias("fault"), F.count(F.lit(1)).alias("n"))
    faces = face_gaps(blocks, shape).agg(F.lit("face gaps").alias("fault"), F.sum("n").alias("n"))
    return corners.unionAll(gaps).unionAll(pairs).unionAll(faces)


def face_gaps(blocks: DataFrame, shape: dict[str, int]) -> DataFrame:
    """(axis, place, n): how many voxels of the first and the last plane across each axis no block covers.

    Blocks become runs along the plane's second direction, one for each row, and the holes between sorted runs are
    added up, so that no voxel is made a row.
    """
    spark, out = blocks.sparkSession, None
    for axis in AXES:
        u, v = [a for a in AXES if a != axis]
        planes = spark.range(1).select(F.lit(axis).alias("axis"), F.explode(F.array(F.lit(1), F.lit(shape[axis]))).alias("place")).distinct()
        rows = planes.withColumn("u", F.explode(F.sequence(F.lit(1), F.lit(shape[u]))))
        runs = blocks.join(F.broadcast(planes), F.col("place").between(F.col(f"{axis}1"), F.col(f"{axis}2"))).select("axis", "place", F.explode(F.sequence(F.greatest(F.lit(1), f"{u}1"), F.least(F.lit(shape[u]), f"{u}2"))).alias("u"), F.greatest(F.lit(1), f"{v}1").alias("a"), F.least(F.lit(shape[v]), f"{v}2").alias("b"))  # two planes an axis
        before = F.coalesce(F.max("b").over(Window.partitionBy("axis", "place", "u").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        holes = runs.withColumn("hole", F.greatest(F.lit(0), F.col("a") - before - 1)).groupBy("axis", "place", "u").agg((F.sum("hole") + F.greatest(F.lit(0), shape[v] - F.max("b"))).alias("hole"))
        one = rows.join(holes, ["axis", "place", "u"], "left").groupBy("axis", "place").agg(F.sum(F.coalesce("hole", F.lit(shape[v]))).cast("long").alias("n"))
        out = one if out is None else out.unionAll(one)
    return out


def points_in_regions(points: DataFrame, edges: DataFrame, key: list[str], bin_size: float) -> DataFrame:
    """(key, region) of points inside polygons, by the parity of the edges that a ray to greater x crosses.

    points: key, x, y. edges: region, x1, y1, x2, y2. Both sides meet on bins of y, which a ray along x stays in.
    """
    lo, hi = F.floor(F.least("y1", "y2") / bin_size), F.floor(F.greatest("y1", "y2") / bin_size)
    e = edges.filter(F.col("y1") != F.col("y2")).withColumn("_b", F.explode(F.sequence(lo, hi)))
    p = points.withColumn("_b", F.floor(F.col("y") / bin_size))
    cross = ((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & (F.col("x") < (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    return p.join(e, "_b").filter(cross).groupBy(*key, "region").agg((F.count(F.lit(1)) % 2).alias("odd")).filter("odd = 1").drop("odd")


def points_in_meshes(points: DataFrame, triangles: DataFrame, key: list[str], bin_size: float) -> DataFrame:
    """(key, region) of points inside closed meshes: parity of the triangles that a ray to greater z pierces.

    triangles: region, ax, ay, az, bx, by, bz, cx, cy, cz. Points and the triangles' shadows meet on bins of x and y.
    """
    t = triangles
    for c in ("x", "y"):
        corners = [f"a{c}", f"b{c}", f"c{c}"]
        t = t.withColumn(f"_{c}", F.explode(F.sequence(F.floor(F.least(*corners) / bin_size), F.floor(F.greatest(*corners) / bin_size))))
    p = points.withColumn("_x", F.floor(F.col("x") / bin_size)).withColumn("_y", F.floor(F.col("y") / bin_size))
    c = F.col

    def turn(p1: str, p2: str) -> Column:
        return (c(f"{p2}x") - c(f"{p1}x")) * (c("y") - c(f"{p1}y")) - (c(f"{p2}y") - c(f"{p1}y")) * (c("x") - c(f"{p1}x"))

    w = {"c": turn("a", "b"), "a": turn("b", "c"), "b": turn("c", "a")}
    # a shared edge belongs to one of its triangles: an edge value of 0 counts as positive only for upward edges
    side = lambda v, p1, p2: (v > 0) | ((v == 0) & ((c(f"{p2}y") > c(f"{p1}y")) | ((c(f"{p2}y") == c(f"{p1}y")) & (c(f"{p2}x") > c(f"{p1}x")))))
    sides = [side(w["c"], "a", "b"), side(w["a"], "b", "c"), side(w["b"], "c", "a")]
    inside = (sides[0] == sides[1]) & (sides[1] == sides[2])
    area = w["a"] + w["b"] + w["c"]
    height = (w["a"] * c("az") + w["b"] * c("bz") + w["c"] * c("cz")) / area
    hit = p.join(t, ["_x", "_y"]).filter(inside & (area != 0) & (c("z") < height))
    return hit.groupBy(*key, "region").agg((F.count(F.lit(1)) % 2).alias("odd")).filter("odd = 1").drop("odd")


def nearest_strong(cells: DataFrame, plane: str) -> DataFrame:
    """For each cell (plane, x, y, strong) the nearest strong cell of its plane, the least (x, y) of ties: sx, sy, d2.
    Rings of growing size are tried on bins, and a cell leaves when no nearer one can exist."""
    strong = cells.filter("strong").select(plane, F.col("x").alias("sx"), F.col("y").alias("sy"))
    todo, done, size = cells.select(plane, "x", "y"), None, 1
    span = cells.agg(F.max("x") - F.min("x"), F.max("y") - F.min("y")).first()
    reach = max(1, int(max((v for v in span if v is not None), default=0)))
    while True:
        s = strong.withColumn("_x", F.floor(F.col("sx") / size)).withColumn("_y", F.floor(F.col("sy") / size))
        around = F.array(F.lit(-1), F.lit(0), F.lit(1))
        p = todo.withColumn("_x", F.explode(F.transform(around, lambda k: F.floor(F.col("x") / size) + k))).withColumn("_y", F.explode(F.transform(around, lambda k: F.floor(F.col("y") / size) + k)))
        d2 = (F.col("x") - F.col("sx")) * (F.col("x") - F.col("sx")) + (F.col("y") - F.col("sy")) * (F.col("y") - F.col("sy"))
        best = p.join(s, [plane, "_x", "_y"]).withColumn("d2", d2).groupBy(plane, "x", "y").agg(F.min(F.struct("d2", "sx", "sy")).alias("m"))
        near = best.filter(F.col("m.d2") <= size * size) if size <= reach else best
        got = near.select(plane, "x", "y", "m.sx", "m.sy", "m.d2")
        done = got if done is None else done.unionByName(got)
        if size > reach:
            return done
        todo = todo.join(got.select(plane, "x", "y"), [plane, "x", "y"], "left_anti")
        size *= 4
