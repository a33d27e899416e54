"""Down-sampling and projections as grouped aggregations of (keys.., z, y, x, v)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(c: str, k: int) -> Column:
    return F.floor(F.col(c) / k).cast("int").alias(c) if k > 1 else F.col(c).alias(c)


def _block_value(how: str, full: int) -> Column:
    n, v = F.count("v"), F.col("v")
    if how == "max":
        return F.when(n < full, F.greatest(F.max(v), F.lit(0))).otherwise(F.max(v))
    if how == "min":
        return F.when(n < full, F.least(F.min(v), F.lit(0))).otherwise(F.min(v))
    if how == "mean":
        return F.sum(v) / F.lit(float(full))
    if how == "sum":
        return F.sum(v)
    if how == "median":
        middle = F.sort_array(F.concat(F.collect_list(v.cast("double")), F.array_repeat(F.lit(0.0), (full - n).cast("int"))))
        return (F.element_at(middle, full // 2 + 1) + F.element_at(middle, (full + 1) // 2)) / 2  # a block is small by its factors
    raise ValueError(how)


def block_reduce(px: DataFrame, factors: dict[str, int], how: str | tuple[str, ...], keys: list[str] | None = None) -> DataFrame:
    """Blocks of the given sizes by max, min, mean, median or sum, as v; several at once have their own names. Ragged blocks
    are filled with zeros, as a padded array would be: a mean divides by the full size, and min and median see the zeros."""
    full = math.prod(factors.values())
    groups = [*(F.col(k) for k in keys or []), *(_cell(c, k) for c, k in factors.items())]
    out = [_block_value(how, full).alias("v")] if isinstance(how, str) else [_block_value(h, full).alias(h) for h in how]
    return px.groupBy(*groups).agg(*out)


def alternating(px: DataFrame, sizes: dict[str, int], target: float, voxel: dict[str, float], keys: list[str] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Halvings towards the target voxel: rounds of y, then x, while an axis stays as large as its target size;
    y begins with max and x with mean, and each goes on with the other in the next round."""
    sizes = dict(sizes)
    rounds = {c: math.floor(math.sqrt(target / voxel[c])) for c in ("y", "x")}
    goal = {c: math.ceil(sizes[c] * voxel[c] / target) for c in ("y", "x")}
    for k in range(max(rounds.values(), default=0)):
        for c, first in (("y", "max"), ("x", "mean")):
            if k < rounds[c] and math.ceil(sizes[c] / 2) >= goal[c]:
                how = first if k % 2 == 0 else ("mean" if first == "max" else "max")
                rest = [a for a in ("z", "y", "x") if a != c and a in px.columns]
                px = block_reduce(px, {c: 2}, how, [*(keys or []), *rest])
                sizes[c] = math.ceil(sizes[c] / 2)
    return px, sizes


def z_reduce(px: DataFrame, target: float, voxel: float, keys: list[str] | None = None) -> DataFrame:
    """ceil(sqrt(target / voxel)) halvings along z by max, mean, max, .."""
    for k in range(math.ceil(math.sqrt(target / voxel))):
        px = block_reduce(px, {"z": 2}, "max" if k % 2 == 0 else "mean", [*(keys or []), "y", "x"])
    return px


def z_chunks(start: int, end: int, steps: int) -> list[list[int]]:
    """Planes by chunk. Only an index above `end` is cut, so that a last chunk one short still holds `end`."""
    return [[z for z in range(a, a + steps) if z <= end] for a in range(start, end, steps)]


def halve(px: DataFrame, axes: tuple[str, ...] = ("z", "y", "x"), how: str = "mean", keys: list[str] | None = None) -> DataFrame:
    """Complete blocks of 2 along the axes; an odd tail is dropped."""
    groups = [*(F.col(k) for k in keys or []), *(_cell(c, 2) if c in axes else F.col(c) for c in ("z", "y", "x") if c in px.columns)]
    agg = F.avg("v") if how == "mean" else F.max("v")
    return px.groupBy(*groups).agg(agg.alias("v"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == 2 ** len(axes)).drop("n")


def primes(n: int) -> list[int]:
    out, p = [], 2
    while n > 1:
        while n % p == 0:
            out.append(p)
            n //= p
        p += 1
    return out


def axis_average(px: DataFrame, axis: str, factor: int, fourth_root: bool = False, keys: list[str] | None = None) -> DataFrame:
    """Mean along an axis by the factor's primes; incomplete blocks at each step are dropped."""
    if fourth_root:
        px = px.withColumn("v", F.pow("v", F.lit(0.25)))
    for p in primes(factor):
        groups = [*(F.col(k) for k in keys or []), *(_cell(c, p) if c == axis else F.col(c) for c in ("z", "y", "x") if c in px.columns)]
        px = px.groupBy(*groups).agg(F.avg("v").alias("v"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == p).drop("n")
    return px


def decimate(px: DataFrame, yx: int, z: int = 1) -> DataFrame:
    return px.filter((F.col("y") % yx == 0) & (F.col("x") % yx == 0) & (F.col("z") % z == 0))


def projections(px: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Maximum projections along z, y and x in one pass: face, then its two places (the third is null)."""
    face = F.when(F.grouping("z") == 1, "xy").when(F.grouping("y") == 1, "xz").otherwise("yz")
    return px.groupingSets([["y", "x"], ["z", "x"], ["z", "y"]], "z", "y", "x").agg(face.alias("face"), F.greatest(F.lit(0), F.max("v")).alias("v"), *(c.alias(k) for k, c in (extra or {}).items()))


def profiles(px: DataFrame, epsilon: float = 1e-5) -> DataFrame:
    """Sum and maximum along each axis; a sum of 0 becomes epsilon."""
    axis = F.when(F.grouping("z") == 0, "z").when(F.grouping("y") == 0, "y").otherwise("x")
    total = F.sum(F.col("v").cast("double"))
    return px.groupingSets([["z"], ["y"], ["x"]], "z", "y", "x").agg(axis.alias("axis"), F.when(total == 0, epsilon).otherwise(total).alias("total"), F.max("v").alias("top")).select("axis", F.coalesce("z", "y", "x").alias("place"), "total", "top")


def pyramid(px: DataFrame, levels: int, how: str = "mean", flat_first: int = 0, keys: list[str] | None = None) -> DataFrame:
    """(level, ..) of all resolutions. Maxima come from the base in one pass; means halve level by level.
    flat_first: so many levels halve y and x only, until voxels are isotropic."""
    out = [px.withColumn("level", F.lit(0))]
    for level in range(1, levels):
        px = halve(px, ("y", "x") if level <= flat_first else ("z", "y", "x"), how, keys)
        out.append(px.withColumn("level", F.lit(level)))
    total = out[0]
    for p in out[1:]:
        total = total.unionByName(p)
    return total


def spacing_axis(n: int, voxel: float, target: float, start: float) -> list[float]:
    """Coordinates of the reduced axis: centred on the middle, in steps of the target voxel."""
    return [start + target * k for k in range(math.ceil(n * voxel / target))]
