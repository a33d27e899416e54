"""Coordinates, boxes, planes and vectors as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ("x", "y", "z")


def intersects(a: str, b: str, axes: tuple[str, ...] = AXES) -> Column:
    """Half-open boxes with columns <prefix>x0, <prefix>x1, ... that share a voxel."""
    out = F.lit(True)
    for c in axes:
        out = out & (F.col(f"{a}{c}0") < F.col(f"{b}{c}1")) & (F.col(f"{b}{c}0") < F.col(f"{a}{c}1"))
    return out


def contains(a: str, b: str, axes: tuple[str, ...] = AXES) -> Column:
    """Box a holds all of box b."""
    out = F.lit(True)
    for c in axes:
        out = out & (F.col(f"{a}{c}0") <= F.col(f"{b}{c}0")) & (F.col(f"{a}{c}1") >= F.col(f"{b}{c}1"))
    return out


def intersection(a: str, b: str, axes: tuple[str, ...] = AXES) -> list[Column]:
    """x0, x1, ... of the shared box."""
    return [f(F.col(f"{a}{c}{k}"), F.col(f"{b}{c}{k}")).alias(f"{c}{k}") for c in axes for k, f in ((0, F.greatest), (1, F.least))]


def rotate(y: Column, x: Column, height: int, width: int, degrees: int) -> tuple[Column, Column]:
    """(y, x) after a counter-clockwise turn by a multiple of 90 degrees."""
    return {0: (y, x), 90: (width - 1 - x, y), 180: (height - 1 - y, width - 1 - x), 270: (x, height - 1 - y)}[degrees % 360]


def flip(c: Column, n: int | Column) -> Column:
    return n - 1 - c


def shifted(px: DataFrame, axis: str, move: int, size: int) -> DataFrame:
    """Pixels moved along an axis; those that leave [0, size) go, and what is uncovered has no rows (zero)."""
    return px.withColumn(axis, F.col(axis) + move).filter(F.col(axis).between(0, size - 1))


def centred(px: DataFrame, axis: str, size: int, new: int) -> DataFrame:
    """Pad or trim an axis to `new` places: half, rounded down, in front."""
    front = (new - size) // 2 if new >= size else -((size - new) // 2)
    return px.withColumn(axis, F.col(axis) + front).filter(F.col(axis).between(0, new - 1))


def corrected(px: DataFrame, axis: str, size: int, new: int, at_end: bool = True) -> DataFrame:
    """Crop or extend an axis at its end, or at its start."""
    return px.withColumn(axis, F.col(axis) + (0 if at_end else new - size)).filter(F.col(axis).between(0, new - 1))


def dense(px: DataFrame, shape: dict[str, int], keys: list[str] | None = None) -> DataFrame:
    """Every place of the grid, 0 where px has no row. keys: columns that have a grid each."""
    keys = keys or []
    grid = px.select(*keys).distinct() if keys else px.sparkSession.range(1).select()
    for axis, n in shape.items():
        grid = grid.withColumn(axis, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return grid.join(px, [*keys, *shape], "left").withColumn("v", F.coalesce("v", F.lit(0)))


def layer(px: DataFrame, axis: str, index: int) -> DataFrame:
    """The plane across an axis, as (y, x, v)."""
    y, x = [a for a in ("z", "y", "x") if a != axis]
    return px.filter(F.col(axis) == index).select(F.col(y).alias("y"), F.col(x).alias("x"), "v")


def mirrored(c: Column, low: int | Column, high: int | Column) -> Column:
    """Symmetric padding: places outside [low, high] are read from inside, the edge repeated."""
    return F.when(c < low, 2 * low - 1 - c).when(c > high, 2 * high + 1 - c).otherwise(c)


def to_microns_flip_first(c: Column, length: float | None, source: float, target: float) -> Column:
    """Flip within the length, then scale source to target voxels."""
    return (c if length is None else length - c) * (source / target)


def to_microns_scale_first(c: Column, scale: float, length: float | None, negate: bool) -> Column:
    """Scale, then flip, then change the sign."""
    c = c * scale
    c = c if length is None else length - c
    return -c if negate else c


def plane_side(p1: tuple, p2: tuple, p3: tuple, z: Column, y: Column, x: Column) -> Column:
    """Signed side of the plane through three points given as (z, y, x)."""
    a, b = [q - p for p, q in zip(p1, p2, strict=True)], [q - p for p, q in zip(p1, p3, strict=True)]
    n = (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
    return n[0] * z + n[1] * y + n[2] * x - (n[0] * p1[0] + n[1] * p1[1] + n[2] * p1[2])


def angle(a: list[Column], b: list[Column]) -> Column:
    """Degrees between two vectors."""
    dot = sum((p * q for p, q in zip(a[1:], b[1:], strict=True)), a[0] * b[0])
    norm = F.sqrt(sum((p * p for p in a[1:]), a[0] * a[0])) * F.sqrt(sum((q * q for q in b[1:]), b[0] * b[0]))
    return F.degrees(F.acos(F.least(F.greatest(dot / norm, F.lit(-1.0)), F.lit(1.0))))


def transformation_needed(translation: list[Column], shear: list[Column]) -> Column:
    """A shift of at least one voxel at two decimals, or a shear over 0.01."""
    return F.greatest(*(F.abs(F.round(t, 2)) for t in translation)) >= 1 if not shear else (F.greatest(*(F.abs(F.round(t, 2)) for t in translation), F.lit(0.0)) >= 1) | (F.greatest(*(F.abs(s) for s in shear), F.lit(0.0)) > 0.01)
