"""Registration of channels and their merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .align import best_offset, correlations, offsets


def translation(a: DataFrame, b: DataFrame, key: str, reach: int) -> DataFrame:
    """(key, dy, dx, score): the whole shift of b that correlates best with a."""
    return best_offset(correlations(a, b, offsets(a.sparkSession, reach, reach), key), key)


def align_volumes(a: DataFrame, b: DataFrame, shape: dict[str, int], reach: int, most_rounds: int = 10) -> dict[str, int]:
    """Shifts of b by axis: the middle planes of the three faces are matched, the two shifts found for each axis are
    averaged, b moves, and so on until it doesn't move, comes back to an earlier place, or rounds run out."""
    total, seen = {"z": 0, "y": 0, "x": 0}, set()
    for _ in range(most_rounds):
        moves: dict[str, list[int]] = {"z": [], "y": [], "x": []}
        for axis in ("z", "y", "x"):
            first, second = [c for c in ("z", "y", "x") if c != axis]
            mid = shape[axis] // 2
            cut = lambda px: px.filter(F.col(axis) == mid).select(F.lit(0).alias("k"), F.col(first).alias("y"), F.col(second).alias("x"), "v")  # noqa: B023, E731
            moved = b
            for c in ("z", "y", "x"):
                moved = moved.withColumn(c, F.col(c) + total[c])
            row = translation(cut(a), cut(moved), "k", reach).first()
            if row is not None:
                moves[first].append(row["dy"])
                moves[second].append(row["dx"])
        step = {c: int(round(sum(m) / len(m))) if m else 0 for c, m in moves.items()}
        if not any(step.values()):
            break
        total = {c: total[c] + step[c] for c in total}
        if tuple(total.values()) in seen:
            break
        seen.add(tuple(total.values()))
    return total


def scaled_shift(shift: dict[str, int], reduced: dict[str, float], full: dict[str, float]) -> dict[str, int]:
    """A shift found on reduced voxels for the full resolution, truncated."""
    return {c: int(shift[c] * reduced[c] / full[c]) for c in shift}


def merge_channels(reference: DataFrame, others: list[tuple[DataFrame, dict[str, int]]]) -> DataFrame:
    """Channels side by side: c0 and c1.. at the reference's places, each other channel moved by its shift; missing is 0."""
    out = reference.withColumnRenamed("v", "c0")
    for k, (px, move) in enumerate(others, 1):
        at = px
        for c in ("z", "y", "x"):
            at = at.withColumn(c, F.col(c) + move.get(c, 0))
        out = out.join(at.select("z", "y", "x", F.col("v").alias(f"c{k}")), ["z", "y", "x"], "left").withColumn(f"c{k}", F.coalesce(f"c{k}", F.lit(0)))
    return out


def aligned_z(z: Column, n_ref: int, pad_ref: int, pad: int, offset: int) -> Column:
    """The plane of a channel that goes with a plane of the reference."""
    return z + pad_ref - pad - offset
