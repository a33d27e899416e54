"""File names, paths and z ranges as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))


def has_extension(path: Column, *suffixes: str) -> Column:
    return extension(path).isin(*[s.lower() for s in suffixes])


def natural_key(name: Column) -> Column:
    """Sorts runs of digits by number and the rest as text."""
    parts = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.concat(F.lit("0"), F.lpad(p, 20, "0"))).otherwise(F.concat(F.lit("1"), F.lower(p)))), "\x01")


def plane_name(prefix: str, z: Column, n: int | None = None, suffix: str = ".tif") -> Column:
    """prefix_000123.tif; with n the order of planes is reversed."""
    return F.concat(F.lit(f"{prefix}_"), F.lpad((z if n is None else n - 1 - z).cast("string"), 6, "0"), F.lit(suffix))


def kept_z(ranges: Column) -> Column:
    """Indices inside `[a,b);[c,d)`. `(a,` begins after a. Unless the text as a whole ends with `)`, every range includes its end."""
    closed = F.when(F.rtrim(ranges).endswith(")"), 0).otherwise(1)

    def expand(piece: Column) -> Column:
        a = F.regexp_extract(piece, r"(-?\d+)\s*,", 1)
        b = F.regexp_extract(piece, r",\s*(-?\d+)", 1)
        start, stop = F.when(a != "", a.cast("int")) + F.when(F.trim(piece).startswith("["), 0).otherwise(1), F.when(b != "", b.cast("int")) - 1 + closed
        return F.when(stop >= start, F.sequence(start, stop)).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(F.filter(F.split(ranges, ";"), lambda p: F.trim(p) != ""), expand))


def tile_position(path: Column) -> tuple[Column, Column]:
    """x and y, in tenths of a micron, of a file under <x>/<x>_<y>/."""
    return F.regexp_extract(path, r"/(-?\d+)_(-?\d+)/[^/]*$", 1).cast("long"), F.regexp_extract(path, r"/(-?\d+)_(-?\d+)/[^/]*$", 2).cast("long")


def marker_fields(name: Column) -> list[Column]:
    """x, y, z and the size from marker_x_y_z_size."""
    pattern = r"marker_(-?[\d.]+)_(-?[\d.]+)_(-?[\d.]+)_(-?[\d]+(?:\.\d+)?)"
    return [F.regexp_extract(name, pattern, k).cast("double").alias(c) for k, c in enumerate(("x", "y", "z", "size"), 1)]


def remount(path: Column, mounts: dict[str, str]) -> Column:
    """Drive letters to mount points."""
    for drive, mount in mounts.items():
        path = F.regexp_replace(path, rf"(?i)^{drive}:", mount)
    return F.translate(path, "\\", "/")
