"""Readers: raw planes, tracings, point files, markers and project files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import APO_COLUMNS


def decode_raw(content: bytes) -> np.ndarray | None:
    """A plane of 16-bit pixels after two 32-bit sizes, in the byte order that gives the smaller width, big-endian if both are equal; None if it isn't one."""
    if len(content) < 8:
        return None
    little, big = (int(np.frombuffer(content, t, 1)[0]) for t in ("<u4", ">u4"))
    order = "<" if little < big else ">"
    width, height = (int(x) for x in np.frombuffer(content, f"{order}u4", 2))
    if len(content) < 8 + 2 * width * height:
        return None
    return np.frombuffer(content, f"{order}u2", width * height, 8).reshape(height, width)


def encode_raw(plane: np.ndarray) -> bytes:
    """The same, little-endian."""
    height, width = plane.shape
    return np.array([width, height], "<u4").tobytes() + np.ascontiguousarray(plane, "<u2").tobytes()


def raw_planes(spark: SparkSession, folder: str) -> DataFrame:
    """(path, height, width, dtype, pixels) of raw files; an unreadable file has null pixels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            planes = [decode_raw(c) for c in b.content]
            yield pd.DataFrame({
                "path": b.path, "height": [None if p is None else p.shape[0] for p in planes], "width": [None if p is None else p.shape[1] for p in planes],
                "dtype": "uint16", "pixels": [None if p is None else p.astype("<u2").tobytes() for p in planes],
            })

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.raw").load(folder)
    return found.select("path", "content").mapInPandas(run, "path string, height int, width int, dtype string, pixels binary")


def pixels(planes: DataFrame) -> DataFrame:
    """(path, y, x, v) of 16-bit little-endian planes, without Python: two hex digits a byte."""
    hexed = planes.filter("pixels is not null").withColumn("_h", F.hex("pixels"))
    at = F.explode(F.sequence(F.lit(0), F.col("height") * F.col("width") - 1))
    one = hexed.select("path", "width", "_h", at.alias("i"))
    byte = lambda k: F.conv(F.substring(F.col("_h"), F.col("i") * 4 + 1 + 2 * k, F.lit(2)), 16, 10).cast("int")
    return one.select("path", F.floor(F.col("i") / F.col("width")).cast("int").alias("y"), (F.col("i") % F.col("width")).cast("int").alias("x"), (byte(0) + 256 * byte(1)).alias("v"))


def _cells(spark: SparkSession, path: str) -> tuple[DataFrame, Column]:
    """Lines without comments and blanks, split at runs of white space."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.trim("value").alias("line"))
    return lines.filter(~F.col("line").startswith("#") & (F.col("line") != "")), F.split("line", r"\s+")


def read_swc(spark: SparkSession, path: str, extended: bool = False) -> DataFrame:
    lines, cell = _cells(spark, path)
    names = [("id", "int"), ("type", "int"), ("x", "double"), ("y", "double"), ("z", "double"), ("radius", "double"), ("parent_id", "int")]
    if extended:
        names += [(c, "int") for c in ("seg_id", "level", "mode", "timestamp", "TFresindex")]
    return lines.select("file", *(F.get(cell, F.lit(k)).try_cast(t).alias(c) for k, (c, t) in enumerate(names)))


def read_apo(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, name, z, x, y, volsize) of point files; the header's z comes before x and y."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value").filter(~F.col("value").startswith("##") & (F.trim("value") != ""))
    cell, at = F.split("value", r"\s*,\s*"), {c: k for k, c in enumerate(APO_COLUMNS)}
    number = lambda c: F.get(cell, F.lit(at[c])).try_cast("double").alias(c)
    return lines.select("file", F.get(cell, F.lit(0)).try_cast("int").alias("n"), F.get(cell, F.lit(at["name"])).alias("name"), *(number(c) for c in ("z", "x", "y", "volsize")))


def read_markers(spark: SparkSession, folder: str) -> DataFrame:
    """(file, x, y, z, radius) of all marker_* files of a folder."""
    lines = spark.read.option("pathGlobFilter", "marker_*").text(folder).select(F.col("_metadata.file_name").alias("file"), F.trim("value").alias("line")).filter(~F.col("line").startswith("#") & (F.col("line") != ""))
    cell = F.split("line", r"\s*,\s*")
    return lines.select("file", *(F.get(cell, F.lit(k)).try_cast("double").alias(c) for k, c in enumerate(("x", "y", "z", "radius"))))


def read_rois(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").csv(path)


def read_project(spark: SparkSession, path: str) -> DataFrame:
    """One row a stack of a project file, its attributes as columns named _ROW, _COL, _ABS_V, ..."""
    return spark.read.format("xml").option("rowTag", "Stack").load(path)


def crop(volume: DataFrame, offsets: tuple[int, int, int], extents: tuple[int, int, int], channel: int | None = None, resolution: int | None = None) -> DataFrame:
    """A sub-volume of (res, channel, z, y, x, v); an extent of 0 or less runs to the end. Filters reach the scan."""
    out = volume
    if channel is not None:
        out = out.filter(F.col("channel") == channel)
    if resolution is not None:
        out = out.filter(F.col("res") == resolution)
    for c, o, n in zip("zyx", offsets, extents, strict=True):
        if o < 0:
            raise ValueError("an offset lies outside the volume")
        out = out.filter((F.col(c) >= o) if n <= 0 else F.col(c).between(o, o + n - 1))
    return out
