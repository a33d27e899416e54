"""Schemas and pixel types. Spark has no unsigned types, so each maps to the next wider signed one."""

from __future__ import annotations

from pyspark.sql import types as T

PIXEL_TYPES = {"uint8": T.ShortType(), "uint16": T.IntegerType(), "uint32": T.LongType(), "float32": T.FloatType(), "float64": T.DoubleType()}


def dtype_for_bytes(bytes_per_channel: int) -> str:
    """The pixel type of a project whose channels have so many bytes."""
    if bytes_per_channel <= 1:
        return "uint8"
    return "uint16" if bytes_per_channel <= 8 else "uint32"


BOX = T.StructType([T.StructField(c, T.IntegerType()) for c in ("x0", "x1", "y0", "y1", "z0", "z1")])
PLANES = T.StructType([
    T.StructField("channel", T.StringType()), T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()), T.StructField("z", T.IntegerType()),
    T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("dtype", T.StringType()), T.StructField("pixels", T.BinaryType()),
])
STACKS = T.StructType([
    T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()), *BOX.fields,
    T.StructField("z_ranges", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("n_chans", T.IntegerType()), T.StructField("bytes_per_chan", T.IntegerType()),
])
EDGES = T.StructType([
    *(T.StructField(c, T.IntegerType()) for c in ("r0", "c0", "r1", "c1")), T.StructField("side", T.StringType()), T.StructField("layer", T.IntegerType()), T.StructField("dir", T.StringType()),
    T.StructField("displ", T.IntegerType()), T.StructField("default_displ", T.IntegerType()), T.StructField("peak", T.FloatType()), T.StructField("width", T.IntegerType()), T.StructField("inv_width", T.IntegerType()), T.StructField("delay", T.IntegerType()),
])
_NODE = [T.StructField("id", T.IntegerType()), T.StructField("type", T.IntegerType()), *(T.StructField(c, T.DoubleType()) for c in ("x", "y", "z", "radius")), T.StructField("parent_id", T.IntegerType())]
SWC = T.StructType(_NODE)
ESWC = T.StructType([*_NODE, *(T.StructField(c, T.IntegerType()) for c in ("seg_id", "level", "mode", "timestamp", "TFresindex"))])
#: The columns of a point file, in its order (z before x and y).
APO_COLUMNS = ["##n", "orderinfo", "name", "comment", "z", "x", "y", "pixmax", "intensity", "sdev", "volsize", "mass", "blank1", "blank2", "blank3", "color_r", "color_g", "color_b"]
#: Voxel sizes in micrometres, tile heights and tile widths of the objectives.
OBJECTIVES = {"4x": (1.809, 1600, 2000), "8x": (0.82, 2000, 2000), "9x": (0.72, 2000, 2000), "10x": (0.62, 2000, 2000), "15x": (0.41, 2000, 2000), "40x": (0.14, 2048, 2048)}
