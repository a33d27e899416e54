"""Neuron tracings: trees of nodes, point tables and their conversions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.pixel import sphere_radius, sphere_volume

#: What an extended node has where the plain one says nothing.
ESWC_DEFAULTS = {"seg_id": 0, "level": 1, "mode": 0, "timestamp": 1, "TFresindex": 1}


def _preorder(ids: np.ndarray, parents: np.ndarray) -> tuple[list[int], list[int]]:
    """(ids, parents) of one tracing, given by ascending id, from its roots: each node before its children, those in ascending order."""
    ids, parents = ids.tolist(), parents.tolist()
    roots = [i for i, p in zip(ids, parents, strict=True) if p == -1]
    if not roots:
        roots = [i for i, p in zip(ids, parents, strict=True) if p == 0] or [i for i in ids if i == 1]
    below: dict[int, list[int]] = {}
    top = set(roots)
    for i, p in zip(ids, parents, strict=True):
        if i not in top:
            below.setdefault(p, []).append(i)
    out, up, todo = [], [], [(r, -1) for r in reversed(roots)]
    while todo:
        node, parent = todo.pop()
        out.append(node)
        up.append(parent)
        todo += [(x, node) for x in reversed(below.get(node, ()))]
    return out, up


def sort_tree(nodes: DataFrame, file: str = "file") -> DataFrame:
    """Nodes of each file in pre-order from its root, renumbered from 1, with parents to match.

    The root is the node with parent -1, else the one with parent 0, else id 1; several -1 roots follow each other.
    Children follow their parent before its other branches, the least id first. Nodes that no root reaches are dropped;
    a cycle is never reached, so it can't loop. Several parent-0 roots without a -1 root fail. Repeated rows count once.
    A file is one tracing, whose ids and parents alone are ordered in one task.
    """
    n = nodes.dropDuplicates()
    cells = [c for c in n.columns if c not in (file, "id", "parent_id")]
    kind = n.schema[file].dataType.simpleString()
    roots = n.groupBy(file).agg(F.max((F.col("parent_id") == -1).cast("int")).alias("minus"), F.sum((F.col("parent_id") == 0).cast("int")).alias("zeros"))
    if not roots.filter("minus = 0 and zeros > 1").isEmpty():
        raise ValueError("a file has several roots with parent 0")

    def run(own: pa.Table) -> pa.Table:
        given, first = np.unique(own["id"].to_numpy(), return_index=True)
        ids, up = _preorder(given, own["parent_id"].to_numpy()[first])
        place = {i: k for k, i in enumerate(ids, 1)}
        return pa.table({"_file": own["file"].take(pa.array([0] * len(ids), pa.int64())), "_id": pa.array(ids, pa.int64()), "_new": pa.array(range(1, len(ids) + 1), pa.int32()), "_up": pa.array([place.get(p, -1) for p in up], pa.int32())})

    links = n.select(F.col(file).alias("file"), F.col("id").cast("long").alias("id"), F.col("parent_id").cast("long").alias("parent_id"))
    order = links.groupBy("file").applyInArrow(run, f"_file {kind}, _id long, _new int, _up int")
    out = n.join(order, (F.col(file) == F.col("_file")) & (F.col("id") == F.col("_id")))
    return out.select(file, F.col("_new").alias("id"), *cells, F.col("_up").alias("parent_id"))


def to_eswc(swc: DataFrame) -> DataFrame:
    return swc.select("*", *(F.lit(v).alias(k) for k, v in ESWC_DEFAULTS.items()))


def to_swc(eswc: DataFrame) -> DataFrame:
    return eswc.drop(*ESWC_DEFAULTS)


def apo_to_swc(apo: DataFrame, radius: float = 12.0) -> DataFrame:
    """A soma node for each distinct point row; ids follow the order of the points' numbers."""
    rows = apo.dropDuplicates()
    n = F.row_number().over(Window.partitionBy("file").orderBy("n")) if "file" in apo.columns else F.row_number().over(Window.orderBy("n"))
    return rows.select(*(["file"] if "file" in apo.columns else []), n.alias("id"), F.lit(1).alias("type"), "x", "y", "z", F.lit(float(radius)).alias("radius"), F.lit(-1).alias("parent_id"))


def seed_pairs(nodes: DataFrame) -> DataFrame:
    """Two rows for each node: the soma with parent 0 and a copy that hangs from it."""
    pair = F.array(F.struct(F.lit(1).alias("id"), F.lit(0).alias("parent_id")), F.struct(F.lit(2).alias("id"), F.lit(1).alias("parent_id")))
    return nodes.withColumn("_p", F.explode(pair)).select(F.col("id").alias("node"), F.col("_p.id").alias("id"), "type", "x", "y", "z", "radius", F.col("_p.parent_id").alias("parent_id"))


def whole(c: Column) -> Column:
    """Nearest whole number, halves up, for what isn't negative."""
    return (c + 0.5).cast("int")


def to_seeds(nodes: DataFrame) -> DataFrame:
    """Whole coordinates and radii, and the seed's file name."""
    s = nodes.select(whole(F.col("x")).alias("x"), whole(F.col("y")).alias("y"), whole(F.col("z")).alias("z"), F.floor("radius").cast("int").alias("radius"))
    return s.withColumn("name", F.format_string("[%d,%d,%d]-r=%d.swc", "x", "y", "z", "radius"))


def least_soma(nodes: DataFrame, least: float, file: str = "file") -> DataFrame:
    """The first node of each file at least so large."""
    first = F.row_number().over(Window.partitionBy(file).orderBy("id")) == 1
    return nodes.withColumn("radius", F.when(first, F.greatest("radius", F.lit(least))).otherwise(F.col("radius")))


def duplicates(nodes: DataFrame) -> DataFrame:
    """How many nodes repeat a place and radius."""
    return nodes.agg((F.count(F.lit(1)) - F.countDistinct("x", "y", "z", "radius")).alias("n"))


def valid_soma(nodes: DataFrame) -> DataFrame:
    """Files whose first node isn't a soma root are skipped: its type is neither 0 nor 1 and its parent neither -1 nor 0."""
    return nodes.filter(F.col("type").isin(0, 1) | F.col("parent_id").isin(-1, 0))


def rescale_nodes(nodes: DataFrame, source: tuple[float, float, float], target: tuple[float, float, float], flips: dict[str, float] | None = None) -> DataFrame:
    """Coordinates flipped within their lengths and then scaled from source to target voxels."""
    out = nodes
    for c, s, t in zip("xyz", source, target, strict=True):
        v = F.col(c) if c not in (flips or {}) else (flips or {})[c] - F.col(c)
        out = out.withColumn(c, v * (s / t))
    return out


def markers_to_apo(markers: DataFrame, voxel: tuple[float, float, float], scale_radius: bool = False) -> DataFrame:
    """Markers in micrometres to points in voxels, numbered, with the sphere's volume."""
    r = F.col("radius") / min(voxel) if scale_radius else F.col("radius")
    return markers.select(F.row_number().over(Window.orderBy("x", "y", "z", "radius")).alias("n"), *((F.col(c) / v).alias(c) for c, v in zip("xyz", voxel, strict=True)), sphere_volume(r).alias("volsize"))


def apo_to_markers(apo: DataFrame, voxel: tuple[float, float, float]) -> DataFrame:
    """Points in voxels to whole micrometres, with the radius of their volume."""
    return apo.select(*(F.round(F.col(c) * v).cast("int").alias(c) for c, v in zip("xyz", voxel, strict=True)), sphere_radius(F.col("volsize")).alias("radius"))


def consolidated(markers: DataFrame, least_radius: float = 10.0) -> DataFrame:
    """All markers as the roots of one tracing."""
    return markers.select(F.row_number().over(Window.orderBy("x", "y", "z", "radius")).alias("id"), F.lit(1).alias("type"), "x", "y", "z", F.greatest("radius", F.lit(least_radius)).alias("radius"), F.lit(-1).alias("parent_id"))


def somas_to_markers(somas: DataFrame, voxel: tuple[float, float, float]) -> DataFrame:
    """Whole coordinates after scaling, whole volumes and the marker's file name."""
    m = somas.select(*((F.col(c) * v).cast("int").alias(c) for c, v in zip("xyz", voxel, strict=True)), F.col("volume").cast("int").alias("volume"))
    return m.withColumn("name", F.concat_ws("_", F.lit("marker"), "x", "y", "z", "volume"))


def affine(nodes: DataFrame, scale: tuple[float, float, float], offset: tuple[float, float, float]) -> DataFrame:
    """Coordinates times a scale (its sign sets the axis direction) plus an offset."""
    out = nodes
    for c, s, o in zip("xyz", scale, offset, strict=True):
        out = out.withColumn(c, F.col(c) * s + o)
    return out
