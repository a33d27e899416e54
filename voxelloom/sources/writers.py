"""Sinks: volumes, tracings, points and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import APO_COLUMNS


def write_volume(px: DataFrame, path: str, compression: str = "lz4", partition: list[str] | None = None) -> None:
    """A volume as Parquet, clustered by z so that slabs prune."""
    w = px.repartitionByRange("z").sortWithinPartitions("z", "y", "x").write.option("compression", compression).mode("overwrite")
    (w.partitionBy(*partition) if partition else w).parquet(path)


def write_reduced(px: DataFrame, axes: dict[str, list[float]], path: str) -> None:
    """A reduced volume and its axis coordinates."""
    px.write.mode("overwrite").parquet(f"{path}/volume")
    px.sparkSession.createDataFrame([(k, [float(x) for x in v]) for k, v in axes.items()], "axis string, coords array<double>").write.mode("overwrite").parquet(f"{path}/axes")


def swc_lines(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.concat_ws(" ", *(F.col(c).cast("string") for c in ("id", "type", "x", "y", "z", "radius", "parent_id"))).alias("value"))


def write_swc(nodes: DataFrame, path: str) -> None:
    """Text of one tracing, ordered by id; small by its nature, so one file."""
    swc_lines(nodes.orderBy("id")).coalesce(1).write.mode("overwrite").text(path)


def apo_lines(points: DataFrame) -> DataFrame:
    """Point rows (n, x, y, z, volsize) in the format's order; the header is a line of its own."""
    known = {"##n": "n", "orderinfo": "n", "name": "n", "x": "x", "y": "y", "z": "z", "volsize": "volsize"}
    cells = [F.col(known[c]).cast("string") if c in known else F.lit("") for c in APO_COLUMNS]
    return points.select(F.concat_ws(",", *cells).alias("value"))


def apo_header() -> str:
    return ",".join("" if c.startswith("blank") else c for c in APO_COLUMNS)


def ano_text(apo: str, swc: str) -> str:
    return f"APOFILE={apo}\nSWCFILE={swc}\n"


def marker_text(x: float, y: float, z: float, radius: float) -> str:
    return f"# x,y,z,radius_um\n{x},{y},{z},{radius}\n"


def write_report(rows: DataFrame, path: str) -> None:
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def alignment_json(records: DataFrame) -> DataFrame:
    """(key, json): all alignments of a stack pair as one list, ordered by z."""
    return records.groupBy("xidx", "yidx", "zidx").agg(F.to_json(F.sort_array(F.collect_list(F.struct("z", "score", "xoff", "yoff", "zoff")))).alias("json"))


def alignments_from_json(rows: DataFrame) -> DataFrame:
    schema = "array<struct<z:int,score:double,xoff:int,yoff:int,zoff:int>>"
    return rows.select("xidx", "yidx", "zidx", F.explode(F.from_json("json", schema)).alias("a")).select("xidx", "yidx", "zidx", "a.*")


def merge_displacements(parts: list[DataFrame]) -> DataFrame:
    """The edges of several partial runs as one table; where runs overlap the most reliable entry holds."""
    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    keys = ["r0", "c0", "r1", "c1", "side", "layer", "dir"]
    cells = [c for c in total.columns if c not in keys]
    return total.groupBy(*keys).agg(F.max_by(F.struct(*cells), F.struct("peak", -F.col("width"))).alias("b")).select(*keys, "b.*")
