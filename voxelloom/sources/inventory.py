"""File inventories: series, tile trees and scanners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.names import natural_key, stem, tile_position
from ..model import OBJECTIVES


def files(spark: SparkSession, folder: str, pattern: str = ".*") -> DataFrame:
    """(path, length) of the files below a folder whose path matches, whatever the case; contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select("path", "length").filter(F.col("path").rlike(f"(?i){pattern}"))


def series(paths: DataFrame, keys: list[str] | None = None, offset: int = 0) -> DataFrame:
    """z of each plane of a series, by natural order of the names."""
    return paths.withColumn("z", F.row_number().over(Window.partitionBy(*(keys or [])).orderBy(natural_key(F.col("path")), "path")) - 1 + offset)


def tile_tree(paths: DataFrame, voxel_x: float, voxel_y: float) -> DataFrame:
    """Column and row voxels of tiles from their folders, from the least position."""
    x, y = tile_position(F.col("path"))
    p = paths.select("path", x.alias("px"), y.alias("py"))
    all_ = Window.partitionBy()
    return p.select("path", ((F.col("px") - F.min("px").over(all_)) / voxel_x / 10).cast("int").alias("x0"), ((F.col("py") - F.min("py").over(all_)) / voxel_y / 10).cast("int").alias("y0"))


def z_step(names: DataFrame, keys: list[str]) -> DataFrame:
    """Tenths of the difference of the first two stems of each folder."""
    s = names.withColumn("_v", stem(F.col("path")).cast("long")).withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_v"))).filter("_r <= 2")
    return s.groupBy(*keys).agg(((F.max("_v") - F.min("_v")) / 10.0).alias("z_step"))


def travels(planes: DataFrame, keys: list[str], z: str, piezo: float) -> DataFrame:
    """The piezo travel of each plane: a new one begins at the first plane `piezo` or more past the start of the last.

    The start moves with the data, so a lag can't tell; an ordered fold over each tile's planes does.
    """
    place = F.col(z).cast("double")
    start = F.struct(F.lit(None).cast("double").alias("z0"), F.lit(-1).alias("t"), F.array().cast("array<struct<z:double,travel:int,z0:double>>").alias("out"))

    def step(a: Column, v: Column) -> Column:
        new = a["z0"].isNull() | (v - a["z0"] >= piezo)
        z0, t = F.when(new, v).otherwise(a["z0"]), F.when(new, a["t"] + 1).otherwise(a["t"])
        return F.struct(z0.alias("z0"), t.alias("t"), F.concat(a["out"], F.array(F.struct(v.alias("z"), t.alias("travel"), z0.alias("z0")))).alias("out"))

    folded = planes.groupBy(*keys).agg(F.sort_array(F.collect_set(place)).alias("_zs")).withColumn("_o", F.explode(F.aggregate("_zs", start, step, lambda a: a["out"])))
    return folded.select(*keys, F.col("_o.z").alias(z), F.col("_o.travel").alias("travel"), F.col("_o.z0").alias("start"))


def folder_counts(paths: DataFrame, folder: str) -> DataFrame:
    """(n_files, folders): folders by their number of files."""
    each = paths.groupBy(folder).agg(F.count(F.lit(1)).alias("n_files"))
    return each.groupBy("n_files").agg(F.sort_array(F.collect_list(folder)).alias("folders"), F.count(F.lit(1)).alias("n"))


def odd_folders(paths: DataFrame, folder: str) -> DataFrame:
    """Folders with fewer files than the fullest; a single file is excused."""
    each = paths.groupBy(folder).agg(F.count(F.lit(1)).alias("n_files"))
    top = each.agg(F.max("n_files").alias("top"))
    return each.crossJoin(top).filter("n_files < top and n_files <> 1").select(folder, "n_files")


def remaining(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose output doesn't exist yet."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def missing_cells(cells: DataFrame, axes: list[str], keys: list[str] | None = None) -> DataFrame:
    """Combinations of the axes' values that have no row. The distinct values of an axis are metadata of a grid."""
    grid = cells.select(*(keys or []), axes[0]).distinct()
    for a in axes[1:]:
        grid = grid.crossJoin(cells.select(a).distinct())
    return grid.join(cells.select(*(keys or []), *axes).distinct(), [*(keys or []), *axes], "left_anti")


def missing_planes(stacks: DataFrame, planes: DataFrame, keys: list[str], step: int) -> DataFrame:
    """(keys, z, name) of planes that a stack lacks, named by position in tenths of a micron; inputs aren't touched."""
    want = stacks.select(*keys, F.explode(F.sequence("z0", F.col("z1") - 1)).alias("z"))
    return want.join(planes.select(*keys, "z"), [*keys, "z"], "left_anti").withColumn("name", F.format_string("%06d", (F.col("z") * step * 10).cast("int")))


def completeness(stacks: DataFrame, planes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, present, wanted, state) of stacks (z0, z1): how many of its planes a stack has, and whether that makes it empty,
    sparse or complete. Planes outside the range, and repeated ones, don't count."""
    held = stacks.join(planes.select(*keys, "z").distinct(), keys).filter((F.col("z") >= F.col("z0")) & (F.col("z") < F.col("z1"))).groupBy(*keys).agg(F.count(F.lit(1)).alias("present"))
    out = stacks.select(*keys, (F.col("z1") - F.col("z0")).cast("long").alias("wanted")).join(held, keys, "left").withColumn("present", F.coalesce("present", F.lit(0)))
    return out.select(*keys, "present", "wanted", F.when(F.col("present") == F.col("wanted"), "complete").when(F.col("present") == 0, "empty").otherwise("sparse").alias("state"))


def largest_first(jobs: DataFrame, size: Column, key: str, workers: int) -> DataFrame:
    """The jobs with `place`, their order by falling size and then key, and `worker`, as they are dealt in that order.
    Jobs are the metadata of a run."""
    order = F.row_number().over(Window.orderBy(size.desc(), F.col(key))) - 1
    return jobs.withColumn("place", order).withColumn("worker", F.col("place") % workers)


def frames(rows: DataFrame, keys: list[str], order: str, start: int, end: int | None = None) -> DataFrame:
    """The frames [start, end) of each series in its order, counted from 0; all from start on without an end."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    return rows.withColumn("_n", n).filter(F.col("_n") >= start if end is None else F.col("_n").between(start, end - 1)).drop("_n")


def preview_order(z: Column, start: int, most: int = 6) -> Column:
    """Sorts planes so that a coarse preview comes first: by the powers of ten that divide their distance."""
    level = F.lit(0)
    for k in range(1, most + 1):
        level = F.when((z - start) % 10**k == 0, k).otherwise(level)
    return level


def rebased_names(paths: DataFrame) -> DataFrame:
    """x, y of folders from 0, padded to six digits."""
    x, y = tile_position(F.col("path"))
    p = paths.select("path", x.alias("x"), y.alias("y"))
    all_ = Window.partitionBy()
    pad = lambda c: F.lpad((F.col(c) - F.min(c).over(all_)).cast("string"), 6, "0")
    return p.select("path", F.concat(pad("x"), F.lit("/"), pad("x"), F.lit("_"), pad("y")).alias("folder"))


def unknown_channels(wanted: DataFrame, available: DataFrame, channel: str) -> DataFrame:
    """Requested channels that don't exist."""
    return wanted.select(channel).distinct().join(available.select(channel).distinct(), channel, "left_anti")


def channel_order(channel: Column, first: list[str]) -> Column:
    """Sorts a priority list of channels first and the others after it."""
    out = F.lit(len(first))
    for k, name in reversed(list(enumerate(first))):
        out = F.when(channel == name, k).otherwise(out)
    return out


def with_objective(df: DataFrame, objective: str) -> DataFrame:
    """Voxel size, tile height and tile width of each row's objective; null for one that isn't known."""
    dims = df.sparkSession.createDataFrame([(k, *v) for k, v in OBJECTIVES.items()], f"{objective} string, voxel double, tile_height int, tile_width int")
    return df.join(F.broadcast(dims), objective, "left")  # a fixed list of six
