"""Global placement of tiles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.scratch import written

#: Fixed value: the weight of an edge without reliability.
NO_RELIABILITY = 1000.0


def edge_weight(reliability: Column) -> Column:
    return F.when(reliability > 0, 1.0 / reliability).otherwise(NO_RELIABILITY)


def shortest_paths(edges: DataFrame, source: DataFrame, most_rounds: int | None = None) -> DataFrame:
    """(node, cost, displ) of the cheapest paths from the source node of each graph, by Bellman-Ford relaxation.

    edges: graph, a, b, weight, displ, used both ways (displ changes sign). Ties go to the path through the lower node.
    A round is a join and a grouped minimum over a written table; it ends when nothing changes, after as many rounds
    as there are nodes at most.
    """
    both = written(edges.select("graph", "a", "b", "weight", F.col("displ").cast("double").alias("displ")).unionByName(edges.select("graph", F.col("b").alias("a"), F.col("a").alias("b"), "weight", (-F.col("displ")).cast("double").alias("displ"))), "edges")
    nodes = both.select("graph", F.col("a").alias("node")).distinct()
    start = source.select("graph", F.col("node").alias("_s"))
    first = F.col("node") == F.col("_s")
    state = written(nodes.join(start, "graph").select("graph", "node", F.when(first, 0.0).alias("cost"), F.when(first, 0.0).alias("displ"), F.lit(None).cast(both.schema["a"].dataType).alias("via")), "paths")
    rounds = 0
    while most_rounds is None or rounds < most_rounds:
        rounds += 1
        known = state.filter("cost is not null").select("graph", F.col("node").alias("a"), F.col("cost").alias("_c"), F.col("displ").alias("_d"))
        step = both.join(known, ["graph", "a"]).groupBy("graph", F.col("b").alias("node")).agg(F.min(F.struct((F.col("_c") + F.col("weight")).alias("cost"), F.col("a").alias("via"), (F.col("_d") + F.col("displ")).alias("displ"))).alias("n"))
        better = F.col("n").isNotNull() & (F.col("cost").isNull() | (F.col("n.cost") < F.col("cost") - 1e-12))
        moved = state.join(step, ["graph", "node"], "left").select("graph", "node", *(F.when(better, F.col(f"n.{c}")).otherwise(F.col(c)).alias(c) for c in ("cost", "displ", "via")), F.coalesce(better, F.lit(False)).alias("_moved"))
        moved = written(moved, "paths")
        state = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            break
    return state.drop("via")


def place(edges: DataFrame, directions: tuple[str, ...] = ("V", "H", "D"), width: int = 1 << 20) -> DataFrame:
    """(row, col, <direction>..) of tiles: for each direction the shortest path by 1 / reliability from the stitchable tile
    nearest the corner, shifted so that tile (0, 0) lies at 0.

    edges: r0, c0, r1, c1, dir, displ, reliability, stitchable. All directions are solved in the same rounds.
    """
    node = lambda r, c: (F.col(r) * width + F.col(c)).cast("long")
    e = edges.filter(F.col("dir").isin(*directions)).select(F.col("dir").alias("graph"), node("r0", "c0").alias("a"), node("r1", "c1").alias("b"), edge_weight(F.col("reliability")).alias("weight"), "displ", "stitchable")
    ends = e.filter("stitchable").select("graph", F.explode(F.array("a", "b")).alias("node")).distinct()
    corner = ends.withColumn("_d", F.floor(F.col("node") / width) + F.col("node") % width)
    source = corner.groupBy("graph").agg(F.min_by("node", F.struct("_d", "node")).alias("node"))
    paths = shortest_paths(e.drop("stitchable"), source)
    origin = F.first(F.when(F.col("node") == 0, F.col("displ")), ignorenulls=True).over(Window.partitionBy("graph"))
    rel = paths.withColumn("at", F.col("displ") - F.coalesce(origin, F.lit(0.0)))
    return rel.groupBy("node").pivot("graph", list(directions)).agg(F.first("at")).select(F.floor(F.col("node") / width).cast("int").alias("row"), (F.col("node") % width).cast("int").alias("col"), *directions)


def place_least_squares(rows: int, cols: int, edges: list[tuple[tuple[int, int], tuple[int, int], float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """(relaxed, whole) displacements of the edges of a grid that close every loop, by reliability-weighted least squares.

    edges: (tile, next tile, displacement, reliability, slack). The relaxed solution minimises sum r (x - d)^2 subject to
    the loops of four tiles; the whole one rounds tile positions, which closes all loops by itself, within d +- slack
    where it can. A grid is metadata, small by its nature, and solved on the driver.
    """
    index = {(a, b): k for k, (a, b, *_) in enumerate(edges)}
    d = np.array([e[2] for e in edges], float)
    r = np.maximum(np.array([e[3] for e in edges], float), 1e-9)
    loops = []
    for i in range(rows - 1):
        for j in range(cols - 1):
            need = [((i, j), (i, j + 1), 1), ((i, j + 1), (i + 1, j + 1), 1), ((i + 1, j), (i + 1, j + 1), -1), ((i, j), (i + 1, j), -1)]
            if all((a, b) in index for a, b, _ in need):
                row = np.zeros(len(edges))
                for a, b, s in need:
                    row[index[a, b]] = s
                loops.append(row)
    if not loops:
        return d, np.rint(d)
    a = np.array(loops)
    kkt = np.block([[np.diag(2 * r), a.T], [a, np.zeros((len(a), len(a)))]])
    x = np.linalg.lstsq(kkt, np.concatenate([2 * r * d, np.zeros(len(a))]), rcond=None)[0][: len(edges)]
    place_ = {edges[0][0]: 0.0}
    todo = [edges[0][0]]
    links: dict = {}
    for k, (p, q, *_) in enumerate(edges):
        links.setdefault(p, []).append((q, x[k]))
        links.setdefault(q, []).append((p, -x[k]))
    while todo:
        p = todo.pop()
        for q, v in links.get(p, []):
            if q not in place_:
                place_[q] = place_[p] + v
                todo.append(q)
    whole = np.array([np.rint(place_[q]) - np.rint(place_[p]) for p, q, *_ in edges])
    return x, whole


def connected(cells: DataFrame, reach: int = 1) -> DataFrame:
    """(y, x, label) of the 4-connected components of cells (y, x); label is the least y * 2^31 + x."""
    node = F.col("y").cast("long") * (1 << 31) + F.col("x")
    nodes = cells.select(node.alias("node")).distinct()
    steps = [s for k in range(1, reach + 1) for s in (k, k << 31)]
    links = nodes.select(F.col("node").alias("u"), F.explode(F.array(*[F.col("node") + s for s in steps])).alias("v")).join(nodes.withColumnRenamed("node", "v"), "v")
    both = written(links.select("u", "v").union(links.select("v", "u")), "edges")
    labels = written(nodes.withColumn("label", F.col("node")), "labels")
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node", "left").select("node", F.least("label", F.coalesce("near", "label")).alias("next"), F.col("label").alias("old"))
        ahead = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        moved = written(lower.join(ahead, "next").select("node", F.least("next", "jump").alias("label"), "old"), "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels.select(F.shiftright("node", 31).cast("int").alias("y"), F.col("node").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("x"), "label")


def filled_holes(cells: DataFrame, height: int, width: int) -> DataFrame:
    """The cells and all places that no corner of the plane reaches around them."""
    grid = cells.sparkSession.range(height * width).select(F.floor(F.col("id") / width).cast("int").alias("y"), (F.col("id") % width).cast("int").alias("x"))
    open_ = grid.join(cells.select("y", "x").distinct(), ["y", "x"], "left_anti")
    parts = written(connected(open_), "parts")
    corner = F.col("y").isin(0, height - 1) & F.col("x").isin(0, width - 1)
    outside = parts.filter(corner).select("label").distinct()
    return cells.select("y", "x").unionByName(parts.join(outside, "label", "left_anti").select("y", "x")).distinct()
