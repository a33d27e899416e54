from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom.functions import geometry, names, pixel
from voxelloom.model import dtype_for_bytes
from voxelloom.operators import align, mosaic, place, reduce, register, spatial, stats, tracing
from voxelloom.sources import inventory, readers, writers
from voxelloom.streaming import manifest


def px_of(spark, cube):
    return spark.createDataFrame([(*map(int, at), float(v)) for at, v in np.ndenumerate(cube)], "z int, y int, x int, v double")


def one(df):
    return df.first()[0]


def value(spark, column):
    return one(spark.range(1).select(column))


@pytest.mark.parametrize("how,fill", [("max", np.max), ("min", np.min), ("mean", np.mean), ("median", np.median)])
def test_block_reduce_pads_with_zeros(spark, how, fill):
    a = np.random.default_rng(0).integers(1, 99, (1, 7, 9)).astype(float)
    got = {(r.y, r.x): r.v for r in reduce.block_reduce(px_of(spark, a), {"y": 2, "x": 4}, how, ["z"]).collect()}
    wide = np.pad(a[0], ((0, 1), (0, 3)))
    want = fill(wide.reshape(4, 2, 3, 4), axis=(1, 3))
    assert all(abs(got[y, x] - want[y, x]) < 1e-9 for y in range(4) for x in range(3))


def test_alternating_and_z(spark):
    a = np.random.default_rng(1).random((1, 16, 16))
    out, sizes = reduce.alternating(px_of(spark, a), {"y": 16, "x": 16}, 4.0, {"y": 1.0, "x": 1.0})
    w = a[0]
    for k in range(2):
        w = (np.max if k % 2 == 0 else np.mean)(w.reshape(-1, 2, w.shape[1]), axis=1)
        w = (np.mean if k % 2 == 0 else np.max)(w.reshape(w.shape[0], -1, 2), axis=2)
    assert sizes == {"y": 4, "x": 4} and all(abs(r.v - w[r.y, r.x]) < 1e-9 for r in out.collect())
    assert reduce.z_chunks(0, 10, 4) == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10]]
    assert reduce.primes(360) == [2, 2, 2, 3, 3, 5] and len(reduce.spacing_axis(10, 1.0, 4.0, 2.0)) == 3


def test_bit_shift_keeps_what_is_lit(spark):
    v = spark.createDataFrame([(0,), (1,), (7,), (8,), (5000,)], "v int")
    assert [r[0] for r in v.select(pixel.to_uint8(F.col("v"), 3)).collect()] == [0, 1, 1, 1, 255]
    with pytest.raises(ValueError):
        pixel.to_uint8(F.lit(1), 9)
    assert [dtype_for_bytes(n) for n in (1, 2, 8, 9)] == ["uint8", "uint16", "uint16", "uint32"]


def test_pixel_helpers(spark):
    assert value(spark, pixel.enhance(F.lit(5.0), [(0, 0), (10, 100)])) == 50
    assert value(spark, pixel.taper(F.lit(0), 10, 4)) == 0 and value(spark, pixel.taper(F.lit(9), 10, 4)) == pytest.approx(0.25) and value(spark, pixel.taper(F.lit(1), 3, 8)) == 1
    assert value(spark, pixel.composite([F.lit(1), F.lit(2)])) == [1, 2, 0]
    assert value(spark, geometry.mirrored(F.lit(-2), 0, 9)) == 1 and value(spark, geometry.mirrored(F.lit(11), 0, 9)) == 8
    assert value(spark, geometry.transformation_needed([F.lit(0.999)], [F.lit(0.0)])) is True
    assert value(spark, geometry.transformation_needed([F.lit(0.9)], [F.lit(0.0)])) is False


def test_names(spark):
    assert value(spark, names.kept_z(F.lit("[1,3);[7,9)"))) == [1, 2, 7, 8]
    assert value(spark, names.kept_z(F.lit("[1,3);[7,9]"))) == [1, 2, 3, 7, 8, 9]
    assert value(spark, names.has_extension(F.lit("/a/b.TIF"), ".tif")) is True
    assert value(spark, names.remount(F.lit("D:\\x\\y"), {"d": "/mnt/d"})) == "/mnt/d/x/y"
    ordered = inventory.series(spark.createDataFrame([("img_10",), ("img_2",), ("img_1",)], "path string")).orderBy("z").collect()
    assert [r.path for r in ordered] == ["img_1", "img_2", "img_10"]


def test_inventory(spark):
    p = spark.createDataFrame([(f"/r/{x}/{x}_{y}/{z:06d}.tif",) for x in (1000, 5000) for y in (200,) for z in (0, 15, 30)], "path string")
    assert {(r.x0, r.y0) for r in inventory.tile_tree(p, 10.0, 10.0).collect()} == {(0, 0), (40, 0)}
    f = p.withColumn("folder", F.regexp_extract("path", "^(.*)/", 1))
    assert {r.z_step for r in inventory.z_step(f, ["folder"]).collect()} == {1.5}
    assert inventory.odd_folders(f.filter("path <> '/r/1000/1000_200/000000.tif'"), "folder").collect()[0].n_files == 2
    assert {r.folder for r in inventory.rebased_names(p).collect()} == {"000000/000000_000000", "004000/004000_000000"}
    t = inventory.travels(spark.createDataFrame([("a", z) for z in (0, 4, 9, 10, 12, 25)], "k string, z int"), ["k"], "z", 10.0)
    assert [(r.z, r.travel) for r in t.orderBy("z").collect()] == [(0, 0), (4, 0), (9, 0), (10, 1), (12, 1), (25, 2)]


def test_raw_round_trip(spark, tmp_path):
    a = np.arange(64 * 300, dtype=np.uint16).reshape(64, 300)
    (tmp_path / "a.raw").write_bytes(readers.encode_raw(a))
    (tmp_path / "b.raw").write_bytes(np.array([300, 64], ">u4").tobytes() + a.astype(">u2").tobytes())
    (tmp_path / "c.raw").write_bytes(b"no")
    planes = readers.raw_planes(spark, str(tmp_path))
    got = {r.path[-5:]: r for r in planes.collect()}
    assert all((np.frombuffer(got[n].pixels, "<u2").reshape(64, 300) == a).all() for n in ("a.raw", "b.raw")) and got["c.raw"].pixels is None
    px = readers.pixels(planes.filter("path like '%a.raw'"))
    assert px.count() == a.size and px.filter(F.col("v") != F.col("y") * 300 + F.col("x")).isEmpty()


def test_text_formats(spark, tmp_path):
    (tmp_path / "t.swc").write_text("# note\n1 1 0.5  2 3 4 -1\n 2 3 1 2 3 1 1\n\n")
    rows = readers.read_swc(spark, str(tmp_path / "t.swc")).orderBy("id").collect()
    assert [(r.id, r.x, r.parent_id) for r in rows] == [(1, 0.5, -1), (2, 1.0, 1)]
    back = str(tmp_path / "out")
    writers.write_swc(readers.read_swc(spark, str(tmp_path / "t.swc")), back)
    assert readers.read_swc(spark, back).drop("file").orderBy("id").collect() == readers.read_swc(spark, str(tmp_path / "t.swc")).drop("file").orderBy("id").collect()
    points = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 8.0)], "n int, x double, y double, z double, volsize double")
    (tmp_path / "p.apo").write_text(writers.apo_header() + "\n" + writers.apo_lines(points).first()[0] + "\n")
    r = readers.read_apo(spark, str(tmp_path / "p.apo")).first()
    assert (r.n, r.x, r.y, r.z, r.volsize) == (1, 1.0, 2.0, 3.0, 8.0)
    (tmp_path / "marker_1_2_3_4").write_text(writers.marker_text(1, 2, 3, 4))
    assert readers.read_markers(spark, str(tmp_path)).select("x", "radius").collect() == [(1.0, 4.0)]
    (tmp_path / "p.xml").write_text('<V><STACKS><Stack ROW="0" COL="1" ABS_V="5"/><Stack ROW="1" COL="1" ABS_V="7"/></STACKS></V>')
    assert readers.read_project(spark, str(tmp_path / "p.xml")).select("_ROW", "_ABS_V").orderBy("_ROW").collect() == [(0, 5), (1, 7)]
    assert writers.ano_text("a", "b") == "APOFILE=a\nSWCFILE=b\n"


def test_volumes_and_crops(spark, tmp_path):
    px = px_of(spark, np.arange(60.0).reshape(3, 4, 5)).withColumn("channel", F.lit(0)).withColumn("res", F.lit(0))
    writers.write_volume(px, str(tmp_path / "v"), partition=["res", "channel"])
    back = spark.read.parquet(str(tmp_path / "v"))
    assert readers.crop(back, (1, 0, 2), (1, 2, 0), 0, 0).count() == 6
    with pytest.raises(ValueError):
        readers.crop(back, (-1, 0, 0), (0, 0, 0))
    writers.write_reduced(px, {"z": [0, 1], "x": [2.0]}, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r/axes")).count() == 2


def test_multi_otsu_separates_classes(spark):
    h = spark.createDataFrame([(float(c + d), 10) for c in (0, 100, 200, 300) for d in range(5)], "v double, n long")
    t = stats.multi_otsu(h, "v").first()
    assert 0 <= t.t1 < 100 <= t.t2 < 200 <= t.t3 < 300
    flat = stats.otsu(spark.createDataFrame([(7, 5)], "v int, n long"), "v")
    assert one(flat) == 7


def test_meshes(spark):
    c = [(x, y, z) for x in (0.0, 10.0) for y in (0.0, 10.0) for z in (0.0, 10.0)]
    quads = [(0, 1, 3, 2), (4, 6, 7, 5), (0, 4, 5, 1), (2, 3, 7, 6), (0, 2, 6, 4), (1, 5, 7, 3)]
    tri = [("cube", *c[a], *c[b], *c[d]) for q in quads for a, b, d in ((q[0], q[1], q[2]), (q[0], q[2], q[3]))]
    t = spark.createDataFrame(tri, "region string, ax double, ay double, az double, bx double, by double, bz double, cx double, cy double, cz double")
    p = spark.createDataFrame([(0, 5.0, 5.0, 5.0), (1, 5.0, 5.0, 15.0), (2, 5.0, 5.0, -1.0), (3, 12.0, 5.0, 5.0), (4, 1.0, 9.0, 9.5), (5, 3.0, 3.0, 3.0)], "id int, x double, y double, z double")
    assert sorted(r.id for r in spatial.points_in_meshes(p, t, ["id"], 4.0).collect()) == [0, 4, 5]


def test_nearest_strong_matches_brute_force(spark):
    r = np.random.default_rng(3)
    cells = [(int(p), int(x), int(y), bool(s)) for p in range(2) for x, y, s in zip(r.permutation(60), r.integers(0, 90, 60), r.random(60) < 0.1, strict=True)]
    got = {(q.p, q.x, q.y): q.d2 for q in spatial.nearest_strong(spark.createDataFrame(cells, "p int, x int, y int, strong boolean"), "p").collect()}
    for p, x, y, _ in cells:
        assert got[p, x, y] == min((x - a) ** 2 + (y - b) ** 2 for q, a, b, s in cells if s and q == p)


def test_block_coverage_faults(spark):
    shape = {"x": 20, "y": 20, "z": 10}
    good = spatial.block_grid(shape, {"x": 10, "y": 10, "z": 5}, spark)
    assert {r.fault: r.n for r in spatial.coverage_faults(good, shape).collect()} == {"corners": 0, "uncovered z": 0, "overlap": 0, "face gaps": 0}
    bad = good.filter("z1 > 1").withColumn("x2", F.col("x2") + 4).withColumn("y2", F.col("y2") + 4)
    found = {r.fault: r.n for r in spatial.coverage_faults(bad, shape).collect()}
    assert found["corners"] > 0 and found["uncovered z"] == 5


def test_alignment_finds_the_shift(spark):
    r = np.random.default_rng(5)
    a = r.random((24, 24))
    b = np.roll(a, (2, -3), (0, 1))
    frame = lambda m: spark.createDataFrame([(0, int(y), int(x), float(v)) for (y, x), v in np.ndenumerate(m)], "k int, y int, x int, v double")
    cand = align.offsets(spark, 4, 4)
    scores = align.correlations(frame(a), frame(b), cand, "k")
    best = align.best_offset(scores, "k").first()
    assert (best.dy, best.dx) == (-2, 3)
    assert align.peak_width(scores, "k", "dy").first().width == 1
    flat = align.correlations(frame(np.ones((6, 6))), frame(np.ones((6, 6))), cand, "k")
    assert {s.score for s in flat.collect()} == {0.0}
    lit = align.best_offset(align.correlations(frame(a), frame(b), cand, "k", dark=0.2), "k").first()
    assert (lit.dy, lit.dx) == (-2, 3)
    assert align.sub_volumes(10, 4) == [(0, 4), (4, 7), (7, 10)]


def test_registration_of_volumes(spark):
    r = np.random.default_rng(6)
    a = r.random((8, 12, 12))
    a = (a + np.roll(a, 1, 0) + np.roll(a, 1, 1) + np.roll(a, 1, 2)) / 4
    b = px_of(spark, a).withColumn("y", F.col("y") - 1).withColumn("x", F.col("x") + 2)
    move = register.align_volumes(px_of(spark, a), b, {"z": 8, "y": 12, "x": 12}, 3, most_rounds=3)
    assert (move["y"], move["x"]) == (1, -2)
    assert register.scaled_shift({"z": 3}, {"z": 4.0}, {"z": 1.5}) == {"z": 8}


def test_ties_of_projection_and_merge(spark):
    rows = [(0, 0, "V", 2, 5, 1, 0.5, 3, 9), (0, 0, "V", 1, 4, 1, 0.5, 3, 9), (0, 1, "V", 1, 4, 1, 0.0, 9, 9)]
    e = spark.createDataFrame(rows, "r0 int, c0 int, dir string, layer int, displ int, default_displ int, peak double, width int, inv_width int")
    p = {(r.c0): r for r in align.threshold(align.project(e, ["r0", "c0", "dir"]), 0.3).collect()}
    assert p[0].layer == 1 and p[0].displ == 4 and (p[1].displ, p[1].reliability, p[1].width) == (1, 0.0, 9)


def test_least_squares_closes_loops():
    t = lambda i, j: (i, j)
    edges = [(t(0, 0), t(0, 1), 10.0, 1.0, 5.0), (t(1, 0), t(1, 1), 14.0, 1.0, 5.0), (t(0, 0), t(1, 0), 1.0, 1.0, 5.0), (t(0, 1), t(1, 1), 1.0, 3.0, 5.0)]
    x, whole = place.place_least_squares(2, 2, edges)
    assert abs(x[0] + x[3] - x[1] - x[2]) < 1e-9 and whole[0] + whole[3] - whole[1] - whole[2] == 0


def test_components_and_holes(spark):
    ring = [(y, x) for y in range(2, 7) for x in range(2, 7) if y in (2, 6) or x in (2, 6)]
    cells = spark.createDataFrame([*ring, (8, 8)], "y int, x int")
    assert place.connected(cells).select("label").distinct().count() == 2
    assert place.filled_holes(cells, 10, 10).count() == 26


def test_tree_orders(spark):
    rows = [("a", 1, 1, -1), ("a", 2, 3, 1), ("a", 3, 3, 1), ("a", 4, 3, 2), ("a", 9, 3, 77), ("a", 2, 3, 1), ("b", 5, 1, 0), ("b", 6, 2, 5), ("c", 1, 1, 3), ("c", 2, 1, 1), ("d", 7, 1, 8), ("d", 8, 1, 7)]
    t = spark.createDataFrame([(f, i, k, 0.0, 0.0, float(i), 1.0, p) for f, i, k, p in rows], "file string, id int, type int, x double, y double, z double, radius double, parent_id int")
    got = {f: [(r.id, int(r.z), r.parent_id) for r in tracing.sort_tree(t).filter(F.col("file") == f).orderBy("id").collect()] for f in "abcd"}
    assert got["a"] == [(1, 1, -1), (2, 2, 1), (3, 4, 2), (4, 3, 1)]
    assert got["b"] == [(1, 5, -1), (2, 6, 1)] and got["c"] == [(1, 1, -1), (2, 2, 1)] and got["d"] == []
    two = t.filter("file = 'b'").withColumn("parent_id", F.lit(0))
    with pytest.raises(ValueError):
        tracing.sort_tree(two).count()


def test_tracing_conversions(spark):
    apo = spark.createDataFrame([(2, 1.0, 2.0, 3.0), (1, 1.0, 2.0, 3.0), (1, 1.0, 2.0, 3.0)], "n int, x double, y double, z double")
    swc = tracing.apo_to_swc(apo)
    assert swc.count() == 2 and tracing.to_swc(tracing.to_eswc(swc)).columns == swc.columns
    assert [(r.id, r.parent_id) for r in tracing.seed_pairs(swc.filter("id = 1")).orderBy("id").collect()] == [(1, 0), (2, 1)]
    assert tracing.to_seeds(swc).first().name == "[1,2,3]-r=12.swc"
    assert tracing.rescale_nodes(swc, (1, 1, 2), (2, 1, 1), {"x": 5.0}).first().x == 2.0
    m = tracing.somas_to_markers(spark.createDataFrame([(1.9, 2.2, 3.0, 7.8)], "x double, y double, z double, volume double"), (1.0, 2.0, 1.0))
    assert m.first().name == "marker_1_4_3_7"
    points = spark.createDataFrame([(1.2, 2.0, 3.0, 33.510321638)], "x double, y double, z double, volsize double")
    back = tracing.consolidated(tracing.apo_to_markers(points, (1.0, 1.0, 1.0))).first()
    assert (back.x, back.radius) == (1, 10.0)
    assert tracing.affine(points, (-1.0, 1.0, 1.0), (5.0, 0.0, 0.0)).first().x == pytest.approx(3.8)


def test_mosaic_helpers(spark):
    assert mosaic.output_tiles(1050, 500) == [(0, 350), (350, 700), (700, 1050)] and mosaic.output_tiles(90, 50) == [(0, 90)]
    b = spark.createDataFrame([(3, 5, 1, 2, 7, 9), (4, 6, 0, 2, 8, 9)], "x0 int, x1 int, y0 int, y1 int, z0 int, z1 int")
    assert mosaic.rebased(b).agg(F.min("x0"), F.min("y0"), F.min("z0")).first() == (0, 0, 0)
    px = spark.createDataFrame([(1, 0, 0, 0, 5), (2, 0, 0, 0, 7), (2, 0, 0, 1, 9)], "stack int, z int, y int, x int, v int")
    assert mosaic.diagnostic(px, [1, 2]).orderBy("x").collect() == [(0, 0, 0, 5, 7), (0, 0, 1, 0, 9)]
    assert mosaic.scanner_x(spark.createDataFrame([(0, 0, 5), (1, 0, 6), (2, 0, 7)], "x int, y int, x_off_x int"), 1.0).orderBy("x").select("x0").collect() == [(0.0,), (5.0,), (11.0,)]
    blend = lambda name, angle: value(spark, mosaic.BLENDS[name](F.lit(3.0), F.lit(4.0), F.lit(angle), F.lit(0.5)))
    assert [blend("margin", t) for t in (1.2, 1.7, 2.2)] == [3, 1, 4] and blend("margin", 1.5707963267948966) == 3
    assert blend("enhanced", 0.0) == 4 and blend("sinusoidal", 0.0) == 3 and blend("none", 1.6) == 4


def test_stream_of_planes_is_processed_once(spark, tmp_path):
    src, out, man = (str(tmp_path / n) for n in ("src", "out", "man"))
    spark.createDataFrame([(1, 5), (2, 6), (2, 6)], "z int, v int").write.parquet(src)
    for _ in range(2):
        stream = manifest.new_planes(spark, src, "z int, v int")
        manifest.process_new(stream, lambda d: d.withColumn("v", F.col("v") * 2), out, man, ["z"], str(tmp_path / "ck")).awaitTermination()
        spark.createDataFrame([(2, 6), (3, 7)], "z int, v int").write.mode("append").parquet(src)
    assert sorted((r.z, r.v) for r in spark.read.parquet(out).collect()) == [(1, 10), (2, 12), (3, 14)]


def test_streaming_windows(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (4000, "a", 5.0)], "s long, event_type string, value double").select(F.timestamp_seconds("s").alias("ts"), "event_type", "value").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(str(tmp_path / "e"))
    q = manifest.windowed(stream).writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.total for r in spark.table("w").collect()) == [3.0, 5.0]


def test_range_shrinks_to_stitchable_tiles(spark):
    good = {(1, 2), (3, 1)}
    tiles = spark.createDataFrame([(r, c, (r, c) in good) for r in range(5) for c in range(4)], "r0 int, c0 int, stitchable boolean")
    got = align.stitchable_range(tiles, "r0", "c0")
    assert got.columns == tiles.columns and sorted((x.r0, x.c0) for x in got.collect()) == [(r, c) for r in (1, 2, 3) for c in (1, 2)]
    assert align.stitchable_range(tiles.withColumn("stitchable", F.lit(False)), "r0", "c0").count() == 0


def test_a_tree_is_walked_along_its_first_children(spark):
    parents = {1: -1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3, 7: 3}
    t = spark.createDataFrame([("f", i, 3, 0.0, 0.0, float(i), 1.0, p) for i, p in parents.items()], "file string, id int, type int, x double, y double, z double, radius double, parent_id int")
    got = tracing.sort_tree(t).orderBy("id").collect()
    assert [int(r.z) for r in got] == [1, 2, 4, 5, 3, 6, 7] and [r.parent_id for r in got] == [-1, 1, 2, 2, 1, 5, 5]
    long = spark.range(1, 20_001).select(F.lit("g").alias("file"), F.col("id").cast("int"), F.lit(3).alias("type"), F.col("id").cast("double").alias("z"), F.when(F.col("id") == 1, -1).otherwise(F.col("id") - 1).cast("int").alias("parent_id"))
    assert tracing.sort_tree(long).filter("id = z and parent_id = if(id = 1, -1, id - 1)").count() == 20_000


def test_estimates_are_combined_by_peak(spark):
    est = lambda d, p, w: {"displ": F.lit(d), "peak": F.lit(p), "width": F.lit(w)}
    both = value(spark, align.combine(est(10, 0.3, 5), est(12, 0.6, 20)))  # (3 + 7.2) / 0.9 = 11.33
    assert (both.displ, both.width) == (11, 20) and both.peak == pytest.approx(0.5)
    assert value(spark, align.combine(est(10, 0.2, 4), est(40, 0.4, 8))).displ == 40  # a tie goes to the second
    assert value(spark, align.combine(est(10, 0.3, 4), est(40, 0.4, 8))).displ == 10


def test_consensus_is_above_the_threshold_and_minus_one_is_zero(spark):
    rows = [(1, 0.5, 9)] * 5 + [(1, 0.6, -1)] * 3 + [(2, 0.6, -2)] * 3
    t = spark.createDataFrame(rows, "z int, score double, zoff int")
    assert {r.z: r.zoff for r in align.consensus_z(t, 0.5, 5, 2).collect()} == {1: 0.0, 2: -2.0}


def test_next_round_trims_and_truncates(spark):
    rows = [("x", 0.8, v, 0, 0) for v in [0] * 50 + [3, -1, 400]] + [("y", 0.9, 1, 2, 0)] * 3 + [("z", 0.9, 0, 0, 7)] * 3 + [("z", 0.1, 90, 90, 90)]
    got = align.next_round(spark.createDataFrame(rows, "axis string, score double, xoff int, yoff int, zoff int"), 0.75, decimate=4).first()
    assert (got.x_slop, got.y_slop, got.z_slop) == (3 + 4, 4, 4) and (got.xoff_x, got.xoff_y, got.zoff_z) == (0, 1, 7)  # int(3 * 1.25) = 3


def brute_cosine(px, boxes):
    """Weights by whole arrays of the shared boxes."""

    def distance(s, o):
        lo, hi = [max(a, b) for a, b in zip(s[0], o[0], strict=True)], [min(a, b) for a, b in zip(s[1], o[1], strict=True)]
        shape = [b - a for a, b in zip(lo, hi, strict=True)]
        cut = {k: (o[1][k] > s[0][k] > o[0][k], o[0][k] < s[1][k] < o[1][k]) for k in (0, 1)}
        most = min([np.inf, *(shape[k] for k in (0, 1) if o[0][k] != s[0][k] and o[1][k] != s[1][k])])
        out = np.full(shape, most)
        for k in (0, 1):
            i = np.arange(shape[k]).reshape([-1 if j == k else 1 for j in (0, 1)])
            if cut[k][0]:
                out = np.minimum(out, i + 1)
            if cut[k][1]:
                out = np.minimum(out, shape[k] - i)
        return lo, hi, out

    weight = {(s, y, x): 1.0 for s, y, x, _ in px}
    for s, a in boxes.items():
        for o, b in boxes.items():
            if s != o and all(a[0][k] < b[1][k] and b[0][k] < a[1][k] for k in (0, 1)):
                lo, hi, d = distance(a, b)
                other = distance(b, a)[2]
                if np.isinf(d.min()):
                    d = np.full(d.shape, other.max())
                elif np.isinf(other.min()):
                    other = np.full(d.shape, d.max())
                w = np.sin(np.arctan2(d, other)) ** 2
                for y in range(lo[0], hi[0]):
                    for x in range(lo[1], hi[1]):
                        weight[s, y, x] *= w[y - lo[0], x - lo[1]]
    top, low = {}, {}
    for s, y, x, v in px:
        top[y, x] = top.get((y, x), 0) + v * weight[s, y, x]
        low[y, x] = low.get((y, x), 0) + weight[s, y, x]
    return {k: top[k] / low[k] for k in top}


@pytest.mark.parametrize("most", [0, 500_000])
def test_mosaic_of_partly_covered_contained_and_equal_stacks(spark, most):
    boxes = {1: ((0, 0), (10, 12)), 2: ((3, 4), (7, 9)), 3: ((6, 8), (14, 20)), 4: ((0, 8), (10, 16)), 5: ((0, 0), (10, 12)), 6: ((0, 18), (14, 26)), 7: ((0, 30), (10, 40)), 8: ((0, 34), (10, 37))}
    px = [(s, y, x, (s * 31 + y * 7 + x * 3) % 50 + 1) for s, ((y0, x0), (y1, x1)) in boxes.items() for y in range(y0, y1) for x in range(x0, x1)]
    stacks = spark.createDataFrame([(s, x0, x1, y0, y1, 0, 1) for s, ((y0, x0), (y1, x1)) in boxes.items()], "stack int, x0 int, x1 int, y0 int, y1 int, z0 int, z1 int")
    table = spark.createDataFrame([(s, 0, y, x, v) for s, y, x, v in px], "stack int, z int, y int, x int, v int")
    got = {(r.y, r.x): r.v for r in mosaic.mosaic_cosine(table, stacks, 8, most).collect()}
    want = brute_cosine(px, boxes)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_a_replayed_epoch_keeps_its_output(spark, tmp_path):
    out, man = str(tmp_path / "out"), str(tmp_path / "man")
    kept = {}

    class Stream:
        writeStream = property(lambda self: self)

        def foreachBatch(self, f):
            kept["batch"] = f
            return self

        option = trigger = lambda self, *a, **k: self
        start = lambda self: None

    manifest.process_new(Stream(), lambda d: d, out, man, ["z"], "ck")
    df = spark.createDataFrame([(k, k) for k in range(5)], "z int, v int")
    for epoch, rows in ((0, df), (0, df), (1, df.union(df.selectExpr("z + 3", "v"))), (1, df.union(df.selectExpr("z + 3", "v")))):
        kept["batch"](rows, epoch)
        assert spark.read.parquet(out).filter(f"epoch = {epoch}").count() == (5 if epoch == 0 else 3)
    manifest.process_new(Stream(), lambda d: d, out, man, ["z"], "another")
    kept["batch"](df, 0)
    assert sorted(r.z for r in spark.read.parquet(out).collect()) == list(range(8))


def test_raw_planes_of_equal_widths_are_big_endian():
    pixels = np.arange(65_792) % 65_536
    plane = readers.decode_raw(np.array([65_792, 1], ">u4").tobytes() + pixels.astype(">u2").tobytes())  # its bytes are the same from both ends
    assert plane.shape == (1, 65_792) and (plane[0] == pixels).all()


def test_z_ranges_of_all_brackets(spark):
    assert value(spark, names.kept_z(F.lit("(1,4);[7,9)"))) == [2, 3, 7, 8]


def test_reliability_is_relative_to_the_invalid_width(spark):
    assert value(spark, pixel.reliability(F.lit(0.6), F.lit(15), F.lit(30))) == pytest.approx((0.5 * 0.25 + 0.5 * 0.36) ** 0.5)
    assert value(spark, pixel.reliability(F.lit(0.0), F.lit(99), F.lit(99))) == 0


def test_faces_with_holes(spark):
    shape = {"x": 5, "y": 4, "z": 3}
    cells = [(1, 1, 5, 1, 2, 1, 3), (2, 1, 3, 3, 4, 1, 3), (3, 5, 5, 3, 4, 2, 3)]  # the column x = 4 of the upper half is open, and x = 5 at z = 1
    b = spark.createDataFrame(cells, "block int, x1 int, x2 int, y1 int, y2 int, z1 int, z2 int")
    got = {(r.axis, r.place): r.n for r in spatial.face_gaps(b, shape).collect()}
    held = {(x, y, z) for _, a, b_, c, d, e, f in cells for x in range(a, b_ + 1) for y in range(c, d + 1) for z in range(e, f + 1)}
    size = [shape[c] for c in "xyz"]
    want = {}
    for k, axis in enumerate("xyz"):
        for place in {1, size[k]}:
            at = [range(1, n + 1) if j != k else [place] for j, n in enumerate(size)]
            want[axis, place] = sum((x, y, z) not in held for x in at[0] for y in at[1] for z in at[2])
    assert got == want and sum(want.values()) > 0


def test_a_pair_must_have_one_displacement(spark):
    pairs = spark.createDataFrame([(1,), (2,)], "a int")
    ok = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "a int, displ int")
    assert {r.a: r.displ for r in align.displacement_of(pairs, ok, ["a"]).collect()} == {1: 5, 2: 6}
    for bad in (ok.filter("a <> 2"), ok.union(ok.filter("a = 1"))):
        with pytest.raises(Exception, match="displacements"):
            align.displacement_of(pairs, bad, ["a"]).collect()
