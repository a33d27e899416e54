"""Further operators of the engine on the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import names as N
from ..functions import pixel as P
from ..operators import align, decon, mosaic, reduce, register, spatial, tracing
from ..sources import inventory, readers
from .volume_queries import _EDGES, _ST, PX, VX, _edges, _stack_pixels, planes, query, table, voxels


@query("""select c_custkey, cast(row_number() over (partition by c_nationkey order by c_custkey) + 9 as integer) as z from customer""")
def plane_series(spark, sf_dir):
    name = F.format_string("/r/%d/img_%d.tif", F.col("c_nationkey").cast("int"), F.col("c_custkey").cast("int"))
    p = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", name.alias("path"))
    return inventory.series(p, ["c_nationkey"], 10).select("c_custkey", F.col("z").cast("int").alias("z"))


@query(f"""with {VX} select channel, z, y, x, v from vx where channel = 'A' and z between 2 and 4 and y >= 5 and x between 8 and 17""")
def cropped_volume(spark, sf_dir):
    v = voxels(spark, sf_dir).withColumn("channel", F.when(F.col("channel") == "A", 0).otherwise(1))
    return readers.crop(v, (2, 5, 8), (3, 0, 10), channel=0).select(F.lit("A").alias("channel"), "z", "y", "x", "v")


@query(f"""with {VX}, p as (select z, y, x, max(v) as v from vx group by all), a as (select z // 2 as z, y, x, max(v) as v from p group by all) select cast(z // 2 as integer) as z, y, x, round(sum(v) / 2.0, 6) as v from a group by z // 2, y, x""")
def reduced_along_z(spark, sf_dir):
    px = voxels(spark, sf_dir).groupBy("z", "y", "x").agg(F.max("v").alias("v"))
    return reduce.z_reduce(px, 4.0, 1.0).select(F.col("z").cast("int").alias("z"), "y", "x", F.round(F.col("v").cast("double"), 6).alias("v"))


@query(f"""with {PX}, a as (select z, y // 2 as y, x, max(v) as v from px group by all), b as (select z, y, x // 2 as x, sum(v) / 2.0 as v from a group by z, y, x // 2)
select z, cast(y as integer) as y, cast(x as integer) as x, round(v, 6) as v from b""")
def reduced_in_turn(spark, sf_dir):
    out, _ = reduce.alternating(planes(spark, sf_dir), {"y": 8, "x": 8}, 2.0, {"y": 1.0, "x": 1.0})
    return out.select("z", F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.round(F.col("v").cast("double"), 6).alias("v"))


def _points(spark, sf_dir):
    """Points with repeated rows from the suppliers."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.cast("int").alias("n"), (k % 17 * 1.5).alias("x"), (k % 13 * 2.5).alias("y"), (k % 7 * 1.0).alias("z"), (k % 29 + 1.0).alias("volsize"))


_POINTS = "ap as (select cast(s_suppkey as integer) as n, cast(s_suppkey % 17 * 1.5 as double) as x, cast(s_suppkey % 13 * 2.5 as double) as y, cast(s_suppkey % 7 * 1.0 as double) as z, cast(s_suppkey % 29 + 1.0 as double) as volsize from supplier)"


@query(f"""with {_POINTS}, d as (select distinct n, x, y, z from (select * from ap union all select * from ap)) select cast(row_number() over (order by n) as integer) as id, 1 as type, x, y, z, 12.0::double as radius, -1 as parent_id from d""")
def points_to_nodes(spark, sf_dir):
    p = _points(spark, sf_dir).drop("volsize")
    return tracing.apo_to_swc(p.union(p))


@query(f"""with {_POINTS} select cast(round(x * 2) as integer) as x, cast(round(y * 2) as integer) as y, cast(round(z * 4) as integer) as z, round(pow(3 * volsize / (4 * pi()), 1 / 3.0), 6) as radius from ap""")
def points_to_markers(spark, sf_dir):
    return tracing.apo_to_markers(_points(spark, sf_dir), (2.0, 2.0, 4.0)).withColumn("radius", F.round("radius", 6))


@query(f"""with {_POINTS}, m as (select cast(n as double) as x, y, z, volsize as radius from ap) select cast(row_number() over (order by x, y, z, radius) as integer) as id, 1 as type, x, y, z, greatest(radius, 10.0) as radius, -1 as parent_id from m""")
def markers_as_roots(spark, sf_dir):
    return tracing.consolidated(_points(spark, sf_dir).select(F.col("n").cast("double").alias("x"), "y", "z", F.col("volsize").alias("radius")))


@query(f"""with {_POINTS} select n, round((100.0 - x) * 0.5, 9) as x, round(y * 2, 9) as y, round(z * -3 + 1, 9) as z from ap""")
def nodes_moved(spark, sf_dir):
    p = tracing.rescale_nodes(_points(spark, sf_dir), (1.0, 2.0, 1.0), (2.0, 1.0, 1.0), {"x": 100.0})
    return tracing.affine(p, (1.0, 1.0, -3.0), (0.0, 0.0, 1.0)).select("n", *(F.round(c, 9).alias(c) for c in "xyz"))


@query("""select s_suppkey from supplier where s_suppkey % 4 in (0, 1) or s_suppkey % 3 - 1 in (-1, 0)""")
def soma_filter(spark, sf_dir):
    k = F.col("s_suppkey")
    return tracing.valid_soma(table(spark, sf_dir, "supplier").select("s_suppkey", (k % 4).alias("type"), (k % 3 - 1).alias("parent_id"))).select("s_suppkey")


@query("""with t as (select c_custkey, c_nationkey * 40 as x, c_custkey % 9 * 25 as y from customer) select c_custkey, lpad(cast(x - min(x) over () as varchar), 6, '0') || '/' || lpad(cast(x - min(x) over () as varchar), 6, '0') || '_' || lpad(cast(y - min(y) over () as varchar), 6, '0') as folder from t""")
def tile_folders(spark, sf_dir):
    x, y = (F.col("c_nationkey") * 40).cast("string"), (F.col("c_custkey") % 9 * 25).cast("string")
    p = table(spark, sf_dir, "customer").select(F.concat(F.lit("/r/"), x, F.lit("/"), x, F.lit("_"), y, F.lit("/"), F.col("c_custkey").cast("string"), F.lit(".tif")).alias("path"))
    return inventory.rebased_names(p).select(N.stem(F.col("path")).cast("long").alias("c_custkey"), "folder")


@query(f"""with {PX} select z, y, x + 2 as x, v from px where x + 2 between 0 and 7""")
def axis_corrected(spark, sf_dir):
    moved = planes(spark, sf_dir).withColumn("x", F.col("x") + 4)  # a wider plane whose first four columns are blank
    return G.corrected(moved, "x", 10, 8, at_end=False).select("z", "y", "x", "v")


@query(f"""with {VX} select z as y, x, cast(max(v) as integer) as v from vx where y = 3 group by all""")
def layer_across(spark, sf_dir):
    px = voxels(spark, sf_dir).groupBy("z", "y", "x").agg(F.max("v").alias("v"))
    return G.layer(px, "y", 3)


@query("""select s_suppkey, abs(round(s_acctbal / 5000, 2)) >= 1 or abs(s_suppkey % 7 / 300.0) > 0.01 as needed from supplier""")
def needs_transformation(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", G.transformation_needed([F.col("s_acctbal") / 5000], [F.col("s_suppkey") % 7 / 300.0]).alias("needed"))


@query("""select s_suppkey, cast(s_suppkey + 5 - 3 - s_suppkey % 4 as bigint) as z from supplier""")
def channel_planes(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", register.aligned_z(F.col("s_suppkey"), 100, 5, 3, F.col("s_suppkey") % 4).cast("long").alias("z"))


@query(f"""with {_ST} select y, x, cast(coalesce(max(case when stack = 1 then v end), 0) as integer) as c0, cast(coalesce(max(case when stack = 2 then v end), 0) as integer) as c1, cast(coalesce(max(case when stack = 21 then v end), 0) as integer) as c2 from sp group by all""")
def stack_channels(spark, sf_dir):
    return mosaic.diagnostic(_stack_pixels(spark, sf_dir)[1], [1, 2, 21]).drop("z")


@query("""select x, y, round(coalesce(sum(x_off_x) over (partition by y order by x rows between unbounded preceding and 1 preceding), 0) - y * 1.5, 6) as x0 from (select n_nationkey % 5 as x, n_nationkey // 5 as y, n_nationkey * 3 % 7 as x_off_x from nation)""")
def scanner_columns(spark, sf_dir):
    k = F.col("n_nationkey")
    s = table(spark, sf_dir, "nation").select((k % 5).alias("x"), F.floor(k / 5).cast("int").alias("y"), (k * 3 % 7).alias("x_off_x"))
    return mosaic.scanner_x(s, 1.5).select("x", "y", F.round("x0", 6).alias("x0"))


@query(f"""with {PX} select z, y, x, round(case when v <= 500 then 0.0 when v <= 2000 then 0 + (v - 500) * (1000 / 1500.0) when v <= 4000 then 1000 + (v - 2000) * (100 / 2000.0) else 1100.0 end, 6) as v from px""")
def enhanced_pixels(spark, sf_dir):
    return planes(spark, sf_dir).select("z", "y", "x", F.round(P.enhance(F.col("v"), [(500, 0), (2000, 1000), (4000, 1100)]), 6).alias("v"))


@query(f"""with {PX} select z, y, x, round(m * v + (1 - m) * 7.0, 6) as v from (select *, least(1.0, x / 3.0, (8 - x) / 3.0) * least(1.0, y / 4.0, (8 - y) / 4.0) as m from px)""")
def tapered_pixels(spark, sf_dir):
    m = P.taper(F.col("x"), 8, 3) * P.taper(F.col("y"), 8, 9)
    return planes(spark, sf_dir).select("z", "y", "x", F.round(P.blend(m, F.col("v"), F.lit(7.0)), 6).alias("v"))


@query("""select c_custkey, '/mnt/' || case when c_custkey % 2 = 0 then 'y' else 'z' end || '/a/' || c_custkey || '.tif' as path from customer""")
def remounted_paths(spark, sf_dir):
    p = F.format_string("%s:\\a\\%d.tif", F.when(F.col("c_custkey") % 2 == 0, "Y").otherwise("z"), F.col("c_custkey").cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", N.remount(p, {"y": "/mnt/y", "z": "/mnt/z"}).alias("path"))


@query(f"""with {_EDGES}, t as (select r0, c0, max(rel) >= 0.9 as stitchable from er group by all), e as (select min(r0) as r0, max(r0) as r1, min(c0) as c0, max(c0) as c1 from t where stitchable) select t.* from t, e where t.r0 between e.r0 and e.r1 and t.c0 between e.c0 and e.c1""")
def stitchable_range(spark, sf_dir):
    r = _edges(spark, sf_dir).withColumn("reliability", P.reliability(F.col("peak"), F.col("width"), F.col("inv_width")))
    return align.stitchable_range(align.stitchable(r, ["r0", "c0"], 0.9), "r0", "c0")


_STRIPES = f"""with {_ST}, t as (select y0 // 8 as row, stack, x0, lead(x0) over w as nx, lag(x0 + 12) over w as lx from st window w as (partition by y0 order by x0)),
p as (select row, y, x, v, x < coalesce(lx, -1) as r, case when x < coalesce(lx, -1) then (x - sp.x0) * pi() / 3 when x >= coalesce(nx, 100000) then (x - nx) * pi() / 3 end as a from sp join t using (stack)),
b as (select row, y, x, max(case when not r then v end) as l, max(case when r then v end) as q, max(a) as a from p group by all)
select cast(row as integer) as row, y, x, round(cast(case when l is null then q when q is null then l else {{}} end as double), 6) as v from b"""


def _stripes(spark, sf_dir, blend):
    s, px = _stack_pixels(spark, sf_dir)
    tiles = s.select(F.floor(F.col("y0") / 8).cast("int").alias("row"), (F.floor(F.col("x0") / 8)).cast("int").alias("col"), "x0", "x1", "stack")
    out = mosaic.stripe(px.join(tiles.select("stack", "row", "col"), "stack").select("row", "col", "y", "x", "v"), tiles.drop("stack"), blend)
    return out.select("row", "y", "x", F.round(F.col("v").cast("double"), 6).alias("v"))


@query(_STRIPES.format("(cos(a) + 1) / 2 * q + (1 - (cos(a) + 1) / 2) * l"))
def stripe_enhanced(spark, sf_dir):
    return _stripes(spark, sf_dir, "enhanced")


@query(_STRIPES.format("case when a > 1.5707 and a - pi() / 3 < 1.5707 then 1 when a <= 1.5707 then l else q end"))
def stripe_margin(spark, sf_dir):
    return _stripes(spark, sf_dir, "margin")


@query(f"""with {PX}, b as (select min(v) as lo, max(v) as hi from px) select z, y, x, cast(least(255.0, greatest(0.0, round(case when lo > 0 then (v - lo) * 255.0 / (hi - lo) else v * 255.0 / hi end - 1.0))) as integer) as v from px, b""")
def normalised_volume(spark, sf_dir):
    px = planes(spark, sf_dir).withColumn("v", F.col("v").cast("double"))
    return decon.normalised(px, 255.0, 1.0).select("z", "y", "x", F.col("v").cast("int").alias("v"))


@query("""select c_custkey, [cast(c_custkey % 3 as bigint), cast(c_custkey % 5 as bigint), 0::bigint] as two, [cast(c_custkey % 7 as bigint), cast(c_custkey % 5 as bigint), cast(c_custkey % 3 as bigint)] as three from customer""")
def colour_planes(spark, sf_dir):
    a, b, c = (F.col("c_custkey") % k for k in (3, 5, 7))
    return table(spark, sf_dir, "customer").select("c_custkey", P.composite([a, b]).cast("array<long>").alias("two"), P.composite([a, b, c]).cast("array<long>").alias("three"))


@query("""select p_partkey as stack, least(p_partkey % 5, p_size % 7) as present, p_size % 7 as wanted, case when least(p_partkey % 5, p_size % 7) = p_size % 7 then 'complete' when p_partkey % 5 = 0 then 'empty' else 'sparse' end as state from (select cast(p_partkey as bigint) as p_partkey, cast(p_size as bigint) as p_size from part)""")
def stack_completeness(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    stacks = table(spark, sf_dir, "part").select(k.alias("stack"), (k % 11).alias("z0"), (k % 11 + s % 7).alias("z1"))
    held = stacks.withColumn("n", (F.col("stack") % 5).cast("int")).filter("n > 0").select("stack", F.explode(F.sequence("z0", F.col("z0") + F.col("n") - 1)).alias("z"))
    return inventory.completeness(stacks, held.union(held.limit(9)), ["stack"])


@query("""select p_partkey, cast(row_number() over (order by p_size * (p_partkey % 9 + 1) desc, p_partkey) - 1 as integer) as place, cast((row_number() over (order by p_size * (p_partkey % 9 + 1) desc, p_partkey) - 1) % 6 as integer) as worker from part""")
def largest_jobs_first(spark, sf_dir):
    return inventory.largest_first(table(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("p_size") * (F.col("p_partkey") % 9 + 1), "p_partkey", 6).select("p_partkey", "place", "worker")


@query("""select c_nationkey, c_custkey from (select *, row_number() over (partition by c_nationkey order by c_custkey) - 1 as n from customer) where n >= 2 and n < 5""")
def frame_slice(spark, sf_dir):
    return inventory.frames(table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey"), ["c_nationkey"], "c_custkey", 2, 5)


@query(f"""with {_EDGES}, b as (select *, row_number() over (partition by r0, c0, dir order by round(rel, 9) desc, layer, displ desc, default_displ desc, peak desc, width desc, inv_width desc) as k from er), p as (select r0, c0, dir from range(44) a(r0), range(7) b(c0), (values ('V'), ('H'), ('D')) d(dir))
select cast(p.r0 as integer) as r0, cast(p.c0 as integer) as c0, p.dir, coalesce(displ, 11) as displ, coalesce(width, 33) as width, round(coalesce(peak, 0.0), 9) as peak, round(coalesce(rel, 0.0), 9) as reliability from p left join (select * from b where k = 1) b on p.r0 = b.r0 and p.c0 = b.c0 and p.dir = b.dir""")
def nominal_displacements(spark, sf_dir):
    pairs = spark.range(44).select(F.col("id").cast("int").alias("r0"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("c0")).withColumn("dir", F.explode(F.array(F.lit("V"), F.lit("H"), F.lit("D")))).select("*", F.lit(11).alias("default_displ"), F.lit(33).alias("inv_width"))
    out = align.project(_edges(spark, sf_dir).dropDuplicates(), ["r0", "c0", "dir"], pairs)
    return out.select("r0", "c0", "dir", "displ", "width", F.round("peak", 9).alias("peak"), F.round("reliability", 9).alias("reliability"))


@query("""with n as (select n_nationkey % 5 as x, n_nationkey // 5 as y, n_nationkey * 7 % 11 as displ from nation) select cast(a.x as integer) as x, cast(a.y as integer) as y, cast(a.displ as bigint) as displ from n a where a.x < 4""")
def pair_displacements(spark, sf_dir):
    k = F.col("n_nationkey")
    grid = table(spark, sf_dir, "nation").select((k % 5).cast("int").alias("x"), F.floor(k / 5).cast("int").alias("y"), (k * 7 % 11).cast("long").alias("displ"))
    return align.displacement_of(grid.filter("x < 4").select("x", "y"), grid, ["x", "y"])


@query("""with b as (select p_partkey % 10 * 10 + 1 as x1, least(p_partkey % 10 * 10 + 10, 97) as x2, p_partkey // 10 % 6 * 8 + 1 as y1, p_partkey // 10 % 6 * 8 + 8 - cast(p_partkey % 7 = 0 as integer) as y2 from part where p_partkey % 11 <> 3),
c as (select distinct x, y from (select y, unnest(range(x1, x2 + 1)) as x from (select x1, x2, unnest(range(y1, y2 + 1)) as y from b)) where x <= 97 and y <= 48),
x as (select 1 as place, count(distinct y) as n from c where x = 1 union all select 97, count(distinct y) from c where x = 97), y as (select 1 as place, count(distinct x) as n from c where y = 1 union all select 48, count(distinct x) from c where y = 48)
select 'x' as axis, place, cast((48 - n) * 4 as bigint) as n from x union all select 'y', place, cast((97 - n) * 4 as bigint) from y union all select 'z', place, cast(97 * 48 - (select count(*) from c) as bigint) from (values (1), (4)) t(place)""")
def block_face_gaps(spark, sf_dir):
    k = F.col("p_partkey")
    row = F.floor(k / 10) % 6
    b = table(spark, sf_dir, "part").filter(k % 11 != 3).select(k.alias("block"), (k % 10 * 10 + 1).alias("x1"), F.least(k % 10 * 10 + 10, F.lit(97)).alias("x2"), (row * 8 + 1).alias("y1"), (row * 8 + 8 - (k % 7 == 0).cast("int")).alias("y2"), F.lit(1).alias("z1"), F.lit(4).alias("z2"))
    return spatial.face_gaps(b, {"x": 97, "y": 48, "z": 4}).select("axis", F.col("place").cast("int").alias("place"), "n")
