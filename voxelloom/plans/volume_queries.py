"""The engine's operators on the driver's tables, each with its SQL.

Embeddings are planes of 8 x 8 pixels (z = vec_id), and line items a sparse volume; boxes, edges, trees and channels are
derived from keys by the same arithmetic on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import names as N
from ..functions import pixel as P
from ..operators import align, decon, kernels, mosaic, place, reduce, register, spatial, stats, tracing
from ..sources import inventory, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(z, y, x, v) of the embeddings, on 0..4095."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("z"), F.posexplode("embedding").alias("i", "e"))
    v = P.clip(F.round((F.col("e").cast("double") + 1) * 2048), 0.0, 4095.0).cast("int")
    return e.select("z", F.floor(F.col("i") / 8).cast("int").alias("y"), (F.col("i") % 8).cast("int").alias("x"), v.alias("v"))


PX = """px as (select cast(vec_id as bigint) as z, cast((i - 1) // 8 as integer) as y, cast((i - 1) % 8 as integer) as x,
  cast(least(4095.0, greatest(0.0, round((cast(e as double) + 1) * 2048))) as integer) as v
  from (select vec_id, unnest(embedding) as e, generate_subscripts(embedding, 1) as i from embeddings))"""


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(channel, z, y, x, v) of the line items: several rows may share a voxel."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("channel"), F.col("l_linenumber").cast("int").alias("z"), (F.col("l_suppkey") % 32).cast("int").alias("y"), (F.col("l_partkey") % 32).cast("int").alias("x"), F.col("l_quantity").cast("int").alias("v"))


VX = "vx as (select l_returnflag as channel, cast(l_linenumber as integer) as z, cast(l_suppkey % 32 as integer) as y, cast(l_partkey % 32 as integer) as x, cast(trunc(l_quantity) as integer) as v from lineitem)"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of stacks from the keys of parts."""
    k = F.col("p_partkey")
    b = table(spark, sf_dir, "part").select(k.alias("stack"), ((k * 37) % 400).cast("int").alias("x0"), ((k * 53) % 400).cast("int").alias("y0"), ((k * 11) % 20).cast("int").alias("z0"), (F.col("p_size") % 24 + 8).cast("int").alias("s"))
    return b.select("stack", "x0", (F.col("x0") + F.col("s")).alias("x1"), "y0", (F.col("y0") + F.col("s")).alias("y1"), "z0", (F.col("z0") + 6).alias("z1"))


BOXES = """bx as (select stack, x0, x0 + s as x1, y0, y0 + s as y1, z0, z0 + 6 as z1 from (select p_partkey as stack, cast((p_partkey * 37) % 400 as integer) as x0,
  cast((p_partkey * 53) % 400 as integer) as y0, cast((p_partkey * 11) % 20 as integer) as z0, cast(p_size % 24 + 8 as integer) as s from part))"""


# pixel maps


@query(f"""with {PX}, m as (select z, y, x, case when v > 1900 then v - 1900 else 0 end as d from px),
e as (select z, y, x, least(case when d > 0 and d < 4 then 1 else d >> 2 end, 255) as v from m),
b as (select z, y // 2 as y, x // 2 as x, max(v) as v from e group by all)
select z, cast(max(v) as integer) as top, cast(sum(v) as bigint) as total, cast(count(*) as bigint) as n from b group by z""")
def px_8bit_block_max(spark, sf_dir):
    px = planes(spark, sf_dir).withColumn("v", P.to_uint8(P.subtract_dark(F.col("v"), 1900), 2))
    return reduce.block_reduce(px, {"y": 2, "x": 2}, "max", ["z"]).groupBy("z").agg(F.max("v").alias("top"), F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))


@query("""select l_orderkey, l_linenumber, round(ln(1 + l_extendedprice), 6) as log, round(exp(l_discount) - 1, 9) as back, cast(round_even(least(greatest(l_extendedprice, 0.0), 65535.0), 0) as integer) as whole,
cast(trunc(least(greatest(l_extendedprice, 0.0), 65535.0)) as integer) as cut from lineitem""")
def px_log_round(spark, sf_dir):
    v = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(P.log1p(v), 6).alias("log"), F.round(P.expm1(F.col("l_discount")), 9).alias("back"), P.round_to(v, 0, 65535).alias("whole"), P.to_uint16(v).alias("cut"))


@query(f"""with {PX} select z, y, x, least(v >> 3, 255) as u8, least(v >> 1, 65535) as u16, round(0.5 * (tanh(0.5 * (v - 2048)) + 1), 9) as sig, round(0.5 * (tanh(0.5 * ((v - 2000.0) / 50.0)) + 1), 9) as fg,
round(v / (1.0 + x / 10.0), 9) as flat, cast(trunc(least(greatest(v / 3.0, 0), 900)) as integer) as cut from px""")
def px_types(spark, sf_dir):
    v = F.col("v")
    return planes(spark, sf_dir).select("z", "y", "x", P.shift_saturate(v, 3, 8).alias("u8"), P.shift_saturate(v, 1, 16).alias("u16"), F.round(P.sigmoid(v - 2048), 9).alias("sig"), F.round(P.foreground_fraction(v, 2000.0, 50.0), 9).alias("fg"), F.round(P.flat_field(v, 1.0 + F.col("x") / 10.0), 9).alias("flat"), P.truncate_to(v / 3.0, 0, 900).alias("cut"))


@query(f"""with {PX} select z, cast(min(v) as integer) as low, cast(max(v) as integer) as high, min(v) = max(v) as uniform from px group by z""")
def px_uniform(spark, sf_dir):
    return stats.uniform(planes(spark, sf_dir), ["z"])


@query(f"""with {PX}, b as (select z, y // 3 as y, x // 3 as x, v from px)
select z, y, x, cast(case when count(*) < 9 then least(min(v), 0) else min(v) end as integer) as lo, round(sum(v) / 9.0, 9) as mean, cast(sum(v) as bigint) as total,
round(list_aggregate(list_concat(list(cast(v as double)), list_resize(cast([] as double[]), 9 - count(*), 0.0)), 'median'), 9) as median from b group by z, y, x""")
def block_min_mean_median(spark, sf_dir):
    all_ = reduce.block_reduce(planes(spark, sf_dir), {"y": 3, "x": 3}, ("min", "mean", "median", "sum"), ["z"])
    return all_.select("z", "y", "x", F.col("min").cast("int").alias("lo"), F.round("mean", 9).alias("mean"), F.col("sum").alias("total"), F.round("median", 9).alias("median"))


@query(f"""with {PX} select z, y, x, v from px where z % 4 = 0 and y % 2 = 0 and x % 2 = 0""")
def px_decimate(spark, sf_dir):
    return reduce.decimate(planes(spark, sf_dir), 2, 4)


@query(f"""with {PX}, b as (select z // 2 as z, y // 2 as y, x // 2 as x, avg(v) as v, count(*) as n from px group by all) select cast(z as bigint) as z, y, x, round(v, 9) as v from b where n = 8""")
def halve_mean(spark, sf_dir):
    return reduce.halve(planes(spark, sf_dir)).select(F.col("z").cast("long").alias("z"), "y", "x", F.round("v", 9).alias("v"))


@query(f"""with {PX}, l0 as (select z, y, x, cast(v as double) as v from px), l1 as (select z // 2 as z, y // 2 as y, x // 2 as x, max(v) as v, count(*) as n from l0 group by all having n = 8),
l2 as (select z // 2 as z, y // 2 as y, x // 2 as x, max(v) as v, count(*) as n from l1 group by all having n = 8)
select 0 as level, z, y, x, v from l0 union all select 1, z, y, x, v from l1 union all select 2, z, y, x, v from l2""")
def pyramid(spark, sf_dir):
    px = planes(spark, sf_dir).withColumn("v", F.col("v").cast("double"))
    return reduce.pyramid(px, 3, "max").select("level", F.col("z").cast("long").alias("z"), "y", "x", "v")


@query(f"""with {PX}, a as (select z, y, x // 2 as x, avg(sqrt(sqrt(v))) as v from px group by all), b as (select z, y, x // 2 as x, avg(v) as v from a group by all) select z, y, x, round(v, 6) as v from b""")
def axis_average(spark, sf_dir):
    return reduce.axis_average(planes(spark, sf_dir), "x", 4, fourth_root=True).select("z", "y", "x", F.round("v", 6).alias("v"))


@query(f"""with {VX} select case when grouping(z) = 1 then 'xy' when grouping(y) = 1 then 'xz' else 'yz' end as face, coalesce(z, -1) as z, coalesce(y, -1) as y, coalesce(x, -1) as x, cast(max(v) as integer) as v from vx group by grouping sets ((y, x), (z, x), (z, y))""")
def mip_grouping_sets(spark, sf_dir):
    return reduce.projections(voxels(spark, sf_dir)).select("face", *(F.coalesce(c, F.lit(-1)).alias(c) for c in ("z", "y", "x")), "v")


@query(f"""with {VX} select case when grouping(z) = 0 then 'z' when grouping(y) = 0 then 'y' else 'x' end as axis, coalesce(z, y, x) as place, cast(sum(v) as double) as total, cast(max(v) as integer) as top from vx group by grouping sets ((z), (y), (x))""")
def profiles_two_phase(spark, sf_dir):
    return reduce.profiles(voxels(spark, sf_dir))


@query(f"""with {PX} select z, 7 - x as ry, y as rx, 7 - y as hy, 7 - x as hx, x as ty, 7 - y as tx, 7 - y as fy, v from px""")
def rotate_flip(spark, sf_dir):
    y, x = F.col("y"), F.col("x")
    (ry, rx), (hy, hx), (ty, tx) = (G.rotate(y, x, 8, 8, d) for d in (90, 180, 270))
    return planes(spark, sf_dir).select("z", ry.alias("ry"), rx.alias("rx"), hy.alias("hy"), hx.alias("hx"), ty.alias("ty"), tx.alias("tx"), G.flip(y, 8).alias("fy"), "v")


@query(f"""with {PX}, g as (select distinct z from px), s as (select z, y, x + 3 as x, v from px where x + 3 <= 7),
grid as (select g.z, a.y, b.x from g, (select cast(unnest(range(8)) as integer) as y) a, (select cast(unnest(range(10)) as integer) as x) b)
select grid.z, grid.y, grid.x, coalesce(p.v, 0) as v from grid left join (select z, y, x + 1 as x, v from s) p using (z, y, x)""")
def shift_pad(spark, sf_dir):
    px = G.centred(G.shifted(planes(spark, sf_dir), "x", 3, 8), "x", 8, 10)
    return G.dense(px, {"y": 8, "x": 10}, ["z"])


@query("""select l_orderkey, l_linenumber, case when s > 0 then label when label = 1 then 11 when label = 2 then 12 when label = 5 then 15 else label end as label, round(degrees(acos(least(greatest((a * 3 + b * 4 + 12 * c) / (sqrt(a * a + b * b + c * c) * 13.0), -1.0), 1.0))), 6) as angle
from (select l_orderkey, l_linenumber, cast(l_linenumber as integer) as label, l_quantity as a, l_tax * 100 as b, l_discount * 100 as c,
  0.0 * (l_quantity - 1.0) + 10.0 * l_tax * 100 - 20.0 * (l_discount * 100 - 2.0) as s from lineitem)""")
def plane_mask_relabel(spark, sf_dir):
    a, b, c = F.col("l_quantity"), F.col("l_tax") * 100, F.col("l_discount") * 100
    side = G.plane_side((1.0, 0.0, 2.0), (2.0, 0.0, 2.0), (1.0, 20.0, 12.0), a, b, c)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", P.relabel(F.col("l_linenumber").cast("int"), {1: 11, 2: 12, 5: 15}, -side > 0).alias("label"), F.round(G.angle([a, b, c], [F.lit(3.0), F.lit(4.0), F.lit(12.0)]), 6).alias("angle"))


@query("""select p_partkey, round(4.0 / 3.0 * 3.141592653589793 * pow(p_size, 3.0), 6) as volume, round(cbrt(3.0 * p_retailprice / (4.0 * 3.141592653589793)), 9) as radius, round((3000.0 - p_retailprice) * (0.5 / 2.0), 9) as flipped, round(-(5000.0 - p_retailprice * 0.5), 9) as scaled from part""")
def sphere_scale(spark, sf_dir):
    price = F.col("p_retailprice")
    return table(spark, sf_dir, "part").select("p_partkey", F.round(P.sphere_volume(F.col("p_size").cast("double")), 6).alias("volume"), F.round(P.sphere_radius(price), 9).alias("radius"), F.round(G.to_microns_flip_first(price, 3000.0, 0.5, 2.0), 9).alias("flipped"), F.round(G.to_microns_scale_first(price, 0.5, 5000.0, True), 9).alias("scaled"))


@query("""with b as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem)
select l_orderkey, l_linenumber, least(greatest(round((l_extendedprice - lo) * 255.0 * 1.0 / (hi - lo) - 1.0), 0.0), 255.0) as u8, least(greatest(round(l_extendedprice * 65535.0 * 1.0 / hi - 1.0), 0.0), 65535.0) as u16 from lineitem, b""")
def rescale_bounds(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("v"))
    bounds = items.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    both = items.crossJoin(F.broadcast(bounds))  # one row
    return both.select("l_orderkey", "l_linenumber", P.rescale(F.col("v"), F.col("lo"), F.col("hi"), 255.0, 1.0).alias("u8"), P.rescale(F.col("v"), F.lit(0.0), F.col("hi"), 65535.0, 1.0).alias("u16"))


# distributions


@query("""with b as (select l_returnflag, quantile_cont(case when ln(1 + l_extendedprice) > 10 then ln(1 + l_extendedprice) end, 0.9) as p, max(ln(1 + l_extendedprice)) as m from lineitem group by 1),
c as (select l_returnflag, cast(round_even(exp(coalesce(p, m)) - 1, 0) as bigint) as bound from b)
select l_returnflag, bound, cast(least(8, greatest(0, ceil(log2(greatest(bound, 1.0) / 256)))) as integer) as shift from c""")
def percentile_bitshift(spark, sf_dir):
    return stats.estimate_bit_shift(table(spark, sf_dir, "lineitem"), "l_extendedprice", 10.0, 90.0, ["l_returnflag"])


@query("""with c as (select event_type, median(value) as m, stddev_pop(value) as s from events group by 1)
select event_type, median(value) as median, min(value) as low, max(value) as high from events join c using (event_type) where abs(value - m) <= 1.5 * s group by 1""")
def outlier_trim(spark, sf_dir):
    return stats.offset_summary(table(spark, sf_dir, "events"), "value", ["event_type"], 1.5)


@query(f"""with {PX}, h as (select v, count(*) as n from px group by v) select v, cast(n as bigint) as n, cast(sum(n) over (order by v) as bigint) as below, round(sum(n) over (order by v) / sum(n) over (), 9) as cdf from h""")
def histogram_cdf(spark, sf_dir):
    return stats.histogram(planes(spark, sf_dir), "v").select("v", "n", "below", F.round("cdf", 9).alias("cdf"))


_H = "select v, n, sum(n) over (order by v) / sum(n) over () as q from (select v, count(*) as n from {0} group by v)"


@query(f"""with {PX}, s as (select v from px where z % 2 = 0), t as (select v + 300 as v from px where z % 2 = 1), hs as ({_H.format("s")}), ht as ({_H.format("t")})
select v, n, round(case when lo is null then hi.v when hi is null then lo.v when lo.q = hi.q then lo.v else lo.v + (q - lo.q) * (hi.v - lo.v) / (hi.q - lo.q) end, 6) as matched
from (select v, cast(n as bigint) as n, q, (select arg_max(struct_pack(q := ht.q, v := ht.v), ht.q) from ht where ht.q <= hs.q) as lo, (select arg_min(struct_pack(q := ht.q, v := ht.v), ht.q) from ht where ht.q >= hs.q) as hi from hs)""")
def histogram_match(spark, sf_dir):
    px = planes(spark, sf_dir)
    source, target = px.filter("z % 2 = 0").select("v"), px.filter("z % 2 = 1").select((F.col("v") + 300).alias("v"))
    return stats.match_histogram(source, target, "v").select("v", "n", F.round("matched", 6).alias("matched"))


@query(f"""with {PX}, h as (select z % 5 as g, v, count(*) as n from px group by all),
c as (select g, v, sum(n) over (partition by g order by v) as w0, sum(n * v) over (partition by g order by v) as s0, sum(n) over (partition by g) as w, sum(n * v) over (partition by g) as s from h),
r as (select g, v, case when w > w0 then w0 * (w - w0) * pow(s0 / w0 - (s - s0) / (w - w0), 2) else -1.0 end as var from c)
select g, cast(arg_min(v, struct_pack(a := -var, b := v)) as integer) as threshold from r group by g""")
def otsu(spark, sf_dir):
    px = planes(spark, sf_dir).withColumn("g", F.col("z") % 5)
    return stats.otsu(stats.histogram(px, "v", ["g"]).select("g", "v", "n"), "v", ["g"])


@query(f"""with {PX}, g as (select cast(unnest(range(0, 3)) as integer) as gy), k as (select cast(unnest(range(0, 3)) as integer) as gx)
select z, gy, gx, round(quantile_cont(v, 0.25), 6) as v from px, g, k where abs(y - 4 * gy) <= 2 and abs(x - 4 * gx) <= 3 group by all""")
def local_percentile(spark, sf_dir):
    return stats.local_percentile(planes(spark, sf_dir), 0.25, 2, 3, 4, ["z"]).select("z", "gy", "gx", F.round("v", 6).alias("v")).filter("gy <= 2 and gx <= 2").select("z", F.col("gy").cast("int").alias("gy"), F.col("gx").cast("int").alias("gx"), "v")


@query("""select l_returnflag, round(sqrt(sum(l_tax * l_tax)), 9) as norm, round(abs(sqrt(sum(l_tax * l_tax)) - sqrt(sum(l_discount * l_discount))) / sqrt(sum(l_discount * l_discount)) * 100, 6) as change from lineitem group by 1""")
def relative_change(spark, sf_dir):
    return stats.relative_change(table(spark, sf_dir, "lineitem"), "l_discount", "l_tax", ["l_returnflag"]).select("l_returnflag", F.round("norm", 9).alias("norm"), F.round("change", 6).alias("change"))


# offsets and placement


def _grid(spark, sf_dir):
    k = F.col("p_partkey")
    d = lambda m, o: ((k * m) % 17 + o).cast("int")
    return table(spark, sf_dir, "part").select(F.floor(k / 20).cast("int").alias("row"), (k % 20).cast("int").alias("col"), d(3, -30).alias("west_v"), d(5, -100).alias("west_h"), d(7, -8).alias("west_d"), d(11, -100).alias("north_v"), d(13, -8).alias("north_h"), d(2, -4).alias("north_d"))


@query("""with g as (select cast(p_partkey // 20 as integer) as row, cast(p_partkey % 20 as integer) as col, (p_partkey * 3) % 17 - 30 as wv, (p_partkey * 5) % 17 - 100 as wh, (p_partkey * 7) % 17 - 8 as wd, (p_partkey * 11) % 17 - 100 as nv, (p_partkey * 13) % 17 - 8 as nh, (p_partkey * 2) % 17 - 4 as nd from part),
w as (select *, sum(case when row = 0 and col > 0 then -wv else 0 end) over r as av, sum(case when row = 0 and col > 0 then -wh else 0 end) over r as ah, sum(case when row = 0 and col > 0 then -wd else 0 end) over r as ad from g window r as (partition by row order by col)),
n as (select row, col, sum(case when row = 0 then av else -nv end) over c as y, sum(case when row = 0 then ah else -nh end) over c as x, sum(case when row = 0 then ad else -nd end) over c as z from w window c as (partition by col order by row))
select row, col, cast(y - min(y) over () as bigint) as y, cast(x - min(x) over () as bigint) as x, cast(z - min(z) over () as bigint) as z from n""")
def offset_chain(spark, sf_dir):
    return mosaic.offset_chain(_grid(spark, sf_dir))


@query("""with s as (select l_suppkey % 10 as x, l_linenumber as y, l_orderkey % 8 as z, cast(count(*) as bigint) as depth from lineitem group by all),
a as (select *, sum(depth - z % 3) over (partition by x, y order by z) as e from s), r as (select y, x, sum(x % 4) over (partition by y order by x) as base from (select distinct x, y from s))
select x, y, z, cast(e + base - depth as bigint) as z0, cast(e + base as bigint) as z1 from a join r using (x, y)""")
def scanner_z(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("x"), F.col("l_linenumber").alias("y"), (F.col("l_orderkey") % 8).alias("z")).agg(F.count(F.lit(1)).alias("depth"))
    return mosaic.scanner_z(s.withColumn("offset", -(F.col("z") % 3)).withColumn("row_offset", F.col("x") % 4)).select("x", "y", "z", "z0", "z1")


@query("""with recursive p as (select user_id, cast(date_diff('second', timestamp '2024-01-01', ts) // 60 as double) as m from events group by all), o as (select *, row_number() over (partition by user_id order by m) as k from p),
f as (select user_id, k, m, m as start, 0 as travel from o where k = 1 union all select o.user_id, o.k, o.m, case when o.m - f.start >= 1440 then o.m else f.start end, case when o.m - f.start >= 1440 then f.travel + 1 else f.travel end from f join o on o.user_id = f.user_id and o.k = f.k + 1)
select user_id, m, travel, start from f""")
def travel_split(spark, sf_dir):
    m = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / 60).cast("double")
    return inventory.travels(table(spark, sf_dir, "events").select("user_id", m.alias("m")), ["user_id"], "m", 1440.0)


# boxes and mosaics


@query(f"""with {BOXES} select a.stack as a, b.stack as b, greatest(a.x0, b.x0) as x0, least(a.x1, b.x1) as x1, greatest(a.y0, b.y0) as y0, least(a.y1, b.y1) as y1, greatest(a.z0, b.z0) as z0, least(a.z1, b.z1) as z1,
(a.x0 <= b.x0 and a.x1 >= b.x1 and a.y0 <= b.y0 and a.y1 >= b.y1 and a.z0 <= b.z0 and a.z1 >= b.z1) as holds
from bx a join bx b on a.stack <> b.stack and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1 and a.z0 < b.z1 and b.z0 < a.z1""")
def overlap_join(spark, sf_dir):
    side = lambda p: boxes(spark, sf_dir).select(*(F.col(c).alias(f"{p}{c}") for c in ("stack", "x0", "x1", "y0", "y1", "z0", "z1")))
    pairs = spatial.overlap_join(side("a_"), side("b_"), "a_", "b_", 32).filter("a_stack <> b_stack")
    return pairs.select(F.col("a_stack").alias("a"), F.col("b_stack").alias("b"), *G.intersection("a_", "b_"), G.contains("a_", "b_").alias("holds"))


@query(f"""with {BOXES} select min(x0) as x0, max(x1) as x1, min(y0) as y0, max(y1) as y1, min(z0) as z0, max(z1) as z1 from bx""")
def bounding_volume(spark, sf_dir):
    return spatial.bounding_box(boxes(spark, sf_dir))


def _stack_pixels(spark, sf_dir):
    """Two-dimensional stacks of 12 x 12 pixels that overlap by 4."""
    k = F.col("p_partkey")
    t = table(spark, sf_dir, "part").select(k.alias("stack"), (k % 20 * 8).cast("int").alias("x0"), (F.floor(k / 20) * 8).cast("int").alias("y0")).repartition(spark.sparkContext.defaultParallelism, "stack")  # tiles lie apart, as their files do
    s = t.select("stack", "x0", (F.col("x0") + 12).alias("x1"), "y0", (F.col("y0") + 12).alias("y1"), F.lit(0).alias("z0"), F.lit(1).alias("z1"))
    px = s.withColumn("y", F.explode(F.sequence("y0", F.col("y1") - 1))).withColumn("x", F.explode(F.sequence("x0", F.col("x1") - 1)))
    return s, px.select("stack", F.lit(0).alias("z"), "y", "x", ((F.col("stack") * 31 + F.col("x") * 7 + F.col("y") * 13) % 250 + 1).cast("int").alias("v"))


_ST = """st as (select p_partkey as stack, cast(p_partkey % 20 * 8 as integer) as x0, cast(p_partkey // 20 * 8 as integer) as y0 from part),
sp as (select stack, x0, y0, y0 + cast(j as integer) as y, x0 + cast(i as integer) as x, cast((stack * 31 + (x0 + i) * 7 + (y0 + j) * 13) % 250 + 1 as integer) as v from st, range(12) a(i), range(12) b(j))"""


@query(f"""with {_ST} select 0 as z, y, x, max(v) as v from sp group by y, x""")
def mosaic_max(spark, sf_dir):
    return mosaic.mosaic_max(_stack_pixels(spark, sf_dir)[1])


@query(f"""with {_ST}, pr as (select s.stack, s.x0, s.y0, o.x0 as ox, o.y0 as oy, (o.x0 < s.x0) as xmin, (o.x0 > s.x0) as xmax, (o.y0 < s.y0) as ymin, (o.y0 > s.y0) as ymax
  from st s join st o on s.stack <> o.stack and s.x0 < o.x0 + 12 and o.x0 < s.x0 + 12 and s.y0 < o.y0 + 12 and o.y0 < s.y0 + 12),
wt as (select p.stack, p.y, p.x, p.v, least(case when xmin then p.x - pr.x0 + 1 else 1e9 end, case when ymin then p.y - pr.y0 + 1 else 1e9 end, case when xmax then pr.x0 + 12 - p.x else 1e9 end, case when ymax then pr.y0 + 12 - p.y else 1e9 end) as d,
  least(case when xmax then p.x - ox + 1 else 1e9 end, case when ymax then p.y - oy + 1 else 1e9 end, case when xmin then ox + 12 - p.x else 1e9 end, case when ymin then oy + 12 - p.y else 1e9 end) as o
  from sp p join pr on p.stack = pr.stack and p.x >= ox and p.x < ox + 12 and p.y >= oy and p.y < oy + 12),
pw as (select stack, y, x, exp(sum(ln(d * d / (d * d + o * o)))) as w from wt group by all)
select 0 as z, p.y, p.x, round(sum(p.v * coalesce(w, 1.0)) / sum(coalesce(w, 1.0)), 6) as v from sp p left join pw on p.stack = pw.stack and p.y = pw.y and p.x = pw.x group by p.y, p.x""")
def mosaic_cosine(spark, sf_dir):
    s, px = _stack_pixels(spark, sf_dir)
    return mosaic.mosaic_cosine(px, s, 16).select("z", "y", "x", F.round("v", 6).alias("v"))


@query(f"""with {_ST}, t as (select y0 // 8 as row, stack, x0, lead(x0) over w as nx, lag(x0 + 12) over w as lx from st window w as (partition by y0 order by x0)),
p as (select row, y, x, v, x < coalesce(lx, -1) as r, case when x < coalesce(lx, -1) then (x - sp.x0) * pi() / 3 when x >= coalesce(nx, 100000) then (x - nx) * pi() / 3 end as a from sp join t using (stack)),
b as (select row, y, x, max(case when not r then v end) as l, max(case when r then v end) as q, max(a) as a from p group by all)
select cast(row as integer) as row, y, x, round(case when l is null then q when q is null then l else (cos(a) + 1) / 2 * l + (1 - (cos(a) + 1) / 2) * q end, 6) as v from b""")
def stripe_blend(spark, sf_dir):
    s, px = _stack_pixels(spark, sf_dir)
    tiles = s.select(F.floor(F.col("y0") / 8).cast("int").alias("row"), (F.floor(F.col("x0") / 8)).cast("int").alias("col"), "x0", "x1", "stack")
    return mosaic.stripe(px.join(tiles.select("stack", "row", "col"), "stack").select("row", "col", "y", "x", "v"), tiles.drop("stack")).select("row", "y", "x", F.round(F.col("v").cast("double"), 6).alias("v"))


@query(f"""with {_ST} select cast(min(y0) as integer) as v0, cast(max(y0) + 12 as integer) as v1, cast(min(x0) as integer) as h0, cast(max(x0) + 12 as integer) as h1, cast(max(stack % 7) as bigint) as d0, cast(min(stack % 7) + 50 as bigint) as d1 from st""")
def volume_dims(spark, sf_dir):
    s, _ = _stack_pixels(spark, sf_dir)
    return mosaic.volume_dims(s.select(F.col("y0").alias("abs_v"), F.col("x0").alias("abs_h"), (F.col("stack") % 7).alias("abs_d")), 12, 12, 50)


# alignment


@query(f"""with {PX}, o as (select cast(i // 5 - 2 as integer) as dy, cast(i % 5 - 2 as integer) as dx, i as ord from range(25) r(i)),
s as (select b.z // 2 as k, dy, dx, ord, corr(a.v, b.v) as s from px b, o, px a where b.z % 2 = 1 and a.z = b.z - 1 and a.y = b.y + dy and a.x = b.x + dx group by all),
r as (select *, round(case when s is null or isnan(s) then 0.0 else s end, 6) as q from s)
select cast(k as bigint) as k, dy, dx, q as score from (select *, row_number() over (partition by k order by q desc, ord) as n from r) where n = 1""")
def neighbour_corr(spark, sf_dir):
    px = planes(spark, sf_dir).withColumn("k", F.floor(F.col("z") / 2))
    a, b = px.filter("z % 2 = 0"), px.filter("z % 2 = 1")
    return align.best_offset(align.correlations(a, b, align.offsets(spark, 2, 2), "k"), "k", 6)


@query("""with s as (select n_nationkey % 5 as xi, n_nationkey // 5 as yi, 0 as zi, n_name as name from nation)
select a.xi as a_xi, a.yi as a_yi, a.name as a_name, b.xi as b_xi, b.yi as b_yi, b.name as b_name from s a join s b on b.xi = a.xi + 1 and b.yi = a.yi""")
def neighbour_pairs(spark, sf_dir):
    k = F.col("n_nationkey")
    s = table(spark, sf_dir, "nation").select((k % 5).alias("xi"), F.floor(k / 5).cast("int").alias("yi"), F.lit(0).alias("zi"), F.col("n_name").alias("name"))
    return align.neighbours(s, "xi").select("a_xi", "a_yi", "a_name", "b_xi", "b_yi", "b_name")


def _edges(spark, sf_dir):
    k = F.col("l_orderkey")
    d = F.element_at(F.array(F.lit("V"), F.lit("H"), F.lit("D")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select((k % 40).cast("int").alias("r0"), (k % 7).cast("int").alias("c0"), d.alias("dir"), F.col("l_partkey").cast("int").alias("layer"), (F.col("l_quantity") - 25).cast("int").alias("displ"), F.lit(3).alias("default_displ"), (F.round(F.col("l_discount") * 10) / 10).alias("peak"), (F.col("l_suppkey") % 24 + 1).cast("int").alias("width"), (F.col("l_suppkey") % 5 * 10 + 30).cast("int").alias("inv_width"))


_EDGES = """ed as (select cast(l_orderkey % 40 as integer) as r0, cast(l_orderkey % 7 as integer) as c0, ['V', 'H', 'D'][l_linenumber % 3 + 1] as dir, cast(l_partkey as integer) as layer, cast(trunc(l_quantity - 25) as integer) as displ, 3 as default_displ,
  round(l_discount * 10) / 10 as peak, cast(l_suppkey % 24 + 1 as integer) as width, cast(l_suppkey % 5 * 10 + 30 as integer) as inv_width from lineitem),
er as (select *, sqrt(0.5 * (1 - cast(width as double) / inv_width) * (1 - cast(width as double) / inv_width) + 0.5 * peak * peak) as rel from ed)"""


@query(f"""with {_EDGES}, b as (select *, row_number() over (partition by r0, c0, dir order by round(rel, 9) desc, layer, displ desc, default_displ desc, peak desc, width desc, inv_width desc) as k from er)
select r0, c0, dir, layer, case when rel < 0.6 then 0.0 else peak end as peak, case when rel < 0.6 then inv_width else width end as width, round(case when rel < 0.6 then 0.0 else rel end, 9) as reliability from b where k = 1""")
def project_threshold(spark, sf_dir):
    p = align.project(_edges(spark, sf_dir).dropDuplicates(), ["r0", "c0", "dir"])
    return align.threshold(p, 0.6).select("r0", "c0", "dir", "layer", "peak", "width", F.round("reliability", 9).alias("reliability"))


@query(f"""with {_EDGES} select r0, c0, max(rel) >= 0.68 as stitchable from er group by all""")
def stitchable_tiles(spark, sf_dir):
    return align.stitchable(_edges(spark, sf_dir).withColumn("reliability", P.reliability(F.col("peak"), F.col("width"), F.col("inv_width"))), ["r0", "c0"], 0.68)


@query("""with e as (select l_orderkey, l_linenumber, cast(trunc(l_quantity) as integer) as da, l_tax * 10 as pa, cast(case when l_suppkey % 12 = 1 then 1000000 else l_suppkey % 12 + (case when l_suppkey % 12 = 0 then 1 else 0 end) end as integer) as wa0, cast(l_partkey % 50 as integer) as db, l_discount * 10 as pb, cast(l_partkey % 9 + 2 as integer) as wb from lineitem),
f as (select *, case when wa0 = 1 then 1000000 else wa0 end as wa, pa >= 0.10 and (case when wa0 = 1 then 1000000 else wa0 end) < 1000000 as va, pb >= 0.10 and wb < 1000000 as vb from e)
select l_orderkey, l_linenumber, cast(case when va and vb then case when abs(da - db) < least(wa, wb) then floor((da * pa + db * pb) / (pa + pb) + 0.5) when pa / wa > pb / wb then da else db end when va then da when vb then db else 0 end as integer) as displ,
cast(case when va and vb then case when abs(da - db) < least(wa, wb) then greatest(wa, wb) when pa / wa > pb / wb then wa else wb end when va then wa when vb then wb else 1000000 end as integer) as width from f""")
def combine_estimates(spark, sf_dir):
    m = F.col("l_suppkey") % 12
    wa = F.when(m == 1, align.INFINITE_WIDTH).otherwise(m + F.when(m == 0, 1).otherwise(0)).cast("int")
    e = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("da"), (F.col("l_tax") * 10).alias("pa"), wa.alias("wa"), (F.col("l_partkey") % 50).cast("int").alias("db"), (F.col("l_discount") * 10).alias("pb"), (F.col("l_partkey") % 9 + 2).cast("int").alias("wb"))
    a, b = ({"displ": F.col(f"d{s}"), "peak": F.col(f"p{s}"), "width": F.col(f"w{s}")} for s in "ab")
    return e.withColumn("c", align.combine(a, b)).select("l_orderkey", "l_linenumber", "c.displ", "c.width")


def _records(spark, sf_dir):
    k = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select((k % 11).cast("int").alias("xidx"), (k % 5).cast("int").alias("yidx"), F.col("l_linenumber").cast("int").alias("zidx"), F.col("l_partkey").cast("int").alias("z"), (F.col("l_discount") - 0.03).alias("score"), (F.col("l_suppkey") % 9 - 4).cast("int").alias("xoff"), (F.col("l_quantity") % 7 - 3).cast("int").alias("yoff"), (F.col("l_partkey") % 5 - 2).cast("int").alias("zoff"))


_RECORDS = "rc as (select cast(l_orderkey % 11 as integer) as xidx, cast(l_orderkey % 5 as integer) as yidx, cast(l_linenumber as integer) as zidx, cast(l_partkey as integer) as z, l_discount - 0.03 as score, cast(l_suppkey % 9 - 4 as integer) as xoff, cast(trunc(l_quantity % 7 - 3) as integer) as yoff, cast(l_partkey % 5 - 2 as integer) as zoff from lineitem)"


@query(f"""with {_RECORDS} select xidx, yidx, zidx, coalesce(max(case when score > 0 then score end), 0.0) as score, coalesce(arg_max(case when score > 0 then zoff end, case when score > 0 then struct_pack(a := score, b := -z) end), 0) as zoff from rc group by all""")
def best_alignment(spark, sf_dir):
    return align.best_alignment(_records(spark, sf_dir), ["xidx", "yidx", "zidx"]).select("xidx", "yidx", "zidx", "score", "zoff")


@query(f"""with {_RECORDS}, g as (select zidx as z, count(*) * 3 as n, median(case when zoff = -1 then 0 else zoff end) as m from rc where score > 0.01 group by 1) select z, case when n > 900 then m else 0.0 end as zoff from g""")
def consensus_z(spark, sf_dir):
    return align.consensus_z(_records(spark, sf_dir).drop("z").withColumnRenamed("zidx", "z"), 0.01, 900, 3)


@query(f"""with {_RECORDS} select yidx, case when count(*) >= 100 then median(zoff) else 0.0 end as zoff from rc group by 1""")
def row_delta(spark, sf_dir):
    return align.row_delta(_records(spark, sf_dir), 100)


@query(f"""with {_RECORDS}, l as (select axis, off, v from (select ['x', 'y', 'z'][zidx % 3 + 1] as axis, case when xidx = 3 and yidx = 2 then xoff * 9 else xoff end as xoff, yoff, zoff, score from rc where score >= 0.01) unpivot (v for off in (xoff, yoff, zoff))),
e as (select axis, off, median(v) as m, stddev_pop(v) * 2.0 as s from l group by all), k as (select l.axis, l.off, median(v) as m, min(v) as lo, max(v) as hi from l join e on e.axis = l.axis and e.off = l.off and v >= m - s and v <= m + s group by all),
r as (select *, greatest(hi - m, m - lo) as reach from k)
select {", ".join(f"cast(trunc(max(case when off = '{n}' then reach end) * 1.25) as integer) + 2 as {n[0]}_slop" for n in ("xoff", "yoff", "zoff"))},
{", ".join(f"cast(trunc(max(case when off = '{n}' and axis = '{x}' then m end)) as integer) as {n}_{x}" for x in "xyz" for n in ("xoff", "yoff", "zoff"))} from r""")
def next_slop(spark, sf_dir):
    axis = F.element_at(F.array(F.lit("x"), F.lit("y"), F.lit("z")), F.col("zidx") % 3 + 1)
    far = F.when((F.col("xidx") == 3) & (F.col("yidx") == 2), F.col("xoff") * 9).otherwise(F.col("xoff"))
    return align.next_round(_records(spark, sf_dir).withColumn("axis", axis).withColumn("xoff", far), 0.01, 2.0, 1.25, 2)


@query("""with c as (select n_nationkey % 5 as x, n_nationkey // 5 as y, n_regionkey as p, (n_nationkey * 7) % 4 = 0 as strong from nation)
select p, x, y, m.x as sx, m.y as sy, cast(m.d as bigint) as d2 from (select a.p, a.x, a.y, min(struct_pack(d := (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), x := b.x, y := b.y)) as m from c a join c b on b.p = a.p and b.strong group by all)""")
def weak_to_strong(spark, sf_dir):
    k = F.col("n_nationkey")
    c = table(spark, sf_dir, "nation").select((k % 5).alias("x"), F.floor(k / 5).cast("int").alias("y"), F.col("n_regionkey").alias("p"), ((k * 7) % 4 == 0).alias("strong"))
    return spatial.nearest_strong(c, "p").select("p", "x", "y", "sx", "sy", F.col("d2").cast("long").alias("d2"))


def _path_edges(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    g = s.select((F.col("k") % 4).cast("int").alias("x"), (F.floor(F.col("k") / 4) % 4).cast("int").alias("y"), (F.floor(F.col("k") / 16)).cast("int").alias("z"))
    d = F.explode(F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy"), F.lit(c).alias("dz")) for a, b, c in ((1, 0, 0), (0, 1, 0), (0, 0, 1))]))
    e = g.withColumn("d", d).select("x", "y", "z", "d.dx", "d.dy", "d.dz")
    h = (F.col("x") * 7 + F.col("y") * 13 + F.col("z") * 29 + F.col("dx") * 3 + F.col("dy") * 5) % 10
    return e.select("*", (h / 10).alias("score"), (h % 4 - 3).cast("int").alias("zoff"))


_PATHS = """g as (select cast(s_suppkey % 4 as integer) as x, cast((s_suppkey // 4) % 4 as integer) as y, cast(s_suppkey // 16 as integer) as z from supplier),
ee as (select g.*, dx, dy, dz, (x * 7 + y * 13 + z * 29 + dx * 3 + dy * 5) % 10 as h from g, (values (1, 0, 0), (0, 1, 0), (0, 0, 1)) d(dx, dy, dz)),
e as (select x, y, z, dx, dy, dz, h / 10 as score, cast(h % 4 - 3 as integer) as zoff from ee), f as (select x, y, z, dx, dy, score, zoff from e where dz = 0 union all select x + dx, y + dy, z, -dx, -dy, score, -zoff from e where dz = 0),
w as (select x, y, z, 0 as ord, 1 - score as cost, zoff from e where dz = 1
  union all select o.x, o.y, o.z, k.ord, 3 - o.score - m.score - b.score, o.zoff + m.zoff + b.zoff from (values (1, -1, 0), (2, 1, 0), (3, 0, -1), (4, 0, 1)) k(ord, dx, dy) join f o on o.dx = k.dx and o.dy = k.dy join e m on m.dz = 1 and m.x = o.x + k.dx and m.y = o.y + k.dy and m.z = o.z join f b on b.dx = -k.dx and b.dy = -k.dy and b.x = m.x and b.y = m.y and b.z = o.z + 1)"""


@query(f"""with {_PATHS} select x, y, z, round(min(cost), 6) as cost from w where zoff <= 0 group by all""")
def cheapest_path(spark, sf_dir):
    return align.cheapest_path(_path_edges(spark, sf_dir)).select("x", "y", "z", F.round("cost", 6).alias("cost"))


@query(f"""with {VX}, p as (select z, y, x, avg(v) as v from vx group by all), pr as (select z, y, avg(v) as p from p group by all), m as (select z, avg(v) as m from p group by all), r as (select p.z, p.y, p.x, p.v / case when p > 0 then p else 1e-5 end as r, m from p join pr on p.z = pr.z and p.y = pr.y join m on p.z = m.z), t as (select z, max(r) as t from r group by all)
select r.z, y, x, round(r * least(m, 1 / case when t > 0 then t else 1.0 end), 6) as v from r join t on r.z = t.z""")
def restore_profile(spark, sf_dir):
    px = voxels(spark, sf_dir).groupBy("z", "y", "x").agg(F.avg("v").alias("v"))
    return align.restore_profile(px, "y", ["z"]).select("z", "y", "x", F.round("v", 6).alias("v"))


@query("""with e as (select n_nationkey as layer, (n_nationkey * 7) % 11 - 5 as v, (n_nationkey * 5) % 9 - 4 as h, n_nationkey % 4 as d from nation), s as (select layer, sum(v) over w as v, sum(h) over w as h, sum(d) over w as d from e window w as (order by layer))
select layer, cast(v - least(0, min(v) over ()) as bigint) as v, cast(h - least(0, min(h) over ()) as bigint) as h, cast(d as bigint) as d, cast(greatest(0, max(v) over ()) - least(0, min(v) over ()) as bigint) as grow_v, cast(greatest(0, max(h) over ()) - least(0, min(h) over ()) as bigint) as grow_h from s""")
def layer_offsets(spark, sf_dir):
    k = F.col("n_nationkey")
    return align.layers(table(spark, sf_dir, "nation").select(k.alias("layer"), ((k * 7) % 11 - 5).alias("v"), ((k * 5) % 9 - 4).alias("h"), (k % 4).alias("d")))


def _placement_edges(spark, sf_dir):
    """A grid of 5 x 5 nations with displacements of both directions."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("k"))
    d = F.explode(F.array(F.struct(F.lit(0).alias("dr"), F.lit(1).alias("dc")), F.struct(F.lit(1).alias("dr"), F.lit(0).alias("dc"))))
    e = n.withColumn("d", d).select(F.floor(F.col("k") / 5).cast("int").alias("r0"), (F.col("k") % 5).alias("c0"), "d.dr", "d.dc", "k").withColumn("r1", F.col("r0") + F.col("dr")).withColumn("c1", F.col("c0") + F.col("dc")).filter("r1 < 5 and c1 < 5")
    e = e.withColumn("dir", F.explode(F.array(F.lit("V"), F.lit("H"), F.lit("D"))))
    j = F.col("k") * 7 + F.col("dr") * 3 + F.ascii("dir")
    return e.select("r0", "c0", "r1", "c1", "dir", (j % 9 + 90).cast("int").alias("displ"), ((j * 31) % 97 / 100.0).alias("reliability"), F.lit(True).alias("stitchable"))


_GRID_SQL = """n as (select cast(n_nationkey as integer) as k from nation), e0 as (select k // 5 as r0, k % 5 as c0, dr, dc, k, dir from n, (values (0, 1), (1, 0)) d(dr, dc), (values ('V'), ('H'), ('D')) q(dir) where k // 5 + dr < 5 and k % 5 + dc < 5),
e1 as (select r0 * 5 + c0 as a, (r0 + dr) * 5 + c0 + dc as b, dir, (k * 7 + dr * 3 + ascii(dir)) % 9 + 90 as displ, ((k * 7 + dr * 3 + ascii(dir)) * 31) % 97 / 100.0 as rel from e0),
e2 as (select a, b, dir, case when rel > 0 then 1.0 / rel else 1000.0 end as w, displ from e1 union all select b, a, dir, case when rel > 0 then 1.0 / rel else 1000.0 end, -displ from e1)"""


@query(f"""with recursive {_GRID_SQL}, s as (select 0 as i, dir, 0 as node, 0.0::double as cost, 0 as at_ from (select distinct dir from e2)
union all (select i + 1, dir, node, min(cost), cast(arg_min(at_, cost) as integer) from (select s.i, e2.dir, e2.b as node, s.cost + e2.w as cost, s.at_ + e2.displ as at_ from s join e2 on e2.dir = s.dir and e2.a = s.node where s.i < 12) g group by i, dir, node)),
b as (select dir, node, arg_min(at_, cost) as at_ from s group by dir, node)
select cast(node // 5 as integer) as row, cast(node % 5 as integer) as col, cast(max(case when dir = 'V' then at_ end) as double) as "V", cast(max(case when dir = 'H' then at_ end) as double) as "H", cast(max(case when dir = 'D' then at_ end) as double) as "D" from b group by node""")
def placement(spark, sf_dir):
    return place.place(_placement_edges(spark, sf_dir))


# channels, files and sets


@query(f"""with {VX}, c as (select channel, z, y, x, max(v) as v from vx group by all), r as (select z, y, x, v from c where channel = 'A')
select r.z, r.y, r.x, r.v as c0, coalesce(n.v, 0) as c1, coalesce(k.v, 0) as c2 from r left join c n on n.channel = 'N' and n.z + 1 = r.z and n.y = r.y and n.x = r.x left join c k on k.channel = 'R' and k.z = r.z and k.y = r.y and k.x - 2 = r.x""")
def channel_merge(spark, sf_dir):
    c = voxels(spark, sf_dir).groupBy("channel", "z", "y", "x").agg(F.max("v").alias("v"))
    one = lambda k: c.filter(F.col("channel") == k).drop("channel")
    return register.merge_channels(one("A"), [(one("N"), {"z": 1}), (one("R"), {"x": -2})])


@query("""select doc_id, lang, source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""")
def resume_antijoin(spark, sf_dir):
    return inventory.remaining(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("""with c as (select source || '/' || lang as folder, count(*) as n_files from documents group by 1) select cast(n_files as bigint) as n_files, string_agg(folder, ',' order by folder) as folders, cast(count(*) as bigint) as n from c group by n_files""")
def file_count_histogram(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", "lang").alias("folder"))
    return inventory.folder_counts(d, "folder").select("n_files", F.array_join("folders", ",").alias("folders"), "n")


@query("""select page_id, url, cast(row_number() over (order by k, url, page_id) as integer) as place from (select page_id, url, list_aggregate(list_transform(regexp_extract_all(url, '(\\d+|\\D+)'), lambda p: case when regexp_matches(p, '^\\d') then '0' || lpad(p, 20, '0') else '1' || lower(p) end), 'string_agg', chr(1)) as k from pages)""")
def natural_sort(spark, sf_dir):
    from pyspark.sql.window import Window

    return table(spark, sf_dir, "pages").select("page_id", "url", F.row_number().over(Window.orderBy(N.natural_key(F.col("url")), "url", "page_id")).alias("place"))


@query("""select c_custkey, regexp_extract(f, '([^/]*?)(?:\\.[^./]*)?$', 1) as stem, lower(regexp_extract(f, '(\\.[^./]*)$', 1)) as ext, 'img_' || lpad(cast(999 - c_custkey % 1000 as varchar), 6, '0') || '.tif' as plane, cast(c_custkey % 31 as double) as mx, cast(c_nationkey as double) as size
from (select *, '/' || c_custkey || '/' || c_name || '.TIF' as f from customer)""")
def regex_names(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").withColumn("f", F.concat(F.lit("/"), k.cast("string"), F.lit("/"), F.col("c_name"), F.lit(".TIF")))
    marker = N.marker_fields(F.concat_ws("_", F.lit("marker"), (k % 31).cast("string"), F.lit("5"), F.lit("6"), F.col("c_nationkey").cast("string")))
    return c.select("c_custkey", N.stem(F.col("f")).alias("stem"), N.extension(F.col("f")).alias("ext"), N.plane_name("img", k % 1000, 1000).alias("plane"), marker[0].alias("mx"), marker[3].alias("size"))


@query("""select p_partkey, cast(unnest(list_concat(range(p_size + p_partkey % 2, p_size + p_partkey % 4 + cast(p_partkey % 5 = 0 as integer)), range(100, 100 + p_partkey % 3 + cast(p_partkey % 5 = 0 as integer)))) as integer) as z from part""")
def z_ranges(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    text = F.format_string("%s%d,%d);[100,%d%s", F.when(k % 2 == 1, "(").otherwise("["), s.cast("int"), (s + k % 4).cast("int"), (100 + k % 3).cast("int"), F.when(k % 5 == 0, "]").otherwise(")"))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(N.kept_z(text)).alias("z"))


@query("""select o_orderkey, cast(case when o_orderkey % 1000 = 0 then 3 when o_orderkey % 100 = 0 then 2 when o_orderkey % 10 = 0 then 1 else 0 end as integer) as level, cast(row_number() over (order by case when o_orderkey % 1000 = 0 then 3 when o_orderkey % 100 = 0 then 2 when o_orderkey % 10 = 0 then 1 else 0 end desc, o_orderkey) as integer) as place from orders""")
def jumpy_order(spark, sf_dir):
    from pyspark.sql.window import Window

    level = inventory.preview_order(F.col("o_orderkey"), 0, 3)
    return table(spark, sf_dir, "orders").select("o_orderkey", level.alias("level"), F.row_number().over(Window.orderBy(F.desc(level), "o_orderkey")).alias("place"))


@query("""with c as (select distinct c_nationkey as n, c_mktsegment as s from customer), r as (select distinct n from c), t as (select distinct s from c) select n, s from r, t except select n, s from c""")
def fill_blanks(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("s"))
    return inventory.missing_cells(c, ["n", "s"])


@query("""with s as (select l_suppkey, min(l_linenumber) as z0, max(l_linenumber) + 1 as z1 from lineitem group by 1), w as (select l_suppkey, cast(unnest(range(z0, z1)) as integer) as z from s), h as (select distinct l_suppkey, l_linenumber as z from lineitem where l_returnflag = 'N')
select l_suppkey, z, lpad(cast(z * 30 as varchar), 6, '0') as name from w where not exists (select 1 from h where h.l_suppkey = w.l_suppkey and h.z = w.z)""")
def missing_planes(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem")
    s = i.groupBy("l_suppkey").agg(F.min("l_linenumber").alias("z0"), (F.max("l_linenumber") + 1).alias("z1"))
    return inventory.missing_planes(s, i.filter("l_returnflag = 'N'").select("l_suppkey", F.col("l_linenumber").alias("z")).distinct(), ["l_suppkey"], 3)


@query("""select distinct * from (select c_nationkey as n, c_mktsegment as s from customer union all select s_nationkey, 'SUPPLIER' from supplier)""")
def union_distinct(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("s"))
    return a.unionByName(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n"), F.lit("SUPPLIER").alias("s"))).dropDuplicates()


@query("""with t as (select l_orderkey % 97 as k, l_linenumber as layer, sum(cast(round(l_discount * 100) as integer) % 3) as total from lineitem group by all)
select k, cast(max(struct_pack(t := total, l := layer)).l as integer) as layer, cast(max(struct_pack(t := total, l := layer)).t as bigint) as total from t group by k""")
def last_tie_layer(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 97).alias("k"), F.col("l_linenumber").cast("int").alias("layer"), (F.round(F.col("l_discount") * 100).cast("int") % 3).alias("reliability"))
    return align.most_reliable_layer(e, ["k"])


@query("""select c_nationkey as nation from customer except select s_nationkey from supplier""")
def channel_validation(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return inventory.unknown_channels(wanted, table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")), "nation")


@query("""select o_orderkey, o_orderpriority, cast(case o_orderpriority when '2-HIGH' then 0 when '5-LOW' then 1 else 2 end as integer) as ord from orders""")
def channel_priority(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", inventory.channel_order(F.col("o_orderpriority"), ["2-HIGH", "5-LOW"]).alias("ord"))


@query("""with o as (select c_custkey, ['4x', '8x', '9x', '10x', '15x', '40x', '63x'][c_custkey % 7 + 1] as objective from customer), m(objective, voxel, tile_height, tile_width) as (values ('4x', 1.809::double, 1600, 2000), ('8x', 0.82, 2000, 2000), ('9x', 0.72, 2000, 2000), ('10x', 0.62, 2000, 2000), ('15x', 0.41, 2000, 2000), ('40x', 0.14, 2048, 2048))
select c_custkey, objective, coalesce(voxel, -1.0) as voxel, coalesce(tile_height, -1) as tile_height, coalesce(tile_width, -1) as tile_width from o left join m using (objective)""")
def objective_lookup(spark, sf_dir):
    names_ = F.array(*map(F.lit, ["4x", "8x", "9x", "10x", "15x", "40x", "63x"]))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.element_at(names_, (F.col("c_custkey") % 7 + 1).cast("int")).alias("objective"))
    return inventory.with_objective(c, "objective").select("c_custkey", "objective", F.coalesce("voxel", F.lit(-1.0)).alias("voxel"), *(F.coalesce(c, F.lit(-1)).alias(c) for c in ("tile_height", "tile_width")))


@query("""with p as (select l_suppkey, l_orderkey as v, row_number() over (partition by l_suppkey order by l_orderkey) as k from (select distinct l_suppkey, l_orderkey from lineitem)) select l_suppkey, (max(v) - min(v)) / 10.0 as z_step from p where k <= 2 group by 1""")
def first_z_step(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").select("l_suppkey", F.format_string("/data/%08d.tif", "l_orderkey").alias("path")).distinct()
    return inventory.z_step(p, ["l_suppkey"])


@query("""with t as (select c_custkey, c_custkey * 150 % 9000 as px, c_nationkey * 40 as py from customer) select c_custkey, cast(trunc((px - min(px) over ()) / 0.5 / 10) as integer) as x0, cast(trunc((py - min(py) over ()) / 0.25 / 10) as integer) as y0 from t""")
def tile_tree(spark, sf_dir):
    x, y = F.col("c_custkey") * 150 % 9000, F.col("c_nationkey") * 40
    p = table(spark, sf_dir, "customer").select(F.concat(F.lit("/r/"), x.cast("string"), F.lit("/"), x.cast("string"), F.lit("_"), y.cast("string"), F.lit("/"), F.col("c_custkey").cast("string"), F.lit(".tif")).alias("path"))
    return inventory.tile_tree(p, 0.5, 0.25).select(N.stem(F.col("path")).cast("long").alias("c_custkey"), "x0", "y0")


# tracings


def _tree(spark, sf_dir):
    """One tree for each brand: node k hangs from k div 2."""
    from pyspark.sql.window import Window

    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("file"), F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")).alias("id"), F.col("p_size").cast("double").alias("radius"), "p_retailprice")
    return p.select("file", "id", (F.col("id") % 5).cast("int").alias("type"), F.col("p_retailprice").alias("x"), (F.col("p_retailprice") / 3).alias("y"), (F.col("id") * 1.5).alias("z"), "radius", F.when(F.col("id") == 1, -1).otherwise(F.floor(F.col("id") / 2)).cast("int").alias("parent_id"))


_TREE = """tr as (select file, id, cast(id % 5 as integer) as type, p_retailprice as x, p_retailprice / 3 as y, id * 1.5 as z, cast(p_size as double) as radius, cast(case when id = 1 then -1 else id // 2 end as integer) as parent_id
  from (select p_brand as file, cast(row_number() over (partition by p_brand order by p_partkey) as integer) as id, p_size, p_retailprice from part))"""


@query(f"""with recursive {_TREE}, w as (select file, id, [cast(1 as bigint)] as path, -1 as up from tr where parent_id = -1 union all select t.file, t.id, list_append(w.path, t.id), t.parent_id from w join tr t on t.file = w.file and t.parent_id = w.id),
n as (select file, id, up, row_number() over (partition by file order by path) as k from w)
select n.file, cast(n.k as integer) as id, t.type, t.radius, cast(coalesce(p.k, -1) as integer) as parent_id from n left join n p on p.file = n.file and p.id = n.up join tr t on t.file = n.file and t.id = n.id""")
def swc_sort(spark, sf_dir):
    return tracing.sort_tree(_tree(spark, sf_dir)).select("file", "id", "type", "radius", "parent_id")


@query(f"""with {_TREE} select file, id, cast(trunc(x + 0.5) as integer) as x, cast(floor(case when id = 1 then greatest(radius, 12.0) else radius end) as integer) as radius, '[' || cast(trunc(x + 0.5) as integer) || ',' || cast(trunc(y + 0.5) as integer) || ',' || cast(trunc(z + 0.5) as integer) || ']-r=' || cast(floor(case when id = 1 then greatest(radius, 12.0) else radius end) as integer) || '.swc' as name,
0 as seg_id, 1 as level from tr where type in (0, 1) or parent_id in (-1, 0)""")
def swc_seeds(spark, sf_dir):
    t = tracing.to_eswc(tracing.valid_soma(tracing.least_soma(_tree(spark, sf_dir), 12.0)))
    r = F.floor("radius").cast("int")
    x, y, z = (tracing.whole(F.col(c)) for c in "xyz")
    return t.select("file", "id", x.alias("x"), r.alias("radius"), F.format_string("[%d,%d,%d]-r=%d.swc", x, y, z, r).alias("name"), "seg_id", "level")


@query(f"""with {_TREE} select c.file, c.id, c.type, p.type as parent_type, round(sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y) + (c.z - p.z) * (c.z - p.z)), 6) as length from tr c join tr p on p.file = c.file and p.id = c.parent_id""")
def node_parent(spark, sf_dir):
    t = _tree(spark, sf_dir)
    p = t.select("file", F.col("id").alias("parent_id"), F.col("type").alias("parent_type"), *(F.col(c).alias(f"p{c}") for c in "xyz"))
    d = sum(((F.col(c) - F.col(f"p{c}")) * (F.col(c) - F.col(f"p{c}")) for c in "yz"), (F.col("x") - F.col("px")) * (F.col("x") - F.col("px")))
    return t.join(p, ["file", "parent_id"]).select("file", "id", "type", "parent_type", F.round(F.sqrt(d), 6).alias("length"))


@query(f"""with {_TREE}, m as (select x, y, z, radius from tr) select cast(row_number() over (order by x, y, z, radius) as integer) as n, round(x / 0.5, 6) as x, round(y / 0.5, 6) as y, round(z / 2.0, 6) as z, round(4.0 / 3.0 * 3.141592653589793 * pow(radius / 0.5, 3.0), 4) as volsize from m""")
def markers_to_apo(spark, sf_dir):
    m = tracing.markers_to_apo(_tree(spark, sf_dir).select("x", "y", "z", "radius"), (0.5, 0.5, 2.0), True)
    return m.select("n", *(F.round(c, 6).alias(c) for c in "xyz"), F.round("volsize", 4).alias("volsize"))


@query(f"""with {_TREE} select cast(count(*) - count(distinct (x, y, z, radius)) as bigint) as n from tr""")
def duplicate_nodes(spark, sf_dir):
    return tracing.duplicates(_tree(spark, sf_dir))


@query("""with r as (select n_nationkey as region, n_nationkey % 5 * 20.0 as x0, n_nationkey // 5 * 20.0 as y0 from nation), q as (select region, x0 + 10 as cx, y0 + 10 as cy from r), p as (select c_custkey, (c_custkey * 7.3::double + 0.0137::double) % 100 as x, (c_custkey * 3.7::double + 0.0071::double) % 100 as y from customer)
select c_custkey, region from p join q on abs(x - cx) + abs(y - cy) < 10""")
def point_in_region(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("region"), (F.col("n_nationkey") % 5 * 20.0 + 10).alias("cx"), (F.floor(F.col("n_nationkey") / 5) * 20.0 + 10).alias("cy"))
    c = [(10, 0), (0, 10), (-10, 0), (0, -10)]
    sides = F.explode(F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b"), F.lit(float(d)).alias("d"), F.lit(float(e)).alias("e")) for (a, b), (d, e) in zip(c, c[1:] + c[:1], strict=True)]))
    edges = n.withColumn("s", sides).select("region", (F.col("cx") + F.col("s.a")).alias("x1"), (F.col("cy") + F.col("s.b")).alias("y1"), (F.col("cx") + F.col("s.d")).alias("x2"), (F.col("cy") + F.col("s.e")).alias("y2"))
    points = table(spark, sf_dir, "customer").select("c_custkey", ((F.col("c_custkey") * F.lit(7.3) + F.lit(0.0137)) % 100).alias("x"), ((F.col("c_custkey") * F.lit(3.7) + F.lit(0.0071)) % 100).alias("y"))
    return spatial.points_in_regions(points, edges, ["c_custkey"], 5.0)


# blocks and tables between runs


@query("""with recursive t(i) as (select 0) select cast(x + 7 * (y + 5 * z) as integer) as block, cast(x * 30 + 1 as integer) as x1, cast(least(200, (x + 1) * 30) as integer) as x2, cast(y * 30 + 1 as integer) as y1, cast(least(150, (y + 1) * 30) as integer) as y2, cast(z * 16 + 1 as integer) as z1, cast(least(50, (z + 1) * 16) as integer) as z2 from range(7) a(x), range(5) b(y), range(4) c(z)""")
def block_grid(spark, sf_dir):
    return spatial.block_grid({"x": 200, "y": 150, "z": 50}, {"x": 30, "y": 30, "z": 16}, spark).select("block", "x1", "x2", "y1", "y2", "z1", "z2")


@query("""select f as fault, n from (values ('corners', 0::bigint), ('uncovered z', 0::bigint), ('overlap', 0::bigint), ('face gaps', 0::bigint)) t(f, n)""")
def block_coverage(spark, sf_dir):
    shape = {"x": 200, "y": 150, "z": 50}
    return spatial.coverage_faults(spatial.block_grid(shape, {"x": 30, "y": 30, "z": 16}, spark), shape)


@query(f"""with {VX} select cast(bz as integer) as bz, cast(b as integer) as by, cast(a as integer) as bx, cast(count(*) as bigint) as n, cast(sum(v) as bigint) as total from vx, range(4) c(bz), range(4) d(b), range(4) e(a)
where z between bz * 2 - 1 and bz * 2 + 2 and y between b * 8 - 2 and b * 8 + 9 and x between a * 8 - 2 and a * 8 + 9 group by all""")
def halo_blocks(spark, sf_dir):
    h = spatial.halo(voxels(spark, sf_dir), {"z": 2, "y": 8, "x": 8}, {"z": 1, "y": 2, "x": 2}, {"z": 8, "y": 32, "x": 32})
    return h.groupBy("bz", "by", "bx").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))


@query(f"""with {_RECORDS} select distinct xidx, yidx, zidx, z, round(score, 6) as score, xoff, yoff, zoff from rc""")
def alignments_json(spark, sf_dir):
    r = _records(spark, sf_dir).withColumn("score", F.round("score", 6)).dropDuplicates()
    back = writers.alignments_from_json(writers.alignment_json(r))
    return back.select("xidx", "yidx", "zidx", "z", "score", "xoff", "yoff", "zoff")


@query(f"""with {VX}, c as (select distinct z, y, x from vx where v > 49), t as (select y, x from c) select cast(count(*) as bigint) as cells from t""")
def mask_components(spark, sf_dir):
    cells = voxels(spark, sf_dir).filter("v > 49").select((F.col("z") * 64 + F.col("y")).alias("y"), "x")
    return place.connected(cells).agg(F.count(F.lit(1)).alias("cells"))


@query("""select event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as start, cast(count(*) as bigint) as n, round(sum(value), 6) as total from events group by all""")
def event_windows(spark, sf_dir):
    w = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return w.select("event_type", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n", "total")


@query()
def mask_component_labels(spark, sf_dir):
    """(z, y, x, label) of each cell of the mask, by components within the planes; tested against brute force."""
    cells = voxels(spark, sf_dir).filter("v > 49").select((F.col("z") * 64 + F.col("y")).alias("y"), "x")
    return place.connected(cells).select(F.floor(F.col("y") / 64).cast("int").alias("z"), (F.col("y") % 64).cast("int").alias("y"), "x", "label")


# kernels: no SQL, tested against direct numpy versions


def _binary_planes(spark, sf_dir):
    px = planes(spark, sf_dir)
    rows = px.groupBy("z").agg(F.sort_array(F.collect_list(F.struct("y", "x", "v"))).alias("p"))
    word = F.transform("p", lambda p: F.concat(F.substring(F.lpad(F.hex(p["v"]), 4, "0"), 3, 2), F.substring(F.lpad(F.hex(p["v"]), 4, "0"), 1, 2)))
    return rows.select(F.lit("c0").alias("channel"), F.lit(0).alias("row"), F.lit(0).alias("col"), F.col("z").cast("int").alias("z"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit("uint16").alias("dtype"), F.unhex(F.array_join(word, "")).alias("pixels"))


@query()
def destriped_planes(spark, sf_dir):
    return kernels.map_planes(_binary_planes(spark, sf_dir), lambda im: kernels.process_plane(im, sigmas=(2.0, 2.0), dark=100)).select("z", "height", "width", "dtype", F.sha2("pixels", 256).alias("digest"))


@query()
def deconvolved_blocks(spark, sf_dir):
    px = planes(spark, sf_dir).select(F.col("z").cast("int").alias("z"), "y", "x", "v")
    depth = (px.agg(F.max("z")).first()[0] or 0) + 1
    psf = decon.make_psf((3, 3, 3), (1.0, 0.4, 0.4), 0.4, 0.6, 0.1, 0.5, 1.33)
    out = decon.by_block(px, {"z": depth, "y": 8, "x": 8}, {"z": 16, "y": 8, "x": 8}, {"z": 2, "y": 2, "x": 2}, lambda b: decon.deconvolve(b, psf, decon.Plan(rounds=2, classical=True)))
    return decon.normalised(out, 255.0, 1.0).select("z", "y", "x", F.col("v").cast("int").alias("v"))


@query(f"""with {PX}, a as (select cast(y + 8 * z as bigint) as y, x, v from px), b as (select y + 1 as y, x + 1 as x, (v * 3) // 2 + x as v from a), o as (select i // 5 - 2 as dy, i % 5 - 2 as dx, i as ord from range(25) r(i)),
s as (select dy, dx, ord, corr(a.v, b.v) as s from b, o, a where a.y = b.y + dy and a.x = b.x + dx group by all)
select cast(0 as integer) as k, cast(dy as integer) as dy, cast(dx as integer) as dx, round(s, 6) as score from (select *, row_number() over (order by s desc, ord) as n from s) where n = 1""")
def registered_pair(spark, sf_dir):
    """The shift of a second channel, brighter and moved by a place down and right."""
    px = planes(spark, sf_dir)
    a = px.select(F.lit(0).alias("k"), (F.col("y") + 8 * F.col("z")).alias("y"), "x", "v")
    b = a.select("k", (F.col("y") + 1).alias("y"), (F.col("x") + 1).alias("x"), (F.floor(F.col("v") * 3 / 2) + F.col("x")).alias("v"))
    return register.translation(a, b, "k", 2).select("k", "dy", "dx", F.round("score", 6).alias("score"))
