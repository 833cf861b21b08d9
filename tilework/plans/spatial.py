"""Queries by place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import spatial as P
from ..operators import timelines as T
from .registry import query
from .views import TILE_MM, boxes, cells, points, table, vertices

STEP = 50_000


@query("select id, x_mm // 500000 * 500000 as west, y_mm // 500000 * 500000 as south, x_mm // 2000000 as block, (x_mm % 500000) // 1000 as c, 499 - (y_mm % 500000) // 1000 as r from points", "points")
def owner_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 B9 B10"""
    x, y = F.col("x_mm"), F.col("y_mm")
    return points(spark, sf_dir).select("id", S.owner_tile(x, TILE_MM).alias("west"), S.owner_tile(y, TILE_MM).alias("south"), F.floor(x / 2_000_000).alias("block"), F.expr("(x_mm % 500000) div 1000").alias("c"), (499 - F.expr("(y_mm % 500000) div 1000")).alias("r"))


@query("""with t as (select id, unnest(range((x0 - 10000) // 500000, (x1 + 10000) // 500000 + 1)) as gx, y0, y1 from boxes where x0 >= 10000),
u as (select id, gx, unnest(range((y0 - 10000) // 500000, (y1 + 10000) // 500000 + 1)) as gy from t where y0 >= 10000)
select gx, gy, count(*) as features, cast(sum(id) as bigint) as ids from u group by 1, 2""", "boxes")
def features_by_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that meet each tile's window with its halo."""
    met = P.boxes_to_tiles(boxes(spark, sf_dir).filter("x0 >= 10000 and y0 >= 10000"), TILE_MM, 10_000)
    return met.groupBy("gx", "gy").agg(F.count("*").alias("features"), F.sum("id").alias("ids"))


@query("select p.id, b.id as box from points p join boxes b on p.x_mm >= b.x0 and p.x_mm < b.x1 and p.y_mm >= b.y0 and p.y_mm < b.y1", "points boxes")
def points_by_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 for boxes"""
    return P.points_in_boxes(points(spark, sf_dir), boxes(spark, sf_dir), STEP)


@query("select a.id as a, b.id as b, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) as area from boxes a join boxes b on a.id < b.id and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1", "boxes")
def box_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping footprints"""
    return P.overlapping_boxes(boxes(spark, sf_dir), STEP)


@query("""with o as (select a.id as a, b.id as b, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) as area from boxes a join boxes b on a.id <> b.id and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1),
s as (select id, (x1 - x0) * (y1 - y0) as size from boxes)
select o.a as id, count(*) as matches, count(*) = 1 as univocal, count(*) filter (area * 4 >= s.size) as strong from o join s on s.id = o.a group by 1""", "boxes")
def footprint_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches per footprint, those that cover a quarter of it, and whether one match is the only one."""
    rows = boxes(spark, sf_dir)
    pairs = P.overlapping_boxes(rows, STEP)
    both = pairs.select(F.col("a").alias("id"), "area").union(pairs.select(F.col("b").alias("id"), "area"))
    size = rows.select("id", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("size"))
    return both.join(size, "id").groupBy("id").agg(F.count("*").alias("matches"), (F.count("*") == 1).alias("univocal"), F.count_if(F.col("area") * 4 >= F.col("size")).alias("strong"))


@query("""with d as (select a.id, b.id as target, (a.x_mm - b.x_mm) ** 2 + (a.y_mm - b.y_mm) ** 2 as d2 from points a join points b on a.id <> b.id and abs(a.x_mm - b.x_mm) <= 50000 and abs(a.y_mm - b.y_mm) <= 50000),
r as (select id, target, cast(d2 as bigint) as d2, row_number() over (partition by id order by d2, target) as place from d where d2 <= 2500000000) select * from r where place <= 4""", "points")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 C8"""
    rows = points(spark, sf_dir)
    return P.nearest_within(rows, rows, STEP, 4)


@query("""with t as (select x0 as x, y0 as y from boxes), d as (select a.id, min((a.x_mm - t.x) ** 2 + (a.y_mm - t.y) ** 2) as d2 from points a join t on abs(a.x_mm - t.x) <= 50000 and abs(a.y_mm - t.y) <= 50000 group by a.id)
select p.id, case when d.d2 <= 2500000000 then cast(d.d2 as bigint) end as d2, coalesce(d.d2 <= 2500000000, false) as within_guard from points p left join d using (id)""", "points boxes")
def guarded_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each point's nearest box corner, null with a flag beyond the guard."""
    rows = points(spark, sf_dir)
    corners = boxes(spark, sf_dir).select((-F.col("id") - 1).alias("id"), F.col("x0").alias("x_mm"), F.col("y0").alias("y_mm"))
    near = P.nearest_within(rows, corners, STEP, 1).select("id", "d2")
    return rows.select("id").join(near, "id", "left").withColumn("within_guard", F.col("d2").isNotNull())


@query("""with s as (select l_suppkey as tile, l_orderkey * 10 + l_linenumber as id, max(l_partkey % 300) as u, max(l_orderkey % 300) as v from lineitem group by 1, 2),
k as (select tile, id, v // 10 + a as r, u // 10 + b as c, (case when a = 1 then v % 10 else 10 - v % 10 end) * (case when b = 1 then u % 10 else 10 - u % 10 end) as w from s cross join (values (0), (1)) x(a) cross join (values (0), (1)) y(b))
select k.tile, id, cast(sum(w * mnt_mm) as bigint) as weighted, cast(sum(w) as bigint) as weights from k join cells on cells.tile = k.tile and cells.r = k.r and cells.c = k.c where w > 0 group by 1, 2""", "cells")
def bilinear_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10 L4"""
    rows = table(spark, sf_dir, "lineitem")
    samples = rows.groupBy(F.col("l_suppkey").alias("tile"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")).agg(F.max(F.col("l_partkey") % 300).alias("u"), F.max(F.col("l_orderkey") % 300).alias("v"))
    return P.bilinear(samples, cells(spark, sf_dir), "mnt_mm", 10)


@query("""with p as (select line, seq, line // 50 as area, line * 7919 % 1500 + x // 20 as x, line * 104729 % 1500 + y // 20 as y from vertices),
s as (select * from (select *, lead(x) over w as x2, lead(y) over w as y2 from p window w as (partition by line order by seq)) where x2 is not null)
select a.line, a.seq, b.line as other, b.seq as other_seq from s a join s b on a.area = b.area and a.line < b.line
where least(a.x, a.x2) <= greatest(b.x, b.x2) and least(b.x, b.x2) <= greatest(a.x, a.x2) and least(a.y, a.y2) <= greatest(b.y, b.y2) and least(b.y, b.y2) <= greatest(a.y, a.y2)
  and sign((a.x2 - a.x) * (b.y - a.y) - (a.y2 - a.y) * (b.x - a.x)) * sign((a.x2 - a.x) * (b.y2 - a.y) - (a.y2 - a.y) * (b.x2 - a.x)) < 0
  and sign((b.x2 - b.x) * (a.y - b.y) - (b.y2 - b.y) * (a.x - b.x)) * sign((b.x2 - b.x) * (a.y2 - b.y) - (b.y2 - b.y) * (a.x2 - b.x)) < 0""", "vertices")
def line_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proper crossings of different lines; lines lie within their area of 50 lines, areas side by side."""
    local = vertices(spark, sf_dir).select("line", "seq", F.expr("line div 50 * 2000 + line * 7919 % 1500 + x div 20").alias("x"), F.expr("line * 104729 % 1500 + y div 20").alias("y"))
    s = T.segments(local)
    return P.crossing_segments(s, s, 500).filter("line < other")


@query("""with q as (select o_orderkey as zone, o_custkey * 137 as cx, o_orderkey * 311 as cy, 500 + o_custkey % 4 * 500 as side from orders)
select zone, unnest(range(cast(floor((cx - side / 2) / 500) as bigint), cast(ceil((cx + side / 2) / 500) as bigint))) * 500 as x, y from (select *, unnest(range(cast(floor((cy - side / 2) / 500) as bigint), cast(ceil((cy + side / 2) / 500) as bigint))) * 500 as y from q)""")
def tile_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1"""
    requests = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("zone"), (F.col("o_custkey") * 137).alias("cx"), (F.col("o_orderkey") * 311).alias("cy"), (500 + F.col("o_custkey") % 4 * 500).alias("side"))
    return P.square_plan(requests, 500)


@query("""with t as (select x_mm // 500000 as tile, id, height_cm from points), n as (select l_suppkey as tile, count(*) as cells from lineitem group by 1)
select n.tile, n.cells, count(t.id) as trees, round(count(t.id) / 0.25, 3) as per_km2, min(height_cm) as lowest, max(height_cm) as highest from n left join t using (tile) group by 1, 2""", "points")
def density_per_km2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles without points stay, with zeros."""
    trees = points(spark, sf_dir).groupBy(F.expr("x_mm div 500000").alias("tile")).agg(F.count("*").alias("trees"), F.min("height_cm").alias("lowest"), F.max("height_cm").alias("highest"))
    tiles = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("tile")).agg(F.count("*").alias("cells"))
    n = F.coalesce("trees", F.lit(0))
    return tiles.join(trees, "tile", "left").select("tile", "cells", n.alias("trees"), F.round(n / 0.25, 3).alias("per_km2"), "lowest", "highest")


@query("""with b as (select distinct tile as t, r, c from cells where mns_mm - mnt_mm >= 10000), p as (select id, x_mm // 500000 as t, (y_mm % 500000) // 15625 as r, (x_mm % 500000) // 15625 as c from points)
select p.t as tile, count(*) as burned from p semi join b on b.t = p.t and b.r = p.r and b.c = p.c group by 1""", "cells points")
def points_in_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C22"""
    burned = cells(spark, sf_dir).filter("mns_mm - mnt_mm >= 10000").select("tile", "r", "c")
    at = points(spark, sf_dir).select("id", F.expr("x_mm div 500000").alias("tile"), F.expr("(y_mm % 500000) div 15625").alias("r"), F.expr("(x_mm % 500000) div 15625").alias("c"))
    return at.join(burned, ["tile", "r", "c"], "left_semi").groupBy("tile").agg(F.count("*").alias("burned"))


@query("""select id, cast((x0 + x1) // 2 as bigint) as cx, cast((y0 + y1) // 2 as bigint) as cy, greatest(x1 - x0, y1 - y0) as long_side, least(x1 - x0, y1 - y0) as short_side, case when x1 - x0 >= y1 - y0 then 0 else 90 end as yaw, (x1 - x0) * (y1 - y0) as area from boxes""", "boxes")
def oriented_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 on axis-aligned footprints; D18 area by the ring's shoelace."""
    w, d = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    corner = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    return boxes(spark, sf_dir).select("id", F.expr("(x0 + x1) div 2").alias("cx"), F.expr("(y0 + y1) div 2").alias("cy"), F.greatest(w, d).alias("long_side"), F.least(w, d).alias("short_side"), F.when(w >= d, 0).otherwise(90).alias("yaw"), (S.shoelace(ring) / 2).cast("long").alias("area"))


@query("""with r as (select a.id, count(*) filter (a.height_cm > b.height_cm) as taller, count(*) as near from points a join points b on a.id <> b.id and abs(a.x_mm - b.x_mm) <= 50000 and abs(a.y_mm - b.y_mm) <= 50000 and (a.x_mm - b.x_mm) ** 2 + (a.y_mm - b.y_mm) ** 2 <= 2500000000 group by 1)
select id, near, taller, taller = near as dominant from r""", "points")
def dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 in plan view: points that no neighbour within reach overtops."""
    rows = points(spark, sf_dir)
    pairs = P.pairs_within(rows, rows, STEP)
    return pairs.groupBy("id").agg(F.count("*").alias("near"), F.count_if(F.col("height_cm") > F.col("target_height_cm")).alias("taller")).withColumn("dominant", F.col("taller") == F.col("near"))


@query("""with d as (select id, ((x_mm // 500000) * 500000 + 250000) / 1000.0 + 0.001 - x_mm / 1000.0 as dx, 250 - y_mm / 1000.0 as dy, -height_cm / 100.0 as dz from points),
n as (select id, dx::double as dx, dy::double as dy, dz::double as dz, sqrt(dx::double ** 2 + dy::double ** 2 + dz::double ** 2) as len from d),
f as (select id, dx / len as f0, dy / len as f1, dz / len as f2, abs(dz / len) > 0.98 as steep from n),
c as (select *, case when steep then -f2 else f1 end as c0, case when steep then 0 else -f0 end as c1, case when steep then f0 else 0 end as c2 from f),
r as (select *, c0 / sqrt(c0 ** 2 + c1 ** 2 + c2 ** 2) as r0, c1 / sqrt(c0 ** 2 + c1 ** 2 + c2 ** 2) as r1, c2 / sqrt(c0 ** 2 + c1 ** 2 + c2 ** 2) as r2 from c),
t as (select *, r1 * f2 - r2 * f1 as t0, r2 * f0 - r0 * f2 as t1, r0 * f1 - r1 * f0 as t2 from r),
m as (select id, r0 as a, t0 as b, -f0 as c, r1 as d, t1 as e, -f1 as g, r2 as h, t2 as i, -f2 as j from t),
q as (select id, case when a + e + j > 0 then [sqrt(1 + a + e + j) / 2, (i - g) / (2 * sqrt(1 + a + e + j)), (c - h) / (2 * sqrt(1 + a + e + j)), (d - b) / (2 * sqrt(1 + a + e + j))]
  when a >= e and a >= j then [(i - g) / (2 * sqrt(1 + a - e - j)), sqrt(1 + a - e - j) / 2, (b + d) / (2 * sqrt(1 + a - e - j)), (c + h) / (2 * sqrt(1 + a - e - j))]
  when e >= j then [(c - h) / (2 * sqrt(1 + e - a - j)), (b + d) / (2 * sqrt(1 + e - a - j)), sqrt(1 + e - a - j) / 2, (g + i) / (2 * sqrt(1 + e - a - j))]
  else [(d - b) / (2 * sqrt(1 + j - a - e)), (c + h) / (2 * sqrt(1 + j - a - e)), (g + i) / (2 * sqrt(1 + j - a - e)), sqrt(1 + j - a - e) / 2] end as v from m)
select id, round(v[1], 6) + 0 as w, round(v[2], 6) + 0 as x, round(v[3], 6) + 0 as y, round(v[4], 6) + 0 as z from q""", "points")
def view_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look-at quaternion of each point towards its tile's centre, unit length."""
    x, y, z = F.col("x_mm") / 1000.0, F.col("y_mm") / 1000.0, F.col("height_cm") / 100.0
    cx = (F.floor(F.col("x_mm") / TILE_MM) * TILE_MM + TILE_MM / 2) / 1000.0
    q = S.look_at_quaternion((x, y, z), (cx + 0.001, F.lit(250.0), F.lit(0.0)))
    return points(spark, sf_dir).select("id", *((F.round(v, 6) + 0.0).alias(n) for v, n in zip(q, "wxyz", strict=True)))  # no negative zeros
