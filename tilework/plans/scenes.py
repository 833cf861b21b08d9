"""Queries on cameras, instances, corridors and burn states."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import grids as G
from ..operators import scenes as C
from ..operators import timelines as T
from .grids import HAG, hag
from .registry import query
from .views import boxes, cells, points, table, vertices


@query("""select id, round(d, 6) as depth, case when d > 1e-6 then round((x / d * 2 + 1) / 2 * 1920, 3) end as u, coalesce(d > 1e-6 and (x / d * 2 + 1) / 2 * 1920 between 0 and 1920 and (1 - (z - 50) / d * 2 * 1920 / 1080) / 2 * 1080 between 0 and 1080, false) as in_frame
from (select id, y_mm / 1000.0 + 200 as d, (x_mm % 500000) / 1000.0 - 250 as x, height_cm / 100.0 as z from points)""", "points")
def camera_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points before a camera that looks north."""
    at = points(spark, sf_dir).select("id", (F.col("x_mm") % 500_000 / 1000.0).alias("x"), (F.col("y_mm") / 1000.0).alias("y"), (F.col("height_cm") / 100.0).alias("z"))
    axis = lambda *v: tuple(map(F.lit, v))
    found = C.projected(at, (250.0, -200.0, 50.0), axis(0.0, 1.0, 0.0), axis(1.0, 0.0, 0.0), axis(0.0, 0.0, 1.0), 35.0, 35.0, 1920, 1080)
    return found.select("id", F.round("depth", 6).alias("depth"), F.round("u", 3).alias("u"), "in_frame")


@query("""select id, case when category in ('ECONOMY', 'SMALL') then 'tree' when category = 'PROMO' then 'context' else 'building' end as family,
 round(case when category in ('ECONOMY', 'SMALL') then (500 + id % 900) / 700.0 when category = 'PROMO' then 1 else (x1 - x0) / 10000.0 end, 6) as sx, round(case when category in ('ECONOMY', 'SMALL') then (500 + id % 900) / 700.0 when category = 'PROMO' then 1 else (y1 - y0) / 10000.0 end, 6) as sy, x0 % 500000 as dx, y0 % 500000 as dy from boxes""", "boxes")
def instance_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale by family and the place relative to the tile's origin."""
    tree, context = F.col("category").isin("ECONOMY", "SMALL"), F.col("category") == "PROMO"
    tall = (500 + F.col("id") % 900) / 700.0
    scale = lambda a, b: F.round(F.when(tree, tall).when(context, 1.0).otherwise((F.col(b) - F.col(a)) / 10_000.0), 6)
    return boxes(spark, sf_dir).select("id", F.when(tree, "tree").when(context, "context").otherwise("building").alias("family"), scale("x0", "x1").alias("sx"), scale("y0", "y1").alias("sy"), (F.col("x0") % 500_000).alias("dx"), (F.col("y0") % 500_000).alias("dy"))


@query("""with n as (select tile, r, c, mnt_mm % 700 - 350 as gx, mns_mm % 900 - 450 as gy from cells), l as (select *, sqrt(cast(gx * gx + gy * gy + 16000000 as double)) as len from n)
select tile, r, c, cast(case when -gx >= 0 then floor(-gx * 32767 / len + 0.5) else ceil(-gx * 32767 / len - 0.5) end as integer) as nx, cast(case when -gy >= 0 then floor(-gy * 32767 / len + 0.5) else ceil(-gy * 32767 / len - 0.5) end as integer) as ny, cast(floor(4000 * 32767 / len + 0.5) as integer) as nz from l""", "cells")
def surface_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B28"""
    nx, ny, nz = C.snorm16(F.col("mnt_mm") % 700 - 350, F.col("mns_mm") % 900 - 450)
    return cells(spark, sf_dir).select("tile", "r", "c", nx.alias("nx"), ny.alias("ny"), nz.alias("nz"))


@query("""with s as (select line, seq, x, y, lead(x) over (partition by line order by seq) as x2, lead(y) over (partition by line order by seq) as y2 from vertices), g as (select line % 7 + 1 as rank, line, count(*) as segments, sum(sqrt((x2 - x) ** 2 + (y2 - y) ** 2)) as length, count(*) filter (sqrt((x2 - x) ** 2 + (y2 - y) ** 2) > 8000) as capped from s where x2 is not null group by 1, 2)
select rank, count(*) as lines, cast(sum(segments) as bigint) as segments, round(sum(length), 3) as length, cast(sum(capped) as bigint) as capped from g group by rank""", "vertices")
def network_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, segments, lengths and cap hits by rank."""
    length = F.sqrt((F.col("x2") - F.col("x")) ** 2 + (F.col("y2") - F.col("y")) ** 2)
    lines = T.segments(vertices(spark, sf_dir)).groupBy((F.col("line") % 7 + 1).alias("rank"), "line").agg(F.count("*").alias("segments"), F.sum(length).alias("length"), F.count_if(length > 8000).alias("capped"))
    return lines.groupBy("rank").agg(F.count("*").alias("lines"), F.sum("segments").alias("segments"), F.round(F.sum("length"), 3).alias("length"), F.sum("capped").alias("capped"))


@query("""with a as (select tile, r, c, r * 40 + c * 55 + (mnt_mm % 97) as arrival from cells), m as (select * from (values (1, 300), (2, 900), (3, 1800)) v(state, t)), d as (select * from (values (-1, 0), (1, 0), (0, -1), (0, 1)) v(dr, dc)),
b as (select tile, state, count(*) * 625 as area_m2 from a join m on arrival <= t group by 1, 2),
f as (select a.tile, state, count(*) * 25 as front_m from a cross join d left join a n on n.tile = a.tile and n.r = a.r + dr and n.c = a.c + dc join m on a.arrival <= t and (n.arrival is null or n.arrival > t) group by 1, 2)
select b.tile, b.state, area_m2, coalesce(front_m, 0) as front_m from b left join f on f.tile = b.tile and f.state = b.state""", "cells")
def burn_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area and front length of three moments."""
    arrival = cells(spark, sf_dir).select("tile", "r", "c", (F.col("r") * 40 + F.col("c") * 55 + F.col("mnt_mm") % 97).alias("arrival"))
    moments = spark.createDataFrame([(1, 300), (2, 900), (3, 1800)], "state int, t int")
    return C.burn_states(arrival, moments, 25)


@query("""with f as (select id, brand, x0, x0 // 500000 as area, x1 - x0 as w, coalesce(abs((x1 - x0) - lead(x1 - x0) over (partition by brand, x0 // 500000 order by id)) <= 20000, false) as joins from boxes),
s as (select *, cast(sum(case when before then 0 else 1 end) over (partition by brand, x0 // 500000 order by id) as bigint) as run from (select *, coalesce(lag(joins) over (partition by brand, x0 // 500000 order by id), false) as before from f)),
p as (select *, (row_number() over (partition by brand, area, run order by id) - 1) // 2 as half from s)
select brand, area, run || ':' || half as pair, min(id) as first, count(*) as parts, min(w) as low, max(w) as high from p group by 1, 2, 3""", "boxes")
def merged_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of one tile and near equal width merge in twos."""
    rows = boxes(spark, sf_dir).select("id", "brand", F.expr("x0 div 500000").alias("area"), (F.col("x1") - F.col("x0")).alias("w"))
    paired = C.merged_pairs(rows, ["brand", "area"], "id", F.abs(F.col("w") - F.col("nxt.w")) <= 20_000)
    return paired.groupBy("brand", "area", "pair").agg(F.min("id").alias("first"), F.count("*").alias("parts"), F.min("w").alias("low"), F.max("w").alias("high"))


@query(f"""with m as (select tile, r, c, hag, tile * 1000000 + r * 1000 + c as k from (select *, {HAG} as hag from cells) where hag >= 1000),
e as (select a.k as a, b.k as b from m a join m b on a.tile = b.tile and abs(a.r - b.r) <= 1 and abs(a.c - b.c) <= 1 and a.k <> b.k),
walk as (with recursive w as (select k as node, k as seen from m union select w.node, e.b from w join e on e.a = w.seen) select * from w),
l as (select m.*, f // 1000000 || ':' || f // 1000 % 1000 || ':' || f % 1000 as component from m join (select node, min(seen) as f from walk group by 1) on node = k),
n as (select *, count(*) over p as n, min(c * 1000 + r) over p as first from l window p as (partition by component))
select tile, r, c, component, hag from n where (n < 32 and c * 1000 + r = first) or (n >= 32 and r % 4 = 0 and c % 4 = 0)""", "cells")
def plateau_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One peak per 8-connected plateau of high cells, the lattice on large ones."""
    high = hag(spark, sf_dir).filter("hag >= 1000").select("tile", "r", "c", "hag")
    return C.peaks(G.labelled_components(high, G.EIGHT), "component", 4, 32).select("tile", "r", "c", "component", "hag")


@query("""with w as (select line, seq, x, y, lag(x) over o as px, lag(y) over o as py, lead(x) over o as qx, lead(y) over o as qy from vertices window o as (partition by line order by seq)),
n as (select *, sqrt(cast((x - px) ** 2 + (y - py) ** 2 as double)) as la, sqrt(cast((qx - x) ** 2 + (qy - y) ** 2 as double)) as lb from w),
u as (select *, -(y - py) / nullif(la, 0) as a1, (x - px) / nullif(la, 0) as a2, -(qy - y) / nullif(lb, 0) as b1, (qx - x) / nullif(lb, 0) as b2 from n),
m as (select *, coalesce(a1, b1) + coalesce(b1, a1) as sx, coalesce(a2, b2) + coalesce(b2, a2) as sy from u),
k as (select *, case when sx * sx + sy * sy > 1e-6 then sx / sqrt(sx * sx + sy * sy) else coalesce(b1, a1) end as mx, case when sx * sx + sy * sy > 1e-6 then sy / sqrt(sx * sx + sy * sy) else coalesce(b2, a2) end as my from m),
r as (select *, least(6.0, 3.0 / greatest(abs(mx * coalesce(b1, a1) + my * coalesce(b2, a2)), 1e-9)) as reach from k)
select line, seq, round(x + mx * reach, 3) as ox, round(y + my * reach, 3) as oy from r where mx is not null""", "vertices")
def offset_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One side of a corridor of half width three, mitres held to twice that."""
    found = C.offset_points(vertices(spark, sf_dir), F.lit(3.0))
    return found.filter("ox is not null").select("line", "seq", F.round("ox", 3).alias("ox"), F.round("oy", 3).alias("oy"))


@query("""with s as (select line, seq, x, y, lead(x) over (partition by line order by seq) as x2, lead(y) over (partition by line order by seq) as y2 from vertices), l as (select *, sqrt((x2 - x) ** 2 + (y2 - y) ** 2) as len from s where x2 is not null),
c as (select *, sum(len) over (partition by line order by seq) as upto, sum(len) over (partition by line) / 2 as mid from l)
select line, round(x + (mid - upto + len) / len * (x2 - x), 3) as x, round(y + (mid - upto + len) / len * (y2 - y), 3) as y from c where mid > upto - len and mid <= upto""", "vertices")
def line_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The midpoint by length."""
    return T.stations(vertices(spark, sf_dir), 1).select("line", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query(f"""with h as (select tile, r // 8 as fr, c // 8 as fc, mnt_mm, {HAG} as hag from cells), g as (select tile, fr, fc, count(*) as samples, quantile_disc(hag, 0.95) as p95, quantile_disc(mnt_mm, 0.5) as ground from h group by 1, 2, 3)
select *, case when samples < 20 then 'rejected' when p95 < 200 then 'ambiguous' else 'valid' end as status from g""", "cells")
def footprint_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: height and ground of square footprints, with status."""
    found = hag(spark, sf_dir).groupBy("tile", F.expr("r div 8").alias("fr"), F.expr("c div 8").alias("fc")).agg(F.count("*").alias("samples"), G.nearest_rank("hag", 0.95).alias("p95"), G.nearest_rank("mnt_mm", 0.5).alias("ground"))
    return found.withColumn("status", F.when(F.col("samples") < 20, "rejected").when(F.col("p95") < 200, "ambiguous").otherwise("valid"))


@query("""select id, round(cx + dx * cos(a) - dy * sin(a), 4) as x, round(cy + dx * sin(a) + dy * cos(a), 4) as y, id % 3 as profile from (select id, x_mm / 1000.0 as cx, y_mm / 1000.0 as cy, 10.0 + id % 40 as dx, id % 25 as dy, radians(id % 360) as a from points)""", "points")
def retargeted_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I16: an aim turned about its camera."""
    k = F.col("id")
    cx, cy, dx, dy, a = F.col("x_mm") / 1000.0, F.col("y_mm") / 1000.0, 10.0 + k % 40, k % 25, F.radians((k % 360).cast("double"))
    return points(spark, sf_dir).select("id", F.round(cx + dx * F.cos(a) - dy * F.sin(a), 4).alias("x"), F.round(cy + dx * F.sin(a) + dy * F.cos(a), 4).alias("y"), (k % 3).alias("profile"))


@query("""with q as (select o_orderkey as site, o_custkey % 32 as r, o_orderkey % 32 as c, o_custkey % 100 as tile from orders), ring as (select site, tile, r + dr as r, c + dc as c from q cross join (values (-3, 0), (3, 0), (0, -3), (0, 3)) v(dr, dc))
select site, count(*) as samples, max(mns_mm) + 25000 as altitude from ring join cells using (tile, r, c) group by site""", "cells")
def aerial_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the altitude that clears every sample of a ring by 25 m."""
    sites = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("site"), (F.col("o_custkey") % 100).alias("tile"), (F.col("o_custkey") % 32).alias("r"), (F.col("o_orderkey") % 32).alias("c"))
    ring = G.neighbours(sites, [(-3, 0), (3, 0), (0, -3), (0, 3)]).select("site", "tile", F.col("nr").alias("r"), F.col("nc").alias("c"))
    return ring.join(cells(spark, sf_dir).select("tile", "r", "c", "mns_mm"), ["tile", "r", "c"]).groupBy("site").agg(F.count("*").alias("samples"), (F.max("mns_mm") + 25_000).alias("altitude"))


@query()
def camera_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve high points, each at least 100 m from those before it."""
    rows = points(spark, sf_dir).select("id", F.col("x_mm").alias("x"), F.col("y_mm").alias("y"), F.col("height_cm").alias("score"))
    return C.diverse_picks(rows, 12, 100_000)


@query("""with e as (select p_partkey as part, p_size as expected, p_type as category from part), g as (select l_partkey as part, count(*) as got, count(*) filter (l_quantity < 2) as placeholders from lineitem group by 1)
select category, cast(sum(expected) as bigint) as expected, cast(sum(coalesce(got, 0)) as bigint) as got, cast(sum(coalesce(placeholders, 0)) as bigint) as placeholders, count(*) filter (coalesce(got, 0) <> expected or placeholders > 0) as uncovered from e left join g using (part) group by 1""")
def coverage_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places expected of a part (its size) against those made of it in another table, without placeholders."""
    expected = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.col("p_size").alias("expected"), F.col("p_type").alias("category"))
    got = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(F.count("*").alias("got"), F.count_if(F.col("l_quantity") < 2).alias("placeholders"))
    both = expected.join(got, "part", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    return both.groupBy("category").agg(F.sum("expected").alias("expected"), F.sum("got").alias("got"), F.sum(F.coalesce("placeholders", F.lit(0))).alias("placeholders"), F.count_if((F.col("got") != F.col("expected")) | (F.col("placeholders") > 0)).alias("uncovered"))


@query("""with c as (select id, p_type as asset, case when id % 4 = 0 then 'trees' when id % 4 = 1 then 'context_assets' else 'buildings' end as family, x0, y0, p_size, x1 - x0 as w, y1 - y0 as d, id % 7 - 3 as k
  from boxes join part on p_partkey = id),
e as (select p_type as asset, 1 + avg(p_size) / 10 as ex, 2 + count(*) % 9 as ey, 1 + max(p_size) / 20.0 as ez from part group by 1),
t as (select *, case family when 'trees' then id * 7919 * 1000000007 / 18446744073709551616.0 * 2 * pi() when 'buildings' then k * 0.4 else k * 0.1 end as turn, (500 + id % 900) / 100.0 as tall from c join e using (asset))
select id, family, asset, round(case family when 'trees' then tall / ey when 'buildings' then w / 1000.0 / ex else 1 end, 6) as sx, round(case family when 'context_assets' then 1 else tall / ey end, 6) as sy,
  round(case family when 'trees' then tall / ey when 'buildings' then d / 1000.0 / ez else 1 end, 6) as sz, round(x0 % 500000 / 1000.0, 6) as px, round(y0 / 1000.0 - y0 // 500000 * 500, 6) as py, round(p_size * 11 / 1000.0, 6) as pz,
  round(cos(turn / 2) * sqrt(0.5), 6) as qw, round(cos(turn / 2) * sqrt(0.5), 6) as qx, round(sin(turn / 2) * sqrt(0.5), 6) as qy, round(sin(turn / 2) * sqrt(0.5), 6) as qz from t""", "boxes")
def placed_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale, place and orientation of buildings, trees and context assets, from a catalog of prototypes."""
    k, part = F.col("id"), table(spark, sf_dir, "part")
    prototypes = part.groupBy(F.col("p_type").alias("asset")).agg((1 + F.avg("p_size") / 10).alias("ex"), (2 + F.count("*") % 9).cast("double").alias("ey"), (1 + F.max("p_size") / 20.0).alias("ez"))
    family = F.when(k % 4 == 0, "trees").when(k % 4 == 1, "context_assets").otherwise("buildings")
    candidates = boxes(spark, sf_dir).join(part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("asset"), "p_size"), "id").select(
        "id", family.alias("family"), "asset", (F.col("x0") / 1000.0).alias("x"), (F.col("y0") / 1000.0).alias("y"), (F.col("p_size") * 11).alias("ground_mm"), (500 + k % 900).alias("height_cm"),
        ((F.col("x1") - F.col("x0")) / 1000.0).alias("width"), ((F.col("y1") - F.col("y0")) / 1000.0).alias("depth"), ((k % 7 - 3) * F.when(family == "buildings", 0.4).otherwise(0.1)).alias("yaw"),
        (k.cast("decimal(19,0)") * F.lit(Decimal(7919 * 1_000_000_007))).alias("seed"), (F.expr("x0 div 500000") * 500.0).alias("ox"), (F.expr("y0 div 500000") * 500.0).alias("oy"),
    )
    found = C.instances(candidates, prototypes)
    return found.select("id", "family", "asset", *(F.round(c, 6).alias(c) for c in ("sx", "sy", "sz", "px", "py", "pz", "qw", "qx", "qy", "qz")))
