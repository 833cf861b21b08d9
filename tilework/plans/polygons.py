"""Queries on polygons: footprints with holes, rasters of them, joins with cells, outlines, dissolving, boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import grids as G
from ..operators import polygons as P
from ..operators import tiles
from .grids import LABELLED, hag
from .registry import query
from .views import TILE_MM, boxes

#: Cell side of the rasters in mm.
FINE = 1000


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, part, rings: each box as a slanted quadrilateral, cut along its diagonal into two parts for every second id; every third
    whole one has a slanted hole."""
    k = F.col("id")
    point = lambda x, y: F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    ux, uy, vx, vy = F.col("x1") - F.col("x0"), (k % 7 - 3) * 700, -(k % 5 - 2) * 600, F.col("y1") - F.col("y0")
    at = lambda a, b: point(F.col("x0") + F.floor((ux * a + vx * b) / 4), F.col("y0") + F.floor((uy * a + vy * b) / 4))
    whole = F.array(at(0, 0), at(4, 0), at(4, 4), at(0, 4), at(0, 0))
    hole = F.array(at(1, 1), at(1, 3), at(3, 2))
    one = lambda part, *rings: F.struct(F.lit(part).alias("part"), F.array(*rings).alias("rings"))
    halves = F.array(one(0, F.array(at(0, 0), at(4, 0), at(4, 4))), one(1, F.array(at(0, 0), at(4, 4), at(0, 4))))
    parts = F.when(k % 2 == 0, halves).when(k % 3 == 0, F.array(one(0, whole, hole))).otherwise(F.array(one(0, whole)))
    return boxes(spark, sf_dir).select("id", F.explode(parts).alias("p")).select("id", "p.part", "p.rings")


#: The same polygons as sides, and a test of every cell centre of a polygon's box: one that an odd number of sides pass to the right.
SIDES = """corners as (select id, x0, y0, x1 - x0 as ux, (id % 7 - 3) * 700 as uy, -(id % 5 - 2) * 600 as vx, y1 - y0 as vy from boxes),
spots as (select id, a, b, x0 + (ux * a + vx * b) // 4 as x, y0 + (uy * a + vy * b) // 4 as y from corners, (values (0, 0), (4, 0), (4, 4), (0, 4), (1, 1), (1, 3), (3, 2)) v(a, b)),
plan as (select * from (values (0, 0, 0, 0, 4, 0), (0, 0, 4, 0, 4, 4), (0, 0, 4, 4, 0, 0), (0, 1, 0, 0, 4, 4), (0, 1, 4, 4, 0, 4), (0, 1, 0, 4, 0, 0),
  (1, 0, 0, 0, 4, 0), (1, 0, 4, 0, 4, 4), (1, 0, 4, 4, 0, 4), (1, 0, 0, 4, 0, 0), (2, 0, 1, 1, 1, 3), (2, 0, 1, 3, 3, 2), (2, 0, 3, 2, 1, 1)) v(kind, part, a, b, a2, b2)),
sides as (select s.id, part, s.x as x1, s.y as y1, t.x as x2, t.y as y2 from plan p join spots s on s.a = p.a and s.b = p.b join spots t on t.id = s.id and t.a = p.a2 and t.b = p.b2
  where case kind when 0 then s.id % 2 = 0 when 1 then s.id % 2 = 1 else s.id % 2 = 1 and s.id % 3 = 0 end)"""


def _centres(cell: int) -> str:
    return f"""span as (select id, part, min(least(x1, x2)) // {cell} - 1 as c0, max(greatest(x1, x2)) // {cell} + 1 as c1, min(least(y1, y2)) // {cell} - 1 as r0, max(greatest(y1, y2)) // {cell} + 1 as r1 from sides group by 1, 2),
places as (select id, part, r, unnest(range(c0, c1 + 1)) as c from (select *, unnest(range(r0, r1 + 1)) as r from span)),
centres as (select id, r, c from places p join sides s using (id, part)
  where (2 * y1 > (2 * r + 1) * {cell}) <> (2 * y2 > (2 * r + 1) * {cell})
    and case when y2 > y1 then 1 else -1 end * ((x2 - x1) * ((2 * r + 1) * {cell} - 2 * y1) - ((2 * c + 1) * {cell} - 2 * x1) * (y2 - y1)) > 0
  group by id, part, r, c having count(*) % 2 = 1)"""


@query(f"with {SIDES}, {_centres(FINE)} select distinct id, r, c from centres", "boxes")
def polygon_centre_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 by cell centres: parts that share a border have disjoint cells."""
    return P.centre_cells(footprints(spark, sf_dir), FINE)


@query(
    f"""with {SIDES}, {_centres(FINE)},
clipped as (select p.id, p.r, p.c, s.*, s.x2 - s.x1 as dx, s.y2 - s.y1 as dy, p.c * {FINE} as w, (p.c + 1) * {FINE} as e, p.r * {FINE} as b, (p.r + 1) * {FINE} as t from places p join sides s using (id, part)),
bands as (select *, greatest(0, case when dx > 0 then (w - x1) / dx when dx < 0 then (e - x1) / dx else 0 end, case when dy > 0 then (b - y1) / dy when dy < 0 then (t - y1) / dy else 0 end) as enters,
  least(1, case when dx > 0 then (e - x1) / dx when dx < 0 then (w - x1) / dx else 1 end, case when dy > 0 then (t - y1) / dy when dy < 0 then (b - y1) / dy else 1 end) as leaves from clipped
  where (dx <> 0 or x1 >= w and x1 < e) and (dy <> 0 or y1 >= b and y1 < t)),
touched as (select id, r, c from bands where enters < leaves - 1e-12
  union select id, r, c from clipped where x1 >= w and x1 < e and y1 >= b and y1 < t
  union select id, r, c from bands where abs(enters - leaves) <= 1e-12 and x1 + enters * dx >= w - 1e-9 and x1 + enters * dx < e - 1e-9 and y1 + enters * dy >= b - 1e-9 and y1 + enters * dy < t - 1e-9)
select id, count(*) as cells, cast(sum(r * 7 + c * 13) as bigint) as mark from (select id, r, c from touched union select id, r, c from centres) group by id""",
    "boxes",
)
def polygon_touched_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 with every cell that a polygon has a point in."""
    found = P.touched_cells(footprints(spark, sf_dir), FINE)
    return found.groupBy("id").agg(F.count("*").alias("cells"), F.sum(F.col("r") * 7 + F.col("c") * 13).alias("mark"))


@query(
    f"""with {SIDES},
near as (select id, part, unnest(range(cast(floor((min(least(x1, x2)) - 10001) / 500000) as bigint), cast(floor((max(greatest(x1, x2)) + 10001) / 500000) as bigint) + 1)) as gx, cast(floor((min(least(y1, y2)) - 10001) / 500000) as bigint) as low, cast(floor((max(greatest(y1, y2)) + 10001) / 500000) as bigint) as high from sides group by 1, 2),
windows as (select id, part, gx * 500000 - 10000 as w, (gx + 1) * 500000 + 10000 as e, gy * 500000 - 10000 as b, (gy + 1) * 500000 + 10000 as t, gx, gy from (select *, unnest(range(low, high + 1)) as gy from near)),
tests as (select n.id, gx, gy, part,
    bool_or(least(x1, x2) <= e and greatest(x1, x2) >= w and least(y1, y2) <= t and greatest(y1, y2) >= b
      and least(f(w, b), f(e, b), f(e, t), f(w, t)) <= 0 and greatest(f(w, b), f(e, b), f(e, t), f(w, t)) >= 0) as met,
    count(*) filter ((y1 > b) <> (y2 > b) and case when y2 > y1 then f(w, b) > 0 else f(w, b) < 0 end) % 2 = 1 as inside
  from windows n join sides s using (id, part) group by all)
select distinct id, gx, gy from tests where met or inside""".replace("f(w, b)", "((x2 - x1) * (b - y1) - (y2 - y1) * (w - x1))").replace("f(e, b)", "((x2 - x1) * (b - y1) - (y2 - y1) * (e - x1))").replace("f(e, t)", "((x2 - x1) * (t - y1) - (y2 - y1) * (e - x1))").replace("f(w, t)", "((x2 - x1) * (t - y1) - (y2 - y1) * (w - x1))"),
    "boxes",
)
def polygons_by_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons that meet each tile's window with its halo."""
    return P.tiles_of(footprints(spark, sf_dir), TILE_MM, 10_000)


def tiled_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile, r, c, footprint: the footprints' cells, by the supplier number that stands for their tile."""
    found = P.centre_cells(footprints(spark, sf_dir), 2000)
    return found.select((F.col("id") % 10 + 1).cast("long").alias("tile"), F.pmod("r", F.lit(32)).cast("int").alias("r"), F.pmod("c", F.lit(32)).cast("int").alias("c"), F.col("id").alias("footprint")).distinct()


@query(
    f"""with {SIDES}, {_centres(2000)}, {LABELLED},
fp as (select distinct id % 10 + 1 as tile, cast(((r % 32) + 32) % 32 as integer) as r, cast(((c % 32) + 32) % 32 as integer) as c, id as footprint from centres),
sh as (select component, footprint, count(*) as shared from fp join labelled using (tile, r, c) group by 1, 2 having count(*) >= 4),
mt as (select sh.* from sh join (select component, count(*) as n from labelled group by 1) a using (component) join (select footprint, count(*) as n from fp group by 1) b using (footprint) where shared * 4 >= a.n and shared * 4 >= b.n)
select component, footprint, shared, count(*) over (partition by component) = 1 and count(*) over (partition by footprint) = 1 as univocal from mt""",
    "boxes cells",
)
def component_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footprints and connected high cells that share four cells and a quarter of both."""
    members = tiles.components(hag(spark, sf_dir).filter("hag >= 1000"), G.FOUR).select("tile", "r", "c", "component")
    return P.component_matches(tiled_footprints(spark, sf_dir), members)


def _walked(members: str, keys: str) -> str:
    """Rings of the members' sides (k, r, c), each followed from every side of it."""
    return f"""steps as (select * from (values (0, 0, 0, 0, 1, -1, 0), (1, 0, 1, 1, 1, 0, 1), (2, 1, 1, 1, 0, 1, 0), (3, 1, 0, 0, 0, 0, -1)) v(h, a, b, d, e, up, rt)),
sd as (select m.k, h, m.r + a as r0, m.c + b as c0, m.r + d as r1, m.c + e as c1 from {members} m, steps s where not exists (select 1 from {members} o where o.k = m.k and o.r = m.r + up and o.c = m.c + rt)),
nx as (select *, row_number() over (order by k, r0, c0, h) as n from sd),
ln as (select n, to_n, turn from (select a.n, b.n as to_n, (b.h - a.h + 4) % 4 as turn, row_number() over (partition by a.n order by case (b.h - a.h + 4) % 4 when 1 then 0 when 0 then 1 else 2 end) as o from nx a join nx b on a.k = b.k and a.r1 = b.r0 and a.c1 = b.c0) where o = 1),
wk as (with recursive w as (select n as start, n as pos, 0 as step from ln union all select w.start, l.to_n, step + 1 from w join ln l on l.n = w.pos where l.to_n > w.start) select * from w),
lp as (select w.start, max(step) + 1 as sides from wk w join (select start, arg_max(pos, step) as last from wk group by 1) e using (start) join ln on ln.n = e.last where ln.to_n = w.start group by 1),
rg as (select s.{keys.replace(", ", ", s.")}, s.r0, s.c0, lp.sides, w.step, a.r0 as y, a.c0 as x, a.r1 as y2, a.c1 as x2, ln.turn from lp join nx s on s.n = lp.start join wk w on w.start = lp.start join nx a on a.n = w.pos join ln on ln.n = a.n)"""


_RING = """cast(sum(x * y2 - x2 * y) as bigint) as area2, max(sides) as sides, string_agg(case when turn <> 0 then y2 || ' ' || x2 end, ',' order by case when step = sides - 1 then -1 else step end) as corners"""


@query(
    f"""with {LABELLED.replace("labelled as", "named as")}, lb as (select component as k, r, c from named), {_walked("lb", "k")}
select cast(split_part(k, ':', 1) as bigint) as tile, k as component, cast(r0 as bigint) as r0, cast(c0 as bigint) as c0, {_RING} from rg group by k, r0, c0""",
    "cells",
)
def component_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8: closed rings of the connected high cells, outer ones and holes, inside their tile."""
    members = tiles.components(hag(spark, sf_dir).filter("hag >= 1000"), G.FOUR)
    return _told(tiles.rings(members), "tile", "component")


def _told(rings: DataFrame, *keys: str) -> DataFrame:
    text = F.array_join(F.transform("corners", lambda p: F.concat_ws(" ", p["r"].cast("string"), p["c"].cast("string"))), ",")
    return rings.select(*keys, F.col("r0").cast("long").alias("r0"), F.col("c0").cast("long").alias("c0"), "area2", "sides", text.alias("corners"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The footprints with their category and time, moved together so that members of a group overlap and touch."""
    near = lambda p: F.struct(F.pmod(p["x"], F.lit(60_000)).alias("x"), F.pmod(p["y"], F.lit(60_000)).alias("y"))
    group = boxes(spark, sf_dir).select("id", F.col("brand").alias("category"), (F.col("id") % 5).alias("time"))
    return footprints(spark, sf_dir).withColumn("rings", F.transform("rings", lambda ring: F.transform(ring, near))).join(group, "id")


_GROUPED = f"""{SIDES.replace("sides as (", "far as (")},
sides as (select id, part, ((x1 % 60000) + 60000) % 60000 as x1, ((y1 % 60000) + 60000) % 60000 as y1, ((x2 % 60000) + 60000) % 60000 as x2, ((y2 % 60000) + 60000) % 60000 as y2 from far)"""


@query(
    f"""with {_GROUPED}, {_centres(2000)}, gr as (select distinct brand as category, b.id % 5 as time, r, c from centres join boxes b using (id)),
mb as (select category || '/' || time as k, category, time, r, c from gr), {_walked("mb", "k")}
select split_part(k, '/', 1) as category, cast(split_part(k, '/', 2) as bigint) as time, cast(r0 as bigint) as r0, cast(c0 as bigint) as c0, {_RING} from rg group by k, r0, c0""",
    "boxes",
)
def dissolved_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of each category's and time's polygons, as closed rings of the cell-set union."""
    return _told(P.dissolved(categories(spark, sf_dir), ["category", "time"], 2000), "category", "time")


@query(
    f"""with {SIDES}, n as (select category as dataset, count(distinct id) as frames, count(*) + count(*) filter (false) as sides from sides join boxes using (id) group by 1),
closing as (select category as dataset, count(*) as n from boxes where id % 2 = 1 group by 1)
select dataset, cast(sides + coalesce(n, 0) as bigint) as coordinates, frames, case when sides + coalesce(n, 0) > 500000 then 'coordinates' else '' end || case when frames > 366 then 'frames' else '' end as faults from n left join closing using (dataset)""",
    "boxes",
)
def layer_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates and frames of each dataset, and the limits they break."""
    kinds = boxes(spark, sf_dir).select("id", F.col("category").alias("dataset"))
    frames = footprints(spark, sf_dir).join(kinds, "id").select("dataset", F.col("id").alias("frame"), "rings")
    return P.layer_faults(frames).withColumn("faults", F.array_join("faults", ""))


@query(
    f"""with {SIDES}, pts as (select distinct id, x1 as x, y1 as y from sides),
hull as (select a.id, a.x, a.y, b.x - a.x as dx, b.y - a.y as dy from pts a join pts b on a.id = b.id and (a.x <> b.x or a.y <> b.y) join pts o on o.id = a.id
  group by a.id, a.x, a.y, b.x, b.y having min((b.x - a.x) * (o.y - a.y) - (b.y - a.y) * (o.x - a.x)) >= 0),
turned as (select h.id, atan2(dy, dx) as ang, max(p.x * cos(atan2(dy, dx)) + p.y * sin(atan2(dy, dx))) - min(p.x * cos(atan2(dy, dx)) + p.y * sin(atan2(dy, dx))) as w,
  max(p.y * cos(atan2(dy, dx)) - p.x * sin(atan2(dy, dx))) - min(p.y * cos(atan2(dy, dx)) - p.x * sin(atan2(dy, dx))) as d from hull h join pts p using (id) group by h.id, dx, dy),
boxed as (select id, greatest(w, d) as width, least(w, d) as depth, case when d > w then ang + pi() / 2 else ang end as ang from turned)
select id, round(min(width * depth) / 1e6, 3) as area_m2 from boxed group by id""",
    "boxes",
)
def least_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the area of the minimum-area box of each slanted footprint."""
    return P.least_boxes(footprints(spark, sf_dir)).select("id", F.round(F.col("width") * F.col("depth") / 1e6, 3).alias("area_m2"))
