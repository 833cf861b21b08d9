"""Lines of sight over terrain, trees and boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sight
from .registry import query
from .views import boxes, cells, points

#: Metres between terrain nodes: 32 to a tile of 500 m.
STEP = 15.625


def scene(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rays from each point to the middle of the third tile on, the points as trees, the boxes, and the cells as terrain nodes."""
    k, at = F.col("id"), lambda c: (F.col(c) / 1000.0).alias(c[0])
    rays = points(spark, sf_dir).select(
        "id", at("x_mm"), at("y_mm"), (F.col("height_cm") % 60 + 5.0).alias("z"), (F.expr("x_mm div 500000 + 3") * 500.0 + 250).alias("tx"), F.lit(250.0).alias("ty"), (k % 20 + 2.0).alias("tz"), (k % 50).alias("ignored")
    )
    trees = points(spark, sf_dir).select(F.col("id").alias("tree"), at("x_mm"), at("y_mm"), (k % 3 + 0.5).alias("radius"), (k % 2 * 1.0).alias("base"), (F.col("height_cm") / 1000.0).alias("top"))
    w, d = (F.col("x1") - F.col("x0")) / 1000.0, (F.col("y1") - F.col("y0")) / 1000.0
    houses = boxes(spark, sf_dir).select(F.col("id").alias("box"), ((F.col("x0") + F.col("x1")) / 2000.0).alias("x"), ((F.col("y0") + F.col("y1")) / 2000.0).alias("y"), (F.sqrt(w * w + d * d) / 2).alias("half"), F.lit(0.0).alias("low"), (k % 9 + 2.0).alias("high"))
    ground = cells(spark, sf_dir).select(F.col("r").cast("long").alias("r"), ((F.col("tile") - 1) * 32 + F.col("c")).alias("c"), ((F.col("mnt_mm") - 100_000) / 1000.0).alias("ground"))
    return rays, trees, houses, ground


@query(
    """with rays as (select id, x_mm / 1000.0 as x, y_mm / 1000.0 as y, height_cm % 60 + 5.0 as z, (x_mm // 500000 + 3) * 500.0 + 250 as tx, 250.0 as ty, id % 20 + 2.0 as tz, id % 50 as ignored from points),
r as (select *, sqrt(cast((tx - x) * (tx - x) + (ty - y) * (ty - y) as double)) as d from (select id, cast(x as double) as x, cast(y as double) as y, cast(z as double) as z, cast(tx as double) as tx, cast(ty as double) as ty, cast(tz as double) as tz, ignored from rays)),
trees as (select cast(x_mm / 1000.0 as double) as px, cast(y_mm / 1000.0 as double) as py, id % 3 + 0.5 as side, id % 2 as low, height_cm / 1000.0 as high from points),
houses as (select id as box, cast((x0 + x1) / 2000.0 as double) as px, cast((y0 + y1) / 2000.0 as double) as py, sqrt(((x1 - x0) / 1000.0) ** 2 + ((y1 - y0) / 1000.0) ** 2) / 2 as side, 0 as low, id % 9 + 2 as high from boxes),
t as (select id, min(along) as along from (select *, z + (tz - z) * least(greatest(along / d, 0), 1) as h from (select r.*, o.*, (px - x) * ((tx - x) / d) + (py - y) * ((ty - y) / d) as along, abs((px - x) * ((ty - y) / d) - (py - y) * ((tx - x) / d)) as beside from r join trees o on abs(o.px - r.x) <= 180 and abs(o.py - r.y) <= 180))
  where along > 3 and along < 180 and (px - x) ** 2 + (py - y) ** 2 <= 32400 and beside < side + 1.5 and h < high + 1 and h > low - 1 group by 1),
b as (select id, min(along) as along from (select *, z + (tz - z) * least(greatest(along / d, 0), 1) as h from (select r.*, o.*, (px - x) * ((tx - x) / d) + (py - y) * ((ty - y) / d) as along, abs((px - x) * ((ty - y) / d) - (py - y) * ((tx - x) / d)) as beside from r join houses o on o.px between r.x - 50 and r.tx + 50))
  where along > 2 and along < d and beside < side + 1 and h >= low - 1 and h <= high + 1 and box <> ignored group by 1),
s as (select *, case when k = n - 1 then 0.95::double else 0.05::double + k * (0.9::double / (n - 1)) end as f from (select *, unnest(range(n)) as k from (select *, greatest(16, least(96, cast(floor(d / 40) as integer))) as n from r))),
p as (select id, k, (x + (tx - x) * f) / 15.625::double as u, (y + (ty - y) * f) / 15.625::double as v, z + (tz - z) * f as h from s),
q as (select id, k, h, cast(floor(v) as bigint) + a as gr, cast(floor(u) as bigint) + b as gc, (case when a = 1 then v - floor(v) else 1 - (v - floor(v)) end) * (case when b = 1 then u - floor(u) else 1 - (u - floor(u)) end) as w from p, (values (0), (1)) i(a), (values (0), (1)) j(b)),
g as (select id, k, any_value(h) as h, sum(w * ground) as total, sum(case when ground is not null then w end) as weights from q left join (select r as gr, (tile - 1) * 32 + c as gc, cast((mnt_mm - 100000) / 1000.0 as double) as ground from cells) using (gr, gc) group by 1, 2),
c as (select id, case when count(*) = count(case when weights > 0 then 1 end) then min(h - total / weights) end as clearance from g group by 1)
select r.id, coalesce(t.along is null and b.along is null and d > 0 and clearance >= 1, false) as seen, round(case when t.along is not null or b.along is not null then 0 else clearance end, 6) as clearance,
  round(coalesce(t.along, b.along, least(d, 180)), 6) as foreground from r left join t using (id) left join b using (id) left join c using (id)""",
    "points boxes cells",
)
def lines_of_sight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rays against trees of the foreground, boxes on the way, and the terrain under their samples."""
    found = sight.clear_views(*scene(spark, sf_dir), STEP)
    return found.select("id", "seen", F.round("clearance", 6).alias("clearance"), F.round("foreground", 6).alias("foreground"))
