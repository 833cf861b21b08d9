"""Lines of sight: rays walked through a grid, so that obstacles and terrain meet them in equi-joins.

A ray (id, x, y, z, tx, ty, tz) goes from a camera to a target, in metres.  It is seen unless a tree stands in its foreground, a box
anywhere on it, or the ground comes within a metre of it; the first of these that holds decides, as in clear_views.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import dealt

#: Where a tree or a box can stand along a ray, what is added to its half-width and its height, samples of the terrain
#: (their number at least, at most, and metres a sample; the shares of the ray between which they lie), and the least clearance.
TREE_FROM, FOREGROUND, TREE_SIDE, BOX_FROM, BOX_SIDE, RISE = 3.0, 180.0, 1.5, 2.0, 1.0, 1.0
LEAST, MOST, EVERY, FIRST, LAST, CLEARANCE = 16, 96, 40.0, 0.05, 0.95, 1.0


def _distance() -> Column:
    dx, dy = F.col("tx") - F.col("x"), F.col("ty") - F.col("y")
    return F.sqrt(dx * dx + dy * dy)


def _directed(rays: DataFrame) -> DataFrame:
    """rays with d, their length, and ux, uy, their direction: computed once a ray, not again in each test of a pair."""
    if "ux" in rays.columns:
        return rays
    return rays.withColumn("d", _distance()).withColumns({"ux": (F.col("tx") - F.col("x")) / F.nullif("d", F.lit(0.0)), "uy": (F.col("ty") - F.col("y")) / F.nullif("d", F.lit(0.0))})


def ray_cells(rays: DataFrame, size: float, margin: float) -> DataFrame:
    """rays with gx, gy: every grid cell that holds a point within the margin of the ray.

    Column by column: the part of the ray that comes within the margin of the column gives the rows.
    """
    ends = rays.withColumns({"_low": F.least("x", "tx"), "_high": F.greatest("x", "tx"), "_slope": (F.col("ty") - F.col("y")) / F.nullif(F.col("tx") - F.col("x"), F.lit(0.0))})
    cut = ends.withColumn("gx", F.explode(F.sequence(F.floor((F.col("_low") - margin) / size), F.floor((F.col("_high") + margin) / size))))
    edge = lambda at: F.least(F.greatest(F.col("_low"), at), F.col("_high"))
    cut = cut.withColumns({"_a": edge(F.col("gx") * size - margin), "_b": edge((F.col("gx") + 1) * size + margin)})
    y = lambda at: F.col("y") + (F.col(at) - F.col("x")) * F.col("_slope")
    cut = cut.withColumns({"_ya": F.coalesce(y("_a"), "y"), "_yb": F.coalesce(y("_b"), "ty")})
    slack = margin + size * 1e-6  # for the rounding of the slope
    rows = F.sequence(F.floor((F.least("_ya", "_yb") - slack) / size), F.floor((F.greatest("_ya", "_yb") + slack) / size))
    return cut.withColumn("gy", F.explode(rows)).select(*rays.columns, "gx", "gy")


def _walked(near: DataFrame, things: DataFrame, size: float) -> DataFrame:
    """Rays by grid cell (gx, gy) with the things (at px, py) there, and how far along and beside the ray each is."""
    keyed = things.withColumns({"gx": F.floor(F.col("px") / size), "gy": F.floor(F.col("py") / size)})
    met = near.filter("d > 0").join(keyed, ["gx", "gy"])
    ux, uy, ox, oy = F.col("ux"), F.col("uy"), F.col("px") - F.col("x"), F.col("py") - F.col("y")
    found = met.withColumns({"along": ox * ux + oy * uy, "lateral": F.abs(ox * uy - oy * ux), "away2": ox * ox + oy * oy})
    share = F.least(F.greatest(F.col("along") / F.col("d"), F.lit(0.0)), F.lit(1.0))
    return found.withColumn("ray_z", F.col("z") + (F.col("tz") - F.col("z")) * share)


def _widest(things: DataFrame, column: str) -> float:
    return things.agg(F.max(column)).first()[0] or 0.0


def tree_blocks(rays: DataFrame, trees: DataFrame, size: float = 32.0) -> DataFrame:
    """(id, along): the nearest tree (tree, x, y, radius, base, top) that hides the target in a ray's foreground."""
    rays = _directed(rays)
    part = F.lit(FOREGROUND) / F.greatest(_distance(), F.lit(1e-9))  # the foreground may reach beyond a near target
    short = rays.withColumns({"fx": F.col("tx"), "fy": F.col("ty")}).withColumns({"tx": F.col("x") + (F.col("tx") - F.col("x")) * part, "ty": F.col("y") + (F.col("ty") - F.col("y")) * part})
    near = ray_cells(short, size, _widest(trees, "radius") + TREE_SIDE).drop("tx", "ty").withColumnsRenamed({"fx": "tx", "fy": "ty"})
    keyed = trees.select(F.col("x").alias("px"), F.col("y").alias("py"), "radius", "base", "top")
    met = _walked(near, keyed, size)
    blocked = (F.col("along") > TREE_FROM) & (F.col("along") < FOREGROUND) & (F.col("away2") <= FOREGROUND**2) & (F.col("lateral") < F.col("radius") + TREE_SIDE)
    return met.filter(blocked & (F.col("ray_z") < F.col("top") + RISE) & (F.col("ray_z") > F.col("base") - RISE)).groupBy("id").agg(F.min("along").alias("along"))


def box_blocks(rays: DataFrame, boxes: DataFrame, size: float = 64.0) -> DataFrame:
    """(id, along): the nearest box (box, x, y, half, low, high) on a ray, but for the one that the ray ignores (column ignored)."""
    near = ray_cells(_directed(rays), size, _widest(boxes, "half") + BOX_SIDE)
    met = _walked(near, boxes.select("box", F.col("x").alias("px"), F.col("y").alias("py"), "half", "low", "high"), size)
    blocked = (F.col("along") > BOX_FROM) & (F.col("along") < F.col("d")) & (F.col("lateral") < F.col("half") + BOX_SIDE) & (F.col("ray_z") >= F.col("low") - RISE) & (F.col("ray_z") <= F.col("high") + RISE)
    return met.filter(blocked & ~F.col("box").eqNullSafe(F.col("ignored"))).groupBy("id").agg(F.min("along").alias("along"))


def terrain_clearance(rays: DataFrame, terrain: DataFrame, step: float) -> DataFrame:
    """(id, clearance): the least height of a ray over the ground at its samples; terrain: r, c, ground at (c, r) * step.

    The ground is the weighted mean of the up to four nodes around a sample; a sample without any makes the clearance null.  Nodes
    are gathered by fours first (of nodes at one place the highest counts), so that a sample meets one row.
    """
    n = F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.floor(_distance() / EVERY).cast("int")))
    samples = rays.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    share = F.when(F.col("k") == F.col("n") - 1, LAST).otherwise(F.lit(FIRST) + F.col("k") * ((LAST - FIRST) / (F.col("n") - 1)))
    on = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * F.col("share")
    at = samples.withColumn("share", share).select("id", "k", (on("x", "tx") / step).alias("u"), (on("y", "ty") / step).alias("v"), on("z", "tz").alias("ray_z"))
    at = at.withColumns({"c": F.floor("u"), "r": F.floor("v")}).withColumns({"fu": F.col("u") - F.col("c"), "fv": F.col("v") - F.col("r")})
    back = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)))
    west, east = rays.agg(F.min(F.least("x", "tx")), F.max(F.greatest("x", "tx"))).first()
    inside = F.col("c").between(math.floor((west or 0) / step) - 1, math.floor((east or 0) / step) + 2)  # no sample has other nodes around it
    near = terrain.filter(F.col("ground").isNotNull() & inside).select(F.explode(back).alias("q"), (F.col("r").cast("long") - F.col("q.a")).alias("r"), (F.col("c").cast("long") - F.col("q.b")).alias("c"), "ground")
    corner = lambda a, b: F.max(F.when((F.col("q.a") == a) & (F.col("q.b") == b), F.col("ground"))).alias(f"g{a}{b}")
    met = at.join(near.groupBy("r", "c").agg(*(corner(a, b) for a in (0, 1) for b in (0, 1))), ["r", "c"], "left")
    weight = lambda a, b: (F.col("fv") if a else 1 - F.col("fv")) * (F.col("fu") if b else 1 - F.col("fu"))
    known = lambda f: sum((F.when(F.col(f"g{a}{b}").isNotNull(), f(a, b)).otherwise(0.0) for a in (0, 1) for b in (0, 1)), F.lit(0.0))
    weighted, weights = known(lambda a, b: weight(a, b) * F.col(f"g{a}{b}")), known(weight)
    over = F.when(weights > 0, F.col("ray_z") - weighted / weights)
    return met.groupBy("id").agg(F.when(F.count(over) == F.count("*"), F.min(over)).alias("clearance"))


#: Rows that a ray is reckoned to make: grid cells on its way, and samples.
CELLS_OF = 128


def clear_views(rays: DataFrame, trees: DataFrame, boxes: DataFrame, terrain: DataFrame, step: float) -> DataFrame:
    """(id, seen, clearance, foreground): whether the target is seen, the ray's clearance over the ground (0 where something stands in
    it), and the free distance before the camera.  A ray without length, or over unknown ground, is not seen."""
    rays = dealt(_directed(rays), CELLS_OF)
    tree, box = tree_blocks(rays, trees).select("id", F.col("along").alias("tree")), box_blocks(rays, boxes).select("id", F.col("along").alias("box"))
    found = rays.select("id", "d").join(tree, "id", "left").join(box, "id", "left").join(terrain_clearance(rays, terrain, step), "id", "left")
    stood = F.coalesce("tree", "box")
    seen = stood.isNull() & (F.col("d") > 0) & (F.col("clearance") >= CLEARANCE)
    return found.select("id", F.coalesce(seen, F.lit(False)).alias("seen"), F.when(stood.isNotNull(), 0.0).otherwise(F.col("clearance")).alias("clearance"), F.coalesce(stood, F.least("d", F.lit(FOREGROUND))).alias("foreground"))
