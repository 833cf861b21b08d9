"""Joins by place: a grid key turns ranges and distances into equi-joins with an exact test behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import dealt


def grid_keys(lo: Column, hi: Column, size: int) -> Column:
    """Every grid step that [lo, hi] touches."""
    return F.sequence(F.floor(lo / size), F.floor(hi / size))


def boxes_to_tiles(boxes: DataFrame, size: int, halo: int = 0) -> DataFrame:
    """Each box with every tile whose window, halo included, it meets: gx, gy."""
    return boxes.withColumn("gx", F.explode(grid_keys(F.col("x0") - halo, F.col("x1") + halo, size))).withColumn("gy", F.explode(grid_keys(F.col("y0") - halo, F.col("y1") + halo, size)))


def points_in_boxes(points: DataFrame, boxes: DataFrame, size: int) -> DataFrame:
    """Pairs (id of the point, box) with the point in the half-open box."""
    keyed = boxes_to_tiles(boxes.withColumnRenamed("id", "box"), size)
    at = points.withColumn("gx", F.floor(F.col("x_mm") / size)).withColumn("gy", F.floor(F.col("y_mm") / size))
    inside = (F.col("x_mm") >= F.col("x0")) & (F.col("x_mm") < F.col("x1")) & (F.col("y_mm") >= F.col("y0")) & (F.col("y_mm") < F.col("y1"))
    return at.join(keyed, ["gx", "gy"]).filter(inside).select("id", "box")


def overlapping_boxes(boxes: DataFrame, size: int) -> DataFrame:
    """Pairs a < b of overlapping boxes and the overlap's area; a pair counts in its lowest common grid step only."""
    keyed = boxes_to_tiles(boxes, size)
    left = keyed.select("gx", "gy", *(F.col(c).alias(f"a_{c}") for c in ("id", "x0", "y0", "x1", "y1")))
    right = keyed.select("gx", "gy", *(F.col(c).alias(f"b_{c}") for c in ("id", "x0", "y0", "x1", "y1")))
    x0, y0 = F.greatest("a_x0", "b_x0"), F.greatest("a_y0", "b_y0")
    w, h = F.least("a_x1", "b_x1") - x0, F.least("a_y1", "b_y1") - y0
    met = left.join(right, ["gx", "gy"]).filter((F.col("a_id") < F.col("b_id")) & (w > 0) & (h > 0) & (F.floor(x0 / size) == F.col("gx")) & (F.floor(y0 / size) == F.col("gy")))
    return met.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), (w * h).alias("area"))


def pairs_within(queries: DataFrame, targets: DataFrame, reach: int) -> DataFrame:
    """(id, x_mm, y_mm and what else queries have, target, d2): each query with its targets within reach, in tasks of a bounded number
    of grid steps.

    Grid steps are as wide as the reach, so three by three of them hold every answer.
    """
    around = F.sequence(F.lit(-1), F.lit(1))
    step = lambda c, d: F.floor(F.col(c) / reach) + d
    asked = dealt(queries, 27).withColumn("gx", F.explode(F.transform(around, lambda d: step("x_mm", d)))).withColumn("gy", F.explode(F.transform(around, lambda d: step("y_mm", d))))
    there = targets.select(F.col("id").alias("target"), F.col("x_mm").alias("tx"), F.col("y_mm").alias("ty"), *(F.col(c).alias(f"target_{c}") for c in targets.columns if c not in ("id", "x_mm", "y_mm")), step("x_mm", 0).alias("gx"), step("y_mm", 0).alias("gy"))
    d2 = (F.col("x_mm") - F.col("tx")) * (F.col("x_mm") - F.col("tx")) + (F.col("y_mm") - F.col("ty")) * (F.col("y_mm") - F.col("ty"))
    met = asked.join(there, ["gx", "gy"]).withColumn("d2", d2).filter((F.col("d2") <= reach * reach) & (F.col("id") != F.col("target")))
    return met.drop("gx", "gy", "tx", "ty")


def nearest_within(queries: DataFrame, targets: DataFrame, reach: int, k: int) -> DataFrame:
    """For each query (id, x_mm, y_mm) its k nearest targets within reach: id, target, d2, place; ties to the smaller target."""
    met = pairs_within(queries.select("id", "x_mm", "y_mm"), targets.select("id", "x_mm", "y_mm"), reach)
    place = F.row_number().over(Window.partitionBy("id").orderBy("d2", "target"))
    return met.withColumn("place", place).filter(F.col("place") <= k).select("id", "target", "d2", "place")


def bilinear(samples: DataFrame, cells: DataFrame, value: str, scale: int) -> DataFrame:
    """Weighted mean of the up to four cells around each sample (tile, id, u, v in 1/scale cells); missing cells drop out.

    Integer weights: the result is sum(weight * value) and sum(weight).
    """
    r, c = F.expr(f"v div {scale}"), F.expr(f"u div {scale}")
    fr, fc = F.col("v") % scale, F.col("u") % scale
    corner = lambda a, b: F.struct((r + a).alias("r"), (c + b).alias("c"), ((fr if a else scale - fr) * (fc if b else scale - fc)).alias("w"))
    spread = samples.withColumn("k", F.explode(F.array(corner(0, 0), corner(0, 1), corner(1, 0), corner(1, 1)))).select("tile", "id", "k.r", "k.c", "k.w").filter("w > 0")
    return spread.join(cells.select("tile", "r", "c", value), ["tile", "r", "c"]).groupBy("tile", "id").agg(F.sum(F.col("w") * F.col(value)).alias("weighted"), F.sum("w").alias("weights"))


def crossing_segments(a: DataFrame, b: DataFrame, size: int) -> DataFrame:
    """Pairs of segments (line, seq, x, y, x2, y2) of a and b that properly cross: line, seq, other, other_seq."""
    def keyed(df: DataFrame, p: str) -> DataFrame:
        lo, hi = (lambda u, v: F.least(u, v)), (lambda u, v: F.greatest(u, v))
        out = df.withColumn("gx", F.explode(grid_keys(lo("x", "x2"), hi("x", "x2"), size))).withColumn("gy", F.explode(grid_keys(lo("y", "y2"), hi("y", "y2"), size)))
        return out.select("gx", "gy", *(F.col(k).alias(p + k) for k in ("line", "seq", "x", "y", "x2", "y2")))

    side = lambda ox, oy, px, py, qx, qy: (F.col(px) - F.col(ox)) * (F.col(qy) - F.col(oy)) - (F.col(py) - F.col(oy)) * (F.col(qx) - F.col(ox))
    s1, s2 = side("ax", "ay", "ax2", "ay2", "bx", "by"), side("ax", "ay", "ax2", "ay2", "bx2", "by2")
    s3, s4 = side("bx", "by", "bx2", "by2", "ax", "ay"), side("bx", "by", "bx2", "by2", "ax2", "ay2")
    opposite = lambda p, q: ((p > 0) & (q < 0)) | ((p < 0) & (q > 0))
    met = keyed(a, "a").join(keyed(b, "b"), ["gx", "gy"]).filter(opposite(s1, s2) & opposite(s3, s4))
    return met.select(F.col("aline").alias("line"), F.col("aseq").alias("seq"), F.col("bline").alias("other"), F.col("bseq").alias("other_seq")).distinct()


def square_plan(requests: DataFrame, tile: int) -> DataFrame:
    """Tiles (zone, x, y) of each request's square (zone, cx, cy, side), snapped outwards to the grid; rows north to south."""
    west, south = F.floor((F.col("cx") - F.col("side") / 2) / tile), F.floor((F.col("cy") - F.col("side") / 2) / tile)
    east, north = F.ceil((F.col("cx") + F.col("side") / 2) / tile), F.ceil((F.col("cy") + F.col("side") / 2) / tile)
    rows = requests.select("zone", F.explode(F.sequence(north - 1, south, F.lit(-1).cast("long"))).alias("gy"), west.alias("w"), east.alias("e"))
    return rows.select("zone", F.explode(F.sequence(F.col("w"), F.col("e") - 1)).alias("gx"), "gy").select("zone", (F.col("gx") * tile).alias("x"), (F.col("gy") * tile).alias("y"))
