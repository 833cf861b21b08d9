"""Cameras, instances, corridors and burn states."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import grids as G
from . import tiles


def projected(points: DataFrame, camera: tuple[float, float, float], forward: tuple[Column, Column, Column], right: tuple[Column, Column, Column], up: tuple[Column, Column, Column], focal: float, aperture: float, width: int, height: int) -> DataFrame:
    """points (x, y, z in metres) with depth, pixel u, v and in_frame; nothing behind the camera has a pixel."""
    d = [F.col(a) - F.lit(b) for a, b in zip("xyz", camera, strict=True)]
    dot = lambda v: d[0] * v[0] + d[1] * v[1] + d[2] * v[2]
    depth = dot(forward)
    scale = 2 * focal / aperture
    nx, ny = dot(right) / depth * scale, dot(up) / depth * scale * width / height
    front = depth > 1e-6
    found = points.withColumn("depth", depth).withColumn("u", F.when(front, (nx + 1) / 2 * width)).withColumn("v", F.when(front, (1 - ny) / 2 * height))
    return found.withColumn("in_frame", F.coalesce(F.col("u").between(0, width) & F.col("v").between(0, height), F.lit(False)))


def snorm16(gx: Column, gy: Column, run: int = 4000) -> tuple[Column, Column, Column]:
    """The unit normal (-gx, -gy, run) in steps of 1/32767, rounded half away from zero; within one step of integer arithmetic."""
    length = F.sqrt((gx * gx + gy * gy + run * run).cast("double"))
    step = lambda v: F.when(v >= 0, F.floor(v * 32767 / length + 0.5)).otherwise(F.ceil(v * 32767 / length - 0.5)).cast("int")
    return step(-gx), step(-gy), step(F.lit(run))


def merged_pairs(boxes: DataFrame, group: list[str], order: str, same: Column) -> DataFrame:
    """boxes with pair: greedy from the left, a row and the next merge where same (over both, the next's columns in struct nxt) holds.

    Runs of rows that could merge with their next fall into twos by their parity in the run.
    """
    w = Window.partitionBy(*group).orderBy(order)
    flagged = boxes.withColumn("nxt", F.lead(F.struct(*boxes.columns)).over(w)).withColumn("_joins", F.coalesce(same, F.lit(False)))
    start = F.when(~F.coalesce(F.lag("_joins").over(w), F.lit(False)), 1).otherwise(0)
    runs = flagged.withColumn("_run", F.sum(start).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.row_number().over(Window.partitionBy(*group, "_run").orderBy(order)) - 1
    return runs.withColumn("pair", F.concat_ws(":", F.col("_run").cast("string"), F.floor(place / 2).cast("string"))).drop("nxt", "_joins", "_run")


def burn_states(arrival: DataFrame, moments: DataFrame, cell_m: int) -> DataFrame:
    """Per tile and moment (state, t): burned area, and length of the front.

    A side of a cell is on the front from the cell's arrival until its neighbour's; neighbours are found in one pass over the
    tiles, so neither cells nor states are multiplied by sides.
    """
    sides = {f"_u{k}": step for k, step in enumerate(G.FOUR)}
    burned = tiles.around(arrival.select("tile", "r", "c", "arrival"), "arrival", sides).join(F.broadcast(moments), F.col("arrival") <= F.col("t"))
    front = sum((F.col(u).isNull() | (F.col(u) > F.col("t"))).cast("int") for u in sides)
    return burned.groupBy("tile", "state").agg((F.count("*") * cell_m * cell_m).alias("area_m2"), (F.sum(front) * cell_m).alias("front_m"))


def offset_points(vertices: DataFrame, offset: Column, limit: float = 2.0) -> DataFrame:
    """Each vertex moved sideways: by its segment's normal at the ends, by the mean normal inside, the mitre held to limit offsets; by
    the following segment's normal where the line turns straight back."""
    w = Window.partitionBy("line").orderBy("seq")
    rows = vertices.withColumns({"px": F.lag("x").over(w), "py": F.lag("y").over(w), "qx": F.lead("x").over(w), "qy": F.lead("y").over(w)})
    unit = lambda dx, dy: F.struct((-dy / F.nullif(F.sqrt(dx * dx + dy * dy), F.lit(0.0))).alias("x"), (dx / F.nullif(F.sqrt(dx * dx + dy * dy), F.lit(0.0))).alias("y"))
    rows = rows.withColumn("_a", unit(F.col("x") - F.col("px"), F.col("y") - F.col("py"))).withColumn("_b", unit(F.col("qx") - F.col("x"), F.col("qy") - F.col("y")))
    mx, my = F.coalesce("_a.x", "_b.x") + F.coalesce("_b.x", "_a.x"), F.coalesce("_a.y", "_b.y") + F.coalesce("_b.y", "_a.y")
    turns = mx * mx + my * my > 1e-6
    n = F.when(turns, F.sqrt(mx * mx + my * my))
    rows = rows.withColumn("_mx", F.when(turns, mx / n).otherwise(F.coalesce("_b.x", "_a.x"))).withColumn("_my", F.when(turns, my / n).otherwise(F.coalesce("_b.y", "_a.y")))
    dot = F.col("_mx") * F.coalesce("_b.x", "_a.x") + F.col("_my") * F.coalesce("_b.y", "_a.y")
    reach = F.least(F.abs(offset) * limit, F.abs(offset) / F.greatest(F.abs(dot), F.lit(1e-9))) * F.signum(offset)
    return rows.select("line", "seq", (F.col("x") + F.col("_mx") * reach).alias("ox"), (F.col("y") + F.col("_my") * reach).alias("oy"))


def peaks(cells: DataFrame, component: str, lattice: int, split_at: int) -> DataFrame:
    """One peak per plateau, the least (c, r); plateaus of split_at cells or more have their cells on the global lattice instead."""
    sized = cells.withColumn("_n", F.count("*").over(Window.partitionBy(component))).withColumn("_first", F.min(F.struct("c", "r")).over(Window.partitionBy(component)))
    small = (F.col("_n") < split_at) & (F.struct("c", "r") == F.col("_first"))
    return sized.filter(small | ((F.col("_n") >= split_at) & (F.col("c") % lattice == 0) & (F.col("r") % lattice == 0))).drop("_n", "_first")


#: Candidates that a round of diverse_picks brings to the driver at most.
ROUND = 2_000


def diverse_picks(candidates: DataFrame, wanted: int, spacing: int) -> DataFrame:
    """Greedy by score: the best candidate (id, x, y, score), then the best at least spacing away from all picked, up to wanted.

    Order-dependent by definition: each round brings the ROUND best of those left to the driver, which picks among
    them; only where they don't suffice does another round scan what is below them and away from the picks.
    """
    left, picked = candidates.select("id", "x", "y", "score"), []
    far = lambda a, b: (a["x"] - b["x"]) ** 2 + (a["y"] - b["y"]) ** 2 >= spacing * spacing
    while len(picked) < wanted:
        found = left.orderBy(F.desc("score"), "id").limit(ROUND).collect()
        for row in found:
            if len(picked) < wanted and all(far(row, p) for p in picked):
                picked.append(row)
        if len(found) < ROUND:
            break
        away = [(F.col("x") - p["x"]) * (F.col("x") - p["x"]) + (F.col("y") - p["y"]) * (F.col("y") - p["y"]) >= spacing * spacing for p in picked]
        left = candidates.select("id", "x", "y", "score").filter((F.col("score") < found[-1]["score"]) | ((F.col("score") == found[-1]["score"]) & (F.col("id") > found[-1]["id"])))
        for near in away:
            left = left.filter(near)
    ids = [(k, r["id"]) for k, r in enumerate(picked, 1)]
    return candidates.join(F.broadcast(candidates.sparkSession.createDataFrame(ids, "place int, id long")), "id")


def local_origin(features: DataFrame) -> DataFrame:
    """(ox, oy, oz) of features (xmin, ymin, xmax, ymax, zmin): the metre nearest to the middle of their bounds, half away from zero, and the
    floor of their least height; one row."""
    bound = features.agg(F.min("xmin").alias("a"), F.max("xmax").alias("b"), F.min("ymin").alias("c"), F.max("ymax").alias("d"), F.min("zmin").alias("z"))
    middle = lambda lo, hi: F.round((F.col(lo) + F.col(hi)) / 2).cast("long")  # noqa: E731  rounds half away from zero
    return bound.select(middle("a", "b").alias("ox"), middle("c", "d").alias("oy"), F.floor("z").alias("oz"))


def viewer_axes(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """East, north and up of a model whose axes are (x, y up, z to the viewer)."""
    return x, -z, y


def instances(candidates: DataFrame, prototypes: DataFrame) -> DataFrame:
    """(id, family, asset, sx, sy, sz, px, py, pz, qw, qx, qy, qz) of placed assets.

    candidates: id, family, asset, x, y, ground_mm, height_cm, width, depth, yaw (metres, radians; of buildings and context), seed
    (whole, decimal where 64 bits don't hold it; of trees), ox, oy (the tile's origin); prototypes: asset, ex, ey, ez (extents, y up).  Buildings are scaled to their measures on
    each axis, trees by their height alone and turned by their seed, context assets keep their size.  The
    quaternion first stands the prototype's y axis up, then turns it by the yaw.  An asset without a prototype, a family that
    is none of the three or a scale that is not above zero fails the plan.
    """
    made = candidates.join(prototypes, "asset", "left")
    tall = F.col("height_cm") / 100.0
    tree, building, context = (F.col("family") == f for f in ("trees", "buildings", "context_assets"))
    scale = lambda measure, extent: F.when(building, measure / F.col(extent)).when(tree, tall / F.col("ey")).when(context, F.lit(1.0))
    turn = F.when(tree, F.col("seed").cast("double") / float(1 << 64) * (2 * math.pi)).otherwise(F.coalesce("yaw", F.when(context, 0.0)))
    placed = made.withColumns({"sx": scale(F.col("width"), "ex"), "sy": scale(tall, "ey"), "sz": scale(F.col("depth"), "ez"), "turn": turn})
    fault = F.when(F.col("ex").isNull(), "no prototype").when(~F.coalesce(tree | building | context, F.lit(False)), "unknown family").when(~F.coalesce((F.col("sx") > 0) & (F.col("sy") > 0) & (F.col("sz") > 0), F.lit(False)) | F.col("turn").isNull(), "invalid scale or yaw")
    checked = F.when(fault.isNotNull(), F.raise_error(F.concat(F.lit("candidate "), F.col("id").cast("string"), F.lit(": "), fault))).otherwise(F.col("turn"))
    cos, sin = F.cos(F.col("turn") / 2) * math.sqrt(0.5), F.sin(F.col("turn") / 2) * math.sqrt(0.5)
    return placed.withColumn("turn", checked).select(
        "id", "family", "asset", "sx", "sy", "sz", (F.col("x") - F.col("ox")).alias("px"), (F.col("y") - F.col("oy")).alias("py"), (F.col("ground_mm") / 1000.0).alias("pz"), cos.alias("qw"), cos.alias("qx"), sin.alias("qy"), sin.alias("qz")
    )
