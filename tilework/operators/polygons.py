"""Polygons against grids: rasterising in two modes, joins with tiles and cell components, dissolving, minimum boxes.

A polygon is (id, part, rings): rings are arrays of (x, y) in whole units, the outer one and its holes in any order and sense, closed or
not.  Its edges are rows, so a polygon of any size is spread; all tests are in whole numbers, so borders that two polygons
share fall to exactly one of them.  Rows without rings, and rings of fewer than three points, have no cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..checkpoints import dealt, written
from . import graphs, spatial


#: Rows that a polygon is reckoned to make where it is cut into sides, rows and cells.
CELLS_OF = 256


def ring_edges(ring: Column) -> Column:
    """(x1, y1, x2, y2) of each side of a ring; a side without length is none."""
    sides = F.transform(ring, lambda p, k: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), ring[(k + 1) % F.size(ring)]["x"].alias("x2"), ring[(k + 1) % F.size(ring)]["y"].alias("y2")))
    return F.when(F.size(ring) >= 3, F.filter(sides, lambda s: (s["x1"] != s["x2"]) | (s["y1"] != s["y2"]))).otherwise(F.filter(sides, lambda _: F.lit(False)))


def edges(polygons: DataFrame) -> DataFrame:
    """One row a side: id, part, x1, y1, x2, y2."""
    one = F.explode(F.flatten(F.transform("rings", ring_edges)))
    return dealt(polygons.select("id", "part", "rings"), CELLS_OF, "id").select("id", "part", one.alias("e")).select("id", "part", "e.*")


def _floor_div(a: Column, b: Column) -> Column:
    """Of whole numbers, b above 0."""
    return F.call_function("div", a - F.pmod(a, b), b)


def _ceil_div(a: Column, b: Column) -> Column:
    return -_floor_div(-a, b)


def _upright(sides: DataFrame) -> DataFrame:
    """Sides with y1 <= y2."""
    up = F.col("y1") <= F.col("y2")
    pick = lambda a, b: F.when(up, F.col(a)).otherwise(F.col(b))
    return sides.select("id", "part", pick("x1", "x2").alias("x1"), pick("y1", "y2").alias("y1"), pick("x2", "x1").alias("x2"), pick("y2", "y1").alias("y2"))


def centre_cells(polygons: DataFrame, cell: int) -> DataFrame:
    """(id, r, c) of the cells whose centre a polygon holds: r = floor(y / cell), c = floor(x / cell).

    A side counts in the grid rows whose centre line it crosses, half-open at its upper end; the crossings of a row, in order, pair
    into spans, half-open at their right end.  Parts of an id that overlap count once.
    """
    s = _upright(edges(polygons)).filter("y1 < y2")
    row = lambda y: _ceil_div(2 * F.col(y) - cell, F.lit(2 * cell))  # noqa: E731  the first whose centre line is not below y
    rows = s.withColumns({"lo": row("y1"), "hi": row("y2")}).filter("lo < hi").withColumn("r", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)))
    by = F.col("y2") - F.col("y1")
    across = 2 * by * F.col("x1") + ((2 * F.col("r") + 1) * cell - 2 * F.col("y1")) * (F.col("x2") - F.col("x1"))  # 2 * by * x of the crossing
    first = _ceil_div(across - cell * by, 2 * cell * by)  # the first cell whose centre is not left of it
    at = rows.select("id", "part", "r", first.alias("k"))
    order = Window.partitionBy("id", "part", "r").orderBy("k")
    spans = at.withColumn("n", F.row_number().over(order)).withColumn("next", F.lead("k").over(order)).filter("n % 2 = 1 and next > k")
    return spans.select("id", "r", F.explode(F.sequence(F.col("k"), F.col("next") - 1)).alias("c")).distinct()


def edge_cells(polygons: DataFrame, cell: int) -> DataFrame:
    """(id, r, c) of the half-open cells that a side has a point in."""
    s = _upright(edges(polygons))
    size = F.lit(cell)
    rows = s.withColumn("r", F.explode(F.sequence(_floor_div(F.col("y1"), size), _floor_div(F.col("y2"), size))))
    by, lo, hi = F.col("y2") - F.col("y1"), F.greatest("y1", F.col("r") * cell), F.least(F.col("y2"), (F.col("r") + 1) * cell)
    n = lambda y: F.col("x1") * by + (y - F.col("y1")) * (F.col("x2") - F.col("x1"))  # noqa: E731  by times x at height y
    open_end = F.col("y2") >= (F.col("r") + 1) * cell  # the upper end is the next row's
    right = F.col("x2") > F.col("x1")
    level = by == 0
    span = F.greatest(by, F.lit(1)) * cell
    west = F.when(level, _floor_div(F.least("x1", "x2"), size)).otherwise(_floor_div(F.when(right, n(lo)).otherwise(n(hi)), span))
    far = F.when(right, n(hi)).otherwise(n(lo))
    east = F.when(level, _floor_div(F.greatest("x1", "x2"), size)).when(right & open_end, _ceil_div(far, span) - 1).otherwise(_floor_div(far, span))
    return rows.select("id", "r", west.alias("w"), F.greatest(west, east).alias("e")).select("id", "r", F.explode(F.sequence("w", "e")).alias("c")).distinct()


def touched_cells(polygons: DataFrame, cell: int) -> DataFrame:
    """(id, r, c) of the half-open cells that a polygon, border included, has a point in."""
    return edge_cells(polygons, cell).union(centre_cells(polygons, cell)).distinct()


def _meets_window(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Does a side have a point in the closed window?  Its box meets it, and the window's corners are not all on one side of it."""
    boxes = (F.least(e["x1"], e["x2"]) <= x1) & (F.greatest(e["x1"], e["x2"]) >= x0) & (F.least(e["y1"], e["y2"]) <= y1) & (F.greatest(e["y1"], e["y2"]) >= y0)
    side = lambda x, y: F.signum(((e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])).cast("double"))
    signs = F.array(side(x0, y0), side(x1, y0), side(x1, y1), side(x0, y1))
    return boxes & (F.array_min(signs) <= 0) & (F.array_max(signs) >= 0)


def _holds(e: Column, x: Column, y: Column) -> Column:
    """1 where a side is crossed by the ray from (x, y) to the right."""
    upward = e["y1"] < e["y2"]
    left = (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])
    return F.when(((e["y1"] > y) != (e["y2"] > y)) & F.when(upward, left > 0).otherwise(left < 0), 1).otherwise(0)


def tiles_of(polygons: DataFrame, tile: int, halo: int = 0) -> DataFrame:
    """(id, gx, gy): each tile whose window, halo included, a polygon meets; boxes give the candidates, sides decide.

    A window that no side meets lies wholly inside or outside, so one of its corners tells.
    """
    points = F.flatten("rings")
    bound = lambda f, c: f(F.transform(points, lambda p: p[c]))
    boxed = polygons.select("id", "part", F.flatten(F.transform("rings", ring_edges)).alias("sides"), bound(F.array_min, "x").alias("x0"), bound(F.array_min, "y").alias("y0"), bound(F.array_max, "x").alias("x1"), bound(F.array_max, "y").alias("y1"))
    near = spatial.boxes_to_tiles(boxed.filter(F.size("sides") > 0), tile, halo + 1)  # windows are closed
    x0, y0, x1, y1 = F.col("gx") * tile - halo, F.col("gy") * tile - halo, (F.col("gx") + 1) * tile + halo, (F.col("gy") + 1) * tile + halo
    crossed = F.aggregate("sides", F.lit(0), lambda n, e: n + _holds(e, x0, y0)) % 2 == 1
    return near.filter(F.exists("sides", lambda e: _meets_window(e, x0, y0, x1, y1)) | crossed).select("id", "gx", "gy").distinct()


def component_matches(footprints: DataFrame, members: DataFrame, least: int = 4, share: int = 4) -> DataFrame:
    """(component, footprint, shared, univocal): cell sets that share at least least cells and a share-th of both.

    footprints: tile, r, c, footprint; members: tile, r, c, component.  univocal: neither has another match.  Both sides can be
    far larger than the tables they are made of, by which Spark would judge them, so none of them may be broadcast.
    """
    own = lambda df, key: df.groupBy(key).agg(F.count("*").alias(f"of_{key}")).hint("merge")
    shared = footprints.join(members.hint("merge"), ["tile", "r", "c"]).groupBy("component", "footprint").agg(F.count("*").alias("shared"))
    found = shared.filter(F.col("shared") >= least).join(own(members, "component"), "component").join(own(footprints, "footprint"), "footprint")
    found = found.filter((F.col("shared") * share >= F.col("of_component")) & (F.col("shared") * share >= F.col("of_footprint")))
    alone = lambda key: F.count("*").over(Window.partitionBy(key)) == 1
    return found.select("component", "footprint", "shared", (alone("component") & alone("footprint")).alias("univocal"))


def cell_sides(cells: DataFrame, group: list[str]) -> DataFrame:
    """Directed sides (group, r0, c0, r1, c1, heading) of a group's distinct cells (r, c), the cells on their left: sides that two
    cells share cancel.  heading: 0 east, 1 north, 2 west, 3 south; r grows to the north."""
    corner = lambda k, a, b, d, e: F.struct(F.lit(k).alias("heading"), (F.col("r") + a).alias("r0"), (F.col("c") + b).alias("c0"), (F.col("r") + d).alias("r1"), (F.col("c") + e).alias("c1"))
    sides = F.array(corner(0, 0, 0, 0, 1), corner(1, 0, 1, 1, 1), corner(2, 1, 1, 1, 0), corner(3, 1, 0, 0, 0))
    each = cells.select(*group, F.explode(sides).alias("s")).select(*group, "s.*")
    line = F.struct(F.least("r0", "r1").alias("r"), F.least("c0", "c1").alias("c"), (F.col("heading") % 2).alias("way"))
    kept = each.groupBy(*group, line.alias("line")).agg(F.count("*").alias("n"), F.max(F.struct("r0", "c0", "r1", "c1", "heading")).alias("s"))
    return kept.filter("n = 1").select(*group, "s.*")


def closed_rings(sides: DataFrame, group: list[str]) -> DataFrame:
    """(group, r0, c0, outer, area2, sides, corners) of directed sides: their closed rings, corners in order from the least (r0, c0), collinear
    ones left out; area2 is twice the area, below 0 for holes.

    Where four sides meet, a ring turns left, so it stays with the cells it is of and rings touch but never cross.
    """
    named = written(sides.withColumn("node", F.struct(*group, "r0", "c0", "heading")))
    after = named.select(*group, F.col("r0").alias("r1"), F.col("c0").alias("c1"), F.col("node").alias("next"), F.col("heading").alias("turned"))
    turn = (F.col("turned") - F.col("heading") + 4) % 4
    order = Window.partitionBy("node").orderBy(F.when(turn == 1, 0).when(turn == 0, 1).otherwise(2))
    links = named.join(after, [*group, "r1", "c1"]).withColumn("n", F.row_number().over(order)).filter("n = 1")
    cycles = graphs.cycles(links.select("node", "next"))
    placed = links.select(*group, "node", "r0", "c0", "r1", "c1", turn.alias("turn")).join(cycles, "node")
    step = (F.col("c0") * F.col("r1") - F.col("c1") * F.col("r0")).cast("long")
    end = F.struct("place", F.col("r1").alias("r"), F.col("c1").alias("c"))
    rings = placed.groupBy(*group, F.col("cycle").alias("ring")).agg(F.sum(step).alias("area2"), F.count("*").alias("sides"), F.sort_array(F.collect_list(F.when(F.col("turn") != 0, end))).alias("ends"))
    corners = F.transform(F.concat(F.slice("ends", -1, 1), F.slice("ends", 1, F.size("ends") - 1)), lambda p: F.struct(p["r"].alias("r"), p["c"].alias("c")))
    return rings.select(*group, F.col("ring.r0").alias("r0"), F.col("ring.c0").alias("c0"), (F.col("area2") > 0).alias("outer"), "area2", "sides", corners.alias("corners"))


def dissolved(polygons: DataFrame, group: list[str], cell: int) -> DataFrame:
    """The rings of each group's union, as cell sets at the stated resolution (closed_rings' columns)."""
    keys = polygons.select("id", *group).distinct()
    cells = centre_cells(polygons.select("id", "part", "rings"), cell).join(keys, "id").select(*group, "r", "c").distinct()
    return closed_rings(cell_sides(cells, group), group)


#: Most coordinates of a layer, and most frames of a timeline.
MAX_COORDINATES, MAX_FRAMES = 500_000, 366


def layer_faults(frames: DataFrame) -> DataFrame:
    """(dataset, coordinates, frames, faults) of timelines (dataset, frame, rings): what is beyond the limits on input."""
    size = F.aggregate(F.transform("rings", lambda r: F.size(r).cast("long")), F.lit(0).cast("long"), lambda n, x: n + x)
    found = frames.groupBy("dataset").agg(F.sum(size).alias("coordinates"), F.count_distinct("frame").alias("frames"))
    faults = F.array_compact(F.array(F.when(F.col("coordinates") > MAX_COORDINATES, F.lit("coordinates")), F.when(F.col("frames") > MAX_FRAMES, F.lit("frames"))))
    return found.withColumn("faults", faults)


def _hull(points: np.ndarray) -> np.ndarray:
    """Convex hull by monotone chain: distinct points in order of x and y; the lower chain, then the upper one; no three in a line."""
    points = np.unique(points, axis=0).tolist()
    if len(points) < 3:
        return np.array(points).reshape(-1, 2)

    def chain(some: list) -> list:
        out: list = []
        for p in some:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(chain(points) + chain(points[::-1]))


def _least_box(hull: np.ndarray) -> tuple[float, float, float] | None:
    """(width, depth, yaw) of the smallest box along a hull's side: by area, |yaw|, yaw, width, depth at nine decimals."""
    if len(hull) < 3:
        return None
    side = np.roll(hull, -1, 0) - hull
    angle = np.arctan2(side[:, 1], side[:, 0])
    cos, sin = np.cos(angle), np.sin(angle)
    along, across = np.outer(cos, hull[:, 0]) + np.outer(sin, hull[:, 1]), np.outer(cos, hull[:, 1]) - np.outer(sin, hull[:, 0])
    width, depth = np.ptp(along, 1), np.ptp(across, 1)
    turned = depth > width
    angle = np.where(turned, angle + np.pi / 2, angle)
    width, depth = np.where(turned, depth, width), np.where(turned, width, depth)
    yaw = (angle + np.pi / 2) % np.pi - np.pi / 2
    *_, yaw, width, depth = min(tuple(round(v, 9) for v in x) for x in zip((width * depth).tolist(), np.abs(yaw).tolist(), yaw.tolist(), width.tolist(), depth.tolist(), strict=True))
    return width, depth, yaw


_HULL = T.StructType().add("x", T.ArrayType(T.DoubleType())).add("y", T.ArrayType(T.DoubleType()))
_BOX = T.StructType().add("width", "double").add("depth", "double").add("yaw", "double")


def _points(x: pd.Series, y: pd.Series) -> Iterator[np.ndarray]:
    for a, b in zip(x, y, strict=True):
        yield np.stack((np.asarray(a, np.float64), np.asarray(b, np.float64)), 1).reshape(-1, 2)


@F.pandas_udf(_HULL)
def _hull_of(x: pd.Series, y: pd.Series) -> pd.DataFrame:
    hulls = [_hull(p) for p in _points(x, y)]
    return pd.DataFrame({"x": [h[:, 0].tolist() for h in hulls], "y": [h[:, 1].tolist() for h in hulls]})


@F.pandas_udf(_BOX)
def _box_of(x: pd.Series, y: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_least_box(h) or (None, None, None) for h in _points(x, y)], columns=["width", "depth", "yaw"], dtype=float)


#: Rows that a polygon's hull and box are reckoned for.
BOX_OF = 32


def least_boxes(polygons: DataFrame) -> DataFrame:
    """(id, width, depth, yaw): the minimum-area box of all parts of an id, long side first, yaw from -pi/2 up to below pi/2.

    Parts give their hulls, and the hull of these is the whole's, so only hulls are shuffled; points in one line have no box.
    """
    xs, ys = F.transform(F.flatten("rings"), lambda p: p["x"].cast("double")), F.transform(F.flatten("rings"), lambda p: p["y"].cast("double"))
    parts = dealt(polygons.filter(F.size(F.flatten("rings")) > 0).select("id", "rings"), BOX_OF, "id").select("id", _hull_of(xs, ys).alias("h"))
    both = parts.groupBy("id").agg(F.flatten(F.collect_list("h.x")).alias("x"), F.flatten(F.collect_list("h.y")).alias("y"))
    whole = both.select("id", _hull_of("x", "y").alias("h")).select("id", _box_of("h.x", "h.y").alias("b"))
    return whole.select("id", "b.width", "b.depth", "b.yaw")
