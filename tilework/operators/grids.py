"""Operators on cell tables (tile, r, c, values): heights, gates, neighbourhoods, components, arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import dealt, written
from . import tiles

#: Height limits of the grid gate in mm and cm, and the share of outliers it bears.
HARD_BELOW_MM, BELOW_MM, MAX_CM, MAX_OUTLIERS, MAX_SHARE = -1000, -500, 65_534, 32, 0.000125


def quantised_mm(metres: Column) -> Column:
    """Millimetres, half away from zero."""
    v = metres * 1000.0
    return F.when(v >= 0, F.floor(v + 0.5)).otherwise(F.ceil(v - 0.5)).cast("int")


def rounded_div(value: Column, by: int) -> Column:
    """Integer division rounded half away from zero."""
    up = F.floor((F.abs(value) * 2 + by) / (2 * by))
    return F.when(value < 0, -up).otherwise(up).cast("long")


def height_cm(mnt_mm: Column, mns_mm: Column) -> Column:
    """Height above ground; negative heights and those beyond the range are ground."""
    cm = F.floor((F.greatest(mns_mm - mnt_mm, F.lit(0)) + 5) / 10)
    return F.when(cm > MAX_CM, 0).otherwise(cm).cast("long")


def grid_quality(cells: DataFrame) -> DataFrame:
    """One row a tile: the diagnostics of the grid gate and its verdict."""
    delta = F.col("mns_mm") - F.col("mnt_mm")
    over = F.floor((F.greatest(delta, F.lit(0)) + 5) / 10) > MAX_CM
    found = cells.groupBy("tile").agg(
        F.count("*").alias("cells"), F.min(delta).alias("min_delta_mm"), F.max(delta).alias("max_delta_mm"), F.count_if(delta < 0).alias("negative"), F.count_if(delta < BELOW_MM).alias("below"), F.count_if(over).alias("above")
    )
    bad = lambda n: (F.col(n) > MAX_OUTLIERS) | (F.col(n) / F.col("cells") > MAX_SHARE)
    return found.withColumn("verdict", F.when(F.col("min_delta_mm") < HARD_BELOW_MM, "misaligned").when(bad("below"), "negative").when(bad("above"), "overflow").otherwise("ok"))


def nearest_rank(value: str, p: float) -> Column:
    """The value of rank ceil(p * n), of whole numbers."""
    return F.expr(f"cast(percentile_disc({p}) within group (order by {value}) as bigint)")


def degraded(cells: DataFrame) -> DataFrame:
    """Tiles that fail the gate fall back to ground; mode and reason say so."""
    verdicts = grid_quality(cells).select("tile", "verdict")
    bad = F.col("verdict") != "ok"
    return cells.join(verdicts, "tile").select(
        "tile", "r", "c", "mnt_mm", F.when(bad, F.col("mnt_mm")).otherwise(F.col("mns_mm")).alias("mns_mm"), F.when(bad, "degraded_mns_fallback").otherwise("measured").alias("mode"), F.when(bad, F.col("verdict")).alias("reason")
    )


def reduced_2x2(cells: DataFrame) -> DataFrame:
    """Half resolution: ground the rounded mean, surface ground plus the greatest height of the block."""
    block = cells.groupBy("tile", F.expr("r div 2").alias("r"), F.expr("c div 2").alias("c")).agg(
        F.sum("mnt_mm").alias("total"), F.count("*").alias("n"), F.max(F.col("mns_mm") - F.col("mnt_mm")).alias("up"), F.count_if(F.col("mns_mm") < F.col("mnt_mm")).alias("negative")
    )
    ground = F.floor((F.col("total") * 2 + F.col("n")) / (2 * F.col("n")))
    return block.select("tile", "r", "c", ground.alias("mnt_mm"), (ground + F.greatest("up", F.lit(0))).alias("mns_mm"), "negative")


def box_window(cells: DataFrame, value: str, radius: int, how: str, out: str) -> DataFrame:
    """max, min or sum of value over the square of the radius, and the number of cells in it (out_n)."""
    return tiles.windows(cells, value, radius, {out: how})


def neighbours(cells: DataFrame, steps: list[tuple[int, int]]) -> DataFrame:
    """Each cell's keys shifted by each step: columns nr, nc, dr, dc."""
    moves = F.array(*(F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in steps))
    return cells.withColumn("_m", F.explode(moves)).select(*cells.columns, (F.col("r") + F.col("_m.dr")).alias("nr"), (F.col("c") + F.col("_m.dc")).alias("nc"), F.col("_m.dr").alias("dr"), F.col("_m.dc").alias("dc"))


FOUR = [(-1, 0), (1, 0), (0, -1), (0, 1)]
EIGHT = FOUR + [(-1, -1), (-1, 1), (1, -1), (1, 1)]


def adjacent(members: DataFrame, steps: list[tuple[int, int]]) -> DataFrame:
    """Pairs of neighbouring members: tile, r, c and nr, nc."""
    near = neighbours(members.select("tile", "r", "c"), steps)
    return near.join(members.select("tile", F.col("r").alias("nr"), F.col("c").alias("nc")), ["tile", "nr", "nc"]).select("tile", "r", "c", "nr", "nc")


def boundary_edges(members: DataFrame) -> DataFrame:
    """Each side of a member whose neighbour is no member."""
    near = neighbours(members.select("tile", "r", "c"), FOUR)
    return near.join(members.select("tile", F.col("r").alias("nr"), F.col("c").alias("nc")), ["tile", "nr", "nc"], "left_anti").select("tile", "r", "c", "dr", "dc")


def cell_id(r: str = "r", c: str = "c") -> Column:
    """tile:r:c, for tiles of any type and grids of any width."""
    return F.concat_ws(":", F.col("tile").cast("string"), F.col(r).cast("string"), F.col(c).cast("string"))


def labelled_components(members: DataFrame, steps: list[tuple[int, int]]) -> DataFrame:
    """members with component: the id of the first of the connected cells in reading order."""
    return tiles.components(members, steps)


def steepest_crowns(cells: DataFrame, height: str) -> DataFrame:
    """cells with crown: the id of the peak that steepest ascent over eight neighbours reaches.

    Ties go to the higher cell, then the smaller c, then the smaller r.
    """
    return tiles.crowns(cells, height, EIGHT)


_COSTS = [f"_c{k}" for k in range(len(EIGHT))]


def _step_costs(cells: DataFrame, cost: Column) -> tuple[DataFrame, str]:
    """cells with what it costs to enter each by each of the eight steps, and the type of sums of that."""
    for name, (dr, dc) in zip(_COSTS, EIGHT, strict=True):
        cells = cells.withColumns({"dr": F.lit(dr), "dc": F.lit(dc)}).withColumn(name, cost).drop("dr", "dc")
    kind = "double" if cells.schema[_COSTS[0]].dataType.simpleString() in ("float", "double") else "long"
    return cells.withColumns({c: F.col(c).cast(kind) for c in _COSTS}), kind


def _begun(places: DataFrame, kind: str) -> DataFrame:
    """Offers of ways that begin at the places."""
    return places.withColumns({"k": F.lit(None).cast("int"), "at": F.lit(0).cast(kind)})


def least_cost_arrival(cells: DataFrame, sources: DataFrame, cost: Column) -> DataFrame:
    """(tile, r, c, arrival): the least summed cost from the sources over eight-neighbour steps inside each tile, of the cells that are reached.

    cost is an expression over the entered cell's columns and the step's dr, dc, not below 0; where it is null a cell can't be entered.
    """
    costs, kind = _step_costs(cells, cost)
    rows = costs.select("tile", "r", "c", *_COSTS).withColumn("held", F.lit(None).cast(kind))
    return tiles.arrivals(rows, _begun(sources.select("tile", "r", "c"), kind), EIGHT, _COSTS, kind).filter("arrival is not null").select("tile", "r", "c", "arrival")


def arrival_over_tiles(cells: DataFrame, sources: DataFrame, cost: Column, side: int) -> DataFrame:
    """(r, c, arrival) over a grid (r, c) of any extent, cut into tiles of so many cells a side.

    A round is one pass over the tiles with what their neighbours offer: cells at edges that became better offer themselves across.
    Rounds grow with the tiles that a way crosses, not with its cells.
    """
    tile = F.concat_ws(":", F.floor(F.col("r") / side), F.floor(F.col("c") / side))
    found, kind = _step_costs(cells, cost)
    state = found.select(tile.alias("tile"), "r", "c", *_COSTS, F.lit(None).cast(kind).alias("held"))
    offers = _begun(sources.select(tile.alias("tile"), "r", "c"), kind)
    moves = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(a).alias("dr"), F.lit(b).alias("dc")) for k, (a, b) in enumerate(EIGHT)))
    edge = (F.pmod("r", F.lit(side)).isin(0, side - 1)) | (F.pmod("c", F.lit(side)).isin(0, side - 1))
    while True:
        new = written(tiles.arrivals(state, offers, EIGHT, _COSTS, kind).withColumn("held", F.col("arrival")).drop("arrival"))
        state, crossing = new.drop("better"), new.filter(F.col("better") & edge)
        if not crossing.limit(1).count():
            return state.filter("held is not null").select("r", "c", F.col("held").alias("arrival"))
        moved = crossing.withColumn("m", F.explode(moves)).select(F.col("tile").alias("own"), (F.col("r") + F.col("m.dr")).alias("r"), (F.col("c") + F.col("m.dc")).alias("c"), "m.k", F.col("held").alias("at"))
        offers = moved.withColumn("tile", tile).filter("tile <> own").drop("own")


def nearest_valid_fill(cells: DataFrame, value: str, valid: Column, reach: int) -> DataFrame:
    """cells whose value is not valid take that of the nearest valid cell, ties by (r, c), within reach."""
    found = tiles.nearest(cells.withColumn("_ok", valid), value, "_ok", reach)
    own = found.withColumn("filled", F.when(F.col("_ok"), F.col(value)).otherwise(F.col("filled"))).withColumn("d2", F.when(F.col("_ok"), F.lit(0).cast("long")).otherwise(F.col("d2")))
    return own.drop("_ok")


#: Sub-cells of a cell's side, and the occupancy from which one is kept, in ninths (0.42 of the whole and above).
FINE, KEPT_NINTHS = 3, 4


def refined_occupancy(members: DataFrame, rows: int, columns: int) -> DataFrame:
    """(tile, r, c, ninths) of the sub-cells, three to a cell's side, that stay: occupancy is the bilinear mean of the cells around a
    sub-cell's centre, 1 where one is a member and 0 elsewhere, also beyond the grid's rows and columns.

    Along one axis a member weighs 1, 2, 3, 2, 1 thirds on the five sub-cells around it, so members are spread and summed, by tile
    in tasks of a bounded number of rows.
    """
    near = F.array(*(F.struct(F.lit(d).alias("d"), F.lit(3 - abs(d)).alias("w")) for d in range(-2, 3)))
    spread = dealt(members.select("tile", "r", "c"), 25, "tile").withColumn("y", F.explode(near)).withColumn("x", F.explode(near))
    at = lambda cell, axis: (F.col(cell) * FINE + 1 + F.col(f"{axis}.d")).alias(cell)
    fine = spread.select("tile", at("r", "y"), at("c", "x"), (F.col("y.w") * F.col("x.w")).alias("w")).filter(F.col("r").between(0, rows * FINE - 1) & F.col("c").between(0, columns * FINE - 1))
    return fine.groupBy("tile", "r", "c").agg(F.sum("w").alias("ninths")).filter(F.col("ninths") >= KEPT_NINTHS)


def fingerprint(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """(group, sha256): one hash a group over its rows in order, whatever the partitioning; in two levels, so no group is gathered whole."""
    text = F.concat_ws(",", *columns)
    part = F.conv(F.substring(F.sha2(text, 256), 1, 2), 16, 10).cast("int")
    parts = df.groupBy(group, part.alias("part")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(text)), ";"), 256).alias("h"))
    return parts.groupBy(group).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.lpad(F.col("part").cast("string"), 3, "0"), "h"))), ";"), 256).alias("sha256"))
