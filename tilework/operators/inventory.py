"""Placement inventories: every candidate of a tile's grid with family, status and reasons, under two profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import written
from . import grids as G
from . import tiles

#: Heights in cm and shape limits of a roof-like component.
TALL_CM, WOODY_CM = 200, 100
MIN_AREA, MAX_DISPERSION, MIN_PLANAR, MIN_RECTANGULAR, MIN_COMPACT, MAX_VEGETATION = 16, 100, 0.50, 0.55, 0.20, 0.25
CANDIDATE = ["tile", "family", "id", "status", "area", "height_cm", "reasons"]


_SIDES = {f"_u{k}": step for k, step in enumerate(G.FOUR)}


def _shapes(members: DataFrame) -> DataFrame:
    """Per component of members with _top and _low around them and their neighbours (_SIDES): area, height percentiles, planar share, rectangularity, compactness, vegetation share."""
    sides = F.sum(sum(F.col(u).isNull().cast("int") for u in _SIDES))
    box = (F.max("r") - F.min("r") + 1) * (F.max("c") - F.min("c") + 1)
    found = members.groupBy("tile", "component").agg(
        F.count("*").alias("area"), G.nearest_rank("hag", 0.1).alias("p10"), G.nearest_rank("hag", 0.9).alias("p90"), G.nearest_rank("hag", 0.95).alias("p95"),
        (F.count_if(F.col("_top") - F.col("_low") <= 75) / F.count("*")).alias("planar"), (F.count("*") / box).alias("rectangular"),
        (4 * F.pi() * F.count("*") / F.nullif(sides * sides, F.lit(0))).alias("compact"), (F.count_if(F.col("vegetation")) / F.count("*")).alias("green"),
    )
    return found


def _reasons(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))


def buildings_from_components(cells: DataFrame) -> DataFrame:
    """Components of tall cells; roof-like ones are ambiguous without a footprint, the others rejected: shape alone is never valid.

    cells: tile, r, c, hag, vegetation, footprint (id or null).  A component that one footprint alone confirms,
    with a quarter of the component under it, is valid.
    """
    high = cells.filter(F.col("hag") >= TALL_CM).select("tile", "r", "c", "hag", "vegetation", "footprint")
    tall = written(tiles.together(high, tiles.component_pass(G.FOUR), tiles.window_pass("hag", 1, {"_top": "max", "_low": "min"}), tiles.around_pass(high, "hag", _SIDES)))
    shape = _shapes(tall)
    under = tall.filter("footprint is not null").groupBy("component", "footprint").agg(F.count("*").alias("n"))
    confirm = under.groupBy("component").agg(F.count("*").alias("footprints"), F.max("n").alias("covered"))
    joined = shape.join(confirm, "component", "left")
    reasons = _reasons({
        "small": F.col("area") >= MIN_AREA, "uneven": F.col("p90") - F.col("p10") <= MAX_DISPERSION, "not_planar": F.col("planar") >= MIN_PLANAR,
        "not_rectangular": F.col("rectangular") >= MIN_RECTANGULAR, "not_compact": F.col("compact") >= MIN_COMPACT, "vegetation": F.col("green") <= MAX_VEGETATION,
    })
    univocal = (F.col("footprints") == 1) & (F.col("covered") * 4 >= F.col("area")) & (F.col("green") <= MAX_VEGETATION)
    status = F.when(F.coalesce(univocal, F.lit(False)), "valid").when(F.col("footprints") > 1, "ambiguous").when(F.size("reasons") == 0, "ambiguous").otherwise("rejected")
    return joined.withColumn("reasons", reasons).select("tile", F.lit("building").alias("family"), F.col("component").alias("id"), status.alias("status"), "area", F.col("p95").alias("height_cm"), "reasons")


def buildings_from_footprints(cells: DataFrame) -> DataFrame:
    """One candidate per footprint: its 95th percentile height; low ones are ambiguous."""
    found = cells.filter("footprint is not null").groupBy("tile", F.col("footprint").alias("id")).agg(F.count("*").alias("area"), G.nearest_rank("hag", 0.95).alias("height_cm"))
    reasons = _reasons({"low": F.col("height_cm") >= TALL_CM})
    return found.select("tile", F.lit("building").alias("family"), F.col("id").cast("string").alias("id"), F.when(F.col("height_cm") < TALL_CM, "ambiguous").otherwise("valid").alias("status"), "area", "height_cm", reasons.alias("reasons"))


def trees(cells: DataFrame) -> DataFrame:
    """Crowns by steepest ascent on the cells outside valid buildings; status by height, size and vegetation."""
    crowned = G.steepest_crowns(cells.filter(F.col("hag") >= WOODY_CM).select("tile", "r", "c", "hag", "vegetation"), "hag")
    found = crowned.groupBy("tile", "crown").agg(F.count("*").alias("area"), F.max("hag").alias("height_cm"), F.bool_or("vegetation").alias("green"))
    least = F.when(F.col("green"), F.when(F.col("height_cm") >= TALL_CM, 1).otherwise(2)).otherwise(4)
    reasons = _reasons({"small": F.col("area") >= least, "no_vegetation": F.col("green")})
    status = F.when(F.col("area") < least, "rejected").when(~F.col("green"), "ambiguous").otherwise("valid")
    return found.select("tile", F.lit("tree").alias("family"), F.col("crown").alias("id"), status.alias("status"), "area", "height_cm", reasons.alias("reasons"))


def placement_inventory(cells: DataFrame, profile: str = "v2", on_bad_grid: str = "degrade") -> DataFrame:
    """All candidates of every tile at once: CANDIDATE columns.

    cells: tile, r, c, mnt_mm, mns_mm, vegetation, footprint.  v1 takes buildings from components, v2 from footprints.  A tile
    that fails the height gate is degraded to ground without footprints, or the plan fails (on_bad_grid = "fail").
    """
    verdicts = G.grid_quality(cells).select("tile", "verdict")
    bad = F.col("verdict") != "ok"
    rows = cells.join(verdicts, "tile")
    if on_bad_grid == "fail":
        rows = rows.filter(F.when(bad, F.raise_error(F.concat(F.lit("grid of tile "), F.col("tile").cast("string"), F.lit(": "), F.col("verdict")))).otherwise(F.lit(True)))
    surface = F.when(bad, F.col("mnt_mm")).otherwise(F.col("mns_mm"))
    rows = rows.select("tile", "r", "c", G.height_cm(F.col("mnt_mm"), surface).alias("hag"), "vegetation", F.when(~bad, F.col("footprint")).alias("footprint"))
    rows = written(rows)
    houses = (buildings_from_components if profile == "v1" else buildings_from_footprints)(rows)
    return houses.select(CANDIDATE).unionByName(trees(rows.filter("footprint is null")).select(CANDIDATE))


def outlines(members: DataFrame) -> DataFrame:
    """Directed boundary sides of a cell set with the corner each starts and ends at, so that a ring is a chain of successors.

    Corners where four sides meet have two successors: the turn to the right is the ring's.
    """
    side = G.boundary_edges(members)
    start_r = F.col("r") + F.when((F.col("dr") == 1) | (F.col("dc") == -1), 1).otherwise(0)
    start_c = F.col("c") + F.when((F.col("dr") == 1) | (F.col("dc") == 1), 1).otherwise(0)
    step_r = F.when(F.col("dc") == 1, 1).when(F.col("dc") == -1, -1).otherwise(0)
    step_c = F.when(F.col("dr") == -1, 1).when(F.col("dr") == 1, -1).otherwise(0)
    return side.select("tile", "r", "c", start_r.alias("r0"), start_c.alias("c0"), (start_r + step_r).alias("r1"), (start_c + step_c).alias("c1"))
