"""Passes over many whole tiles at once: against one tile at a time, and without rows that are multiplied and joined back."""

import random

import pytest
from pyspark.sql import functions as F

from tilework import checkpoints
from tilework.operators import grids as G
from tilework.operators import inventory as I
from tilework.operators import scenes, tiles
from tilework.plans import registry

from .compare import rows_of


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def grid(spark):
    rng = random.Random(5)
    names = [None, "a", "b", *(f"t{k}" for k in range(9))]
    rows = [(t, r, c, rng.randrange(9)) for k, t in enumerate(names) for r in range(-3, 5) for c in range(-2, 3 + k) if rng.random() < 0.6]
    rows.append(("far", 2_000_000_000, -2_000_000_000, 3))
    rows.append(("far", -2_000_000_000, 2_000_000_000, 4))
    return spark.createDataFrame(rows, "tile string, r int, c int, h long").repartition(3).cache()


@pytest.mark.parametrize("work", [
    lambda g: tiles.components(g, G.FOUR),
    lambda g: tiles.crowns(g, "h", G.EIGHT),
    lambda g: tiles.windows(g.filter("coalesce(tile, '') <> 'far'"), "h", 2, {"top": "max", "all": "sum"}),
    lambda g: tiles.around(g, "h", {"n": (-1, 0), "se": (1, 1)}),
    lambda g: tiles.nearest(g.withColumn("ok", F.col("h") > 6), "h", "ok", 3),
])
def test_many_tiles_at_once_equal_one_at_a_time(grid, monkeypatch, work):
    together = rows_of(work(grid))
    monkeypatch.setattr(tiles, "BATCH_ROWS", 1)
    assert rows_of(work(grid)) == together


def test_neighbours_stay_inside_their_tile(grid):
    rows = {(x["tile"], x["r"], x["c"]): x["h"] for x in grid.collect()}
    got = {(x["tile"], x["r"], x["c"]): x["n"] for x in tiles.around(grid, "h", {"n": (-1, 1)}).collect()}
    assert got == {(t, r, c): rows.get((t, r - 1, c + 1)) for t, r, c in rows}


def test_nearest_valid_equals_brute_force(grid):
    rows = [tuple(x) for x in grid.collect()]
    for t, r, c, h, filled, d2 in (tuple(x) for x in G.nearest_valid_fill(grid, "h", F.col("h") > 6, 3).collect()):
        found = [((r - y) ** 2 + (c - x) ** 2, y, x, v) for s, y, x, v in rows if s == t and v > 6 and (r - y) ** 2 + (c - x) ** 2 <= 9]
        assert (filled, d2) == ((h, 0) if h > 6 else (min(found)[3], min(found)[0]) if found else (None, None))


def test_nothing_is_multiplied_or_joined_back(spark, sf_dir):
    assert not {"Generate", "Join"} & set(plan(registry.QUERIES["vertex_means"](spark, sf_dir)).split())  # F14
    assert "Join" not in plan(registry.QUERIES["nearest_fill"](spark, sf_dir))  # F16
    burned = plan(registry.QUERIES["burn_metrics"](spark, sf_dir))  # F18
    assert "Generate" not in burned and "SortMergeJoin" not in burned
    rows = spark.range(64).selectExpr("id % 2 as tile", "id div 8 as r", "id % 8 as c", "300L as hag", "true as vegetation", "id as footprint")
    assert "Generate" not in plan(I.buildings_from_components(rows))  # F10


def test_spread_members_are_dealt_by_their_number(spark, monkeypatch):
    """F12"""
    monkeypatch.setattr(checkpoints, "DEALT", 100)
    members = spark.range(40).coalesce(1).selectExpr("id as tile", "id % 4 as r", "id % 5 as c")
    assert G.refined_occupancy(members, 4, 5).rdd.getNumPartitions() == 10


def test_fronts_of_no_neighbours(spark):
    at = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 1, 9), (2, 0, 0, 20)], "tile int, r int, c int, arrival int")
    moments = spark.createDataFrame([(1, 5), (2, 10)], "state int, t int")
    assert rows_of(scenes.burn_states(at, moments, 2)) == rows_of(spark.createDataFrame([(1, 1, 4, 8), (1, 2, 8, 12)], "tile int, state int, area_m2 long, front_m long"))
