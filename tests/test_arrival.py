"""Least-cost arrival inside and across tiles against one heap over the whole grid."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from tilework.operators import grids as G
from tilework import checkpoints


def dijkstra(weights, sources):
    best, heap = {}, [(0, *s) for s in sources]
    while heap:
        d, r, c = heapq.heappop(heap)
        if (r, c) in best:
            continue
        best[r, c] = d
        for a, b in G.EIGHT:
            w = weights.get((r + a, c + b))
            if w is not None:
                heapq.heappush(heap, (d + w * (7 if a and b else 5), r + a, c + b))
    return best


def cost():
    return (F.col("w") * F.when((F.col("dr") != 0) & (F.col("dc") != 0), 7).otherwise(5)).cast("long")


@pytest.mark.parametrize(("seed", "sources"), [(1, [(-9, -9)]), (2, [(0, 0), (11, 3)]), (3, [])])
def test_tiles_equal_one_heap(spark, seed, sources):
    rng = random.Random(seed)
    weights = {(r, c): rng.choice([1, 1, 2, 9, 40, None]) for r in range(-9, 15) for c in range(-9, 15) if rng.random() < 0.85}
    weights |= dict.fromkeys(sources, 1)
    cells = spark.createDataFrame([(r, c, w) for (r, c), w in weights.items()], "r int, c int, w long")
    starts = spark.createDataFrame(sources, "r int, c int")
    got = {(x["r"], x["c"]): x["arrival"] for x in G.arrival_over_tiles(cells, starts, cost(), 5).collect()}
    assert got == dijkstra(weights, sources)


def test_a_way_that_comes_back_into_a_tile(spark):
    """A wall inside the first tile: the way around it lies in the next one."""
    weights = {(r, c): 1 for r in range(4) for c in range(8)}
    for r in range(3):
        weights[r, 2] = 1000
    weights[3, 2] = 1000
    weights |= {(4, c): 1 for c in range(8)}
    cells = spark.createDataFrame([(r, c, w) for (r, c), w in weights.items()], "r int, c int, w long")
    got = {(x["r"], x["c"]): x["arrival"] for x in G.arrival_over_tiles(cells, spark.createDataFrame([(0, 0)], "r int, c int"), cost(), 4).collect()}
    assert got == dijkstra(weights, [(0, 0)])


def test_rounds_grow_with_tiles_not_with_cells(spark, monkeypatch):
    n = []
    real = checkpoints.written
    monkeypatch.setattr(G, "written", lambda df: n.append(1) or real(df))
    rounds = {}
    for side in (16, 32):
        cells = spark.range(2 * side).select(F.lit(0).alias("r"), F.col("id").cast("int").alias("c"), F.lit(1).cast("long").alias("w"))
        n.clear()
        assert G.arrival_over_tiles(cells, cells.filter("c = 0"), cost(), side).count() == 2 * side
        rounds[side] = len(n)
    assert rounds[16] == rounds[32]


def test_inside_a_tile_with_real_costs_and_none(spark):
    cells = spark.createDataFrame([(1, 0, c, w) for c, w in enumerate([1.0, 0.5, 0.25, None, 1.0])] + [(2, 0, 0, 1.0)], "tile long, r int, c int, w double")
    got = {(x["tile"], x["c"]): x["arrival"] for x in G.least_cost_arrival(cells, cells.filter("tile = 1 and c = 0"), F.col("w")).collect()}
    assert got == {(1, 0): 0.0, (1, 1): 0.5, (1, 2): 0.75}


def test_a_round_is_one_written_table(spark, monkeypatch):
    """two tiles in a row, and a third round that finds nothing better."""
    n = []
    real = checkpoints.written
    monkeypatch.setattr(G, "written", lambda df: n.append(1) or real(df))
    cells = spark.range(8).select(F.lit(0).alias("r"), F.col("id").cast("int").alias("c"), F.lit(1).cast("long").alias("w"))
    assert G.arrival_over_tiles(cells, cells.filter("c = 0"), cost(), 4).count() == 8
    assert len(n) <= 3
