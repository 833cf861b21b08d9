"""Polygons on grids against direct computation."""

import itertools
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilework.operators import graphs, tiles
from tilework.operators import grids as G
from tilework.operators import polygons as P

POLYGON = "id long, part int, rings array<array<struct<x:long,y:long>>>"


def frame(spark, rows):
    return spark.createDataFrame([(i, part, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for i, part, rings in rows], POLYGON)


def sides(rings):
    return [(a, b) for ring in rings if len(ring) >= 3 for a, b in zip(ring, ring[1:] + ring[:1], strict=True) if a != b]


def inside(rings, x, y):
    """Even-odd; a side holds its lower end, a point on a side is right of it."""
    n = 0
    for (x1, y1), (x2, y2) in sides(rings):
        if (y1 <= y) != (y2 <= y) and Fraction(x1) + Fraction((y - y1) * (x2 - x1), 1) / (y2 - y1) <= x:
            n += 1
    return n % 2 == 1


def touches(a, b, w, s, size):
    """Has the closed segment a point in the half-open cell?"""
    lo, hi, open_hi = Fraction(0), Fraction(1), False
    open_lo = False
    for p, d, low in ((a[0], b[0] - a[0], w), (a[1], b[1] - a[1], s)):
        if d == 0:
            if not low <= p < low + size:
                return False
            continue
        enter, leave = Fraction(low - p, d), Fraction(low + size - p, d)
        enters_open, leaves_open = False, True  # the far border is not the cell's
        if d < 0:
            enter, leave, enters_open, leaves_open = leave, enter, True, False
        if enter > lo or enter == lo and enters_open:
            lo, open_lo = max(lo, enter), enters_open
        if leave < hi or leave == hi and leaves_open:
            hi, open_hi = min(hi, leave), leaves_open
    return lo < hi or lo == hi and not open_lo and not open_hi


def model(rows, size):
    centre, touched = set(), set()
    for i, _, rings in rows:
        xs, ys = [p[0] for ring in rings for p in ring], [p[1] for ring in rings for p in ring]
        if not xs:
            continue
        for r, c in itertools.product(range(min(ys) // size - 1, max(ys) // size + 2), range(min(xs) // size - 1, max(xs) // size + 2)):
            if inside(rings, Fraction(2 * c + 1, 2) * size, Fraction(2 * r + 1, 2) * size):
                centre.add((i, r, c))
            if any(touches(a, b, c * size, r * size, size) for a, b in sides(rings)):
                touched.add((i, r, c))
    return centre, centre | touched


def some_polygons():
    rng = random.Random(8)
    rows = [(1, 0, [[(0, 0), (40, 0), (40, 40), (0, 40), (0, 0)], [(10, 10), (10, 30), (30, 30), (30, 10)]]), (2, 0, [[(40, 0), (80, 0), (80, 40), (40, 40)]]), (3, 0, [[(5, 5), (15, 5), (10, 5)]]), (4, 0, [[(-7, -3), (-27, -3), (-15, -41)]])]
    rows += [(5, k, [[(k * 15, 50), (k * 15 + 20, 50), (k * 15 + 20, 70), (k * 15, 70)]]) for k in range(3)]  # parts that overlap
    rows += [(6, 0, []), (7, 0, [[]]), (8, 0, [[(1, 1), (9, 9)]])]
    rows += [(10 + k, 0, [[(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(rng.randrange(3, 8))] for _ in range(rng.randrange(1, 3))]) for k in range(25)]
    return rows


@pytest.mark.parametrize("size", [10, 7])
def test_both_raster_modes_equal_a_test_of_every_cell(spark, size):
    rows = some_polygons()
    centre, touched = model(rows, size)
    polygons = frame(spark, rows)
    assert {tuple(r) for r in P.centre_cells(polygons, size).collect()} == centre
    assert {tuple(r) for r in P.touched_cells(polygons, size).collect()} == touched


def test_polygons_that_share_borders_split_the_cells(spark):
    corner = [(0, 0), (37, 5), (60, 61), (3, 50)]
    middle = (29, 31)
    rows = [(k, 0, [[corner[k], corner[(k + 1) % 4], middle]]) for k in range(4)]
    own = P.centre_cells(frame(spark, rows), 3)
    whole = P.centre_cells(frame(spark, [(9, 0, [corner])]), 3)
    assert own.count() == own.select("r", "c").distinct().count()
    assert {(r["r"], r["c"]) for r in own.collect()} == {(r["r"], r["c"]) for r in whole.collect()}


def test_tiles_of_polygons(spark):
    ring = [(0, 0), (1000, 0), (1000, 1000), (0, 1000)]
    hole = [(150, 150), (850, 150), (850, 850), (150, 850)]
    rows = [(1, 0, [ring, hole]), (2, 0, [[(10, 10), (20, 10), (10, 20)]]), (3, 0, [[(0, 0), (300, 300), (300, 299)]]), (4, 0, [[(105, 50), (140, 50), (140, 60)]]), (5, 0, [])]
    got = {}
    for r in P.tiles_of(frame(spark, rows), 100, 5).collect():
        got.setdefault(r["id"], set()).add((r["gx"], r["gy"]))
    near = lambda lo, hi: {g for g in range(-3, 14) if g * 100 - 5 <= hi and (g + 1) * 100 + 5 >= lo}
    assert got[2] == {(0, 0)}
    assert got[4] == {(x, 0) for x in near(105, 140)} == {(0, 0), (1, 0)}  # five beyond the border of 0 is met, at the limit
    assert (1, 1) in got[1] and (5, 5) not in got[1] and (2, 2) not in got[1] and (-1, -1) in got[1] and (10, 10) in got[1]
    assert {(0, 0), (1, 1), (2, 2)} <= got[3] and (2, 0) not in got[3] and (0, 2) not in got[3]
    assert 5 not in got


def test_matches_at_the_limits(spark):
    cells = lambda label, places: [(1, r, c, label) for r, c in places]
    row = lambda n, r=0: [(r, c) for c in range(n)]
    members = spark.createDataFrame(cells("a", row(16)) + cells("b", row(17, 2)) + cells("c", row(3, 4)) + cells("d", row(8, 6)), "tile int, r int, c int, component string")
    prints = spark.createDataFrame(cells(1, row(4)) + cells(2, row(4, 2)) + cells(3, row(3, 4)) + cells(4, row(4, 6)) + cells(5, [(6, c) for c in range(4, 8)]), "tile int, r int, c int, footprint int")
    got = {(r["component"], r["footprint"]): (r["shared"], r["univocal"]) for r in P.component_matches(prints, members).collect()}
    assert got == {("a", 1): (4, True), ("d", 4): (4, False), ("d", 5): (4, False)}


def shape(ring):
    return {"area2": ring["area2"], "start": (ring["r0"], ring["c0"]), "corners": [tuple(p) for p in ring["corners"]]}


@pytest.mark.parametrize("seed", range(3))
def test_rings_of_random_cells(spark, seed):
    rng = random.Random(seed)
    cells = [(t, r, c) for t in range(2) for r in range(12) for c in range(12) if rng.random() < 0.6]
    members = tiles.components(spark.createDataFrame(cells, "tile long, r int, c int"), G.FOUR if seed else G.EIGHT)
    rows = members.collect()
    found = tiles.rings(members).collect()
    size, total = {}, {}
    for r in rows:
        size[r["component"]] = size.get(r["component"], 0) + 2
    for ring in found:
        total[ring["component"]] = total.get(ring["component"], 0) + ring["area2"]
        corners = [tuple(p) for p in ring["corners"]]
        assert corners[0] == (ring["r0"], ring["c0"]) == min(corners)
        turned = list(zip(corners, corners[1:] + corners[:1], strict=True))
        assert all((a[0] == b[0]) != (a[1] == b[1]) for a, b in turned)
        assert sum(a[1] * b[0] - b[1] * a[0] for a, b in turned) == ring["area2"]
        assert sum(abs(a[0] - b[0]) + abs(a[1] - b[1]) for a, b in turned) == ring["sides"]
    assert size == total
    assert all(sum(x["outer"] for x in found if x["component"] == k) == 1 for k in size) or seed == 0
    joined = P.closed_rings(P.cell_sides(members.select("tile", "component", "r", "c"), ["tile", "component"]), ["tile", "component"]).collect()
    key = lambda x: (x["component"], x["r0"], x["c0"], x["area2"], str(x["corners"]))
    assert sorted(map(key, joined)) == sorted(map(key, found))


def test_dissolved_equals_the_union_of_cells_and_does_not_depend_on_partitions(spark):
    rows = some_polygons()
    polygons = frame(spark, rows).withColumn("category", F.when(F.col("id") < 10, "a").otherwise("b")).withColumn("time", F.col("id") % 3)
    got = P.dissolved(polygons, ["category", "time"], 10).collect()
    area = {}
    for r in got:
        area[r["category"], r["time"]] = area.get((r["category"], r["time"]), 0) + r["area2"]
    want = {}
    for i, r, c in model(rows, 10)[0]:
        want.setdefault(("a" if i < 10 else "b", i % 3), set()).add((r, c))
    assert area == {k: 2 * len(v) for k, v in want.items()}
    again = P.dissolved(polygons.repartition(5, "time"), ["category", "time"], 10).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_layer_limits_from_both_sides(spark):
    ring = F.sequence(F.lit(1), F.when(F.col("id") == 0, 500_000).otherwise(1))
    frames = spark.range(2).select(F.col("id").alias("dataset"), F.lit(1).alias("frame"), F.array(ring).alias("rings"))
    more = frames.union(spark.range(1).select("id", F.lit(1), F.array(F.sequence(F.lit(1), F.lit(1))))).union(spark.range(367).select(F.lit(7), F.col("id"), F.array(F.sequence(F.lit(1), F.lit(1)))))
    assert {r["dataset"]: r["faults"] for r in P.layer_faults(frames).collect()} == {0: [], 1: []}
    assert {r["dataset"]: (r["coordinates"], r["faults"]) for r in P.layer_faults(more).collect()} == {0: (500_001, ["coordinates"]), 1: (1, []), 7: (367, ["frames"])}


def test_cycles_of_all_lengths(spark):
    rng, links, want, at = random.Random(1), [], {}, 0
    for n in (1, 2, 3, 7, 64, 65, 100):
        nodes = list(range(at, at + n))
        rng.shuffle(nodes)
        start = nodes.index(min(nodes))
        nodes, at = nodes[start:] + nodes[:start], at + n
        links += list(zip(nodes, nodes[1:] + nodes[:1], strict=True))
        want |= {x: (nodes[0], k) for k, x in enumerate(nodes)}
    got = graphs.cycles(spark.createDataFrame(links, "node long, next long"))
    assert {r["node"]: (r["cycle"], r["place"]) for r in got.collect()} == want


def test_least_boxes_of_turned_footprints(spark):
    rng, rows, want = random.Random(5), [], {}
    for k in range(60):
        angle = rng.uniform(-math.pi, math.pi)
        w, d = rng.randrange(2000, 4000), rng.randrange(500, 1500)
        turn = lambda x, y: (round(x * math.cos(angle) - y * math.sin(angle)), round(x * math.sin(angle) + y * math.cos(angle)))  # noqa: E731, B023
        ring = [turn(0, 0), turn(w, 0), turn(w, d), turn(0, d)]
        rows += [(k, 0, [ring[:3]]), (k, 1, [[ring[0], *ring[2:]]])]
        want[k] = (w, d, angle)
    rows += [(100, 0, [[(0, 0), (5, 5), (9, 9)]]), (101, 0, [[(0, 0), (10, 0), (10, 10), (0, 10)]]), (102, 0, [[(0, 0), (0, 30), (10, 30), (10, 0)]]), (103, 0, [])]
    got = {r["id"]: r for r in P.least_boxes(frame(spark, rows)).collect()}
    for k, (w, d, angle) in want.items():
        turned = abs((got[k]["yaw"] - angle + math.pi / 2) % math.pi - math.pi / 2)
        assert abs(got[k]["width"] - w) < 3 and abs(got[k]["depth"] - d) < 3 and turned < 0.002
        assert -math.pi / 2 <= got[k]["yaw"] < math.pi / 2
    assert got[100]["width"] is None and 103 not in got
    assert tuple(got[101])[1:] == (10.0, 10.0, 0.0)
    assert tuple(got[102])[1:] == (30.0, 10.0, round(-math.pi / 2, 9))


def test_hull_of_hulls_is_the_whole_hull():
    rng = np.random.default_rng(2)
    points = rng.integers(-50, 50, (300, 2)).astype(float)
    parts = np.concatenate([P._hull(x) for x in np.array_split(points, 7)])
    assert P._hull(parts).tolist() == P._hull(points).tolist()


def test_windows_refuse_repeats_and_wide_tiles(spark):
    cells = lambda *rows: spark.createDataFrame(rows, "tile long, r int, c int, v long")
    for bad, what in ((cells((1, 0, 0, 5), (1, 0, 0, 7)), "twice"), (cells((1, 0, 0, 5), (1, 10**6, 10**6, 7)), "span")):
        with pytest.raises(Exception, match=what):
            tiles.windows(bad, "v", 1, {"m": "max"}).collect()
