"""Refined occupancy, placed instances and sealed packages at their limits."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tilework.operators import grids as G
from tilework.operators import quality as Q
from tilework.operators import scenes


def test_occupancy_equals_a_bilinear_sample(spark):
    rng, size = random.Random(4), 7
    cells = {(r, c) for r in range(size) for c in range(size) if rng.random() < 0.4}
    got = {(x["r"], x["c"]): x["ninths"] for x in G.refined_occupancy(spark.createDataFrame([(1, r, c) for r, c in cells], "tile long, r int, c int"), size, size).collect()}
    want = {}
    for sr, sc in itertools.product(range(3 * size), repeat=2):
        y, x = (sr + 0.5) / 3 - 0.5, (sc + 0.5) / 3 - 0.5
        share = sum(max(0, 1 - abs(r - y)) * max(0, 1 - abs(c - x)) for r, c in cells)
        if share >= 0.42:
            want[sr, sc] = round(9 * share)
    assert got == want and 4 in want.values() and 9 in want.values()


def candidate(id_, family, **own):
    base = {"id": id_, "family": family, "asset": "a", "x": 103.5, "y": 207.25, "ground_mm": 1500, "height_cm": 800, "width": 12.0, "depth": 6.0, "yaw": 0.5, "seed": 0, "ox": 100.0, "oy": 200.0}
    return base | own


KINDS = "id long, family string, asset string, x double, y double, ground_mm long, height_cm long, width double, depth double, yaw double, seed decimal(20,0), ox double, oy double"


def placed(spark, rows):
    from decimal import Decimal

    frame = spark.createDataFrame([tuple({**r, "seed": Decimal(r["seed"])}.values()) for r in rows], KINDS)
    prototypes = spark.createDataFrame([("a", 4.0, 2.0, 3.0)], "asset string, ex double, ey double, ez double")
    return {r["id"]: r for r in scenes.instances(frame, prototypes).collect()}


def test_instances_by_family(spark):
    got = placed(spark, [candidate(1, "buildings"), candidate(2, "trees", seed=1 << 62), candidate(3, "context_assets", yaw=None), candidate(4, "buildings", yaw=-math.pi / 2)])
    size = lambda r: (r["sx"], r["sy"], r["sz"])
    turned = lambda r: (r["qw"], r["qx"], r["qy"], r["qz"])
    at = lambda yaw: pytest.approx(tuple(f(yaw / 2) * math.sqrt(0.5) for f in (math.cos, math.cos, math.sin, math.sin)))
    assert size(got[1]) == (3.0, 4.0, 2.0) and size(got[2]) == (4.0, 4.0, 4.0) and size(got[3]) == (1.0, 1.0, 1.0)
    assert turned(got[1]) == at(0.5) and turned(got[2]) == at(math.pi / 2) and turned(got[3]) == at(0) and turned(got[4]) == at(-math.pi / 2)
    assert all((r["px"], r["py"], r["pz"]) == (3.5, 7.25, 1.5) and sum(q * q for q in turned(r)) == pytest.approx(1) for r in got.values())


@pytest.mark.parametrize(("own", "what"), [({"asset": "none"}, "no prototype"), ({"family": "fences"}, "unknown family"), ({"width": 0.0}, "invalid scale"), ({"depth": None}, "invalid scale"), ({"yaw": None}, "yaw")])
def test_instances_fail_closed(spark, own, what):
    with pytest.raises(Exception, match=what):
        placed(spark, [candidate(1, "buildings") | own])


def test_local_origin_rounds_half_away_and_axes_turn(spark):
    box = spark.createDataFrame([(0.0, -3.0, 3.0, 0.0, 7.9), (1.0, -1.0, 5.0, -2.0, -0.5)], "xmin double, ymin double, xmax double, ymax double, zmin double")
    assert tuple(scenes.local_origin(box).first()) == (3, -2, -1)
    half = spark.createDataFrame([(0.0, -5.0, 5.0, 0.0, 0.0)], box.schema)
    assert tuple(scenes.local_origin(half).first()) == (3, -3, 0)
    axes = [a.alias(n) for a, n in zip(scenes.viewer_axes(F.lit(1.0), F.lit(2.0), F.lit(3.0)), "xyz", strict=True)]
    assert tuple(spark.range(1).select(*axes).first()) == (1.0, -3.0, 2.0)


def test_each_fault_of_a_package(spark):
    files = "package string, path string, bytes long, sha256 string"
    listing = spark.createDataFrame([("p", "a", 1, "x"), ("p", "extra", 1, "x"), ("p", "b", 2, "x"), ("p", "c", 1, "y"), ("p", "../d", 1, "x"), ("p", "/e", 1, "x"), ("q", "a", 1, "x"), ("s", "f", 1, "x")], files)
    sealed = [("p", "a", 1, "x"), ("p", "gone", 1, "x"), ("p", "b", 1, "x"), ("p", "c", 1, "x"), ("p", "../d", 1, "x"), ("p", "/e", 1, "x"), ("q", "a", 1, "x"), ("s", "f", 1, "x"), ("s", "f", 1, "x"), ("r", "z", 1, "x")]
    declared = spark.createDataFrame([("p", 5, 8), ("q", 1, 1), ("r", 1, 1)], "package string, files long, bytes long")
    got = sorted((r["package"], r["path"] or "", r["fault"]) for r in Q.package_faults(listing, spark.createDataFrame(sealed, files), declared).collect())
    want = [("p", "", "bytes"), ("p", "", "files"), ("p", "../d", "unsafe"), ("p", "/e", "unsafe"), ("p", "b", "size"), ("p", "c", "hash"), ("p", "extra", "unexpected"), ("p", "gone", "missing")]
    want += [("r", "", "bytes"), ("r", "", "files"), ("r", "z", "missing"), ("s", "", "undeclared"), ("s", "f", "repeated")]
    assert got == sorted(want)
