"""Lines of sight against direct computation."""

import math
import random

import pytest

from tilework.operators import sight

RAY = "id long, x double, y double, z double, tx double, ty double, tz double, ignored long"
TREE = "tree long, x double, y double, radius double, base double, top double"
BOX = "box long, x double, y double, half double, low double, high double"


def model(ray, trees, boxes, ground, step):
    i, x, y, z, tx, ty, tz, ignored = ray
    d = math.hypot(tx - x, ty - y)
    if d == 0:
        return i, False, None, 0.0
    ux, uy = (tx - x) / d, (ty - y) / d
    along = lambda px, py: (px - x) * ux + (py - y) * uy
    beside = lambda px, py: abs((px - x) * uy - (py - y) * ux)
    height = lambda s: z + (tz - z) * min(1, max(0, s / d))
    hit = [s for _, px, py, radius, base, top in trees if 3 < (s := along(px, py)) < 180 and math.hypot(px - x, py - y) <= 180 and beside(px, py) < radius + 1.5 and base - 1 < height(s) < top + 1]
    hit = hit or [s for k, px, py, half, low, high in boxes if k != ignored and 2 < (s := along(px, py)) < d and beside(px, py) < half + 1 and low - 1 <= height(s) <= high + 1]
    if hit:
        return i, False, 0.0, min(hit)
    n = max(16, min(96, int(d / 40)))
    least = math.inf
    for k in range(n):
        f = 0.95 if k == n - 1 else 0.05 + k * (0.9 / (n - 1))
        u, v = (x + (tx - x) * f) / step, (y + (ty - y) * f) / step
        c, r = math.floor(u), math.floor(v)
        near = [(w, ground[r + a, c + b]) for a in (0, 1) for b in (0, 1) if (r + a, c + b) in ground and (w := ((v - r) if a else 1 - v + r) * ((u - c) if b else 1 - u + c)) > 0]
        if not near:
            return i, False, None, min(d, 180.0)
        least = min(least, z + (tz - z) * f - sum(w * g for w, g in near) / sum(w for w, _ in near))
    return i, least >= 1, least, min(d, 180.0)


def views(spark, rays, trees, boxes, ground, step=10.0):
    frames = spark.createDataFrame(rays, RAY), spark.createDataFrame(trees, TREE), spark.createDataFrame(boxes, BOX), spark.createDataFrame([(r, c, g) for (r, c), g in ground.items()], "r long, c long, ground double")
    return {r["id"]: tuple(r) for r in sight.clear_views(*frames, step).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_views_equal_a_direct_computation(spark, seed):
    rng = random.Random(seed)
    u = lambda lo, hi: round(rng.uniform(lo, hi), 3)
    ground = {(r, c): u(0, 6) for r in range(-42, 43) for c in range(-42, 43) if rng.random() < 0.97}
    rays = [(k, u(-350, 350), u(-350, 350), u(3, 25), u(-350, 350), u(-350, 350), u(3, 25), k % 7) for k in range(150)]
    rays += [(200, 5.0, 5.0, 9.0, 5.0, 300.0, 9.0, None), (201, 5.0, 5.0, 9.0, 5.0, -300.0, 9.0, 1), (202, 5.0, 5.0, 9.0, 200.0, 5.0, 9.0, 1), (203, 5.0, 5.0, 9.0, 5.0, 5.0, 9.0, 1)]
    trees = [(k, u(-350, 350), u(-350, 350), u(0.5, 4), 0.0, u(2, 18)) for k in range(150)]
    boxes = [(k, u(-350, 350), u(-350, 350), u(2, 14), 0.0, u(3, 15)) for k in range(40)]
    got = views(spark, rays, trees, boxes, ground)
    seen = set()
    for ray in rays:
        want = model(ray, trees, boxes, ground, 10.0)
        i, ok, clear, free = got[ray[0]]
        if ray[1:3] == ray[4:6]:
            assert (ok, free) == (False, 0.0)
            continue
        assert ok == want[1] and free == pytest.approx(want[3], abs=1e-9) and (clear is None) == (want[2] is None)
        assert clear is None or clear == pytest.approx(want[2], abs=1e-9)
        seen.add(ok)
    assert seen == {True, False}


def test_limits_from_both_sides(spark):
    """A ray due east at height 10 over ground at 9 and less."""
    flat = {(r, c): 0.0 for r in range(-2, 3) for c in range(-1, 45)}
    ray = lambda i, ignored=None: (i, 0.0, 0.0, 10.0, 400.0, 0.0, 10.0, ignored)
    tree = lambda x, y, radius, base, top: views(spark, [ray(1)], [(1, x, y, radius, base, top)], [], flat)[1][1]
    box = lambda x, y, low, high, ignored=None: views(spark, [ray(1, ignored)], [], [(1, x, y, 2.0, low, high)], flat)[1][1]
    assert not tree(3.001, 0.0, 1.0, 0.0, 20.0) and tree(3.0, 0.0, 1.0, 0.0, 20.0)
    assert not tree(50.0, 2.499, 1.0, 0.0, 20.0) and tree(50.0, 2.5, 1.0, 0.0, 20.0)
    assert not tree(179.9, 0.0, 1.0, 0.0, 20.0) and tree(180.0, 0.0, 1.0, 0.0, 20.0) and tree(179.99, 2.4, 1.0, 0.0, 20.0)
    assert not tree(50.0, 0.0, 1.0, 0.0, 9.001) and tree(50.0, 0.0, 1.0, 0.0, 9.0) and not tree(50.0, 0.0, 1.0, 10.999, 20.0) and tree(50.0, 0.0, 1.0, 11.0, 20.0)
    assert not box(2.001, 0.0, 0.0, 20.0) and box(2.0, 0.0, 0.0, 20.0) and not box(399.9, 0.0, 0.0, 20.0) and box(400.0, 0.0, 0.0, 20.0)
    assert not box(50.0, 0.0, 0.0, 9.0) and box(50.0, 0.0, 0.0, 8.999) and not box(50.0, 2.999, 0.0, 20.0) and box(50.0, 3.0, 0.0, 20.0)
    assert box(50.0, 0.0, 0.0, 20.0, ignored=1)
    raised = lambda g: views(spark, [ray(1)], [], [], {k: g for k in flat})[1]
    assert raised(9.0)[1] and raised(9.0)[2] == pytest.approx(1.0) and not raised(9.001)[1]
