"""Operators on small constructed inputs with known answers."""

import heapq
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilework.functions import scalars as S
from tilework.operators import contracts, graphs, inventory, quality, scenes
from tilework.operators import grids as G
from tilework.operators import spatial as P
from tilework.operators import timelines as T
from tilework.sources import features, files
from tilework.streaming import progress


def plane(spark, n=8, up=0, tile=1):
    return spark.createDataFrame([(tile, r, c, 100_000 + c + r, 100_000 + c + r + up) for r in range(n) for c in range(n)], "tile long, r int, c int, mnt_mm long, mns_mm long")


def one(df, column):
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("metres", "mm"), [(0.0005, 1), (-0.0005, -1), (1.2344, 1234), (-2.5, -2500), (0.0, 0)])
def test_quantised_half_away_from_zero(spark, metres, mm):
    assert one(spark.range(1), G.quantised_mm(F.lit(metres))) == mm


@pytest.mark.parametrize(("value", "by", "want"), [(5, 10, 1), (-5, 10, -1), (4, 10, 0), (15, 10, 2), (-14, 10, -1)])
def test_rounded_division(spark, value, by, want):
    assert one(spark.range(1), G.rounded_div(F.lit(value), by)) == want


def test_gate_accepts_sparse_negatives_and_refuses_dense_or_deep_ones(spark):
    sparse = plane(spark, 600).withColumn("mns_mm", F.when((F.col("r") == 3) & (F.col("c") < 5), F.col("mnt_mm") - 600).otherwise(F.col("mns_mm")))
    dense = plane(spark).withColumn("mns_mm", F.col("mnt_mm") - 600)
    deep = plane(spark).withColumn("mns_mm", F.when(F.col("c") == 0, F.col("mnt_mm") - 1001).otherwise(F.col("mns_mm")))
    assert [G.grid_quality(x).first()["verdict"] for x in (sparse, dense, deep)] == ["ok", "negative", "misaligned"]


def test_degraded_tile_has_no_height(spark):
    bad = G.degraded(plane(spark).withColumn("mns_mm", F.col("mnt_mm") - 2000))
    assert bad.filter("mns_mm <> mnt_mm").count() == 0 and bad.first()["mode"] == "degraded_mns_fallback"


def test_box_window_against_numpy(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 50, (9, 9))
    df = spark.createDataFrame([(1, r, c, int(a[r, c])) for r in range(9) for c in range(9)], "tile long, r int, c int, v long")
    got = {(x["r"], x["c"]): (x["s"], x["s_n"]) for x in G.box_window(df, "v", 2, "sum", "s").collect()}
    for r in range(9):
        for c in range(9):
            w = a[max(0, r - 2) : r + 3, max(0, c - 2) : c + 3]
            assert got[r, c] == (w.sum(), w.size)


def test_components_four_and_eight(spark):
    df = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 1, 2), (1, 5, 5), (2, 0, 0)], "tile long, r int, c int")
    assert G.labelled_components(df, G.FOUR).select("component").distinct().count() == 4
    assert G.labelled_components(df, G.EIGHT).select("component").distinct().count() == 3


def test_components_of_a_long_path_and_no_edges(spark):
    path = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["component"] for r in graphs.components(path).collect()} == {0}
    assert graphs.components(path.limit(0)).count() == 0


def test_crowns_follow_steepest_ascent(spark):
    heights = [3, 5, 4, 2, 6, 9, 7]
    df = spark.createDataFrame([(1, 0, c, h) for c, h in enumerate(heights)], "tile long, r int, c int, h long")
    got = {r["c"]: int(r["crown"].split(":")[2]) for r in G.steepest_crowns(df, "h").collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 5, 4: 5, 5: 5, 6: 5}


def test_arrival_equals_dijkstra(spark):
    rng = np.random.default_rng(2)
    cost = rng.integers(1, 20, (7, 7))
    df = spark.createDataFrame([(1, r, c, int(cost[r, c])) for r in range(7) for c in range(7)], "tile long, r int, c int, w long")
    got = {(x["r"], x["c"]): x["arrival"] for x in G.least_cost_arrival(df, df.filter("r = 0 and c = 0"), F.col("w")).collect()}
    best, heap = {}, [(0, 0, 0)]
    while heap:
        d, r, c = heapq.heappop(heap)
        if (r, c) in best:
            continue
        best[r, c] = d
        for dr, dc in G.EIGHT:
            if 0 <= r + dr < 7 and 0 <= c + dc < 7:
                heapq.heappush(heap, (d + int(cost[r + dr, c + dc]), r + dr, c + dc))
    assert got == best


def test_seam_merge_and_its_two_exceptions(spark):
    rows = [("a", 1, "k1", False, 1), ("b", 2, "k1", False, 1), ("c", 1, "k2", True, 1), ("d", 2, "k2", True, 1), ("e", 1, "k3", False, 2), ("f", 2, "k3", False, 2), ("g", 3, "k4", False, 1)]
    got = dict(graphs.merged_identities(spark.createDataFrame(rows, "id string, tile int, key string, lattice boolean, tiles int")).collect())
    assert got == {"a": "a", "b": "a", "c": "c", "d": "d", "e": "e", "f": "f", "g": "g"}


def test_nearest_fill_and_unreachable(spark):
    df = spark.createDataFrame([(1, 0, c, v) for c, v in enumerate([5, None, None, 9])] + [(2, 0, 0, None)], "tile long, r int, c int, v long")
    got = {(r["tile"], r["c"]): r["filled"] for r in G.nearest_valid_fill(df, "v", F.col("v").isNotNull(), 8).collect()}
    assert got == {(1, 0): 5, (1, 1): 5, (1, 2): 9, (1, 3): 9, (2, 0): None}


def test_as_of_never_carries_forward(spark):
    frames = spark.createDataFrame([("d", 1, 0, 10), ("d", 2, 20, 30), ("d", 3, 25, 26)], "dataset string, event_id long, valid_from long, valid_to long")
    moments = spark.createDataFrame([("d", t) for t in (5, 15, 25, 31)], "dataset string, t long")
    got = {r["t"]: r["frame"] for r in T.as_of(frames, moments, 7).collect()}
    assert got == {5: 1, 15: None, 25: 3, 31: None}


@pytest.mark.parametrize("elapsed,area,rate,want", [
    (60, 90_000, 0.3, "incipient"), (61, 90_000, 0.3, "established"), (7_200, 1_000, 0.05, "incipient"), (7_200, 1_001, 0.05, "slowed"),
    (61, 1_001, 0.01, "stalled"), (61, 1_001, 0.011, "slowed"), (3_000, 44_000, 0.079, "slowed"), (3_000, 44_000, 0.08, "established"),
])
def test_fire_regime_on_both_sides_of_its_limits(spark, elapsed, area, rate, want):
    assert one(spark.range(1), S.fire_regime(F.lit(elapsed), F.lit(area), F.lit(rate))) == want


def test_projection_origin_and_tile_snap(spark):
    east, north = S.lambert93(F.lit(3.0), F.lit(46.5))
    row = spark.range(1).select(F.round(east, 3).alias("e"), F.round(north, 3).alias("n")).first()
    assert (row["e"], row["n"]) == (700_000.0, 6_600_000.0)
    assert one(spark.range(1), S.snapped_owner_tile(F.lit(499.95), 500, 0.1, 1000)) == 500


def test_numeric_property(spark):
    props = F.create_map(*map(F.lit, ("Hauteur", "6,5 m", "flag", "true")))
    assert one(spark.range(1), S.numeric_property(props, ["flag", "hauteur"])) == 6.5


def test_point_in_polygon(spark):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0))))
    assert one(spark.range(1), S.contains(ring, F.lit(1.0), F.lit(1.0))) and not one(spark.range(1), S.contains(ring, F.lit(5.0), F.lit(1.0)))


def test_square_plan_counts(spark):
    plan = P.square_plan(spark.createDataFrame([("z", 750, 750, 1500)], "zone string, cx long, cy long, side long"), 500)
    assert plan.count() == 9 and plan.agg(F.max("x")).first()[0] == 1000


def test_violations_list_null_as_broken(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, v int")
    assert [tuple(r) for r in quality.violations(df, ["id"], {"positive": F.col("v") > 0}).collect()] == [(2, "positive")]


def test_files_that_are_one_feature_or_a_bare_geometry(spark, tmp_path):
    ring = [[[0, 0], [4, 0], [4, 4], [0, 0]]]
    polygon, line = {"type": "Polygon", "coordinates": ring}, {"type": "LineString", "coordinates": [[0, 0], [5, 5]]}
    crs = {"properties": {"name": "urn:ogc:def:crs:EPSG::2154"}}
    for name, doc in {"one": {"type": "Feature", "id": "f", "crs": crs, "geometry": polygon, "properties": {"a": "b"}}, "bare": {**polygon, "crs": crs}, "line": {**line, "crs": crs}, "none": {"type": "FeatureCollection", "crs": crs}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    assert sorted((r["id"], (r["properties"] or {}).get("a")) for r in features.polygon_features(spark, str(tmp_path)).collect()) == [("0:0", None), ("f:0", "b")]
    assert [r["id"] for r in features.line_features(spark, str(tmp_path)).collect()] == ["0:0"]
    (tmp_path / "odd.json").write_text(json.dumps({"type": "Topology", "objects": {}}))
    with pytest.raises(Exception, match="no GeoJSON"):
        features.polygon_features(spark, str(tmp_path)).collect()


def test_temporary_tables_of_two_threads_stay_apart(spark):
    import threading

    from tilework.checkpoints import temporary, written

    inside, other, kept = threading.Event(), threading.Event(), []

    def slow():
        with temporary(spark) as stay:
            inside.set()
            assert other.wait(60)
            kept.append(stay(spark.range(3)))

    thread = threading.Thread(target=slow)
    thread.start()
    assert inside.wait(60)
    with temporary(spark) as stay:
        mine, gone = stay(spark.range(5)), written(spark.range(7))
    other.set()
    thread.join()
    assert (mine.count(), kept[0].count()) == (5, 3)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        gone.collect()


def test_polygon_and_line_scans(spark, tmp_path):
    square = [[[0, 0], [4, 0], [4, 4], [0, 0]]]
    doc = {"type": "FeatureCollection", "crs": {"properties": {"name": "urn:ogc:def:crs:EPSG::2154"}}, "features": [
        {"type": "Feature", "id": "b", "properties": {"h": "3"}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"type": "Feature", "properties": {"id": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [square, [[[0, 0], [1, 1], [2, 2], [0, 0]]]]}},
        {"type": "Feature", "id": "l", "properties": {}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [3, 4]]}},
        {"type": "Feature", "id": "p", "properties": {}, "geometry": {"type": "LineString", "coordinates": [[1, 1], [1, 1]]}}]}
    (tmp_path / "f.json").write_text(json.dumps(doc))
    found = {r["id"]: (r["epsg"], r["xmax"]) for r in features.polygon_features(spark, str(tmp_path / "f.json")).collect()}
    assert found == {"b:0": (2154, 4.0), "m:0": (2154, 4.0)}
    assert [r["id"] for r in features.line_features(spark, str(tmp_path / "f.json")).collect()] == ["l:0"]


def test_a_file_is_not_read_again_for_each_of_its_features(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "id": str(k), "properties": {"n": k}, "geometry": {"type": "LineString", "coordinates": [[k, 0], [k, 5]]}} for k in range(3000)]}
    (tmp_path / "f.json").write_text(json.dumps(doc))
    read = lambda: sum(x.getBytesRead() for x in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = read()
    rows = features.line_features(spark, str(tmp_path)).select("id", "ymax", F.col("properties")["n"].alias("n")).collect()
    assert sorted(map(tuple, rows)) == sorted((f"{k}:0", 5.0, str(k)) for k in range(3000))
    assert read() - before < 2 * (tmp_path / "f.json").stat().st_size


def test_documents_of_a_file(spark, tmp_path):
    one = lambda k: {"type": "Feature", "id": k, "properties": {"a": 1.5, "b": [1, {"c": None}]}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1e3, 5]]}}
    many = [{"type": "FeatureCollection", "numberMatched": "odd", "features": [one("p"), one("q")]}, one("r")]
    for name, text in {"one": json.dumps(one("o"), indent=1), "marked": "\ufeff" + json.dumps(one("m")), "many": "\n " + json.dumps(many), "blank": " \n", "empty": ""}.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    got = {r["id"]: (r["xmax"], r["properties"]) for r in features.line_features(spark, str(tmp_path)).collect()}
    assert got == {f"{k}:0": (1000.0, {"a": "1.5", "b": '[1,{"c":null}]'}) for k in "opqrm"}
    for broken in ('{"type": "Feature", "id"', '[{"type": "Feature"}, {', "word", "null"):
        (tmp_path / "broken.json").write_text(broken)
        with pytest.raises(Exception, match="no GeoJSON"):
            features.line_features(spark, str(tmp_path)).collect()


def test_paged_layer_gate(spark, tmp_path):
    page = lambda ids, n: json.dumps({"type": "FeatureCollection", "numberMatched": n, "features": [{"type": "Feature", "id": i, "properties": {}, "geometry": {"type": "Point", "coordinates": [0, 0]}} for i in ids]})
    (tmp_path / "1.json").write_text(page(["a", "b"], 3))
    (tmp_path / "2.json").write_text(page(["c"], 3))
    assert features.paged_layer(spark, str(tmp_path)).count() == 3
    (tmp_path / "2.json").write_text(page(["b"], 3))
    with pytest.raises(Exception, match="an id repeats"):
        features.paged_layer(spark, str(tmp_path)).collect()


def test_timeline_faults(spark, tmp_path):
    doc = {"id": "d", "name": "n", "timeline": [{"id": "1", "timestamp": "2024-01-01T00:00:00Z", "affected": "x"}, {"id": "2", "timestamp": "2024-01-02T00:00:00", "affected": "x"}, {"id": "3", "timestamp": "2024-01-02T00:00:00+02:00", "valid_from": "2024-01-03T00:00:00Z"}]}
    (tmp_path / "t.json").write_text(json.dumps(doc))
    got = {r["id"]: r["faults"] for r in features.timeline_frames(spark, str(tmp_path / "t.json")).collect()}
    assert got["1"] == [] and "timestamp" in got["2"] and {"open_interval", "no_geometry"} <= set(got["3"])


def test_rasters_points_and_inventory(spark, tmp_path):
    (tmp_path / "r").mkdir()
    np.savez(tmp_path / "r" / "t1.npz", mnt=np.arange(6.0).reshape(2, 3), mns=np.arange(6.0).reshape(2, 3) + 1)
    rows = files.raster_cells(spark, str(tmp_path / "r"))
    assert rows.count() == 6 and rows.filter("mns - mnt = 1").count() == 6
    (tmp_path / "p").mkdir()
    for k, n in (("a", 3), ("b", 2)):
        np.savez(tmp_path / "p" / f"{k}.npz", positions=np.zeros((n, 3)), heights=np.full(n, 5.0), crowns=np.full(n, 1.0), variants=np.array([0, 9, 1][:n]))
    points = files.point_tiles(spark, str(tmp_path / "p"))
    assert sorted(r["number"] for r in points.collect()) == list(range(5)) and points.filter("size(faults) > 0").count() == 2
    assert files.file_inventory(spark, str(tmp_path)).count() == 3


def test_height_tiles_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 2, 7), (1, 1, 1, 0)], "tile long, r int, c int, hag long")
    files.write_heights(rows, str(tmp_path / "h"))
    assert sorted(map(tuple, files.read_heights(spark, str(tmp_path / "h")).collect())) == [(1, 0, 0, 5), (1, 0, 2, 7), (1, 1, 1, 0)]


def test_append_refuses_repeated_captures(spark, tmp_path):
    rows = spark.createDataFrame([(1, "k", 1, 1), (2, "k", 1, 2)], "capture_id long, kind string, day int, zoom int")
    assert files.append_captures(rows, str(tmp_path / "c")).count() == 0
    more = rows.union(spark.createDataFrame([(3, "k", 2, 1)], rows.schema))
    assert sorted(r["capture_id"] for r in files.append_captures(more, str(tmp_path / "c")).collect()) == [1, 2]
    assert spark.read.parquet(str(tmp_path / "c")).count() == 3


CAPTURE = "capture_id long, kind string, day int, zoom int"


def test_an_interrupted_append_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = spark.createDataFrame([(k, "k", 1, 1) for k in range(50)], CAPTURE)
    assert files.append_captures(rows.limit(0), path).count() == 0  # an append of nothing
    broken = rows.union(spark.createDataFrame([(99, "k", 1, 1)], CAPTURE)).repartition(4)
    late = F.when(F.col("capture_id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("day")).cast("int")
    with pytest.raises(Exception, match="lost"):
        files.append_captures(broken.withColumn("day", late), path)
    assert spark.read.schema(f"{CAPTURE}, v int").parquet(path).count() == 0
    assert not [x for x in (tmp_path / "c").iterdir() if x.name.startswith("_staged")]
    files.append_captures(rows, path)
    assert spark.read.schema(f"{CAPTURE}, v int").parquet(path).count() == 50


def test_two_appends_at_the_same_time_store_a_key_once(spark, tmp_path, monkeypatch):
    path, real, others = str(tmp_path / "c"), files._committed, []
    mine, other = (spark.createDataFrame([(k, "k", 1, 1) for k in ids], CAPTURE) for ids in ((1, 2, 3), (3, 4)))

    def slow(session, staged, at):
        if not others:
            others.append(True)
            files.append_captures(other, path)
        return real(session, staged, at)

    monkeypatch.setattr(files, "_committed", slow)
    refused = files.append_captures(mine, path)
    assert [r["capture_id"] for r in refused.collect()] == [3]
    stored = spark.read.schema(f"{CAPTURE}, v int").parquet(path).collect()
    assert sorted((r["capture_id"], r["v"]) for r in stored) == [(1, 2), (2, 2), (3, 1), (4, 1)]


def test_stalled_sessions_close_behind_the_watermark(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 02:00:00")], "job string, at string").withColumn("at", F.to_timestamp("at"))
    rows.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    got = progress.drained(progress.inactive_sessions(stream, "job", "at", "8 minutes", "1 minute"), "append").collect()
    assert [(r["job"], r["events"]) for r in got] == [("a", 2)]


def test_sink_may_see_a_batch_again(spark, tmp_path):
    sink = progress.once(["id"], str(tmp_path / "s"))
    a, b = spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(2,), (3,)], "id int")
    for batch, epoch in ((a, 0), (b, 1), (b, 1)):
        sink(batch, epoch)
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [1, 2, 3]


def test_every_outline_corner_is_entered_as_often_as_left(spark):
    from tilework.operators import inventory

    members = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 2, 2)], "tile long, r int, c int")
    sides = [tuple(r) for r in inventory.outlines(members).select("r0", "c0", "r1", "c1").collect()]
    assert sorted(s[:2] for s in sides) == sorted(s[2:] for s in sides)
    assert sum(a * d - c * b for a, b, c, d in sides) in (8, -8)


def test_inventory_profiles_and_bad_grids(spark):
    from tilework.operators import inventory

    flat = plane(spark, 20).withColumn("vegetation", F.lit(True)).withColumn("footprint", F.lit(None).cast("long"))
    inside = F.col("r").between(5, 10) & F.col("c").between(5, 10)
    roof = flat.withColumn("mns_mm", F.when(inside, F.col("mnt_mm") + 7345).otherwise(F.col("mns_mm"))).withColumn("footprint", F.when(inside, F.lit(7)).cast("long")).withColumn("vegetation", ~inside)
    for profile in ("v1", "v2"):
        got = inventory.placement_inventory(roof, profile).filter("family = 'building'").collect()
        assert [(r["status"], r["area"]) for r in got] == [("valid", 36)] and got[0]["height_cm"] in range(730, 740)
    bad = roof.withColumn("mns_mm", F.when(F.col("r") == 0, F.col("mnt_mm") - 5000).otherwise(F.col("mns_mm")))
    assert inventory.placement_inventory(bad, "v2").count() == 0
    with pytest.raises(Exception, match="misaligned"):
        inventory.placement_inventory(bad, "v2", "fail").collect()


def test_scanned_rasters_of_any_name_and_width_reach_the_inventory(spark, tmp_path):
    wide = 1040
    for name, west in (("tile_650000_6860000", 0), ("tile_650500_6860000", 7)):
        ground = np.full((40, wide), 100.0)
        surface = ground.copy()
        surface[5:15, 1005 - west : 1020 - west] += 8.0
        surface[6, 5] += 3.0
        np.savez(tmp_path / f"{name}.npz", mnt=ground, mns=surface)
    raw = files.raster_cells(spark, str(tmp_path)).withColumns({"mnt_mm": G.quantised_mm(F.col("mnt")).cast("long"), "mns_mm": G.quantised_mm(F.col("mns")).cast("long")})
    grid = raw.withColumn("hag", G.height_cm(F.col("mnt_mm"), F.col("mns_mm")))
    found = {r["component"]: r["n"] for r in G.labelled_components(grid.filter("hag >= 200").select("tile", "r", "c"), G.FOUR).groupBy("component").agg(F.count("*").alias("n")).collect()}
    assert found == {f"tile_650000_6860000:{at}": n for at, n in (("5:1005", 150), ("6:5", 1))} | {f"tile_650500_6860000:{at}": n for at, n in (("5:998", 150), ("6:5", 1))}
    sites = grid.select("tile", "r", "c", "mnt_mm", "mns_mm", F.lit(False).alias("vegetation"), F.lit(None).cast("long").alias("footprint"))
    rows = inventory.placement_inventory(sites, "v1").collect()
    assert {r["status"] for r in rows if r["family"] == "building" and r["area"] == 150} == {"ambiguous"} and len({r["tile"] for r in rows}) == 2


def test_components_equal_a_flood_fill(spark):
    rng = np.random.default_rng(3)
    mask = rng.random((30, 25)) < 0.55
    cells = [("a", int(r), int(c)) for r, c in zip(*np.nonzero(mask), strict=True)]
    got = {(x["r"], x["c"]): x["component"] for x in G.labelled_components(spark.createDataFrame(cells, "tile string, r int, c int"), G.FOUR).collect()}
    seen = {}
    for _, r, c in sorted(cells):
        if (r, c) not in seen:
            todo = [(r, c)]
            while todo:
                at = todo.pop()
                if at not in seen and at in got:
                    seen[at] = f"a:{r}:{c}"
                    todo += [(at[0] + a, at[1] + b) for a, b in G.FOUR]
    assert got == seen


def test_diverse_picks_are_greedy_over_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(scenes, "ROUND", 7)
    rng = np.random.default_rng(4)
    rows = [(k, int(x), int(y), int(s)) for k, (x, y, s) in enumerate(zip(rng.integers(0, 1000, 200), rng.integers(0, 1000, 200), rng.integers(0, 40, 200), strict=True))]
    want = []
    for k, x, y, s in sorted(rows, key=lambda r: (-r[3], r[0])):
        if len(want) < 9 and all((x - a) ** 2 + (y - b) ** 2 >= 250**2 for _, a, b, _ in want):
            want.append((k, x, y, s))
    got = scenes.diverse_picks(spark.createDataFrame(rows, "id long, x long, y long, score long"), 9, 250).orderBy("place").collect()
    assert [r["id"] for r in got] == [k for k, *_ in want]


def test_hash_ranks_are_one_to_n_in_hash_order(spark):
    import hashlib

    df = spark.range(3000).withColumn("g", F.col("id") % 2)
    got = {(r["g"], r["place"]): r["id"] for r in T.hash_ranked(df, ["g"], "place", F.col("id").cast("string")).collect()}
    for g in (0, 1):
        order = sorted((k for k in range(3000) if k % 2 == g), key=lambda k: hashlib.sha256(str(k).encode()).hexdigest())
        assert [got[g, i + 1] for i in range(1500)] == order


def test_contracts_name_each_broken_rule(spark):
    rows = spark.createDataFrame([("z", "A", 1), ("z", "A", 1), ("z", "B", 5)], "zone string, layer string, id long")
    good = rows.filter("layer = 'B'").groupBy("zone", "layer").agg(F.count("*").alias("n"), contracts.checksum(F.col("id")).alias("sum"))
    told = good.union(spark.createDataFrame([("z", "A", 2, 0)], "zone string, layer string, n long, sum long"))
    assert {(r["layer"], r["fault"]) for r in contracts.zone_context(rows, told, ["A", "B", "C"]).collect()} == {("A", "id_repeated"), ("A", "count_differs"), ("A", "hash_differs"), ("C", "layer_missing")}
    at = spark.createDataFrame([(1, 499, 0, 0, 0, 0.0), (2, 500, 0, 0, 0, 6.2), (3, 7, 7, 1, 0, 6.3), (3, 7, 7, 0, 0, -0.1)], "id long, x long, y long, west long, south long, yaw double")
    assert {(r["id"], r["fault"]) for r in contracts.placements(at, 500).collect()} == {(2, "outside_owner"), (3, "owner_off_grid"), (3, "yaw"), (3, "id_repeated")}
    a, b = spark.createDataFrame([("k", 1), ("k", 1), ("k", 2)], "d string, v int"), spark.createDataFrame([("k", 1), ("k", 3)], "d string, v int")
    assert contracts.package_differences(a, b, "d").first().asDict() == {"d": "k", "rows": 2, "missing": 1, "unexpected": 2}


def test_an_own_loader_takes_the_place_of_the_archive(spark, tmp_path):
    (tmp_path / "t1.raw").write_bytes(bytes([1, 2, 3, 4]))
    load = lambda content: (np.frombuffer(content, np.uint8).reshape(2, 2), np.frombuffer(content, np.uint8).reshape(2, 2) + 1)
    assert [(r["tile"], r["r"], r["c"], r["mns"]) for r in files.raster_cells(spark, str(tmp_path), load, "*.raw").orderBy("r", "c").collect()] == [("t1", 0, 0, 2.0), ("t1", 0, 1, 3.0), ("t1", 1, 0, 4.0), ("t1", 1, 1, 5.0)]


def test_a_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    from types import SimpleNamespace as N

    from tilework import checkpoints

    unset = N(sc=lambda: N(getCheckpointDir=lambda: N(isDefined=lambda: False)))
    with pytest.raises(ValueError, match="checkpoint"):
        checkpoints.shared_dir(N(conf=N(get=lambda *_: None), sparkContext=N(_jsc=unset, master="spark://host:7077")))


def test_temporary_tables_go_and_the_kept_ones_stay(spark):
    from pathlib import Path

    from tilework import checkpoints

    where = Path(checkpoints.shared_dir(spark).removeprefix("file:"))
    before = set(where.glob("tilework-*"))
    with checkpoints.temporary(spark) as stay:
        checkpoints.written(spark.range(3))
        checkpoints.bucketed(spark.range(30), "id")
        kept = stay(spark.range(5))
    assert kept.count() == 5 and len(set(where.glob("tilework-*")) - before) == 1


def test_a_coordinate_of_no_known_system_is_an_error(spark):
    at = lambda d, x, y: one(spark.range(1), S.inferred_epsg(F.lit(d).cast("int"), F.lit(x).cast("double"), F.lit(y).cast("double")))
    assert (at(None, 180.0, 90.0), at(None, 2e6, 5e6), at(3857, 5e7, 5e7), at(None, None, None)) == (4326, 2154, 3857, None)
    with pytest.raises(Exception, match="no reference system"):
        at(None, 181.0, 45.0)
