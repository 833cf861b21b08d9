"""Contracts as rule columns: each takes rows and what they were declared to be, and returns one row per broken rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import violations


def checksum(*parts: Column) -> Column:
    """A sum over the rows' hashes: equal for equal rows in any order, and merged in part before a shuffle."""
    return F.sum(F.conv(F.substring(F.sha2(F.concat_ws("|", *(p.cast("string") for p in parts)), 256), 1, 8), 16, 10).cast("long"))


def zone_context(features: DataFrame, declared: DataFrame, layers: list[str]) -> DataFrame:
    """(zone, layer, fault): layers a zone lacks, ids that repeat in a layer, counts and checksums that differ from the declared ones.

    features: zone, layer, id.  declared: zone, layer, n, sum."""
    counted = features.groupBy("zone", "layer", "id").agg(F.count("*").alias("times"))
    found = counted.groupBy("zone", "layer").agg(F.count("*").alias("ids"), F.max("times").alias("times"), checksum(F.col("id")).alias("ids_sum"))
    wanted = declared.select("zone").distinct().withColumn("layer", F.explode(F.array(*map(F.lit, layers))))
    both = wanted.join(declared, ["zone", "layer"], "left").join(found, ["zone", "layer"], "left")
    there = F.col("ids").isNotNull() & F.col("n").isNotNull()
    return violations(both, ["zone", "layer"], {"layer_missing": there, "id_repeated": ~there | (F.col("times") == 1), "count_differs": ~there | (F.col("ids") == F.col("n")), "hash_differs": ~there | (F.col("ids_sum") == F.col("sum"))})


def point_cloud(points: DataFrame, metadata: DataFrame) -> DataFrame:
    """(tile, fault): counts unlike the metadata's, attributes that the narrow types don't hold, points beyond the bounds.

    points: tile, x, y, lossless (of files.compact_attributes).  metadata: tile, n, west, south, east, north."""
    found = points.join(metadata.select("tile", "west", "south", "east", "north"), "tile").groupBy("tile").agg(
        F.count("*").alias("points"), F.bool_and("lossless").alias("lossless"),
        F.bool_and((F.col("x") >= F.col("west")) & (F.col("x") < F.col("east")) & (F.col("y") >= F.col("south")) & (F.col("y") < F.col("north"))).alias("inside"),
    )
    both = metadata.select("tile", "n").join(found, "tile", "left")
    return violations(both, ["tile"], {"count": F.coalesce("points", F.lit(0)) == F.col("n"), "dtype": F.coalesce("lossless", F.lit(True)), "bounds": F.coalesce("inside", F.lit(True))})


def dataset_package(captures: DataFrame, manifest: DataFrame) -> DataFrame:
    """(day, fault): what a day's captures hold against the manifest's row for it.

    captures: capture_id, day, state, camera, zoom.  manifest: day, states, cameras, zooms, captures."""
    repeated = captures.groupBy("day", "capture_id").agg(F.count("*").alias("k")).groupBy("day").agg(F.max("k").alias("times"))
    found = captures.groupBy("day").agg(*(F.count_distinct(c).alias(f"found_{c}") for c in ("state", "camera", "zoom")), F.count("*").alias("found"))
    both = manifest.join(found, "day", "full").join(repeated, "day", "left")
    rules = {"states": F.col("found_state") == F.col("states"), "cameras": F.col("found_camera") == F.col("cameras"), "zooms": F.col("found_zoom") == F.col("zooms"), "captures": F.col("found") == F.col("captures"), "capture_repeated": F.col("times") == 1}
    return violations(both, ["day"], rules)


def package_differences(stored: DataFrame, recomputed: DataFrame, key: str) -> DataFrame:
    """(key, rows, missing, unexpected): a stored package against its rows made anew from the source, as multisets of whole rows."""
    sides = stored.withColumn("_side", F.lit(1)).unionByName(recomputed.withColumn("_side", F.lit(-1)))
    rows = sides.groupBy(*recomputed.columns).agg(F.sum("_side").alias("_more"), F.count_if(F.col("_side") < 0).alias("_n"))
    return rows.groupBy(key).agg(F.sum("_n").alias("rows"), F.sum(F.greatest(-F.col("_more"), F.lit(0))).alias("missing"), F.sum(F.greatest("_more", F.lit(0))).alias("unexpected"))


def publication_gate(captures: DataFrame, faults: DataFrame, locks: DataFrame, scope: DataFrame, zooms: int) -> DataFrame:
    """(dataset, captures, unclean, unlocked, unsafe, incomplete, in_scope, publishable).

    captures: dataset, capture_id, view, zoom, path, sha.  faults: capture_id, one row a fault.  locks: capture_id, sha at the audit.
    scope: dataset, expected captures."""
    from ..functions.scalars import unsafe_path

    bad = faults.select("capture_id").distinct().withColumn("bad", F.lit(True))
    rows = captures.join(bad, "capture_id", "left").join(locks.select("capture_id", F.col("sha").alias("locked")), "capture_id", "left")
    views = captures.groupBy("dataset", "view").agg(F.count_distinct("zoom").alias("zooms")).groupBy("dataset").agg(F.count_if(F.col("zooms") != zooms).alias("incomplete"))
    found = rows.groupBy("dataset").agg(
        F.count("*").alias("captures"), F.count_if(F.col("bad")).alias("unclean"), F.count_if(~F.coalesce(F.col("locked") == F.col("sha"), F.lit(False))).alias("unlocked"), F.count_if(unsafe_path(F.col("path")).isNotNull()).alias("unsafe")
    )
    both = found.join(views, "dataset").join(scope, "dataset", "left").withColumn("in_scope", F.coalesce(F.col("captures") == F.col("expected"), F.lit(False))).drop("expected")
    clean = F.col("unclean") + F.col("unlocked") + F.col("unsafe") + F.col("incomplete") == 0
    return both.withColumn("publishable", clean & F.col("in_scope"))


def placements(rows: DataFrame, side: int) -> DataFrame:
    """(id, fault): owners off the grid, points outside their owner, repeated ids, yaw outside [0, 2 pi).

    rows: id, x, y, west, south, yaw."""
    n = rows.groupBy("id").agg(F.count("*").alias("times"))
    west, south = F.col("west"), F.col("south")
    rules = {
        "owner_off_grid": (west % side == 0) & (south % side == 0), "outside_owner": (F.col("x") >= west) & (F.col("x") < west + side) & (F.col("y") >= south) & (F.col("y") < south + side),
        "id_repeated": F.col("times") == 1, "yaw": (F.col("yaw") >= 0) & (F.col("yaw") < 2 * 3.141592653589793),
    }
    return violations(rows.join(n, "id"), ["id"], rules).distinct()


def inventory_v2(candidates: DataFrame, profile: str, statuses: list[str]) -> DataFrame:
    """(id, fault): a foreign profile, a building without footprint authority, an asset given to context, an unknown refinement status.

    candidates: id, profile, family, authority, asset, refinement."""
    building, context = F.col("family") == "building", F.col("family") == "context"
    rules = {"profile": F.col("profile") == profile, "authority": ~building | F.coalesce(F.col("authority") == "footprint", F.lit(False)), "context_asset": ~context | F.col("asset").isNull(), "refinement": F.col("refinement").isin(statuses)}
    return violations(candidates, ["id"], rules)


def catalog(assets: DataFrame, counts: DataFrame, id_pattern: str) -> DataFrame:
    """(category, fault, n): ids and hashes that don't match their patterns, repeated ids, counts unlike the declared ones.

    assets: id, category, sha.  counts: category, declared."""
    times = assets.groupBy("category", "id").agg(F.count("*").alias("k"), F.first("sha").alias("sha"))
    found = times.groupBy("category").agg(F.sum("k").alias("n"), F.count_if(~F.col("id").rlike(id_pattern)).alias("id_pattern"), F.count_if(~F.coalesce(F.col("sha").rlike("^[0-9a-f]{64}$"), F.lit(False))).alias("hash_pattern"), F.count_if(F.col("k") > 1).alias("id_repeated"))
    both = counts.join(found, "category", "full").withColumn("count", F.when(F.coalesce("n", F.lit(0)) != F.coalesce("declared", F.lit(0)), F.lit(1)).otherwise(0))
    cases = F.array(*(F.struct(F.lit(c).alias("fault"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("n")) for c in ("id_pattern", "hash_pattern", "id_repeated", "count")))
    return both.select("category", F.explode(cases).alias("f")).select("category", "f.fault", "f.n").filter("n > 0")


def required_paths(documents: DataFrame, key: str, column: str, paths: list[str], vectors: dict[str, int]) -> DataFrame:
    """(key, fault): dotted paths of a nested column that are null, and vectors without exactly so many finite parts."""
    at = lambda p: F.col(f"{column}.{p}")
    rules = {f"missing {p}": at(p).isNotNull() for p in paths}
    for p, n in vectors.items():
        rules[f"vector {p}"] = (F.size(at(p)) == n) & F.forall(at(p), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return violations(documents, [key], rules)


def unit_quaternions(documents: DataFrame, key: str, quaternion: str, tolerance: float = 1e-3) -> DataFrame:
    """(key, fault) where a quaternion's length is not one within the tolerance."""
    length = F.sqrt(F.aggregate(F.col(quaternion), F.lit(0.0), lambda s, x: s + x * x))
    return violations(documents, [key], {"quaternion": F.abs(length - 1) <= tolerance})


#: What a scheduled view repeats of its camera (view column: camera column), in these terms exactly and in those within a
#: thousandth; the zooms of a view; the views of a state by sample kind and by profile; and the contracts' own words.
SAME = {
    "camera_role": "role", "placement_type": "placement_type", "capture_device_profile": "capture_device_profile", "framing_style": "framing_style", "placement_contract": "placement_contract",
    "access_surface": "access_surface", "access_tile": "access_tile", "host_building": "host_building", "sample_kind": "sample_capability", "expected_fire_visible": "expected_fire_in_frame", "thermal_expected": "thermal_capture",
    "position_local_m": "position_local_m", "position_l93_ngf_ign69_m": "position_l93_ngf_ign69_m", "look_at_local_m": "target_local_m", "fire_target_local_m": "fire_target_local_m",
}
NEAR = ("fire_bearing_offset_degrees", "focal_length_mm", "focal_length_35mm_equivalent_mm", "horizontal_aperture_mm", "vertical_aperture_mm")
WITHIN = 0.001
ZOOMS = (0.75, 1.0, 1.25, 1.5, 2.0)
KINDS = {"positive_fire": 16, "negative_context": 4}
PROFILES = {"professional": 10, "phone": 8, "aerial": 2}
THERMAL = ("synthetic_16bit_kelvin_non_radiometric", ("synthetic_thermal_kelvin", "synthetic_thermal_16bit", "thermal_metadata"))
TURNED = "camera_rotated_away_from_fire_for_context_control"
STATES_A_DAY, STATE_S = 10, 8640


def schedule_view_faults(views: DataFrame, cameras: DataFrame, package: str) -> DataFrame:
    """(capture_id, fault) of scheduled views against the cameras of the pool, one row a fault; a value that is missing where its camera has
    one is a fault, two missing ones agree.

    views: capture_id, plan_id, camera_id, state, day_index, state_in_day, observation_elapsed_s, camera_path, the columns of SAME and NEAR,
    thermal_contract, expected_modalities, negative_reason, line_of_sight_verified, selection_token_sha256 and zooms, an array of
    (capture_id, zoom_multiplier, focal_length_mm, horizontal_aperture_mm, selection_token_sha256).
    """
    held = cameras.select("camera_id", F.struct(*sorted({*SAME.values(), *NEAR})).alias("pool"))
    both = views.join(held, "camera_id", "left")
    near = lambda a, b: F.abs(a - b) < WITHIN
    token = lambda name: F.sha2(F.concat(F.lit(f"{package}|"), name), 256)
    thermal, words = F.col("thermal_expected"), F.array(*map(F.lit, THERMAL[1]))
    warm = (F.col("thermal_contract") == THERMAL[0]) & (F.size(F.array_except(words, "expected_modalities")) == 0)
    cold = F.col("thermal_contract").isNull() & ~F.array_contains("expected_modalities", THERMAL[1][1])
    zooms, first = F.col("zooms"), F.col("state") - 1
    rules = {
        "camera": F.col("pool").isNotNull(),
        **{mine: F.col(mine).eqNullSafe(F.col(f"pool.{theirs}")) for mine, theirs in SAME.items()},
        **{c: near(F.col(c), F.col(f"pool.{c}")) for c in NEAR},
        "plan_id": F.col("plan_id") == F.col("capture_id"),
        "camera_path": F.col("camera_path") == F.concat(F.lit("/World/Cameras/"), "camera_id"),
        "day_index": F.col("day_index") == F.floor(first / STATES_A_DAY) + 1,
        "state_in_day": F.col("state_in_day") == first % STATES_A_DAY + 1,
        "observation_elapsed_s": F.col("observation_elapsed_s") == first * STATE_S,
        "thermal_role": thermal == (F.col("pool.role") == "aerial"),
        "thermal_contract": F.when(thermal, warm).otherwise(cold),
        "negative_reason": F.col("negative_reason").eqNullSafe(F.when(F.col("sample_kind") == "negative_context", TURNED)),
        "line_of_sight": F.col("line_of_sight_verified"),
        "token": F.col("selection_token_sha256") == token(F.col("capture_id")),
        "zooms": F.transform(zooms, lambda z: z["zoom_multiplier"]) == F.array(*map(F.lit, ZOOMS)),
        "zoom_ids": F.size(F.array_distinct(F.transform(zooms, lambda z: z["capture_id"]))) == len(ZOOMS),
        "zoom_focal": F.forall(zooms, lambda z: near(z["focal_length_mm"], F.col("pool.focal_length_mm") * z["zoom_multiplier"])),
        "zoom_aperture": F.forall(zooms, lambda z: z["horizontal_aperture_mm"] == F.col("pool.horizontal_aperture_mm")),
        "zoom_token": F.forall(zooms, lambda z: z["selection_token_sha256"] == token(z["capture_id"])),
    }
    return violations(both, ["capture_id"], rules)


def schedule_state_faults(views: DataFrame) -> DataFrame:
    """(state, fault) of a schedule's states: views by sample kind and by camera profile (column profile), and repeated cameras."""
    counts = lambda column, wanted: [F.count_if(F.col(column) == name).alias(name) for name in wanted]
    found = views.groupBy("state").agg(*counts("sample_kind", KINDS), *counts("profile", PROFILES), F.count("*").alias("views"), F.count_distinct("camera_id").alias("cameras"))
    rules = {name: F.col(name) == n for name, n in {**KINDS, **PROFILES}.items()} | {"views": F.col("views") == sum(KINDS.values()), "cameras": F.col("cameras") == F.col("views")}
    return violations(found, ["state"], rules)
