"""Scheduled views against their cameras: a whole schedule has no fault, and each broken value is one."""

import copy
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tilework.operators import contracts as C
from tilework.operators import quality as Q

POINT = "array<double>"
CAMERA = "camera_id string, role string, placement_type string, capture_device_profile string, framing_style string, placement_contract string, access_surface string, access_tile string, host_building string, sample_capability string, expected_fire_in_frame boolean, thermal_capture boolean, position_local_m array<double>, position_l93_ngf_ign69_m array<double>, target_local_m array<double>, fire_target_local_m array<double>, fire_bearing_offset_degrees double, focal_length_mm double, focal_length_35mm_equivalent_mm double, horizontal_aperture_mm double, vertical_aperture_mm double"
ZOOM = "array<struct<capture_id:string,zoom_multiplier:double,focal_length_mm:double,horizontal_aperture_mm:double,selection_token_sha256:string>>"
VIEW = "capture_id string, plan_id string, camera_id string, state long, day_index long, state_in_day long, observation_elapsed_s long, camera_path string, camera_role string, placement_type string, capture_device_profile string, framing_style string, placement_contract string, access_surface string, access_tile string, host_building string, sample_kind string, expected_fire_visible boolean, thermal_expected boolean, position_local_m array<double>, position_l93_ngf_ign69_m array<double>, look_at_local_m array<double>, fire_target_local_m array<double>, fire_bearing_offset_degrees double, focal_length_mm double, focal_length_35mm_equivalent_mm double, horizontal_aperture_mm double, vertical_aperture_mm double, thermal_contract string, expected_modalities array<string>, negative_reason string, line_of_sight_verified boolean, selection_token_sha256 string, profile string, zooms " + ZOOM


def sha(name):
    return hashlib.sha256(f"pack|{name}".encode()).hexdigest()


def camera(k, kind, profile):
    air = profile == "aerial"
    return {"camera_id": f"c{k}", "role": "aerial" if air else "ground", "placement_type": "t", "capture_device_profile": "d", "framing_style": "f", "placement_contract": "p", "access_surface": None if air else "road", "access_tile": None, "host_building": None, "sample_capability": kind, "expected_fire_in_frame": kind == "positive_fire", "thermal_capture": air, "position_local_m": [1.0, k, 2.0], "position_l93_ngf_ign69_m": [9.0, k, 2.0], "target_local_m": [0.0, 0.0, 0.0], "fire_target_local_m": [1.0, 1.0, 1.0], "fire_bearing_offset_degrees": 3.0, "focal_length_mm": 35.0, "focal_length_35mm_equivalent_mm": 50.0, "horizontal_aperture_mm": 36.0, "vertical_aperture_mm": 24.0}


def view(cam, profile, state):
    name = f"s{state}_{cam['camera_id']}"
    own = {mine: cam[theirs] for mine, theirs in C.SAME.items()} | {c: cam[c] for c in C.NEAR}
    air = profile == "aerial"
    zooms = [{"capture_id": f"{name}_z{k}", "zoom_multiplier": z, "focal_length_mm": 35.0 * z, "horizontal_aperture_mm": 36.0, "selection_token_sha256": sha(f"{name}_z{k}")} for k, z in enumerate(C.ZOOMS)]
    return own | {"capture_id": name, "plan_id": name, "camera_id": cam["camera_id"], "state": state, "day_index": (state - 1) // 10 + 1, "state_in_day": (state - 1) % 10 + 1, "observation_elapsed_s": (state - 1) * 8640, "camera_path": f"/World/Cameras/{cam['camera_id']}", "thermal_contract": C.THERMAL[0] if air else None, "expected_modalities": ["rgb", *(C.THERMAL[1] if air else ())], "negative_reason": C.TURNED if cam["sample_capability"] == "negative_context" else None, "line_of_sight_verified": True, "selection_token_sha256": sha(name), "profile": profile, "zooms": zooms}


def rows(schema, items):
    names = [part.split()[0] for part in re.split(r", (?=\w+ )", schema)]
    return [tuple(float(v) if isinstance(v, int) and not isinstance(v, bool) and n.endswith("_mm") else [float(x) for x in v] if n.endswith("_m") else v for n in names for v in [item[n]]) for item in items]


@pytest.fixture(scope="module")
def pool():
    kinds = ["positive_fire"] * 16 + ["negative_context"] * 4
    profiles = ["aerial"] * 2 + ["phone"] * 8 + ["professional"] * 10
    cameras = [camera(float(k), kind, profile) | {"camera_id": f"c{k}"} for k, (kind, profile) in enumerate(zip(kinds, profiles, strict=True))]
    return cameras, [view(cam, profile, state) for state in (1, 10, 11) for cam, profile in zip(cameras, profiles, strict=True)]


def faults(spark, cameras, views):
    found = C.schedule_view_faults(spark.createDataFrame(rows(VIEW, views), VIEW), spark.createDataFrame(rows(CAMERA, cameras), CAMERA), "pack")
    return sorted((r["capture_id"], r["fault"]) for r in found.collect())


def test_a_whole_schedule_and_each_broken_value(spark, pool):
    cameras, views = pool
    assert faults(spark, cameras, views) == []
    ground, air = views[5], views[0]
    broken = {name: "other" if isinstance(ground[name], str) or ground[name] is None else (not ground[name]) if isinstance(ground[name], bool) else [7.0, 7.0, 7.0] for name in C.SAME}
    broken |= {name: ground[name] + 0.002 for name in C.NEAR}
    broken |= {"plan_id": "x", "camera_path": "/x", "day_index": 9, "state_in_day": 9, "observation_elapsed_s": 1, "negative_reason": "why", "line_of_sight_verified": None, "selection_token_sha256": "x"}
    items, want = [], set()
    for n, (name, value) in enumerate(broken.items()):
        item = copy.deepcopy(ground) | {name: value}
        if name not in ("plan_id", "selection_token_sha256"):
            item |= {"capture_id": f"v{n}", "plan_id": f"v{n}", "selection_token_sha256": sha(f"v{n}")}
        items.append(item)
        want.add((item["capture_id"], {"selection_token_sha256": "token", "line_of_sight_verified": "line_of_sight"}.get(name, name)))
    extra = {("v10", "thermal_role"), ("v10", "thermal_contract"), ("v8", "negative_reason")}
    got = set(faults(spark, cameras, items))
    assert want <= got and {f for _, f in got - want} <= {f for _, f in extra}
    near = [ground | {c: ground[c] + 0.0009 for c in C.NEAR}]
    assert faults(spark, cameras, near) == []
    zoomed = [copy.deepcopy(air) for _ in range(5)]
    zoomed[0]["zooms"].pop()
    zoomed[1]["zooms"][1]["capture_id"] = zoomed[1]["zooms"][0]["capture_id"]
    zoomed[2]["zooms"][3]["focal_length_mm"] += 0.01
    zoomed[3]["zooms"][2]["horizontal_aperture_mm"] = 35.0
    zoomed[4]["expected_modalities"] = ["rgb"]
    assert {f for _, f in faults(spark, cameras, zoomed)} == {"zooms", "zoom_ids", "zoom_token", "zoom_focal", "zoom_aperture", "thermal_contract"}
    assert "camera" in {f for _, f in faults(spark, cameras[1:], [air])}


def test_states_have_their_quotas(spark, pool):
    _, views = pool
    frame = spark.createDataFrame(rows(VIEW, views), VIEW)
    assert C.schedule_state_faults(frame).count() == 0
    less = frame.filter("not (state = 10 and camera_id = 'c19')").withColumn("camera_id", F.when((F.col("state") == 11) & (F.col("camera_id") == "c3"), "c4").otherwise(F.col("camera_id")))
    assert sorted((r["state"], r["fault"]) for r in C.schedule_state_faults(less).collect()) == [(10, "negative_context"), (10, "professional"), (10, "views"), (11, "cameras")]


def test_first_failures_and_image_limits(spark):
    many = spark.range(201).select(F.col("id").alias("capture"), F.lit("a").alias("fault")).union(spark.range(200).select("id", F.lit("b")))
    got = Q.first_failures(many, "fault", "capture", 200).groupBy("fault", "total", "truncated").agg(F.count("*").alias("n"), F.max("capture").alias("last")).collect()
    assert {r["fault"]: (r["total"], r["truncated"], r["n"], r["last"]) for r in got} == {"a": (201, True, 200, 199), "b": (200, False, 200, 199)}
    pixels = spark.createDataFrame([(1, 1.0, 1.0, 1.0), (1, 0.0, 0.0, 0.0), (2, 0.95, 0.95, 0.95), (3, 0.0, 0.0, 0.0), (3, 0.0, 1.0, 0.0)], "image long, r double, g double, b double")
    limits = {"pale": 0.5, "white": 0.5, "flat": 0.3, "grey": 0.5}
    rows_ = {r["image"]: r for r in Q.image_statistics(pixels, "image", limits).collect()}
    assert (rows_[1]["mean"], rows_[1]["deviation"], rows_[1]["white"], rows_[1]["faults"]) == (pytest.approx(0.5), pytest.approx(0.5), 0.5, ["grey"])
    assert rows_[2]["faults"] == ["pale", "white", "flat", "grey"] and rows_[3]["faults"] == []
