"""Queries that hold rows against contracts, and the hooks with rules other than the default ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import contracts as C
from ..operators import hooks
from ..operators import spatial as P
from ..sources import files
from .registry import query
from .views import boxes, captures, points, table

SUM = "cast(sum(('0x' || substr(sha256(cast({} as varchar)), 1, 8))::bigint) as bigint)"


@query(f"""with f as (select l_suppkey as zone, l_returnflag as layer, l_partkey as id, l_quantity as q from lineitem),
d as (select zone, layer, count(*) as n, {SUM.format('id')} as s from (select distinct zone, layer, id from f where q >= 2) group by 1, 2),
k as (select zone, layer, count(*) as ids, max(t) as t, {SUM.format('id')} as s from (select zone, layer, id, count(*) as t from f group by 1, 2, 3) group by 1, 2),
w as (select z.zone, l.layer from (select distinct zone from d) z cross join (values ('A'), ('N'), ('R'), ('X')) l(layer)),
b as (select w.zone, w.layer, d.n, d.s, k.ids, k.t, k.s as ks from w left join d using (zone, layer) left join k using (zone, layer))
select zone, layer, fault from (select zone, layer, unnest([case when ids is null or n is null then 'layer_missing' end, case when ids is not null and n is not null and t <> 1 then 'id_repeated' end,
  case when ids <> n then 'count_differs' end, case when ks <> s then 'hash_differs' end]) as fault from b) where fault is not null""")
def zone_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts a tile holds by layer, against a declaration made without its smallest quantities."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("zone"), F.col("l_returnflag").alias("layer"), F.col("l_partkey").alias("id"), "l_quantity")
    declared = rows.filter("l_quantity >= 2").select("zone", "layer", "id").distinct().groupBy("zone", "layer").agg(F.count("*").alias("n"), C.checksum(F.col("id")).alias("sum"))
    return C.zone_context(rows, declared, ["A", "N", "R", "X"])


@query("""with p as (select p_partkey // 100 as tile, p_partkey % 100 as x, p_size as y, p_size * 6 as red, cast(floor(p_retailprice) as bigint) % 300 as green from part),
f as (select tile, count(*) as n, bool_and(red <= 255 and green <= 255) as ok, bool_and(y < 50) as inside from p group by tile)
select tile, fault from (select tile, unnest([case when n <> 100 then 'count' end, case when not ok then 'dtype' end, case when not inside then 'bounds' end]) as fault from f) where fault is not null""")
def point_cloud_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed attributes of points, and the cloud against its metadata."""
    k = F.col("p_partkey")
    raw = table(spark, sf_dir, "part").select(F.expr("p_partkey div 100").alias("tile"), (k % 100).alias("x"), F.col("p_size").alias("y"), k.alias("instance"), F.col("p_size").alias("semantic"), (F.col("p_size") * 6).alias("red"), (F.floor("p_retailprice") % 300).alias("green"), F.lit(0).alias("blue"))
    cloud = files.compact_attributes(raw)
    sides = {"n": 100, "west": 0, "south": 0, "east": 100, "north": 50}
    return C.point_cloud(cloud, raw.select("tile").distinct().withColumns({c: F.lit(v) for c, v in sides.items()}))


@query("""with f as (select day, count(distinct state) as s, count(distinct camera) as c, count(distinct zoom) as z, count(*) as n, count(distinct capture_id) as ids from captures group by day)
select day, fault from (select day, unnest([case when s <> 10 then 'states' end, case when c <> 20 then 'cameras' end, case when z <> 5 then 'zooms' end, case when n <> 1000 then 'captures' end, case when ids <> n then 'capture_repeated' end]) as fault from f) where fault is not null""", "captures")
def package_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's captures against a manifest of ten states, twenty cameras, five zooms and 1,000 captures."""
    rows = captures(spark, sf_dir)
    counts = {"states": 10, "cameras": 20, "zooms": 5, "captures": 1_000}
    return C.dataset_package(rows, rows.select("day").distinct().withColumns({c: F.lit(v) for c, v in counts.items()}))


@query("""with c as (select day as dataset, capture_id, state || ':' || camera as view, zoom, case when pixels = 31 then '../' || capture_id when pixels = 62 then '/srv/' || capture_id else 'captures/' || capture_id end as path,
  sha256(capture_id || '|' || kind) as sha, case when kind = 'error' and pixels < 100 then null else sha256(capture_id || '|' || case when distance_m < 3 then 'x' else kind end) end as locked, kind = 'error' and elapsed_s < 20 as bad from captures),
v as (select dataset, count(*) filter (z <> 5) as incomplete from (select dataset, view, count(distinct zoom) as z from c group by 1, 2) group by 1)
select dataset, count(*) as captures, count(*) filter (bad) as unclean, count(*) filter (coalesce(locked <> sha, true)) as unlocked, count(*) filter (path not like 'captures/%') as unsafe, incomplete, count(*) = 1000 as in_scope,
  count(*) = 1000 and count(*) filter (bad) + count(*) filter (coalesce(locked <> sha, true)) + count(*) filter (path not like 'captures/%') + incomplete = 0 as publishable from c join v using (dataset) group by dataset, incomplete""", "captures")
def publication_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of a day with their audit's faults, hash locks, paths and zooms."""
    rows = captures(spark, sf_dir)
    k = F.col("capture_id").cast("string")
    sealed = lambda kind: F.sha2(F.concat_ws("|", k, kind), 256)
    path = F.when(F.col("pixels") == 31, F.concat(F.lit("../"), k)).when(F.col("pixels") == 62, F.concat(F.lit("/srv/"), k)).otherwise(F.concat(F.lit("captures/"), k))
    view = F.concat_ws(":", F.col("state").cast("string"), F.col("camera").cast("string"))
    staged = rows.select(F.col("day").alias("dataset"), "capture_id", view.alias("view"), "zoom", path.alias("path"), sealed(F.col("kind")).alias("sha"))
    locks = rows.filter("not (kind = 'error' and pixels < 100)").select("capture_id", sealed(F.when(F.col("distance_m") < 3, "x").otherwise(F.col("kind"))).alias("sha"))
    return C.publication_gate(staged, rows.filter("kind = 'error' and elapsed_s < 20").select("capture_id"), locks, staged.select("dataset").distinct().withColumn("expected", F.lit(1_000)), 5)


@query("""with p as (select id, x_mm as x, y_mm as y, (x_mm // 500000) * 500000 + case when height_cm % 50 = 7 then 500000 when height_cm % 50 = 8 then 1 else 0 end as west, (y_mm // 500000) * 500000 as south, (height_cm % 700) / 100.0 as yaw from points)
select id, fault from (select id, unnest([case when west % 500000 <> 0 or south % 500000 <> 0 then 'owner_off_grid' end, case when not (x >= west and x < west + 500000 and y >= south and y < south + 500000) then 'outside_owner' end, case when yaw >= 2 * pi() then 'yaw' end]) as fault from p) where fault is not null""", "points")
def placement_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners on the grid that hold their point, unique ids, yaw within a turn."""
    h = F.col("height_cm") % 50
    moved = F.when(h == 7, 500_000).when(h == 8, 1).otherwise(0)
    rows = points(spark, sf_dir).select("id", F.col("x_mm").alias("x"), F.col("y_mm").alias("y"), (S.owner_tile(F.col("x_mm"), 500_000) + moved).alias("west"), S.owner_tile(F.col("y_mm"), 500_000).alias("south"), (F.col("height_cm") % 700 / 100.0).alias("yaw"))
    return C.placements(rows, 500_000)


@query("""with c as (select id, case category when 'PROMO' then 'context' when 'ECONOMY' then 'tree' else 'building' end as family, x1 - x0 as w, category from boxes)
select id, fault from (select id, unnest([case when w = 13000 then 'profile' end, case when family = 'building' and w < 5000 then 'authority' end, case when family = 'context' and w > 45000 then 'context_asset' end, case when w = 21000 then 'refinement' end]) as fault from c) where fault is not null""", "boxes")
def inventory_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile, footprint authority, no asset of context, known refinement status."""
    w, category = F.col("x1") - F.col("x0"), F.col("category")
    family = F.when(category == "PROMO", "context").when(category == "ECONOMY", "tree").otherwise("building")
    rows = boxes(spark, sf_dir).select("id", F.when(w == 13_000, "v1").otherwise("v2").alias("profile"), family.alias("family"), F.when(w >= 5_000, "footprint").alias("authority"), F.when(w > 45_000, "asset").alias("asset"), F.when(w == 21_000, "guessed").otherwise("refined").alias("refinement"))
    return C.inventory_v2(rows, "v2", ["refined", "kept", "not_needed"])


@query("""with a as (select l_partkey as id, p_type as category, min(p_name) as name from lineitem join part on p_partkey = l_partkey group by 1, 2), d as (select p_type as category, count(*) as declared from part group by 1),
f as (select category, count(*) as n, count(*) filter (id % 1000 < 100) as ids, count(*) filter (name = 'small ring') as hashes from a group by 1)
select category, fault, k as n from (select category, unnest(['id_pattern', 'hash_pattern', 'count']) as fault, unnest([ids, hashes, cast(n <> declared as bigint)]) as k from f join d using (category)) where k > 0""")
def catalog_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in use as a catalog against the parts declared; ids have three digits at least, of which the first is not zero."""
    part = table(spark, sf_dir, "part")
    used = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct().join(part, "p_partkey")
    last = F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")
    assets = used.select(F.concat(F.lit("asset_"), F.col("p_partkey").cast("string"), F.lit("_"), last).alias("id"), F.col("p_type").alias("category"), F.when(F.col("p_name") != "small ring", F.sha2("p_name", 256)).alias("sha"))
    return C.catalog(assets, part.groupBy(F.col("p_type").alias("category")).agg(F.count("*").alias("declared")), "^asset_[0-9]+_[1-9][0-9]{2}$")


@query("""with c as (select capture_id, zoom, kind, distance_m, pixels, elapsed_s from captures)
select capture_id, fault from (select capture_id, unnest([case when pixels % 400 = 0 then 'missing view.camera.name' end, case when kind = 'error' then 'missing view.target' end, case when distance_m % 100 = 0 then 'vector view.camera.position' end,
  case when elapsed_s % 250 = 0 then 'quaternion' end]) as fault from c) where fault is not null""", "captures")
def capture_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested paths that must be there, vectors of three finite parts, quaternions of unit length."""
    at = F.col("distance_m").cast("double")
    position = F.when(F.col("distance_m") % 100 == 0, F.array(at, at)).otherwise(F.array(at, at, F.lit(1.5)))
    camera = F.struct(F.when(F.col("pixels") % 400 != 0, F.concat(F.lit("camera "), F.col("camera").cast("string"))).alias("name"), position.alias("position"))
    half = F.when(F.col("elapsed_s") % 250 == 0, F.lit(0.72)).otherwise(F.sqrt(F.lit(0.5)))
    rows = captures(spark, sf_dir).select("capture_id", F.struct(camera.alias("camera"), F.when(F.col("kind") != "error", F.col("kind")).alias("target")).alias("view"), F.array(half, F.lit(0.0), F.lit(0.0), half).alias("q"))
    found = C.required_paths(rows, "capture_id", "view", ["camera.name", "target"], {"camera.position": 3})
    named = found.withColumn("fault", F.regexp_replace("fault", "^(missing|vector) ", "$1 view."))
    return named.union(C.unit_quaternions(rows, "capture_id", "q"))


@query("""with w as (select p_partkey as id, p_size * 0.2::double as width, case when p_size >= 40 then 'wide' else 'narrow' end as method, p_type as category from part), a as (select n_nationkey as asset, n_regionkey as k from nation)
select id, width, method, min(asset) as asset from w left join a on a.k = id % 7 group by 1, 2, 3""")
def own_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 L2: a width rule and a choice of assets put in the place of the default ones."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_size")
    assets = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("asset"), F.col("n_regionkey").alias("k"))
    wide = hooks.with_widths(rows, F.col("p_size") * 0.2, F.lit(None).cast("double"), lambda width, importance: (width, F.when(F.col("p_size") >= 40, "wide").otherwise("narrow")))
    first = lambda wanted, known: wanted.join(known.groupBy("k").agg(F.min("asset").alias("asset")), F.col("id") % 7 == F.col("k"))
    return hooks.with_assets(wide, assets, first).select("id", "width", "method", "asset")


@query("""with q as (select o_orderkey as zone, o_custkey * 137 as cx, o_orderkey * 311 as cy, 500 + o_custkey % 4 * 500 as side from orders),
t as (select zone, unnest(range(cast(floor((cx - side / 2) / 500) as bigint), cast(ceil((cx + side / 2) / 500) as bigint))) * 500 as x, y from (select *, unnest(range(cast(floor((cy - side / 2) / 500) as bigint), cast(ceil((cy + side / 2) / 500) as bigint))) * 500 as y from q))
select zone, count(*) as tiles, min(x) as west, max(y) as north from t group by zone""")
def produced_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: a production of three steps given as functions: requests, their tiles, a summary."""
    context = lambda orders: orders.select(F.col("o_orderkey").alias("zone"), (F.col("o_custkey") * 137).alias("cx"), (F.col("o_orderkey") * 311).alias("cy"), (500 + F.col("o_custkey") % 4 * 500).alias("side"))
    summary = lambda tiles: tiles.groupBy("zone").agg(F.count("*").alias("tiles"), F.min("x").alias("west"), F.max("y").alias("north"))
    return hooks.produced(table(spark, sf_dir, "orders"), context, lambda zones: P.square_plan(zones, 500), summary)


#: What is broken in the views whose number leaves that remainder by 97, and the fault that it is.
_BROKEN = {
    1: "camera_role", 2: "access_tile", 3: "sample_kind", 4: "position_local_m", 5: "focal_length_mm", 6: "vertical_aperture_mm", 7: "plan_id", 8: "camera_path", 9: "day_index", 10: "state_in_day",
    11: "observation_elapsed_s", 12: "thermal_contract", 13: "negative_reason", 14: "line_of_sight", 15: "token", 16: "zooms", 17: "zoom_focal", 18: "zoom_aperture", 19: "zoom_token", 20: "camera",
}


@query("select event_id as capture_id, fault from events, (values " + ", ".join(f"({k}, '{fault}')" for k, fault in _BROKEN.items()) + """) b(k, fault) where event_id % 97 = k
union all select event_id, 'negative_reason' from events where event_id % 97 = 3 union all select event_id, 'zoom_ids' from events where event_id % 97 = 16 union all select event_id, unnest(['camera_path', 'camera_role', 'placement_type', 'capture_device_profile', 'framing_style', 'placement_contract', 'access_surface', 'access_tile', 'sample_kind', 'expected_fire_visible',
  'thermal_expected', 'position_local_m', 'position_l93_ngf_ign69_m', 'look_at_local_m', 'fire_target_local_m', 'fire_bearing_offset_degrees', 'focal_length_mm', 'focal_length_35mm_equivalent_mm', 'horizontal_aperture_mm', 'vertical_aperture_mm', 'thermal_role', 'zoom_focal', 'zoom_aperture']) from events where event_id % 97 = 20""")
def schedule_view_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a scheduled view of one of twenty cameras; some break one of the contract's terms each."""
    k = F.col("event_id")
    words = {c: F.lit(c) for c in ("placement_type", "framing_style", "placement_contract", "access_surface", "access_tile", "capture_device_profile")}
    lens = {"fire_bearing_offset_degrees": 2.0, "focal_length_mm": 35.0, "focal_length_35mm_equivalent_mm": 50.0, "horizontal_aperture_mm": 36.0, "vertical_aperture_mm": 24.0}

    def terms(n: Column) -> dict[str, Column]:
        """Of camera n: two are aerial, the last four look away from the fire."""
        away, at = n >= 16, F.array(n * 10.0, n * 5.0, F.lit(2.0))
        told = {"role": F.when(n < 2, "aerial").otherwise("ground"), "sample_capability": F.when(away, "negative_context").otherwise("positive_fire"), "expected_fire_in_frame": ~away, "thermal_capture": n < 2, "host_building": F.lit(None).cast("string")}
        places = {"position_local_m": at, "position_l93_ngf_ign69_m": F.transform(at, lambda x: x + 1000), "target_local_m": at, "fire_target_local_m": at}
        return words | told | places | {c: F.lit(v) for c, v in lens.items()}

    cameras = spark.range(20).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("camera_id"), *(v.alias(c) for c, v in terms(F.col("id")).items()))
    part, camera = k % 97, k % 20
    token = lambda name: F.sha2(F.concat(F.lit("pack|"), name), 256)
    name, state, own = k.cast("string"), F.expr("event_id div 100") % 180 + 1, terms(camera)
    zoom = lambda z, n: F.struct(
        F.concat(name, F.lit(f"_z{n}")).alias("capture_id"), F.lit(z).alias("zoom_multiplier"), (F.lit(35.0 * z) + F.when(part == 17, 0.5 * n).otherwise(0.0)).alias("focal_length_mm"),
        (F.lit(36.0) - F.when(part == 18, 1.0 * n).otherwise(0.0)).alias("horizontal_aperture_mm"), F.when((part == 19) & F.lit(n == 2), "x").otherwise(token(F.concat(name, F.lit(f"_z{n}")))).alias("selection_token_sha256"),
    )
    zooms = F.array(*(zoom(z, n) for n, z in enumerate(C.ZOOMS)))
    away = own["sample_capability"] == "negative_context"
    warm, bad = camera < 2, lambda n, wrong, right: F.when(part == n, wrong).otherwise(right)
    columns = {mine: own[theirs] for mine, theirs in C.SAME.items()} | {c: own[c] for c in C.NEAR}
    columns |= {
        "camera_role": bad(1, F.lit("diver"), own["role"]), "access_tile": bad(2, F.lit(None), own["access_tile"]), "sample_kind": bad(3, F.lit("unknown"), own["sample_capability"]), "position_local_m": bad(4, F.array(F.lit(0.5)), own["position_local_m"]),
        "focal_length_mm": bad(5, F.lit(35.002), own["focal_length_mm"]), "vertical_aperture_mm": bad(6, F.lit(None), own["vertical_aperture_mm"]), "plan_id": bad(7, F.lit("x"), name), "camera_path": bad(8, F.lit("/"), F.concat(F.lit("/World/Cameras/c"), camera.cast("string"))),
        "day_index": F.floor((state - 1) / 10) + bad(9, F.lit(2), F.lit(1)), "state_in_day": (state - 1) % 10 + bad(10, F.lit(2), F.lit(1)), "observation_elapsed_s": (state - 1) * 8640 + bad(11, F.lit(1), F.lit(0)),
        "thermal_contract": F.when(warm != (part == 12), C.THERMAL[0]), "expected_modalities": F.when(warm, F.array(*map(F.lit, C.THERMAL[1]))).otherwise(F.array(F.lit("rgb"))),
        "negative_reason": F.when((away & (part != 3)) != (part == 13), C.TURNED).otherwise(F.when(part == 3, "why")), "line_of_sight_verified": bad(14, F.lit(None), F.lit(True)), "selection_token_sha256": bad(15, F.lit("x"), token(name)), "zooms": bad(16, F.slice(zooms, 1, 4), zooms),
    }
    views = table(spark, sf_dir, "events").select(name.alias("capture_id"), bad(20, F.lit("c99"), F.concat(F.lit("c"), camera.cast("string"))).alias("camera_id"), state.alias("state"), *(v.alias(c) for c, v in columns.items()))
    return C.schedule_view_faults(views, cameras, "pack").withColumn("capture_id", F.col("capture_id").cast("long"))
