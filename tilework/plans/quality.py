"""Queries that compare, reconcile and check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import quality as Q
from .registry import query
from .views import boxes, candidates, captures, cells, points, table


@query("""with f as (select tile, id, run, min(x_mm * 1000000 + height_cm) as k from candidates where status = 'valid' group by 1, 2, 3),
l as (select tile, id, k // 1000000 as x, k % 1000000 as h from f where run = 'F'), r as (select tile, id, k // 1000000 as x, k % 1000000 as h from f where run = 'O'),
j as (select coalesce(l.tile, r.tile) as tile, l.id as a, r.id as b, abs(l.x - r.x) as dx, abs(l.h - r.h) as dh from l full join r on l.tile = r.tile and l.id = r.id)
select tile, count(*) filter (a is not null and b is not null) as matched, count(*) filter (b is null) as only_left, count(*) filter (a is null) as only_right,
  quantile_disc(dx, 0.5) as dx_p50, quantile_disc(dx, 0.95) as dx_p95, max(dx) as dx_max, max(dh) as dh_max from j group by tile""", "candidates")
def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid candidates of two runs"""
    rows = candidates(spark, sf_dir).filter("status = 'valid'").select("run", "tile", "id", F.col("x_mm").alias("x"), F.col("height_cm").alias("height"))
    return Q.run_comparison(rows, "F", "O")


@query("select tile, run, count(*) filter (status = 'valid') as valid, count(*) filter (status = 'ambiguous') as ambiguous, count(*) filter (status = 'rejected') as rejected, count(*) as source, count(*) = count(*) filter (status in ('valid', 'ambiguous', 'rejected')) as balanced from candidates group by 1, 2", "candidates")
def status_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 D9"""
    return Q.status_totals(candidates(spark, sf_dir), ["tile", "run"])


@query("select run, tile, status, count(*) as n, cast(grouping(tile) as integer) as all_tiles from candidates group by grouping sets ((run, tile, status), (run, status))", "candidates")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by tile and for the zone in one pass."""
    rows = candidates(spark, sf_dir)
    return rows.groupingSets([["run", "tile", "status"], ["run", "status"]], "run", "tile", "status").agg(F.count("*").alias("n"), F.grouping("tile").cast("int").alias("all_tiles"))


@query("""with a as (select distinct tile, id from candidates where run = 'F'), b as (select distinct tile, id from candidates where run = 'O')
select 'common' as side, count(*) as n from (select * from a intersect select * from b) union all select 'only_left', count(*) from (select * from a except select * from b) union all select 'only_right', count(*) from (select * from b except select * from a)""", "candidates")
def key_set_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: one aggregation marks the sides a key is on."""
    sides = candidates(spark, sf_dir).groupBy("tile", "id").agg(F.bool_or(F.col("run") == "F").alias("l"), F.bool_or(F.col("run") == "O").alias("r"))
    side = F.when(F.col("l") & F.col("r"), "common").when(F.col("l"), "only_left").otherwise("only_right")
    return sides.groupBy(side.alias("side")).agg(F.count("*").alias("n"))


@query("select tile, id, count(*) as rows, min(sha256(cast(x_mm as varchar))) as identity, min(sha256(cast(x_mm as varchar))) <> max(sha256(cast(x_mm as varchar))) as conflict from candidates where status <> 'rejected' group by 1, 2", "candidates")
def keyed_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 G4"""
    return Q.keyed_conflicts(candidates(spark, sf_dir).filter("status <> 'rejected'"), ["tile", "id"], F.sha2(F.col("x_mm").cast("string"), 256))


@query("select id, tile, run, status, n, x_mm from candidates", "candidates")
def canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows in the order of their sink; sinks sort inside their partitions."""
    return candidates(spark, sf_dir).select("id", "tile", "run", "status", "n", "x_mm").sortWithinPartitions("id", "tile", "x_mm")


@query("""with e as (select capture_id, unnest([case when zoom = 3 and distance_m > 2500 then 'too_far' end, case when pixels = 0 then 'empty_mask' end, case when kind = 'error' then 'write_failed' end, case when elapsed_s < 5 then 'too_early' end]) as fault from captures)
select * from e where fault is not null""", "captures")
def capture_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per broken rule of a capture."""
    rules = {"too_far": ~((F.col("zoom") == 3) & (F.col("distance_m") > 2500)), "empty_mask": F.col("pixels") != 0, "write_failed": F.col("kind") != "error", "too_early": F.col("elapsed_s") >= 5}
    return Q.violations(captures(spark, sf_dir), ["capture_id"], rules)


@query("""with e as (select unnest([case when zoom = 3 and distance_m > 2500 then 'too_far' end, case when pixels = 0 then 'empty_mask' end, case when kind = 'error' then 'write_failed' end]) as fault from captures)
select fault, count(*) as n, count(*) > 200 as truncated from e where fault is not null group by 1""", "captures")
def failure_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures by code; more than 200 would be listed in part."""
    rules = {"too_far": ~((F.col("zoom") == 3) & (F.col("distance_m") > 2500)), "empty_mask": F.col("pixels") != 0, "write_failed": F.col("kind") != "error"}
    return Q.violations(captures(spark, sf_dir), ["capture_id"], rules).groupBy("fault").agg(F.count("*").alias("n"), (F.count("*") > 200).alias("truncated"))


@query("""select id, len(list_filter(map_keys(m), lambda k: k not in ('category', 'name', 'brand'))) as unknown, not list_contains(map_keys(m), 'brand') as no_brand from (select id, case when id % 5 = 0 then map {'category': category, 'name': name, 'extra': brand} else map {'category': category, 'name': name, 'brand': brand} end as m from boxes)""", "boxes")
def key_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys beyond the allowed ones, and missing ones."""
    pair = lambda last: F.create_map(F.lit("category"), F.col("category"), F.lit("name"), F.col("name"), F.lit(last), F.col("brand"))
    props = F.when(F.col("id") % 5 == 0, pair("extra")).otherwise(pair("brand"))
    keys = F.map_keys(props)
    allowed = F.array(*map(F.lit, ("category", "name", "brand")))
    return boxes(spark, sf_dir).select("id", F.size(F.array_except(keys, allowed)).cast("long").alias("unknown"), (~F.array_contains(keys, "brand")).alias("no_brand"))


@query("""with d as (select o_orderkey as id, sha256(o_custkey || '|' || o_orderstatus) as h, case when o_orderkey % 13 = 0 then 'X' else o_orderstatus end as s, o_custkey as c from orders)
select id, sha256(c || '|' || s) = h as intact from d""")
def self_hash_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J13"""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("c"), F.sha2(F.concat_ws("|", "o_custkey", "o_orderstatus"), 256).alias("h"), F.when(F.col("o_orderkey") % 13 == 0, "X").otherwise(F.col("o_orderstatus")).alias("s"))
    return Q.sealed(rows, ["c", "s"], "h").select("id", "intact")


@query("""with a as (select l_suppkey as tile, sha256(cast(sum(l_partkey) as varchar)) as h from lineitem where l_linestatus = 'F' group by 1), b as (select l_suppkey as tile, sha256(cast(sum(l_partkey) as varchar)) as h from lineitem where l_linestatus = 'O' group by 1)
select tile, a.h = b.h as same from a join b using (tile)""")
def source_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J14"""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("tile")).agg(*(F.sum(F.when(F.col("l_linestatus") == s, F.col("l_partkey"))).alias(s) for s in "FO"))
    return rows.dropna().select("tile", (F.sha2(F.col("F").cast("string"), 256) == F.sha2(F.col("O").cast("string"), 256)).alias("same"))


@query("""with m as (select o_custkey as k, count(*) as files, cast(sum(o_orderkey) as bigint) as bytes, o_orderstatus as batch from orders where o_orderstatus in ('F', 'O') group by o_custkey, o_orderstatus)
select k, cast(sum(files) as bigint) as files, cast(sum(bytes) as bigint) as bytes, count(*) as batches from m group by k""")
def merged_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D13 G4"""
    one = lambda s: table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("files"), F.sum("o_orderkey").alias("bytes"))
    return Q.merged_counters(one("F"), one("O"), "k", ["files", "bytes"])


@query("""with s as (select state, camera, zoom, min(distance_m) as d from captures group by 1, 2, 3), c as (select camera, min(distance_m) as pool from captures group by 1)
select state, camera, zoom, d <> pool as moved from s join c using (camera)""", "captures")
def schedule_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each scheduled view against its camera's row."""
    rows = captures(spark, sf_dir)
    pool = rows.groupBy("camera").agg(F.min("distance_m").alias("pool"))
    views = rows.groupBy("state", "camera", "zoom").agg(F.min("distance_m").alias("d"))
    return views.join(pool, "camera").select("state", "camera", "zoom", (F.col("d") != F.col("pool")).alias("moved"))


@query("""select capture_id, (case when pixels > 2000 then 2126 else 722 end) + pixels % 7 as lum, pixels % 3 = 0 and distance_m >= 1500 as near_white from captures""", "captures")
def pixel_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Luminance and saturation of a pixel that the row encodes, in 1/10000."""
    red = F.when(F.col("pixels") > 2000, 1.0).otherwise(0.0)
    blue = F.when(F.col("pixels") > 2000, 0.0).otherwise(1.0)
    lum = F.round(S.luminance(red, F.lit(0.0), blue) * 10_000).cast("long") + F.col("pixels") % 7
    grey = F.when((F.col("pixels") % 3 == 0) & (F.col("distance_m") >= 1500), 1.0).otherwise(0.0)
    white = (S.luminance(grey, grey, grey) >= 0.9) & (S.saturation(grey, grey, grey) <= 0.08)
    return captures(spark, sf_dir).select("capture_id", lum.alias("lum"), white.alias("near_white"))


@query("""select id, round(greatest(0.015, least(0.42, 0.12 * (0.22 + 0.78 * (height_cm % 100) / 100.0) * exp(0.09 * (id % 12) * ((id % 21) - 10) / 10.0) * exp(greatest(-0.65, least(0.65, 3.8 * ((id % 9) - 4) / 10.0))) * greatest(0.32, least(1.0, 1.22 - (id % 30) / 25.0 - (id % 90) / 280.0)))), 6) as rate from points""", "points")
def travel_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B21"""
    k = F.col("id")
    rate = S.travel_rate(F.col("height_cm") % 100 / 100.0, k % 12, (k % 21 - 10) / 10.0, (k % 9 - 4) / 10.0, k % 30, k % 90)
    return points(spark, sf_dir).select("id", F.round(rate, 6).alias("rate"))


@query("""select tile, r, c, case when h < 100 then 'rejected' when (r + c) % 3 = 0 and h < 300 then 'ambiguous' else 'valid' end as status, case when h < 300 and (r * c) % 2 = 1 then 'woody' else 'tree' end as class from (select tile, r, c, (greatest(mns_mm - mnt_mm, 0) + 5) // 10 as h from cells)""", "cells")
def crown_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and class rules in order."""
    h, r, c = F.floor((F.greatest(F.col("mns_mm") - F.col("mnt_mm"), F.lit(0)) + 5) / 10), F.col("r"), F.col("c")
    status = F.when(h < 100, "rejected").when(((r + c) % 3 == 0) & (h < 300), "ambiguous").otherwise("valid")
    return cells(spark, sf_dir).select("tile", "r", "c", status.alias("status"), F.when((h < 300) & (r * c % 2 == 1), "woody").otherwise("tree").alias("class"))


@query("""with f as (select page_id as id, page_id % 7 as package, case when page_id % 50 = 5 then '../' else 'tiles/' end || page_id || '.html' as path, strlen(html) as bytes, sha256(html) as sha from pages),
l as (select * from f where id % 50 <> 3), m as (select package, path, bytes + case when id % 50 = 1 then 1 else 0 end as said, case when id % 50 = 2 then reverse(sha) else sha end as sealed, id from f where id % 50 <> 4),
p as (select coalesce(l.package, m.package) as package, coalesce(l.path, m.path) as path, l.id as own, m.id as listed, l.bytes, m.said, l.sha, m.sealed from l full join m on l.package = m.package and l.path = m.path)
select package, path, 'missing' as fault from p where own is null union all select package, path, 'unexpected' from p where listed is null union all select package, path, 'size' from p where bytes <> said
union all select package, path, 'hash' from p where sha <> sealed union all select package, path, 'unsafe' from p where path like '../%' union all select package, path, 'repeated' from p where listed % 50 = 6
union all select package, null, 'files' from (select package, count(*) as n, count(*) filter (id % 50 = 3) as gone from f group by 1) where gone > 0
union all select package, null, 'bytes' from (select package, sum(case when id % 50 = 3 then bytes end) as gone from f group by 1) where gone > 0 or package = 6""")
def sealed_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as packages of files; every kind of fault is planted by the page's number, and a total is wrong."""
    k = F.col("page_id")
    path = F.concat(F.when(k % 50 == 5, "../").otherwise("tiles/"), k.cast("string"), F.lit(".html"))
    files = table(spark, sf_dir, "pages").select(k.alias("id"), (k % 7).alias("package"), path.alias("path"), F.octet_length("html").cast("long").alias("bytes"), F.sha2("html", 256).alias("sha256"))
    entries = files.filter("id % 50 <> 4").withColumn("bytes", F.col("bytes") + F.when(F.col("id") % 50 == 1, 1).otherwise(0)).withColumn("sha256", F.when(F.col("id") % 50 == 2, F.reverse("sha256")).otherwise(F.col("sha256")))
    twice = entries.union(entries.filter("id % 50 = 6"))
    declared = files.groupBy("package").agg(F.count("*").alias("files"), (F.sum("bytes") + F.when(F.first("package") == 6, 1).otherwise(0)).alias("bytes"))
    return Q.package_faults(files.filter("id % 50 <> 3").drop("id"), twice.drop("id"), declared)


@query("""with e as (select capture_id, unnest([case when zoom = 3 and distance_m > 2500 then 'too_far' end, case when pixels = 0 then 'empty_mask' end, case when kind = 'error' then 'write_failed' end]) as fault from captures),
n as (select *, row_number() over (partition by fault order by capture_id) as place, count(*) over (partition by fault) as total from e where fault is not null)
select fault, capture_id, place, total, total > 200 as truncated from n where place <= 200""", "captures")
def first_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the first 200 captures of each fault, with its total and whether more were left out."""
    rules = {"too_far": ~((F.col("zoom") == 3) & (F.col("distance_m") > 2500)), "empty_mask": F.col("pixels") != 0, "write_failed": F.col("kind") != "error"}
    return Q.first_failures(Q.violations(captures(spark, sf_dir), ["capture_id"], rules), "fault", "capture_id", 200)


@query("""with p as (select l_suppkey as image, l_partkey * 7 % 256 / 255.0::double as r, l_orderkey * 13 % 256 / 255.0::double as g, l_linenumber * 37 % 256 / 255.0::double as b from lineitem union all select c_nationkey, 1, 0.99::double, 1 from customer),
q as (select image, 0.2126::double * r + 0.7152::double * g + 0.0722::double * b as lum, case when greatest(r, g, b) = 0 then 0 else (greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b) end as sat from p),
m as (select image, count(*) as pixels, avg(lum) as mean, stddev_pop(lum) as deviation, avg(sat) as saturation, count(*) filter (lum >= 0.9 and sat <= 0.08) / count(*) as white from q group by 1)
select image, pixels, round(mean, 6) as mean, round(deviation, 6) as deviation, round(saturation, 6) as saturation, round(white, 6) as white,
  concat_ws(',', case when mean > 0.55 then 'pale' end, case when white > 0.2 then 'white' end, case when deviation < 0.2 then 'flat' end, case when saturation < 0.6 then 'grey' end) as faults from m""")
def image_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Luminance, saturation and near-white share of each image's pixels against four thresholds."""
    level = lambda c, by: (F.col(c) * by % 256 / 255.0)
    pixels = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("image"), level("l_partkey", 7).alias("r"), level("l_orderkey", 13).alias("g"), level("l_linenumber", 37).alias("b"))
    white = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("image"), F.lit(1.0).alias("r"), F.lit(0.99).alias("g"), F.lit(1.0).alias("b"))
    found = Q.image_statistics(pixels.union(white), "image", {"pale": 0.55, "white": 0.2, "flat": 0.2, "grey": 0.6})
    return found.select("image", "pixels", *(F.round(c, 6).alias(c) for c in ("mean", "deviation", "saturation", "white")), F.array_join("faults", ",").alias("faults"))
