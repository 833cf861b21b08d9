"""Queries on ordered rows: incidents, schedules, progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import timelines as T
from .registry import query
from .views import captures, frames, table, vertices


@query("""select user_id as run, event_id, value < before as fell, k <= bk as stuck from (
  select *, cast(json_extract(props, '$.k') as bigint) as k, lag(value) over w as before, lag(cast(json_extract(props, '$.k') as bigint)) over w as bk from events window w as (partition by user_id order by event_id)) where value < before""")
def progression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user whose value fell."""
    rows = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    w = Window.partitionBy("user_id").orderBy("event_id")
    rows = rows.withColumn("bk", F.lag("k").over(w))
    return T.progression_faults(rows, "user_id", ["event_id"], ["value"]).select(F.col("user_id").alias("run"), "event_id", F.lit(True).alias("fell"), (F.col("k") <= F.col("bk")).alias("stuck"))


@query("""select o_orderkey as id, o_custkey as block, row_number() over (partition by o_custkey order by o_orderkey) as turn, min(o_orderkey) over (partition by o_custkey) as first from orders""")
def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2"""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("block"))
    return T.interleaved(rows, "block", "id")


@query("""select * from (select o_orderpriority as pool, o_orderstatus as status, o_orderkey as id, row_number() over (partition by o_orderpriority, o_orderstatus order by sha256(o_orderstatus || '|' || o_orderkey)) as place from orders) where place <= 20""")
def quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3"""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("pool"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("id"))
    return T.hash_sample(rows, ["pool", "status"], 20, F.col("status"), F.col("id").cast("string"))


@query("""with s as (select *, lead(x) over (partition by line order by seq) as x2, lead(y) over (partition by line order by seq) as y2 from vertices)
select line, seq, x, y, x2, y2, (x2 - x) * (x2 - x) + (y2 - y) * (y2 - y) as d2 from s where x2 is not null""", "vertices")
def line_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8"""
    d2 = (F.col("x2") - F.col("x")) * (F.col("x2") - F.col("x")) + (F.col("y2") - F.col("y")) * (F.col("y2") - F.col("y"))
    return T.segments(vertices(spark, sf_dir)).withColumn("d2", d2)


@query("""with s as (select *, lead(x) over (partition by line order by seq) as x2, lead(y) over (partition by line order by seq) as y2 from vertices),
l as (select *, sqrt((x2 - x) ** 2 + (y2 - y) ** 2) as len from s where x2 is not null),
c as (select *, sum(len) over (partition by line order by seq) as upto, sum(len) over (partition by line) as total from l),
p as (select *, (k + 0.5) * total / 4 as pos from c cross join range(4) r(k))
select line, cast(k as integer) as station, round(x + (pos - upto + len) / len * (x2 - x), 3) as x, round(y + (pos - upto + len) / len * (y2 - y), 3) as y from p where pos > upto - len and pos <= upto""", "vertices")
def line_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 E6"""
    found = T.stations(vertices(spark, sf_dir), 4)
    return found.select("line", "station", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query("""with s as (select line, seq, x, y, lead(x) over (partition by line order by seq) as x2, lead(y) over (partition by line order by seq) as y2 from vertices),
p as (select line, seq, least(8, greatest(1, cast(ceil(sqrt((x2 - x) ** 2 + (y2 - y) ** 2) / 1000) as integer))) as n, sqrt((x2 - x) ** 2 + (y2 - y) ** 2) / 1000 > 8 as capped, x, y, x2, y2 from s where x2 is not null)
select line, seq, cast(k as integer) as k, n, capped, round(x + (x2 - x) * k / n, 3) as x, round(y + (y2 - y) * k / n, 3) as y from p cross join range(1, 9) r(k) where k <= n""", "vertices")
def densified_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment in at most eight parts."""
    parts = F.sqrt((F.col("x2") - F.col("x")) ** 2 + (F.col("y2") - F.col("y")) ** 2) / 1000
    n = F.least(F.lit(8), F.greatest(F.lit(1), F.ceil(parts).cast("int")))
    rows = T.segments(vertices(spark, sf_dir)).withColumn("n", n).withColumn("capped", parts > 8).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n"))))
    at = lambda a, b: F.round(F.col(a) + (F.col(b) - F.col(a)) * F.col("k") / F.col("n"), 3)
    return rows.select("line", "seq", "k", "n", "capped", at("x", "x2").alias("_x"), at("y", "y2").alias("_y")).withColumnsRenamed({"_x": "x", "_y": "y"})


@query("""with b as (select *, row_number() over (partition by user_id, cast(round_even(value / 10, 0) as bigint) order by value desc, event_id % 7 desc, event_id) as k from events)
select user_id, cast(round_even(value / 10, 0) as bigint) as bucket, event_id, value, event_id % 7 as triangles from b where k = 1""")
def best_per_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest of each bucket by two values, the first on ties, by one aggregation; buckets round half to even."""
    rows = table(spark, sf_dir, "events").withColumns({"bucket": F.bround(F.col("value") / 10).cast("long"), "triangles": F.col("event_id") % 7})
    best = F.max(F.struct("value", "triangles", (-F.col("event_id")).alias("place"))).alias("b")
    return rows.groupBy("user_id", "bucket").agg(best).select("user_id", "bucket", (-F.col("b.place")).alias("event_id"), "b.value", "b.triangles")


@query("""select dataset, event_id, row_number() over w - 1 as index, valid_from - min(valid_from) over (partition by dataset) as elapsed_s, count(*) over (partition by dataset, valid_from) > 1 as repeated from frames window w as (partition by dataset order by valid_from, valid_to, event_id)""", "frames")
def frame_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E11 B14"""
    w = Window.partitionBy("dataset").orderBy("valid_from", "valid_to", "event_id")
    return frames(spark, sf_dir).select(
        "dataset", "event_id", (F.row_number().over(w) - 1).alias("index"), (F.col("valid_from") - F.min("valid_from").over(Window.partitionBy("dataset"))).alias("elapsed_s"), (F.count("*").over(Window.partitionBy("dataset", "valid_from")) > 1).alias("repeated")
    )


@query("""with m as (select distinct dataset, valid_from + 1800 as t from frames), x as (select m.dataset, m.t, event_id, row_number() over (partition by m.dataset, m.t order by valid_from desc, event_id desc) as k, count(*) over (partition by m.dataset, m.t) as n from m join frames f on f.dataset = m.dataset and m.t between valid_from and valid_to)
select m.dataset, m.t, x.event_id as frame, x.n from m left join x on x.dataset = m.dataset and x.t = m.t and x.k = 1""", "frames")
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C23"""
    rows = frames(spark, sf_dir)
    return T.as_of(rows, rows.select("dataset", (F.col("valid_from") + 1800).alias("t")).distinct(), 3600)


@query("""with d as (select distinct user_id, cast(floor(value) as bigint) as v from events), r as (select *, row_number() over (partition by user_id order by v) - 1 as k, count(*) over (partition by user_id) as m from d)
select user_id, cast(p as integer) as pick, greatest(1, v) as v from r cross join range(5) x(p) where m >= 5 and k = round_even(p * greatest(4, floor((m - 1) * 0.96)) / 4, 0)""")
def order_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E12"""
    return T.equispaced_picks(table(spark, sf_dir, "events").select("user_id", F.floor("value").alias("v")), "user_id", "v", 5, 0.96)


@query("""with s as (select user_id, cast(floor(epoch(ts)) as bigint) as pos, event_id from events), g as (select *, coalesce(cast(pos - lag(pos) over (partition by user_id order by pos) >= 28800 as integer), 0) as new from s),
n as (select *, sum(new) over (partition by user_id order by pos range between unbounded preceding and current row) as session from g)
select user_id, cast(session as bigint) as session, min(pos) as began, max(pos) as ended, count(*) as events from n group by 1, 2""")
def inactivity_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, batch twin"""
    return T.gaps(table(spark, sf_dir, "events").select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at")), "user_id", "at", 28_800)


@query("""with t as (select user_id as job, event_type as tile, max(value) as progress from events group by 1, 2)
select job, count(*) as tiles, round(0.08 + 0.82 * avg(progress / 500), 6) as fraction from t group by job""")
def job_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, batch twin: progress of a tile never falls; the job's fraction is over its tiles."""
    tiles = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("job"), F.col("event_type").alias("tile")).agg(F.max("value").alias("progress"))
    return tiles.groupBy("job").agg(F.count("*").alias("tiles"), F.round(0.08 + 0.82 * F.avg(F.col("progress") / 500), 6).alias("fraction"))


@query("""with r as (select user_id as job, sha256(props) as request, min(event_id) as first, count(*) as n from events group by 1, 2)
select job, count(*) as requests, cast(sum(n) as bigint) as received, count(*) > 1 as conflict, min(first) as first from r group by job""")
def request_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, batch twin: requests by hash; a job with two hashes is a conflict."""
    by_hash = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("job"), F.sha2("props", 256).alias("request")).agg(F.min("event_id").alias("first"), F.count("*").alias("n"))
    return by_hash.groupBy("job").agg(F.count("*").alias("requests"), F.sum("n").alias("received"), (F.count("*") > 1).alias("conflict"), F.min("first").alias("first"))


@query("""select user_id as job, event_id, row_number() over (partition by user_id order by event_id) as sequence, event_type in ('error', 'purchase') or row_number() over (partition by user_id, cast(floor(epoch(ts) / 86400) as bigint) order by event_id) = 1 as sent from events""")
def progress_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: numbered events; the first of a day passes, forced kinds always do."""
    day = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 86_400)
    first = F.row_number().over(Window.partitionBy("user_id", day).orderBy("event_id")) == 1
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("job"), "event_id", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).alias("sequence"), (F.col("event_type").isin("error", "purchase") | first).alias("sent"))


@query("select e.event_id, e.user_id from events e anti join (select distinct user_id, event_type from events where event_type = 'purchase' and value > 100) d on d.user_id = e.user_id and e.event_type <> 'view'")
def remaining_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: rows whose key has no finished work."""
    events = table(spark, sf_dir, "events")
    done = events.filter("event_type = 'purchase' and value > 100").select("user_id").distinct()
    return events.filter("event_type <> 'view'").join(done, "user_id", "left_anti").select("event_id", "user_id").union(events.filter("event_type = 'view'").select("event_id", "user_id"))


@query("""with r as (select capture_id, case when elapsed_s <= 60 or area_m2 <= 1000 then 'incipient' when rate_mm_s / 1000.0 <= 0.01 then 'stalled' when rate_mm_s / 1000.0 < 0.08 then 'slowed' else 'established' end as regime, distance_m, zoom, kind <> 'error' as expected, pixels from captures),
q as (select *, cast(regime <> 'established' as integer) + cast(distance_m >= 1500 as integer) + cast(zoom < 2 as integer) as reasons from r)
select capture_id, regime, reasons, case when not expected then 'negative_context' when reasons > 0 then 'valid_low_or_partial_signal_positive' else 'standard_positive' end as class,
case when not expected then 'negative' when reasons > 0 then 'hard_positive' else 'positive' end as kind,
case when not expected then 'none_expected' when pixels <= 32 then 'trace' when pixels <= 256 then 'small' when pixels <= 2048 then 'moderate' else 'clear' end as tier from q""", "captures")
def capture_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B15 B16 D22"""
    regime = S.fire_regime(F.col("elapsed_s"), F.col("area_m2"), F.col("rate_mm_s") / 1000.0)
    reasons = S.visibility_reasons(regime, F.col("distance_m"), F.col("zoom") / 2)
    expected = F.col("kind") != "error"
    kind, sample = S.acceptance(expected, reasons)
    return captures(spark, sf_dir).select("capture_id", regime.alias("regime"), F.size(reasons).alias("reasons"), kind.alias("class"), sample.alias("kind"), S.visibility_tier(expected, F.col("pixels")).alias("tier"))


@query("""select state, camera, string_agg(distinct cast(zoom as varchar), ',' order by cast(zoom as varchar)) as zooms, count(distinct zoom) = 5 and min(zoom) = 1 and max(zoom) = 5 as complete, count(*) filter (zoom = 2) as originals, count(distinct day) > 1 as moved from captures group by 1, 2""", "captures")
def zoom_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D12"""
    zooms = F.array_sort(F.collect_set("zoom"))
    return captures(spark, sf_dir).groupBy("state", "camera").agg(
        F.array_join(zooms, ",").alias("zooms"), F.coalesce(zooms == F.array(*(F.lit(z).cast("long") for z in range(1, 6))), F.lit(False)).alias("complete"), F.count_if(F.col("zoom") == 2).alias("originals"), (F.count_distinct("day") > 1).alias("moved")
    )


@query("""with s as (select state, count(*) as captures, count(*) filter (kind = 'error') as negatives, count(distinct camera) as cameras from captures group by state)
select count(*) as states, cast(sum(captures) as bigint) as captures, cast(sum(negatives) as bigint) as negatives, min(cameras) as least_cameras, count(*) filter (cameras < 20) as short_states from s""", "captures")
def schedule_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D25 D11 J7"""
    by_state = captures(spark, sf_dir).groupBy("state").agg(F.count("*").alias("captures"), F.count_if(F.col("kind") == "error").alias("negatives"), F.count_distinct("camera").alias("cameras"))
    return by_state.agg(F.count("*").alias("states"), F.sum("captures").alias("captures"), F.sum("negatives").alias("negatives"), F.min("cameras").alias("least_cameras"), F.count_if(F.col("cameras") < 20).alias("short_states"))


@query("""with v as (select distinct state, camera from captures), p as (select state, camera, row_number() over (partition by state order by sha256(state || '|' || camera)) as place from v)
select state, camera, place, cast(z as integer) as zoom_index, list_extract([75, 100, 125, 150, 200], cast(z as integer)) as zoom_percent from p cross join range(1, 6) r(z) where place <= 6""", "captures")
def capture_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six cameras a state by hash rank, each in five zooms (a fixed list in the row)."""
    views = captures(spark, sf_dir).select("state", "camera").distinct()
    picked = T.hash_sample(views, ["state"], 6, F.col("state").cast("string"), F.col("camera").cast("string"))
    return picked.select("state", "camera", "place", F.posexplode(F.array(*map(F.lit, (75, 100, 125, 150, 200)))).alias("zoom_index", "zoom_percent")).withColumn("zoom_index", F.col("zoom_index") + 1)


@query("select o_orderkey as id, case when o_custkey % 97 = 0 then o_custkey % 7 else 1000 end as priority, o_orderkey // 64 as batch from orders")
def priority_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6"""
    k = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(k % 97 == 0, k % 7).otherwise(1000).alias("priority"), F.expr("o_orderkey div 64").alias("batch"))


@query("select spec, cast(unnest(case when contains(spec, '-') then range(lo, hi + 1) else [lo] end) as bigint) as item from (select o_orderkey % 50 || '-' || (o_orderkey % 50 + o_custkey % 5) as spec, o_orderkey % 50 as lo, o_orderkey % 50 + o_custkey % 5 as hi from orders)")
def range_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B26"""
    k = F.col("o_orderkey") % 50
    rows = table(spark, sf_dir, "orders").select(F.concat_ws("-", k.cast("string"), (k + F.col("o_custkey") % 5).cast("string")).alias("spec"))
    ends = F.split("spec", "-")
    return rows.select("spec", F.explode(F.sequence(ends[0].cast("long"), F.element_at(ends, -1).cast("long"))).alias("item"))
