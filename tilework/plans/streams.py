"""Streaming queries over the events table, drained; SQL twins are their batch forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import progress as P
from ..streaming import stalls
from .registry import query

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.readStream.schema(EVENTS).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", 1).parquet(f"{sf_dir}/events.parquet*")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


@query("""with t as (select user_id as job, event_type as tile, max(value) as progress from events group by 1, 2)
select job, count(*) as tiles, round(0.08 + 0.82 * avg(progress / 500), 6) as fraction from t group by job""")
def stream_job_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 as a stream in update mode"""
    return P.job_fraction(P.drained(P.tile_progress(event_stream(spark, sf_dir), "user_id", "event_type", "value"), "update"), 500)


@query("select distinct sha256(props) as request, cast(1 as bigint) as emitted from events")
def stream_unique_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 as a stream: each request once"""
    rows = event_stream(spark, sf_dir).select(F.sha2("props", 256).alias("request"), "ts")
    return P.drained(P.unique_requests(rows, "request", "ts"), "append").groupBy("request").agg(F.count("*").alias("emitted"))


@query("select count(*) as observations, count(distinct user_id) as datasets from (select distinct user_id, ts from events)")
def stream_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 as a stream"""
    rows = event_stream(spark, sf_dir).select("user_id", "ts")
    return P.drained(P.unique_observations(rows, "user_id", "ts"), "append").agg(F.count("*").alias("observations"), F.count_distinct("user_id").alias("datasets"))


@query("""with s as (select user_id, epoch_us(ts) // 1000 as pos, event_type = 'purchase' as last from events), n as (select max(pos) as now from s),
q as (select *, min(case when last then pos end) over (partition by user_id) as ends, min(pos) over (partition by user_id order by pos range between 1 following and unbounded following) as nxt from s)
select user_id as job, min(pos) as last_ms, min(pos) + 28800000 as stalled_ms from q, n where coalesce(nxt, now) - pos >= 28800000 and pos + 28800000 <= now - 1000 and (ends is null or pos < ends) group by user_id""")
def stream_stalled_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 as a stream with timers: jobs that were silent for eight hours before they ended"""
    rows = event_stream(spark, sf_dir)
    return P.drained(stalls.stalled(rows, "user_id", "ts", F.col("event_type") == "purchase", 28_800, "1 second"), "append")
