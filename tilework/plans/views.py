"""The spatial and timeline views that the queries run on, as DataFrames and as SQL.

Every view is a projection or one aggregation of the given tables, so it grows with them; all values
are integers or strings, so that both engines agree to the last digit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells of a tile side, and a tile side in mm.
SIDE, TILE_MM = 32, 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile, r, c, mnt_mm (ground), mns_mm (surface)."""
    r, c = F.col("l_orderkey") % SIDE, (F.col("l_partkey") * 31 + F.col("l_linenumber")) % SIDE
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("tile"), r.cast("int").alias("r"), c.cast("int").alias("c"), F.floor("l_extendedprice").alias("price"), F.floor("l_quantity").alias("quantity")
    )
    found = rows.groupBy("tile", "r", "c").agg(F.min(F.col("price") % 1000).alias("g"), F.max("quantity").alias("q"))
    ground = 100_000 + F.col("r") * 137 + F.col("c") * 61 + F.col("g")
    return found.select("tile", "r", "c", ground.alias("mnt_mm"), (ground + F.col("q") * 300 - 600).alias("mns_mm"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, x_mm, y_mm, height_cm: about 200 points a tile, tiles in a row."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("id"), (F.expr("c_custkey div 200") * TILE_MM + k * 7919 % TILE_MM).alias("x_mm"), (k * 104_729 % TILE_MM).alias("y_mm"), F.floor(F.abs("c_acctbal")).alias("height_cm")
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, x0, y0, x1, y1 (mm), category, name, tag."""
    k = F.col("p_partkey")
    x0, y0 = F.expr("p_partkey div 266") * TILE_MM + k * 15_485 % TILE_MM, k * 32_452 % TILE_MM
    return table(spark, sf_dir, "part").select(
        k.alias("id"), x0.alias("x0"), y0.alias("y0"), (x0 + F.col("p_size") * 1000).alias("x1"), (y0 + (F.col("p_size") % 7 + 1) * 1000).alias("y1"),
        F.col("p_type").alias("category"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
    )


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line, seq (from 1), x, y: the points of each order's line, in a full order."""
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    rows = table(spark, sf_dir, "lineitem").withColumn("seq", F.row_number().over(order))
    return rows.select(F.col("l_orderkey").alias("line"), "seq", (F.col("l_partkey") * 37 % 10_000).alias("x"), (F.col("l_suppkey") * 91 % 10_000).alias("y"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dataset, event_id, valid_from, valid_to (seconds)."""
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("dataset"), "event_id", at.alias("valid_from"), (at + F.floor(F.col("value") * 60)).alias("valid_to"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run, tile, id, status, x_mm, height_cm: two runs that share keys."""
    status = F.when(F.col("l_returnflag") == "A", "valid").when(F.col("l_returnflag") == "N", "ambiguous").otherwise("rejected")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("run"), F.col("l_suppkey").alias("tile"), F.col("l_partkey").alias("id"), status.alias("status"),
        (F.col("l_orderkey") * 17 % TILE_MM).alias("x_mm"), F.floor(F.col("l_quantity") * 100).alias("height_cm"), F.col("l_linenumber").alias("n"),
    )


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """capture_id, day, state, camera, zoom, kind, elapsed_s, area_m2, rate_mm_s, distance_m, pixels."""
    k = F.col("event_id")
    state = F.expr("event_id div 100") % 180 + 1
    return table(spark, sf_dir, "events").select(
        k.alias("capture_id"), (F.expr("(event_id div 100) % 180 div 10") + 1).alias("day"), state.alias("state"), (k % 20).alias("camera"), (F.expr("event_id div 20") % 5 + 1).alias("zoom"),
        F.col("event_type").alias("kind"), (k * 37 % 1000).alias("elapsed_s"), (k * 613 % 12_000).alias("area_m2"), (k * 7 % 200).alias("rate_mm_s"), (k * 97 % 3000).alias("distance_m"), (k * 31 % 4000).alias("pixels"),
    )


SQL = {
    "cells": """cells as (
  select tile, r, c, 100000 + r * 137 + c * 61 + g as mnt_mm, 100000 + r * 137 + c * 61 + g + q * 300 - 600 as mns_mm
  from (select l_suppkey as tile, cast(l_orderkey % 32 as integer) as r, cast((l_partkey * 31 + l_linenumber) % 32 as integer) as c,
               min(cast(floor(l_extendedprice) as bigint) % 1000) as g, max(cast(floor(l_quantity) as bigint)) as q
        from lineitem group by 1, 2, 3))""",
    "points": """points as (
  select c_custkey as id, (c_custkey // 200) * 500000 + c_custkey * 7919 % 500000 as x_mm, c_custkey * 104729 % 500000 as y_mm,
         cast(floor(abs(c_acctbal)) as bigint) as height_cm
  from customer)""",
    "boxes": """boxes as (
  select p_partkey as id, x0, y0, x0 + p_size * 1000 as x1, y0 + (p_size % 7 + 1) * 1000 as y1, p_type as category, p_name as name, p_brand as brand
  from (select *, (p_partkey // 266) * 500000 + p_partkey * 15485 % 500000 as x0, p_partkey * 32452 % 500000 as y0 from part))""",
    "vertices": """vertices as (
  select l_orderkey as line, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) as seq,
         l_partkey * 37 % 10000 as x, l_suppkey * 91 % 10000 as y
  from lineitem)""",
    "frames": """frames as (
  select user_id as dataset, event_id, cast(floor(epoch(ts)) as bigint) as valid_from, cast(floor(epoch(ts)) as bigint) + cast(floor(value * 60) as bigint) as valid_to
  from events)""",
    "candidates": """candidates as (
  select l_linestatus as run, l_suppkey as tile, l_partkey as id,
         case l_returnflag when 'A' then 'valid' when 'N' then 'ambiguous' else 'rejected' end as status,
         l_orderkey * 17 % 500000 as x_mm, cast(floor(l_quantity * 100) as bigint) as height_cm, l_linenumber as n
  from lineitem)""",
    "captures": """captures as (
  select event_id as capture_id, (event_id // 100) % 180 // 10 + 1 as day, (event_id // 100) % 180 + 1 as state, event_id % 20 as camera, event_id // 20 % 5 + 1 as zoom,
         event_type as kind, event_id * 37 % 1000 as elapsed_s, event_id * 613 % 12000 as area_m2, event_id * 7 % 200 as rate_mm_s,
         event_id * 97 % 3000 as distance_m, event_id * 31 % 4000 as pixels
  from events)""",
}
