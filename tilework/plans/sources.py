"""Queries over files: the given tables written out in the shared folder in a source's format, scanned back, and summed up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import new_path
from ..functions import scalars as S
from ..operators import contracts as C
from ..operators import grids as G
from ..sources import features, files
from .registry import query
from .views import boxes, captures, cells, frames, points, table, vertices

CRS = "urn:ogc:def:crs:EPSG::2154"


def collections(rows: DataFrame, file: Column, feature: Column, matched: int | None = None) -> str:
    """rows as feature collections, one document a file, with its declared reference system; returns where they are."""
    document = F.struct(
        F.lit("FeatureCollection").alias("type"), F.lit(matched).cast("long").alias("numberMatched"), F.struct(F.struct(F.lit(CRS).alias("name")).alias("properties")).alias("crs"), F.array_sort(F.collect_list(feature)).alias("features")
    )
    return documents(rows.groupBy(file.alias("file")).agg(F.to_json(document).alias("value")))


def documents(rows: DataFrame) -> str:
    """rows (file, value), one a file, as one text file each, written by the tasks that made them; returns where they are."""
    path = new_path(rows.sparkSession)
    rows.write.partitionBy("file").text(path)
    return path


def ring(*corners: tuple[str, str]) -> Column:
    return F.array(*(F.array(F.col(x), F.col(y)) for x, y in corners))


@query("""with p as (select *, row_number() over (partition by id // 2 order by id) - 1 as part from boxes)
select id // 2 || ':' || part as id, 2154 as epsg, cast(x0 as double) as west, cast(y1 as double) as north, cast((x1 - x0) * (y1 - y0) as bigint) as area, category from p""", "boxes")
def polygon_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes as multi-part polygons of two parts, read back one row a part."""
    outline = ring(("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))
    parts = boxes(spark, sf_dir).withColumn("part", F.struct("id", F.array(outline).alias("rings"), "category"))
    pairs = parts.groupBy(F.expr("id div 2").alias("pair")).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    feature = F.struct(
        F.col("pair").cast("string").alias("id"), F.lit("Feature").alias("type"), F.struct(F.lit("MultiPolygon").alias("type"), F.transform("parts", lambda p: p["rings"]).alias("coordinates")).alias("geometry"),
        F.struct(F.array_join(F.transform("parts", lambda p: p["category"]), ",").alias("kinds")).alias("properties"),
    )
    found = features.polygon_features(spark, collections(pairs, F.expr("pair div 200"), feature))
    kind = F.split(F.col("properties")["kinds"], ",")[F.split("id", ":")[1].cast("int")]
    return found.select("id", "epsg", F.col("xmin").alias("west"), F.col("ymax").alias("north"), (F.abs(S.shoelace(F.col("rings")[0])) / 2).cast("long").alias("area"), kind.alias("category"))


@query("""select line || ':0' as id, count(*) as points, cast(min(x) as double) as west, cast(max(y) as double) as north, cast(arg_max(x, seq) as double) as last_x from vertices group by line having count(*) >= 2 and (min(x) < max(x) or min(y) < max(y))""", "vertices")
def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: lines of two points or more that have a length."""
    lines = vertices(spark, sf_dir).groupBy("line").agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))).alias("points"))
    geometry = F.struct(F.lit("LineString").alias("type"), F.transform("points", lambda p: F.array(p["x"], p["y"])).alias("coordinates"))
    feature = F.struct(F.col("line").cast("string").alias("id"), F.lit("Feature").alias("type"), geometry.alias("geometry"))
    found = features.line_features(spark, collections(lines, F.expr("line div 2000"), feature))
    return found.select("id", F.size("line").cast("long").alias("points"), F.col("xmin").alias("west"), F.col("ymax").alias("north"), F.element_at("line", -1)["x"].alias("last_x"))


@query("select cast(id as varchar) as id, category, brand from boxes", "boxes")
def paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: pages of 500 features that state how many there are in all."""
    rows = boxes(spark, sf_dir)
    feature = F.struct(F.col("id").cast("string").alias("id"), F.lit("Feature").alias("type"), F.struct("category", "brand").alias("properties"))
    found = features.paged_layer(spark, collections(rows, F.expr("id div 500"), feature, rows.count()))
    return found.select("id", F.col("properties")["category"].alias("category"), F.col("properties")["brand"].alias("brand"))


@query("select id, brand from boxes where x1 >= 900000 and x0 <= 3100000 and y1 >= 60000 and y0 <= 400000", "boxes")
def layer_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: a stored layer read by a box and a list of columns."""
    path = new_path(spark)
    boxes(spark, sf_dir).select("id", "category", "name", "brand", F.col("x0").alias("xmin"), F.col("y0").alias("ymin"), F.col("x1").alias("xmax"), F.col("y1").alias("ymax")).write.parquet(path)
    return features.layer_in_bounds(spark.read.parquet(path), (900_000, 60_000, 3_100_000, 400_000), ["brand"])


@query("select tile, r, c, case when (greatest(mns_mm - mnt_mm, 0) + 5) // 10 > 65534 then 0 else (greatest(mns_mm - mnt_mm, 0) + 5) // 10 end as hag from cells", "cells")
def height_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Height tiles written as one array a row and read back as cells."""
    path = new_path(spark)
    files.write_heights(cells(spark, sf_dir).select("tile", "r", "c", G.height_cm(F.col("mnt_mm"), F.col("mns_mm")).alias("hag")), path)
    return files.read_heights(spark, path)


@query("""with l as (select x_mm // 500000 as tile, id, '{"height_cm":' || height_cm || ',"id":' || id || ',"x_mm":' || x_mm || '}' as line from points)
select cast(tile as varchar) as tile, count(*) as candidates, cast(sum(length(line) + 1) as bigint) as bytes, sha256(string_agg(line, chr(10) order by line) || chr(10)) as sha256 from l group by tile""", "points")
def inventory_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventories as canonical JSON lines a tile, listed with bytes and hash, and read back."""
    path = new_path(spark)
    files.write_canonical_json(points(spark, sf_dir).select(F.expr("x_mm div 500000").alias("tile"), "id", "x_mm", "height_cm"), path, "tile")
    listed = files.file_inventory(spark, path).withColumn("tile", F.regexp_extract("path", "tile=([0-9]+)/", 1)).filter("tile <> ''")
    read = spark.read.schema("tile string, id long, x_mm long, height_cm long").json(path).groupBy("tile").agg(F.count("*").alias("candidates"))
    return listed.join(read, "tile").select("tile", "candidates", "bytes", "sha256")


@query("select kind, count(*) as stored, count(*) filter (zoom <= 3) as refused from captures group by kind", "captures")
def capture_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of three zooms, then all of them; those stored before are refused."""
    rows, path = captures(spark, sf_dir), new_path(spark)
    files.append_captures(rows.filter("zoom <= 3"), path, layout=("kind",))
    refused = files.append_captures(rows, path, layout=("kind",)).groupBy("kind").agg(F.count("*").alias("refused"))
    stored = spark.read.parquet(path).groupBy("kind").agg(F.count("*").alias("stored"))
    return stored.join(refused, "kind", "left").select("kind", "stored", F.coalesce("refused", F.lit(0)).alias("refused"))


@query("select cast(dataset as varchar) as dataset, count(*) as rows, count(*) filter (event_id % 37 = 1 or event_id % 41 = 1) as missing, count(*) filter (event_id % 37 <> 1 and event_id % 41 = 1) as unexpected from frames group by dataset", "frames")
def timeline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timelines as documents, some frames lost and some changed, read back and held against the frames made anew."""
    rows = frames(spark, sf_dir)
    stamp = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ssXXX")
    end = F.col("valid_to") + F.when(F.col("event_id") % 41 == 1, 60).otherwise(0)
    kept = rows.filter("event_id % 37 <> 1").withColumn("valid_to", end)  # frames that were lost, and frames that were changed
    frame = F.struct(F.col("event_id").cast("string").alias("id"), stamp("valid_from").alias("timestamp"), stamp("valid_from").alias("valid_from"), stamp("valid_to").alias("valid_to"), F.lit("area").alias("affected"))
    lines = kept.groupBy("dataset").agg(F.array_sort(F.collect_list(frame)).alias("timeline"))
    document = F.array_join(F.collect_list(F.to_json(F.struct(F.col("dataset").cast("string").alias("id"), "timeline"))), ",")
    path = documents(lines.groupBy(F.expr("dataset div 100").alias("file")).agg(F.concat(F.lit("["), document, F.lit("]")).alias("value")))
    stored = features.timeline_frames(spark, path).filter(F.size("faults") == 0).select("dataset", "id", F.unix_seconds("valid_from").alias("valid_from"), F.unix_seconds("valid_to").alias("valid_to"))
    again = rows.select(F.col("dataset").cast("string").alias("dataset"), F.col("event_id").cast("string").alias("id"), "valid_from", "valid_to")
    return C.package_differences(stored, again, "dataset")


@query("""with w as (select l_partkey as package, l_suppkey as root, l_suppkey % 3 as priority from lineitem group by 1, 2 having count(distinct l_linestatus) = 2),
r as (select *, row_number() over (partition by package order by priority, root) as k from w) select package, root, priority from r where k = 1""")
def package_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the copies of a package that hold all required files, the best by priority."""
    listing = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("package"), F.col("l_suppkey").alias("root"), (F.col("l_suppkey") % 3).alias("priority"), F.col("l_linestatus").alias("name"))
    return files.packages(listing, ["F", "O"])
