"""Vector features and timelines from GeoJSON-like files, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

FEATURE = "type string, id string, geometry struct<type:string,coordinates:string>, properties map<string,string>"
COLLECTION = f"type string, numberMatched long, crs struct<properties:struct<name:string>>, features array<struct<{FEATURE.replace(' string', ':string').replace(' struct', ':struct').replace(' map', ':map')}>>"


def _documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row a document of files (UTF-8) that hold one, or an array of them; an unreadable one is a row of nulls.

    The JSON source reads a file anew at the place of each value that is kept as text but is none (coordinates, numbers), so such
    values cost an opened file each.  Here a file is read once, as text, and parsed in memory; such values come as JSON written anew
    (1.10 as 1.1, no white space), which is the same number or structure, but not always the same text.
    """
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\ufeff", "").alias("value")).filter(r"value rlike '\\S'")
    many = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", f"array<struct<{schema}>>"))
    return text.select(F.explode(F.coalesce(many, F.array(F.from_json("value", schema)))).alias("document")).select("document.*")


def _parts(df: DataFrame, kinds: tuple[str, str], depths: tuple[str, str]) -> DataFrame:
    """One row per part: single geometries are multi ones of one part."""
    single, multi = kinds
    g = F.col("geometry")
    parts = F.when(g["type"] == multi, F.from_json(g["coordinates"], depths[1])).when(g["type"] == single, F.array(F.from_json(g["coordinates"], depths[0])))
    return df.select("id", "declared", "properties", F.posexplode(parts).alias("part", "coords"))


#: The types of GeoJSON that hold no features.
GEOMETRIES = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon", "GeometryCollection")


def _read(spark: SparkSession, path: str) -> DataFrame:
    """The features of files that are a collection, one feature or a bare geometry each; a file of any other type fails the plan."""
    alone = "id string, geometry struct<type:string,coordinates:string>, properties map<string,string>, coordinates string"
    raw = _documents(spark, path, f"{COLLECTION}, {alone}")
    one = lambda key, geometry, props: F.array(F.struct(F.lit("Feature").alias("type"), key.alias("id"), geometry.alias("geometry"), props.alias("properties")))
    bare = F.struct(F.col("type"), F.col("coordinates"))
    no_id, no_props = F.lit(None).cast("string"), F.lit(None).cast("map<string,string>")
    found = (
        F.when(F.col("type") == "FeatureCollection", F.coalesce("features", F.filter(one(no_id, bare, no_props), lambda _: F.lit(False))))
        .when(F.col("type") == "Feature", one(F.col("id"), F.col("geometry"), F.col("properties")))
        .when(F.col("type").isin(*GEOMETRIES), one(no_id, bare, no_props))
        .otherwise(F.raise_error(F.concat(F.lit("no GeoJSON: type "), F.coalesce(F.to_json(F.struct("type")), F.lit("?")))))
    )
    rows = raw.select(F.posexplode(found).alias("place", "f"), S.declared_epsg(F.col("crs.properties.name")).alias("declared"))
    key = F.coalesce("f.id", F.col("f.properties")["id"], F.col("place").cast("string"))
    return rows.select(key.alias("id"), "declared", F.col("f.geometry").alias("geometry"), F.col("f.properties").alias("properties"))


def polygon_features(spark: SparkSession, path: str, swap_xy: bool = False) -> DataFrame:
    """id (suffixed :part), epsg, rings, bounds, properties; parts without area are dropped."""
    parts = _parts(_read(spark, path), ("Polygon", "MultiPolygon"), ("array<array<array<double>>>", "array<array<array<array<double>>>>"))
    a, b = (1, 0) if swap_xy else (0, 1)
    rings = F.transform("coords", lambda ring: F.transform(ring, lambda p: F.struct(p[a].alias("x"), p[b].alias("y"))))
    return _bounded(parts.withColumn("rings", rings), F.flatten("rings")).filter(S.shoelace(F.col("rings")[0]) != 0)


def line_features(spark: SparkSession, path: str, swap_xy: bool = False) -> DataFrame:
    """id, epsg, coords, bounds, properties; lines of fewer than two points or without length are dropped."""
    parts = _parts(_read(spark, path), ("LineString", "MultiLineString"), ("array<array<double>>", "array<array<array<double>>>"))
    a, b = (1, 0) if swap_xy else (0, 1)
    line = F.transform("coords", lambda p: F.struct(p[a].alias("x"), p[b].alias("y")))
    found = _bounded(parts.withColumn("line", line), F.col("line"))
    return found.filter((F.size("line") >= 2) & ((F.col("xmax") > F.col("xmin")) | (F.col("ymax") > F.col("ymin"))))


def _bounded(df: DataFrame, points: Column) -> DataFrame:
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    named = df.withColumn("id", F.concat_ws(":", "id", "part")).withColumns({"xmin": F.array_min(x), "ymin": F.array_min(y), "xmax": F.array_max(x), "ymax": F.array_max(y), "epsg": S.inferred_epsg(F.col("declared"), x[0], y[0])})
    return named.drop("coords", "declared", "part")


def paged_layer(spark: SparkSession, path: str) -> DataFrame:
    """Features of landed pages; fails if an id repeats, numberMatched moves, or the rows are not as many as matched."""
    raw = _documents(spark, path, COLLECTION)
    rows = raw.select("numberMatched", F.explode("features").alias("f")).select("numberMatched", "f.id", "f.geometry", "f.properties")
    pages = raw.agg(F.min("numberMatched").alias("low"), F.max("numberMatched").alias("high"))
    gate = rows.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).crossJoin(pages)  # one row by one row
    fault = F.when(F.col("low") != F.col("high"), "numberMatched moved").when(F.col("n") != F.col("ids"), "an id repeats").when(F.col("n") != F.col("high"), "rows are missing")
    checked = gate.select(F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(F.lit(True)).alias("ok"))
    return rows.crossJoin(F.broadcast(checked)).filter("ok").drop("ok", "numberMatched")


def layer_in_bounds(layer: DataFrame, bounds: tuple[float, float, float, float], columns: list[str]) -> DataFrame:
    """Rows of a stored layer whose bounds meet the box; the comparisons are on plain columns, so they reach the Parquet scan."""
    west, south, east, north = bounds
    return layer.filter((F.col("xmax") >= west) & (F.col("xmin") <= east) & (F.col("ymax") >= south) & (F.col("ymin") <= north)).select("id", *columns)


def timeline_frames(spark: SparkSession, path: str) -> DataFrame:
    """dataset, frame id, valid_from, valid_to, kind, and faults of each frame; field aliases in order, zone required."""
    frame = "struct<id:string,timestamp:string,observed_at:string,valid_from:string,valid_to:string,affected:string,active:string>"
    raw = _documents(spark, path, f"id string, name string, timeline array<{frame}>")
    rows = raw.select(F.col("id").alias("dataset"), F.explode("timeline").alias("f"))
    zone = r"(Z|[+-][0-9]{2}:[0-9]{2})$"
    moment = lambda c: F.when(c.rlike(zone), F.try_to_timestamp(c))
    seen = F.coalesce("f.timestamp", "f.observed_at")
    begin, end = F.coalesce("f.valid_from", seen), F.coalesce("f.valid_to", seen)
    faults = F.array_compact(
        F.array(
            F.when(moment(seen).isNull(), F.lit("timestamp")), F.when(F.col("f.valid_from").isNull() != F.col("f.valid_to").isNull(), F.lit("open_interval")),
            F.when(moment(end) < moment(begin), F.lit("negative_interval")), F.when(~moment(seen).between(moment(begin), moment(end)), F.lit("outside_interval")),
            F.when(F.coalesce("f.affected", "f.active").isNull(), F.lit("no_geometry")),
        )
    )
    return rows.select("dataset", F.col("f.id").alias("id"), moment(seen).alias("timestamp"), moment(begin).alias("valid_from"), moment(end).alias("valid_to"), F.when(F.col("f.valid_from").isNull(), "instant").otherwise("explicit_interval").alias("kind"), faults.alias("faults"))
