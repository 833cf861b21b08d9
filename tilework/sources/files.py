"""Files as rows: inventories, packages, raster and point archives, captures, and their sinks."""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..checkpoints import written


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of every file below path."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return raw.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def npz_pair(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    with np.load(io.BytesIO(content), allow_pickle=False) as arrays:
        return arrays["mnt"], arrays["mns"]


def raster_cells(spark: SparkSession, path: str, load: Callable[[bytes], tuple[np.ndarray, np.ndarray]] = npz_pair, pattern: str = "*.npz") -> DataFrame:
    """tile (file name), r, c, mnt, mns of files from whose bytes load gets the two arrays; rows run north to south."""

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, content in zip(batch["path"], batch["content"], strict=True):
                mnt, mns = load(content)
                if mnt.shape != mns.shape:
                    raise ValueError(f"{where}: arrays of different shapes")
                r, c = np.divmod(np.arange(mnt.size), mnt.shape[1])
                yield pd.DataFrame({"tile": where.rsplit("/", 1)[-1].rsplit(".", 1)[0], "r": r.astype(np.int32), "c": c.astype(np.int32), "mnt": mnt.ravel().astype(float), "mns": mns.ravel().astype(float)})

    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return raw.select("path", "content").mapInPandas(decoded, "tile string, r int, c int, mnt double, mns double")


def point_tiles(spark: SparkSession, path: str) -> DataFrame:
    """One row per point of NPZ tiles (positions, heights, crowns, variants), its faults, and a number over all tiles.

    Numbers are the points before the tile (a sum over one row per tile) plus the place in the tile.
    """

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, content in zip(batch["path"], batch["content"], strict=True):
                with np.load(io.BytesIO(content), allow_pickle=False) as a:
                    p, h, crown, v = (a[k] for k in ("positions", "heights", "crowns", "variants"))
                if not len(p) == len(h) == len(crown) == len(v):
                    raise ValueError(f"{where}: arrays of different lengths")
                yield pd.DataFrame({"tile": where.rsplit("/", 1)[-1].removesuffix(".npz"), "place": np.arange(len(p)), "x": p[:, 0], "y": p[:, 1], "z": p[:, 2], "height": h, "crown": crown, "variant": v.astype(np.int32)})

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path)
    rows = raw.select("path", "content").mapInPandas(decoded, "tile string, place long, x double, y double, z double, height double, crown double, variant int")
    before = Window.orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("tile").agg(F.count("*").alias("n")).select("tile", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    faults = F.array_compact(F.array(F.when(F.col("height") < 2, F.lit("height")), F.when(F.col("crown") <= 0, F.lit("crown")), F.when(~F.col("variant").between(0, 5), F.lit("variant"))))
    return rows.join(starts, "tile").withColumn("number", F.col("start") + F.col("place")).withColumn("faults", faults).drop("start")


def packages(listing: DataFrame, required: list[str]) -> DataFrame:
    """Of the copies of a package (package, root, priority, name: one row a file) that hold every required name, the best by priority, then root."""
    whole = listing.groupBy("package", "root", "priority").agg(F.collect_set(F.when(F.col("name").isin(required), F.col("name"))).alias("has")).filter(F.size("has") == len(required))
    return whole.groupBy("package").agg(F.min(F.struct("priority", "root")).alias("best")).select("package", "best.root", "best.priority")


def run_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Inventories of a run folder with the tile from the file's name."""
    raw = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("tile"), "*")


def capture_metadata(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Capture documents with their folder; unreadable ones are rows with audit_exception set."""
    raw = spark.read.schema(f"{schema}, _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).json(path)
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("folder"), "*").withColumn("audit_exception", F.col("_corrupt").isNotNull()).drop("_corrupt")


def write_tiles(df: DataFrame, path: str, tile: list[str], mode: str = "errorifexists") -> None:
    """Rows partitioned by tile, sorted in each file; a tile's rows come from one task."""
    df.repartition(*tile).sortWithinPartitions(*tile, *(c for c in df.columns if c not in tile)).write.mode(mode).partitionBy(*tile).parquet(path)


def write_canonical_json(df: DataFrame, path: str, tile: str) -> None:
    """One file a tile: a JSON object a row, its fields in the order of their names, lines in order."""
    line = F.to_json(F.struct(*sorted(c for c in df.columns if c != tile)))
    df.select(tile, line.alias("value")).repartition(tile).sortWithinPartitions(tile, "value").write.partitionBy(tile).text(path)


def write_heights(cells: DataFrame, path: str) -> None:
    """Height tiles: one array of centimetres per tile row, null where a cell is missing."""
    width = 1 + F.max("c")
    rows = cells.groupBy("tile", "r").agg(F.map_from_entries(F.collect_list(F.struct("c", "hag"))).alias("m"), width.alias("w"))
    rows.select("tile", "r", F.transform(F.sequence(F.lit(0), F.col("w") - 1), lambda k: F.col("m")[k]).alias("cm")).write.parquet(path)


def read_heights(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path).select("tile", "r", F.posexplode("cm").alias("c", "hag"))
    return rows.filter("hag is not null")


def _versions(spark: SparkSession, path: str) -> int:
    """The last committed append of a table, 0 for none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in system.listStatus(place)] if system.exists(place) else []
    return max((int(n.removeprefix("v=")) for n in names if n.startswith("v=")), default=0)


def _committed(spark: SparkSession, staged: str, at: str) -> bool:
    """Moves a written folder to its place, unless another append took that first."""
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(at)
    # without the option to overwrite, a rename fails where the target is there
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, none)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.toString():
            raise
        return False
    return True


def append_captures(df: DataFrame, path: str, key: str = "capture_id", layout: tuple[str, ...] = ("kind", "day", "zoom")) -> DataFrame:
    """Appends the rows whose key is not stored yet and returns those that were refused; keys that repeat in df are refused whole.

    An append is written aside (readers don't see folders that begin with an underscore) and committed by one rename to the next
    version, v=N.  One that is interrupted leaves nothing that is read; of two at the same time the slower one finds its version taken
    and starts over against what the other stored, so that no key is stored twice.
    """
    spark = df.sparkSession
    repeated = df.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key)
    while True:
        version = _versions(spark, path)
        kept = spark.read.schema(df.withColumn("v", F.lit(0)).schema).parquet(path).filter(F.col("v") <= version) if version else df.limit(0)
        stored = kept.select(key)
        bad = written(stored.union(repeated).distinct())
        refused = written(df.join(bad, key, "left_semi"))
        staged = f"{path}/_staged-{uuid.uuid4().hex}"
        try:
            df.join(bad, key, "left_anti").write.partitionBy(*layout).parquet(staged)
            if _committed(spark, staged, f"{path}/v={version + 1}"):
                return refused
        finally:
            place = spark._jvm.org.apache.hadoop.fs.Path(staged)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def compact_attributes(points: DataFrame) -> DataFrame:
    """Typed point attributes: a value stays only if the narrow type holds it without loss."""
    whole = lambda c, top: F.when((F.col(c) == F.floor(c)) & F.col(c).between(0, top), F.col(c).cast("long"))
    out = points.withColumns({"instance": whole("instance", 2**32 - 1), "semantic": whole("semantic", 2**32 - 1), **{k: whole(k, 255).cast("short") for k in ("red", "green", "blue")}})
    return out.withColumn("lossless", F.expr(" and ".join(f"{c} is not null" for c in ("instance", "semantic", "red", "green", "blue"))))
