"""Run comparison, reconciliation, and contracts as rule columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .grids import nearest_rank


def violations(df: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """key and fault, one row per broken rule; a rule that is null is broken."""
    faults = F.array_compact(F.array(*(F.when(F.coalesce(ok, F.lit(False)), None).otherwise(F.lit(name)) for name, ok in rules.items())))
    return df.select(*key, F.explode(faults).alias("fault"))


def keyed_conflicts(df: DataFrame, key: list[str], identity: Column) -> DataFrame:
    """One row per key: its rows, and whether their identity differs."""
    return df.groupBy(*key).agg(F.count("*").alias("rows"), F.min(identity).alias("identity"), (F.min(identity) != F.max(identity)).alias("conflict"))


def run_comparison(rows: DataFrame, left: str, right: str) -> DataFrame:
    """Per tile: matched, only_left, only_right, and the nearest-rank p50 and p95 and maximum of the differences.

    rows: run, tile, id, x, height; the first row of a key by (x, height) counts.  One aggregation brings both runs together, without a join.
    """
    firsts = rows.filter(F.col("run").isin(left, right)).groupBy("tile", "id").agg(
        *(F.min(F.when(F.col("run") == run, F.struct("x", "height"))).alias(side) for run, side in ((left, "l"), (right, "r")))
    )
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    delta = F.when(both, F.abs(F.col("l.x") - F.col("r.x")))
    tall = F.when(both, F.abs(F.col("l.height") - F.col("r.height")))
    return firsts.withColumn("dx", delta).withColumn("dh", tall).groupBy("tile").agg(
        F.count_if(both).alias("matched"), F.count_if(F.col("r").isNull()).alias("only_left"), F.count_if(F.col("l").isNull()).alias("only_right"),
        nearest_rank("dx", 0.5).alias("dx_p50"), nearest_rank("dx", 0.95).alias("dx_p95"), F.max("dx").alias("dx_max"), F.max("dh").alias("dh_max"),
    )


def status_totals(rows: DataFrame, group: list[str]) -> DataFrame:
    """valid, ambiguous, rejected and source per group, and whether they add up."""
    found = rows.groupBy(*group).agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("valid", "ambiguous", "rejected")), F.count("*").alias("source"))
    return found.withColumn("balanced", F.col("valid") + F.col("ambiguous") + F.col("rejected") == F.col("source"))


def merged_counters(old: DataFrame, new: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Sums of two manifests by key; batches counts the sides that had it."""
    return old.select(key, *values).unionByName(new.select(key, *values)).groupBy(key).agg(*(F.sum(v).alias(v) for v in values), F.count("*").alias("batches"))


def sealed(df: DataFrame, columns: list[str], hash_col: str) -> DataFrame:
    """df with intact: whether hash_col is the hash of the other columns."""
    return df.withColumn("intact", F.sha2(F.concat_ws("|", *columns), 256) == F.col(hash_col))


def package_faults(listing: DataFrame, manifest: DataFrame, declared: DataFrame) -> DataFrame:
    """(package, path, fault) of sealed packages, one row a fault; a package without rows is whole.

    listing (package, path, bytes, sha256): the files that are there; manifest: those that were sealed; declared (package, files, bytes): the
    totals that the seal states.  Faults of a path: missing, unexpected, repeated (in the manifest), size, hash, unsafe; of a package (path
    null): files, bytes, undeclared (no totals).
    """
    there = listing.select("package", "path", F.col("bytes").alias("own_bytes"), F.col("sha256").alias("own_sha"))
    sealed_once = manifest.groupBy("package", "path").agg(F.min("bytes").alias("bytes"), F.min("sha256").alias("sha256"), F.count("*").alias("times"))
    both = there.withColumn("found", F.lit(True)).join(sealed_once, ["package", "path"], "full")
    of_path = {
        "missing": F.col("found").isNull(), "unexpected": F.col("times").isNull(), "repeated": F.col("times") > 1,
        "size": F.col("own_bytes") != F.col("bytes"), "hash": F.col("own_sha") != F.col("sha256"), "unsafe": S.unsafe_path(F.col("path")).isNotNull(),
    }
    named = lambda faults: F.explode(F.array_compact(F.array(*(F.when(F.coalesce(wrong, F.lit(False)), F.lit(name)) for name, wrong in faults.items())))).alias("fault")
    paths = both.select("package", "path", named(of_path))
    totals = listing.groupBy("package").agg(F.count("*").alias("n"), F.sum("bytes").alias("size")).join(declared.withColumnsRenamed({"files": "said_files", "bytes": "said_bytes"}), "package", "full")
    none = F.lit(0).cast("long")
    of_package = {"files": F.coalesce("n", none) != F.col("said_files"), "bytes": F.coalesce("size", none) != F.col("said_bytes"), "undeclared": F.col("said_files").isNull() | F.col("said_bytes").isNull()}
    return paths.unionByName(totals.select("package", F.lit(None).cast("string").alias("path"), named(of_package)))


def first_failures(faults: DataFrame, fault: str, order: str, limit: int) -> DataFrame:
    """(fault, order, place, total, truncated): the first limit rows of each fault in order, its total, and whether rows were left out.

    Only the first limit rows of a fault and task reach the final ranking, so a fault of any size is ranked in pieces.
    """
    total = faults.groupBy(fault).agg(F.count("*").alias("total"))
    place = F.row_number().over(Window.partitionBy(fault).orderBy(order)).cast("long")
    first = faults.withColumn("place", place).filter(F.col("place") <= limit)  # a limit on a rank is pushed below the shuffle
    return first.join(total, fault).select(fault, order, "place", "total", (F.col("total") > limit).alias("truncated"))


#: From which luminance, and up to which saturation, a pixel is near white.
BRIGHT, COLOURLESS = 0.90, 0.08


def image_statistics(pixels: DataFrame, image: str, limits: dict[str, float]) -> DataFrame:
    """Per image of its pixels (r, g, b from 0 to 1): their number, mean and population deviation of luminance, mean saturation, share of
    near-white pixels, and the limits it breaks: pale (mean above), white (share above), flat (deviation below), grey (saturation below)."""
    light, colour = S.luminance(F.col("r"), F.col("g"), F.col("b")), S.saturation(F.col("r"), F.col("g"), F.col("b"))
    seen = pixels.select(image, light.alias("light"), colour.alias("colour"))
    found = seen.groupBy(image).agg(
        F.count("*").alias("pixels"), F.avg("light").alias("mean"), F.stddev_pop("light").alias("deviation"), F.avg("colour").alias("saturation"),
        (F.count_if((F.col("light") >= BRIGHT) & (F.col("colour") <= COLOURLESS)) / F.count("*")).alias("white"),
    )
    broken = {"pale": F.col("mean") > limits["pale"], "white": F.col("white") > limits["white"], "flat": F.col("deviation") < limits["flat"], "grey": F.col("saturation") < limits["grey"]}
    return found.withColumn("faults", F.array_compact(F.array(*(F.when(wrong, F.lit(name)) for name, wrong in broken.items()))))
