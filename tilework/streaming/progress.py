"""Streams of progress events and observations; each has a batch twin among the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import shared_dir


def tile_progress(events: DataFrame, job: str, tile: str, value: str) -> DataFrame:
    """Greatest value of each job's tile; for update mode."""
    return events.groupBy(F.col(job).alias("job"), F.col(tile).alias("tile")).agg(F.max(value).alias("progress"))


def job_fraction(tiles: DataFrame, scale: float = 1.0) -> DataFrame:
    """A job's fraction from its tiles' last states."""
    last = tiles.groupBy("job", "tile").agg(F.max("progress").alias("progress"))
    return last.groupBy("job").agg(F.count("*").alias("tiles"), F.round(0.08 + 0.82 * F.avg(F.col("progress") / scale), 6).alias("fraction"))


def inactive_sessions(events: DataFrame, key: str, at: str, gap: str, lateness: str) -> DataFrame:
    """Sessions closed by a gap, in append mode once the watermark passes: a closed session is a stalled key."""
    return events.withWatermark(at, lateness).groupBy(F.session_window(at, gap).alias("s"), F.col(key)).agg(F.count("*").alias("events")).select(key, F.col("s.start").alias("began"), F.col("s.end").alias("stalled_at"), "events")


def unique_requests(requests: DataFrame, request: str, at: str, lateness: str | None = None) -> DataFrame:
    """The first row of each request.  With a lateness, within the watermark: state is dropped behind it, and a request that
    comes again later than that counts anew; without, the state holds every request ever seen."""
    if lateness is None:
        return requests.dropDuplicates([request])
    return requests.withWatermark(at, lateness).dropDuplicatesWithinWatermark([request])


def unique_observations(observations: DataFrame, dataset: str, at: str, lateness: str | None = None) -> DataFrame:
    """One observation per dataset and time; a later one never changes an earlier one.  With a lateness, rows behind the
    watermark are dropped and so is the state behind it."""
    rows = observations if lateness is None else observations.withWatermark(at, lateness)
    return rows.dropDuplicates([dataset, at])


def throttled(events: DataFrame, job: str, at: str, every: str, lateness: str) -> DataFrame:
    """The first event of each job in each window."""
    return events.withWatermark(at, lateness).groupBy(F.window(at, every).alias("w"), F.col(job)).agg(F.min(at).alias("first"), F.count("*").alias("events")).select(job, F.col("w.start").alias("window"), "first", "events")


def once(key: list[str], path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that may see a batch again: keys stored by another batch are left out, and a batch overwrites its own part."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(key)
        if epoch:
            new = new.join(spark.read.parquet(path).filter(F.col("epoch") != epoch).select(*key), key, "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def drained(stream: DataFrame, mode: str) -> DataFrame:
    """Runs the stream over what its source holds now and returns everything it emitted, with the batch number."""
    spark: SparkSession = stream.sparkSession
    import uuid

    path = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}-state").trigger(availableNow=True).foreachBatch(lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", True).parquet(path)
