"""Operators on ordered rows: progress, validity intervals, sampling by hash, linear referencing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def progression_faults(df: DataFrame, run: str, order: list[str], values: list[str], strict: bool = False) -> DataFrame:
    """Rows whose value falls below (strict: does not exceed) the one before in their run: run, order columns, faults."""
    w = Window.partitionBy(run).orderBy(*order)
    fell = lambda v: (F.col(v) <= F.lag(v).over(w)) if strict else (F.col(v) < F.lag(v).over(w))
    return df.withColumn("faults", F.array_compact(F.array(*(F.when(fell(v), F.lit(v)) for v in values)))).filter(F.size("faults") > 0)


def interleaved(df: DataFrame, block: str, order: str) -> DataFrame:
    """df with turn and first: sorting by them takes the k-th row of every block before any (k + 1)-th, blocks in first-seen order."""
    w = Window.partitionBy(block).orderBy(order)
    return df.withColumn("turn", F.row_number().over(w)).withColumn("first", F.min(order).over(Window.partitionBy(block)))


def hash_sample(df: DataFrame, group: list[str], quota: int, *parts: Column) -> DataFrame:
    """The quota rows of each group with the least hash of parts, without replacement; place is their rank."""
    w = Window.partitionBy(*group).orderBy(F.sha2(F.concat_ws("|", *parts), 256))
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= quota)


def hash_ranked(df: DataFrame, group: list[str], out: str, *parts: Column) -> DataFrame:
    """df with out: the rank from 1 of each row in its group by the hash of parts, equal hashes in any order.

    In two levels, the hash's first two digits and the rest, so that no group is ranked in one task."""
    marked = df.withColumn("_h", F.sha2(F.concat_ws("|", *parts), 256)).withColumn("_b", F.substring("_h", 1, 2))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    skips = marked.groupBy(*group, "_b").agg(F.count("*").alias("_n")).withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    ranked = marked.withColumn("_k", F.row_number().over(Window.partitionBy(*group, "_b").orderBy("_h"))).join(skips, [*group, "_b"])
    return ranked.withColumn(out, F.col("_k") + F.col("_skip")).select(*df.columns, out)


def segments(vertices: DataFrame) -> DataFrame:
    """line, seq, x, y, x2, y2 of consecutive vertices."""
    w = Window.partitionBy("line").orderBy("seq")
    return vertices.withColumn("x2", F.lead("x").over(w)).withColumn("y2", F.lead("y").over(w)).filter(F.col("x2").isNotNull())


def stations(vertices: DataFrame, count: int) -> DataFrame:
    """count points at (i + 0.5) / count of each line's length; lines without length have none."""
    length = F.sqrt((F.col("x2") - F.col("x")) ** 2 + (F.col("y2") - F.col("y")) ** 2)
    w = Window.partitionBy("line")
    run = segments(vertices).withColumn("length", length).withColumn("upto", F.sum("length").over(w.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("length").over(w))
    every = run.withColumn("station", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).withColumn("at", (F.col("station") + 0.5) * F.col("total") / count)
    here = every.filter((F.col("at") > F.col("upto") - F.col("length")) & (F.col("at") <= F.col("upto")))
    share = (F.col("at") - F.col("upto") + F.col("length")) / F.col("length")
    return here.select("line", "station", (F.col("x") + share * (F.col("x2") - F.col("x"))).alias("x"), (F.col("y") + share * (F.col("y2") - F.col("y"))).alias("y"))


def as_of(frames: DataFrame, moments: DataFrame, bucket: int) -> DataFrame:
    """moments (dataset, t) with the frame valid at t: the latest start, then the largest event_id; null where none is, never carried on.

    Intervals go to each bucket of time they touch, so the join is an equi-join.
    """
    spans = frames.withColumn("_b", F.explode(F.sequence(F.floor(F.col("valid_from") / bucket), F.floor(F.col("valid_to") / bucket))))
    asked = moments.distinct().withColumn("_b", F.floor(F.col("t") / bucket))
    met = asked.join(spans, ["dataset", "_b"]).filter("t between valid_from and valid_to").groupBy("dataset", "t").agg(F.max(F.struct("valid_from", "event_id")).alias("b"), F.count("*").alias("n"))
    return moments.join(met.select("dataset", "t", F.col("b.event_id").alias("frame"), "n"), ["dataset", "t"], "left")


def equispaced_picks(df: DataFrame, group: str, value: str, count: int, share: float) -> DataFrame:
    """count of each group's distinct values at equal steps of their order, up to the share of them; groups with fewer values give none."""
    distinct = df.select(group, value).distinct()
    w = Window.partitionBy(group)
    ranked = distinct.withColumn("_k", F.row_number().over(w.orderBy(value)) - 1).withColumn("_m", F.count("*").over(w))
    last = F.greatest(F.lit(count - 1), F.floor((F.col("_m") - 1) * share))
    picks = ranked.withColumn("pick", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).filter((F.col("_m") >= count) & (F.col("_k") == F.rint(F.col("pick") * last / (count - 1))))
    return picks.select(group, "pick", F.greatest(F.lit(1), F.col(value)).alias(value))


def gaps(events: DataFrame, key: str, at: str, limit: int) -> DataFrame:
    """Sessions of a key: a gap of limit or more starts a new one.  The batch twin of the stream's inactivity timer."""
    w = Window.partitionBy(key).orderBy(at)
    new = F.coalesce((F.col(at) - F.lag(at).over(w) >= limit).cast("int"), F.lit(0))
    numbered = events.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "session").agg(F.min(at).alias("began"), F.max(at).alias("ended"), F.count("*").alias("events"))
