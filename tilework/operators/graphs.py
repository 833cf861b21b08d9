"""Connected components and identity merging on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node of the undirected edges (a, b); component is the least node.

    Each round takes the least label around a node and jumps along labels; a round is a written table, and
    the loop ends when no label changes.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).toDF("node", "component"))
    while True:
        around = both.join(labels.toDF("b", "seen"), "b").groupBy("a").agg(F.min("seen").alias("seen")).withColumnRenamed("a", "node")
        step = labels.join(around, "node").select("node", F.least("component", "seen").alias("near"), F.col("component").alias("was"))
        new = written(step.join(labels.toDF("near", "far"), "near").select("node", F.least("near", "far").alias("component"), "was"))
        labels = new.select("node", "component")
        if not new.filter("component <> was").limit(1).count():
            return labels


def cycles(links: DataFrame) -> DataFrame:
    """(node, cycle, place) of nodes that each have one next and are the next of one: the least node of its cycle, and the steps from
    that one to it.

    List ranking by doubling: a node knows the least node of the window from it on and how far that is; two windows make one
    of twice the length, and when no window finds a lesser one each covers its cycle.  Rounds are the logarithm of the longest cycle.
    """
    state = written(links.select("node", "next", F.col("node").alias("least"), F.lit(0).cast("long").alias("off")))
    width = 1
    while True:
        ahead = state.select(F.col("node").alias("next"), F.col("next").alias("far"), F.col("least").alias("other"), (F.col("off") + width).alias("there"))
        better = F.col("other") < F.col("least")
        new = state.join(ahead, "next").select("node", F.col("far").alias("next"), F.least("least", "other").alias("least"), F.when(better, F.col("there")).otherwise(F.col("off")).alias("off"), better.alias("better"))
        new = written(new)
        state, width = new.drop("better"), 2 * width
        if not new.filter("better").limit(1).count():
            break
    size = state.groupBy("least").agg(F.count("*").alias("n"))
    return state.join(size, "least").select("node", F.col("least").alias("cycle"), F.pmod(F.col("n") - F.col("off"), F.col("n")).alias("place"))


def merged_identities(evidence: DataFrame) -> DataFrame:
    """(id, identity): ids that share a seam key of at least two tiles, least id first.

    evidence: id, tile, key, lattice, tiles (tiles that saw the id).  A key joins nothing if all its ids
    are lattice markers, or all were seen in more than one tile.
    """
    keys = evidence.groupBy("key").agg(F.count_distinct("tile").alias("tiles_of"), F.min("id").alias("a"), F.bool_and("lattice").alias("all_lattice"), F.bool_and(F.col("tiles") > 1).alias("all_seen"))
    live = keys.filter((F.col("tiles_of") >= 2) & ~F.col("all_lattice") & ~F.col("all_seen"))
    edges = evidence.join(live.select("key", "a"), "key").filter("id <> a").select("a", F.col("id").alias("b")).distinct()
    found = components(edges).toDF("id", "identity")
    return evidence.select("id").distinct().join(found, "id", "left").withColumn("identity", F.coalesce("identity", "id"))
