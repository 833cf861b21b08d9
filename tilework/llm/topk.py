"""Exact top-k by inner product: tiles of queries and shards, a partial selection per tile, a tree of merges.

Queries are dealt into blocks by a hash of their id and candidates into shards by a hash of their row's number, so both
are of about even size whatever ids repeat; each (block, shard) tile is one matrix product in one task, which keeps each query's k best.  The lists are
merged 32 shards at a time.  Ties go to the smaller vec_id, also at the cut.

Vectors that are null or empty or hold null or non-finite components take no part; queries meet only vectors
of their own length.  Every row is a candidate; rows with the query's vec_id are its own and are left
out; a query id held by several rows asks with the least of their vectors.  Components and products are exact
whole numbers of any size; a score beyond 64 bits is returned as the greatest or least long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 5
QUERY_BLOCK, SHARD = 2_048, 4_096
FAN_IN = 32
SCALE = 256


def finite(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)) & (F.size(vector) > 0)


def asking(vectors: DataFrame, every: int) -> DataFrame:
    """(query_id, query) of the ids divisible by every."""
    return vectors.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("query")).withColumnRenamed("vec_id", "query_id")


def tiles(queries: DataFrame, candidates: DataFrame, block: int, shard: int) -> tuple[DataFrame, DataFrame, int]:
    """Queries and candidates (each with dim) keyed by (block, shard, dim), and the number of shards."""
    shards = max(1, -(-candidates.count() // shard))
    blocks = max(1, -(-queries.count() // block))
    numbered = candidates.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    asked = queries.select(F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), *queries.columns)
    return asked, numbered.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "shard", *candidates.columns), shards


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    at = np.arange(len(scores)) if len(scores) <= k else np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), in Python's whole numbers where doubles can't hold the product."""
    with np.errstate(over="ignore"):
        found = np.floor(SCALE * x)
    if np.isfinite(found).all():
        return found
    return np.vectorize(lambda v: int(v) * SCALE if abs(v) > 2.0**60 else int(np.floor(SCALE * v)), otypes=[object])(x)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: doubles where they hold them, 64-bit integers, or Python's beyond that."""
    if a.dtype != object and b.dtype != object:
        bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
        if bound < 2.0**53:
            return a @ b.T
        if bound < 2.0**62:
            return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, -(1 << 63), (1 << 63) - 1)


def _integer_tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    rows = []
    if len(left) and len(right):
        ids = right["vec_id"].to_numpy()
        found = products(scaled(np.stack(left["query"].to_numpy()).astype(np.float64)), scaled(np.stack(right["embedding"].to_numpy()).astype(np.float64)))
        for query, scores in zip(left["query_id"], found, strict=True):
            others = np.flatnonzero(ids != query)
            rows += [(query, ids[others[j]], int(scores[others[j]])) for j in best(scores[others], ids[others], K)]
    out = pd.DataFrame(rows, columns=["query_id", "vec_id", "score"], dtype="int64")
    return out.assign(shard=right["shard"].iloc[0] if len(right) else 0)


def ranked(lists: DataFrame, shards: int, k: int, *ties: str) -> DataFrame:
    """The k best rows of each query by score, then ties, with their rank; lists are merged FAN_IN shards at a time."""
    order = [F.desc("score"), *ties]
    while shards > 1:
        shards = -(-shards // FAN_IN)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int"))
        lists = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "shard").orderBy(*order))).filter(F.col("rank") <= k).drop("rank")
    return lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k)


def exact_top_k(vectors: DataFrame, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the K highest integer inner products of each query."""
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter(finite(F.col("embedding")) & F.col("vec_id").isNotNull())
    queries, candidates, shards = tiles(asking(whole, every).withColumn("dim", F.size("query")), whole.withColumn("dim", F.size("embedding")), QUERY_BLOCK, SHARD)
    key = ["block", "shard", "dim"]
    lists = queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInPandas(_integer_tile, "query_id long, vec_id long, score long, shard int")
    return ranked(lists, shards, K, "vec_id").select("query_id", "rank", "vec_id", "score")


#: The same in SQL: all products, then the first K by score and id.
SQL = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(range(1, len(c.e) + 1), lambda i: q.e[i] * c.e[i])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e)
  where q.vec_id % 50 = 0
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= {K}
"""
