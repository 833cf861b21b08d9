"""Centroid clustering by Shallot search, exact on whole numbers.

Each vector remembers its centroid, the second-nearest it last saw, an upper bound of the distance to the first and a lower bound
of the distance to all others.  Centroids move; a vector whose bounds still part is left alone.  Any other starts from
the closer of its two, walks that one's neighbours in order of their distance from it, and stops where a neighbour is
farther than the distance to the start plus that to the second-nearest found so far, a ball that shrinks as nearer ones
are found.  Bounds are doubles with room for rounding; whoever survives them is compared by squared distances in whole numbers, ties
to the smaller centroid.

A round is one pass over the vectors and their bounds (a written table), and an aggregation of each task's sums, a row a
centroid; the driver holds the centroids alone.  Components are floor(256 * x); beyond 2^27 they are Python's whole
numbers, and sums go in limbs of 30 bits, so every size is exact.  Distances and inertias beyond 64 bits are returned as the greatest long.

Vectors that are null, not of DIM components, or hold null or non-finite components take no part.  Where fewer vectors than K are
kept, each starts a centroid.  Rows that share a vec_id are vectors each; as first centroids they go by their components, null
vec_ids last.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, written
from .topk import SCALE, finite, scaled

K, DIM, ROUNDS = 40, 64, 5
#: Components up to this leave their squared distances in 64 bits; a limb of larger sums has so many bits.
SMALL, LIMB = 1 << 27, 30
#: Share by which bounds are widened, above what rounding can move them.
ROOM = 1e-9
_MOST = (1 << 63) - 1


def whole(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as whole numbers: 64-bit ones, or Python's where one is large."""
    found = scaled(batch["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, DIM))
    if found.dtype != object and np.abs(found).max(initial=0) <= SMALL:
        return found.astype(np.int64)
    return np.vectorize(int, otypes=[object])(found)


def squared(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances of rows to one centroid, or to one of their own each."""
    if x.dtype == object or centre.dtype == object:
        x, centre = x.astype(object), centre.astype(object)
    gap = x - centre
    return (gap * gap).sum(1)


def _root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


class Search:
    """The nearest centroid of vectors, from the one that they had; was are the centroids that the bounds are about."""

    def __init__(self, centres: list[list[int]], was: list[list[int]] | None = None) -> None:
        self.centres = _matrix(centres)
        k = len(centres)
        apart = np.stack([_root(squared(self.centres, c)) for c in self.centres])
        self.near = np.argsort(apart, axis=1, kind="stable")[:, 1:]  # neighbours of each, nearest first
        self.gaps = np.take_along_axis(apart, self.near, 1)
        self.half = self.gaps[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if was is None else _root(squared(self.centres, _matrix(was)))
        self.moved, self.others = moved, np.array([np.delete(moved, j).max(initial=0) for j in range(k)])

    def first(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """(nearest, second, upper, lower) of vectors without bounds: all centroids are compared."""
        n, k = len(x), len(self.centres)
        d = np.stack([squared(x, c) for c in self.centres], 1)
        order = np.argsort(d, axis=1, kind="stable")
        a, b = order[:, 0], order[:, min(1, k - 1)]
        rows = np.arange(n)
        return a, b, _root(d[rows, a]), _root(d[rows, b]) if k > 1 else np.full(n, np.inf)

    def again(self, x: np.ndarray, a: np.ndarray, b: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
        """The same after a move of the centroids."""
        a, b, upper, lower = a.copy(), b.copy(), upper + self.moved[a], lower - self.others[a]
        open_ = np.arange(len(x))
        for tighten in (False, True):
            if tighten:
                upper[open_] = _root(squared(x[open_], self.centres[a[open_]]))
            bound = np.maximum(lower[open_], self.half[a[open_]])
            open_ = open_[upper[open_] * (1 + ROOM) >= bound * (1 - ROOM)]
        if len(open_) and len(self.centres) > 1:
            some = x[open_]
            da, db = (squared(some, self.centres[of[open_]]) for of in (a, b))
            closer = (db < da) | (db == da) & (b[open_] < a[open_])
            start, second = np.where(closer, b[open_], a[open_]), np.where(closer, a[open_], b[open_])
            d1, d2 = np.where(closer, db, da), np.where(closer, da, db)
            best = start.copy()
            for centre in np.unique(start):
                at = np.flatnonzero(start == centre)
                reach = _root(d1[at])  # the distance to the start stays; the ball's other part shrinks
                for other, gap in zip(self.near[centre], self.gaps[centre], strict=True):
                    inside = gap * (1 - ROOM) <= (reach + _root(d2[at])) * (1 + ROOM)
                    at, reach = at[inside], reach[inside]
                    if not len(at):
                        break
                    new = at[second[at] != other]
                    d = squared(some[new], self.centres[other])
                    won = (d < d1[new]) | (d == d1[new]) & (other < best[new])
                    next_ = ~won & ((d < d2[new]) | (d == d2[new]) & (other < second[new]))
                    w, s = new[won], new[next_]
                    second[w], d2[w], best[w], d1[w] = best[w], d1[w], other, d[won]
                    second[s], d2[s] = other, d[next_]
            a[open_], b[open_], upper[open_], lower[open_] = best, second, _root(d1), _root(d2)
        return a, b, upper, lower


def _matrix(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(v) <= SMALL for row in rows for v in row)
    return np.array(rows, np.int64 if small else object).reshape(-1, DIM)


def _assigned(centres: list[list[int]], was: list[list[int]] | None):
    """Batches with a, b, upper, lower of each vector, by the bounds they hold (none at first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = None
        for batch in batches:
            search, x = search or Search(centres, was), whole(batch)
            found = search.first(x) if was is None else search.again(x, *(batch[c].to_numpy(zero_copy_only=False) for c in ("a", "b", "upper", "lower")))
            columns = [batch["vec_id"], batch["embedding"], *(pa.array(v, t) for v, t in zip(found, (pa.int32(), pa.int32(), pa.float64(), pa.float64()), strict=True))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "embedding", "a", "b", "upper", "lower"])

    return lean(run)


def limbs(total: np.ndarray) -> list[np.ndarray]:
    """Whole numbers in parts of LIMB bits, least first; the last carries the sign."""
    out = []
    while total.dtype == object and any(abs(int(v)) >= 1 << 40 for v in total):
        out.append(np.array([int(v) & ((1 << LIMB) - 1) for v in total], np.int64))
        total = np.array([int(v) >> LIMB for v in total], object)
    return [*out, total.astype(np.int64)]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cluster, limb, n, sums) of a batch's vectors."""
    for batch in batches:
        x, a = whole(batch), batch["a"].to_numpy()
        rows = []
        for cluster in np.unique(a):
            own = x[a == cluster]
            rows += [{"cluster": int(cluster), "limb": k, "n": 0 if k else len(own), "sums": part.tolist()} for k, part in enumerate(limbs(own.sum(0)))]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("cluster", pa.int32()), ("limb", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))


def moved_centres(assigned: DataFrame, centres: list[list[int]]) -> list[list[int]]:
    """Each centroid's vectors' componentwise floor(sum / count); empty ones stay.  At most one row a centroid and limb comes back."""
    parts = assigned.select("embedding", "a").mapInArrow(lean(_sums), "cluster int, limb int, n long, sums array<long>")
    found = parts.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(DIM))).collect()
    n, total = {}, {}
    for r in found:
        n[r["cluster"]] = n.get(r["cluster"], 0) + r["n"]
        own = total.setdefault(r["cluster"], [0] * DIM)
        total[r["cluster"]] = [own[k] + (r[f"s{k}"] << LIMB * r["limb"]) for k in range(DIM)]
    return [[v // n[j] for v in total[j]] if j in n else old for j, old in enumerate(centres)]


def first_centres(vectors: DataFrame, k: int) -> list[list[int]]:
    """The k vectors of least sha256 of 2:<vec_id>, in that order."""
    named = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(named.asc_nulls_last(), "embedding").limit(k).select("embedding").toArrow()
    return [[int(v) for v in x] for batch in rows.to_batches() for x in whole(batch)]


def _distances(centres: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = _matrix(centres)
        for batch in batches:
            d = squared(whole(batch), matrix[batch["a"].to_numpy()])
            distance = pa.array([min(int(v), _MOST) for v in d] if d.dtype == object else d, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["a"], distance], ["vec_id", "cluster", "distance"])

    return lean(run)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector."""
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType.simpleString()
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind if kind == "array<float>" else "array<double>").alias("embedding"))
    kept = kept.filter(finite(F.col("embedding")) & (F.size("embedding") == DIM))
    centres, was, state = first_centres(kept, k), None, kept
    schema = f"vec_id long, embedding {kept.schema['embedding'].dataType.simpleString()}, a int, b int, upper double, lower double"
    for turn in range(rounds + 1):
        state = written(state.mapInArrow(_assigned(centres, was), schema))
        if turn < rounds:
            was, centres = centres, moved_centres(state, centres)
    found = written(state.mapInArrow(_distances(centres), "vec_id long, cluster int, distance long"))
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    clipped = lambda x: min(int(x), _MOST)
    each = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(exact.alias("d")).collect()}  # k rows
    names = [(j, clipped(each.get(j, 0)), clipped(sum(each.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centres)]
    of = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The same in SQL, all distances of each round."""
    out = f"""with kept as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as e
  from embeddings
  where len(embedding) = {DIM} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (select row, unnest(range(1, {DIM} + 1)) as i, unnest(e) as x from kept),
c0 as materialized (
  select row_number() over (order by h, e) - 1 as j, e as c from (select e, sha256('2:' || vec_id) as h from kept order by h, e limit {K}))"""
    for turn in range(ROUNDS + 1):
        out += f""",
a{turn} as materialized (
  select row, j, d from (
    select row, j, d, row_number() over (partition by row order by d, j) as n
    from (select row, j, list_sum(list_transform(list_zip(e, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d from kept, c{turn}))
  where n = 1)"""
        if turn < ROUNDS:
            out += f""",
s{turn} as materialized (select j, i, sum(x) as s, count(*) as n from a{turn} join parts using (row) group by j, i),
m{turn} as materialized (select j, list(cast((s - (((s % n) + n) % n)) // n as bigint) order by i) as m from s{turn} group by j),
c{turn + 1} as materialized (select j, coalesce(m, c) as c from c{turn} left join m{turn} using (j))"""
    return out + f"""
select vec_id, cast(j as integer) as cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by j) as bigint) as cluster_inertia,
       cast(sum(d) over () as bigint) as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from kept join a{ROUNDS} using (row) join c{ROUNDS} using (j)"""


SQL = _sql()
