"""Approximate nearest neighbours with score-aware anisotropic quantisation.

Unit vectors are turned at random and told by the nearest of a few centres, the distance to it, and the direction from it, which is
product-quantised, two components to a four-bit code; what that leaves is quantised once more in the same way.  The loss
weighs the part of the residual that is parallel to the direction more than the rest, since that part moves high inner
products; assignment is coordinate descent under that loss, and all codewords of all subspaces are
refitted together by one linear solve.  Centres and codebooks come from a bounded sample (SAMPLE vectors, least hash
of the id first); every row is indexed.

A row's table score is minus half its squared distance from the query, with both distances to the centre exact and only the
product of the two directions by table: its error shrinks with both distances, so rows of a dense group are told apart as
well as others.  Equal vectors have equal scores, and ties go to the smaller vec_id at every cut.

A search ships codes alone: queries and codes are dealt into tiles, each tile scans its codes against the queries'
tables and keeps its share of the RERANK best by table (kept), and these lists are merged to the RERANK best of each
query, however many rows there are.  Only their vectors are then fetched, by a join on the row's number, and ranked by
exact cosine in double precision.

Vectors that are null, empty, zero, or hold null or non-finite components take no part; lengths and norms are taken
after scaling by a power of two, so components of any finite size do.  Queries meet vectors of their own
length; each length that occurs has codebooks of its own.  Rows that share an id are all candidates, but for
queries of that id; such a query asks with the least of their vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, written
from .topk import K, asking, best, finite, ranked, tiles

#: Most vectors, and most components, that codebooks of one length are fitted on.
SAMPLE, SAMPLE_COMPONENTS = 20_000, 1 << 22
CODES, WIDTH = 16, 2
#: Inner products above this share of the norm are those to get right; sets the weight of parallel error.
THRESHOLD = 0.2
ROUNDS = 8
#: Steps of conjugate gradients in each round, from the round before's codebooks on.
STEPS = 12
RERANK = 256
#: Centres at most, sample rows to a centre at least, and rounds of moving them.
CENTRES, PER_CENTRE, MOVES = 512, 40, 10
#: Components that are turned together.
TURNED = 512
#: Queries and codes of a tile.
QUERY_BLOCK, SHARD = 512, 16_384


def _even(x: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two each, so that no square of a component overflows or all of them vanish."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -exponent)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, padded to whole subspaces."""
    x = _even(x.astype(np.float64))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.pad(x, ((0, 0), (0, -x.shape[1] % WIDTH)))


def _weight(dim: int) -> float:
    return max(1.0, (dim - 1) * THRESHOLD**2 / (1 - THRESHOLD**2))


def assign(x: np.ndarray, books: np.ndarray, sweeps: int = 2) -> np.ndarray:
    """Codes of unit rows x under the anisotropic loss; books: (subspaces, CODES, WIDTH)."""
    n, m = len(x), len(books)
    parts = x.reshape(n, m, WIDTH)
    extra = _weight(x.shape[1]) - 1
    squares = np.stack([((parts[:, s, None, :] - books[s]) ** 2).sum(-1) for s in range(m)], 1)
    along = np.stack([(parts[:, s] ** 2).sum(-1)[:, None] - parts[:, s] @ books[s].T for s in range(m)], 1)
    codes = squares.argmin(-1)
    rows = np.arange(n)
    total = np.take_along_axis(along, codes[:, :, None], 2)[:, :, 0].sum(1)
    for _ in range(sweeps):
        for s in range(m):
            rest = total - along[rows, s, codes[:, s]]
            codes[:, s] = (squares[:, s] + extra * (rest[:, None] + along[:, s]) ** 2).argmin(1)
            total = rest + along[rows, s, codes[:, s]]
    return codes.astype(np.uint8)


def train(sample: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks: assignment and a joint refit of all codewords in turn; the refit's normal equations are solved by
    conjugate gradients over the codes, so their matrix is never built."""
    x = _unit(sample.astype(np.float64))
    n, m = len(x), x.shape[1] // WIDTH
    rng = np.random.Generator(np.random.PCG64(7))
    books = np.stack([x.reshape(n, m, WIDTH)[rng.integers(0, n, CODES), s] for s in range(m)])
    weight, size = _weight(x.shape[1]), m * CODES * WIDTH
    for _ in range(rounds):
        codes = assign(x, books, 1)
        place = (((np.arange(m, dtype=np.int32) * CODES + codes)[:, :, None] * WIDTH + np.arange(WIDTH, dtype=np.int32)).reshape(n, -1)).astype(np.int32)
        used = np.bincount(place.ravel(), minlength=size) + 1e-9

        def times(v: np.ndarray, place: np.ndarray = place, used: np.ndarray = used) -> np.ndarray:
            along = (v[place] * x).sum(1)
            return used * v + (weight - 1) * np.bincount(place.ravel(), (along[:, None] * x).ravel(), size)

        v = books.ravel().copy()
        rest = weight * np.bincount(place.ravel(), x.ravel(), size) - times(v)
        step = rest / used
        score = rest @ step
        for _ in range(STEPS):
            if score <= 1e-18 * n:
                break
            moved = times(step)
            v += (by := score / (step @ moved)) * step
            rest -= by * moved
            before, score = score, rest @ (rest / used)
            step = rest / used + score / before * step
        books = np.where(used.reshape(books.shape) > 0.5, v.reshape(books.shape), books)
    return books


def pack(codes: np.ndarray) -> np.ndarray:
    """Two four-bit codes to a byte."""
    codes = np.pad(codes, ((0, 0), (0, codes.shape[1] % 2)))
    return codes[:, ::2] | codes[:, 1::2] << 4


def unpack(packed: np.ndarray, m: int) -> np.ndarray:
    return np.stack((packed & 15, packed >> 4), 2).reshape(len(packed), -1)[:, :m]


def _turned(x: np.ndarray) -> np.ndarray:
    """Rows in other axes, the same for all of their length, so that no few subspaces carry most of their length."""
    rng = np.random.Generator(np.random.PCG64(x.shape[1]))
    x = x[:, rng.permutation(x.shape[1])]
    return np.concatenate([part @ np.linalg.qr(rng.normal(size=(part.shape[1],) * 2))[0] for part in np.split(x, range(TURNED, x.shape[1], TURNED), 1)], 1)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    bias = (centres**2).sum(1) / 2
    return np.concatenate([(x[k : k + 4096] @ centres.T - bias).argmax(1) for k in range(0, len(x), 4096)])


def _centres(x: np.ndarray) -> np.ndarray:
    """k-means; each first centre is drawn by its squared distance from those before it, so dense groups apart have one each."""
    rng = np.random.Generator(np.random.PCG64(11))
    picks, away = [], np.ones(len(x))
    while len(picks) < max(1, min(CENTRES, len(x) // PER_CENTRE)) and away.sum() > 1e-12:
        picks.append(x[rng.choice(len(x), p=away / away.sum())])
        away = np.minimum(away if len(picks) > 1 else np.inf, ((x - picks[-1]) ** 2).sum(1))
    centres = np.array(picks)
    for _ in range(MOVES):
        at = _nearest(x, centres)
        order = np.argsort(at, kind="stable")
        own, first, n = np.unique(at[order], return_index=True, return_counts=True)
        centres[own] = np.add.reduceat(x[order], first, 0) / n[:, None]
    return centres


def _split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows as length and direction; a row without length has any."""
    size = np.sqrt((x**2).sum(1))
    there = size > 1e-15
    return np.where(there, size, 0.0), np.where(there[:, None], x / np.where(there, size, 1)[:, None], np.eye(1, x.shape[1]))


def _decoded(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    return books[np.arange(len(books)), codes].reshape(len(codes), -1)


def fit(sample: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Centres and the codebooks of both stages."""
    x = _turned(_unit(sample))
    centres, books = _centres(x), []
    rest = x - centres[_nearest(x, centres)]
    for rounds in (ROUNDS, ROUNDS // 2):
        size, way = _split(rest)
        books.append(train(way[size > 0] if (size > 0).any() else way, rounds))
        rest = way - _decoded(assign(way, books[-1]), books[-1])
    return centres, books


def encode(x: np.ndarray, model: tuple[np.ndarray, list[np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Of unit rows: codes of both stages side by side, the centre, the lengths of both stages, and the share of the score that is
    the row's alone."""
    centres, books = model
    x = _turned(x)
    cell = _nearest(x, centres)
    size, way = _split(x - centres[cell])
    one = assign(way, books[0])
    first = _decoded(one, books[0])
    rest, left = _split(way - first)
    two = assign(left, books[1])
    along = (centres[cell] * (first + rest[:, None] * _decoded(two, books[1]))).sum(1)
    return np.concatenate((one, two), 1), cell, size, size * rest, -size * size / 2 - size * along


def index(vectors: DataFrame, models: dict[int, tuple[np.ndarray, list[np.ndarray]]]) -> DataFrame:
    """vectors (vec_id, embedding, dim) with each row's packed codes, centre and lengths."""

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                codes, cell, size, rest, base = encode(_unit(np.stack(part["embedding"].to_numpy())), models[dim])
                yield part.assign(code=[x.tobytes() for x in pack(codes)], cell=cell.astype(np.int32), size=size, rest=rest, base=base)

    return vectors.mapInPandas(lean(coded), f"vec_id long, embedding {vectors.schema['embedding'].dataType.simpleString()}, dim int, code binary, cell int, size double, rest double, base double")


def kept(shards: int) -> int:
    """How many of a query's RERANK best one of so many even shards is to give: rows are dealt by a hash, so a shard that
    holds six standard deviations more than the mean of them is met less than once in 10^7 lists."""
    mean = RERANK / shards
    return min(RERANK, int(np.ceil(mean + 6 * np.sqrt(mean) + 6)))


def _scan(models: dict[int, tuple[np.ndarray, list[np.ndarray]]], keep: int):
    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, rows, cell = right["vec_id"].to_numpy(), right["row"].to_numpy(), right["cell"].to_numpy()
            size, rest, base = (right[c].to_numpy() for c in ("size", "rest", "base"))
            q = np.stack(left["query"].to_numpy())
            centres, books = models[q.shape[1]]
            m = len(books[0])
            codes = unpack(np.frombuffer(b"".join(right["code"]), np.uint8).reshape(len(right), -1), 2 * m)
            q = _turned(_unit(q))
            apart = -((q**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * q @ centres.T) / 2
            tables = [np.einsum("qsw,skw->qsk", q.reshape(len(q), m, WIDTH), words).astype(np.float32) for words in books]
            for lo in range(0, len(q), 64):
                scores = apart[lo : lo + 64, cell] + base
                for stage, (table, length) in enumerate(zip(tables, (size, rest), strict=True)):
                    near = np.zeros(scores.shape, np.float32)
                    for s in range(m):
                        near += table[lo : lo + 64, s][:, codes[:, stage * m + s]]
                    scores += length * near
                for query, scan in zip(left["query_id"].iloc[lo : lo + 64], scores, strict=True):
                    scan[ids == query] = -np.inf
                    at = best(scan, ids, keep)
                    at = at[ids[at] != query]
                    out.append(pd.DataFrame({"query_id": query, "row": rows[at], "vec_id": ids[at], "score": scan[at]}))
        kinds = {"query_id": "int64", "row": "int64", "vec_id": "int64", "score": "float64"}
        found = pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: [] for c in kinds}).astype(kinds)
        return found.assign(shard=right["shard"].iloc[0] if len(right) else 0)

    return tile


def _cosines(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The K nearest of a query's (left, one row) candidates (right)."""
    a, b = (_even(np.stack(x.to_numpy()).astype(np.float64)) for x in (left["query"], right["embedding"]))
    exact = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
    at = best(exact, right["vec_id"].to_numpy(), K)
    return pd.DataFrame({"query_id": left["query_id"].iloc[0], "rank": np.arange(1, len(at) + 1, dtype=np.int32), "vec_id": right["vec_id"].to_numpy()[at], "score": exact[at]})


def _ranked(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    if len(left) and len(right):
        return _cosines(left, right)
    return pd.DataFrame({"query_id": [], "rank": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "rank": "int32", "vec_id": "int64", "score": "float64"})


def _sample(vectors: DataFrame, dim: int) -> np.ndarray:
    n = max(1, min(SAMPLE, SAMPLE_COMPONENTS // dim))
    rows = vectors.filter(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id", F.xxhash64("embedding")).limit(n).select("embedding").toArrow().column("embedding").combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)


def search(vectors: DataFrame, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the K nearest found by cosine, nearest first, ties to the smaller vec_id."""
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding")).withColumn("dim", F.size("embedding"))
    whole = whole.filter(F.col("vec_id").isNotNull() & finite(F.col("embedding")) & F.exists("embedding", lambda x: x != 0))
    models = {r["dim"]: fit(_sample(whole, r["dim"])) for r in whole.select("dim").distinct().collect()}
    indexed = written(index(whole, models).withColumn("row", F.monotonically_increasing_id()))
    asked = written(asking(indexed, every).withColumn("dim", F.size("query")))
    queries, codes, shards = tiles(asked, indexed.drop("embedding"), QUERY_BLOCK, SHARD)
    key = ["block", "shard", "dim"]
    lists = queries.groupBy(*key).cogroup(codes.groupBy(*key)).applyInPandas(_scan(models, kept(shards)), "query_id long, row long, vec_id long, score double, shard int")
    near = ranked(lists, shards, RERANK, "vec_id", "row").select("query_id", "row")
    pairs = near.join(indexed.select("row", "vec_id", "embedding"), "row").select("query_id", "vec_id", "embedding")
    return asked.groupBy("query_id").cogroup(pairs.groupBy("query_id")).applyInPandas(_ranked, "query_id long, rank int, vec_id long, score double")
