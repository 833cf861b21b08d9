"""Byte-level BPE by a segment tree over byte positions.

A text is split by the vocabulary's pattern, and each match is merged alone.  A leaf of the tree is a byte position and holds the
rank of the pair that begins there, if the position still begins a token; a node holds the least of its children's, the
left one's where they tie.  So the root is the leftmost pair of least rank, and a merge is three point updates: the pair that
went, and the pairs of its live neighbours.  A match of n bytes takes n log n steps, whatever its length.  A match that is itself a token is
that token, as the public encoder has it.

The new matches of a batch are merged together, a tree each, where there are many of a size.  A worker keeps the ids of
the matches it met (KEPT of them, in two halves: when the newer one is full it takes the place of the older); those of over
LONG characters are not kept.  Texts are split SLICE matches at a time, so what a text needs beside itself doesn't grow with it.

Null and empty texts have no ids; rows that repeat are encoded each; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, lean, text_batches

KEPT, LONG = 600_000, 64
SLICE = 200_000
#: Most matches that are merged together, and the number from which it pays.
TOGETHER, FEW = 8_192, 32
#: Above every rank.
_NONE = 1 << 62


def ranks_of(path: str) -> dict[bytes, int]:
    """Token and rank of each line of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of a match: its least-ranked adjacent pair, the leftmost of equals, is merged until no pair is a token."""
    n = len(piece)
    size = 1 << max(0, (n - 1).bit_length())
    shift, least = size - 1, size.bit_length()
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the token that begins at a live position; the live position before it
    get = ranks.get
    tree = [_NONE] * (2 * size)  # rank and position in one number, so that the least is the leftmost of the least rank
    for at in range(n - 1):
        rank = get(piece[at : at + 2])
        if rank is not None:
            tree[size + at] = rank << least | at
    for node in range(shift, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left <= right else right

    def put(at: int, value: int) -> None:
        node = size + at
        if tree[node] == value:
            return
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            value = left if left <= right else right
            if tree[node] == value:
                return
            tree[node] = value
            node >>= 1

    def pair(at: int) -> int:
        """The value of the pair that begins at a live position."""
        middle = ends[at]
        if middle >= n or ends[middle] - at > longest:
            return _NONE
        rank = get(piece[at : ends[middle]])
        return _NONE if rank is None else rank << least | at

    while (best := tree[1]) < _NONE:
        at = best & shift | best & size
        gone = ends[at]
        ends[at] = after = ends[gone]
        if after < n:
            before[after] = at
        put(gone, _NONE)
        put(at, pair(at))
        if before[at] >= 0:
            put(before[at], pair(before[at]))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : ends[at]]])
        at = ends[at]
    return out


def splits(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens that together are a token, as sorted numbers left * 2^32 + right, and the tokens they are."""
    get = ranks.get
    found = [(left << 32 | right, rank) for token, rank in ranks.items() for k in range(1, len(token)) if (left := get(token[:k])) is not None and (right := get(token[k:])) is not None]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0])]
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def merged_together(pieces: list[bytes], ranks: dict[bytes, int], pairs: tuple[np.ndarray, np.ndarray], size: int) -> list[bytes]:
    """merged(), as little-endian bytes, of many matches of at most size bytes (a power of two), each with a tree of its own: a step makes one merge in each."""
    m, least = len(pieces), size.bit_length() - 1
    lengths = np.fromiter(map(len, pieces), np.int64, m)
    single = np.array([ranks.get(bytes((x,)), 0) for x in range(256)], np.int64)
    raw = np.frombuffer(b"".join(x.ljust(size, b"\0") for x in pieces), np.uint8).reshape(m, size)
    ids, place = single[raw], np.arange(size)
    ends, before = np.tile(place + 1, (m, 1)), np.tile(place - 1, (m, 1))
    begins = place < lengths[:, None]  # a token
    keys, whole = pairs
    tree = np.full((m, 2 * size), _NONE, np.int64)

    def values(left: np.ndarray, right: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        """The tree's value of pairs of ids at positions, where there are such pairs."""
        key = left << 32 | right
        k = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
        return np.where(there & (keys[k] == key), whole[k] << least | at, _NONE) if len(keys) else np.full(key.shape, _NONE)

    tree[:, size:-1] = values(ids[:, :-1], ids[:, 1:], place[:-1], begins[:, 1:])
    for level in reversed(range(least)):
        below = tree[:, 2 << level : 4 << level]
        tree[:, 1 << level : 2 << level] = np.minimum(below[:, ::2], below[:, 1::2])
    live = np.arange(m)
    while len(live := live[tree[live, 1] < _NONE]):
        best, n = tree[live, 1], lengths[live]
        at = best & (size - 1)
        gone = ends[live, at]
        after = ends[live, gone]
        ids[live, at], ends[live, at], begins[live, gone] = best >> least, after, False
        more = after < n
        before[live[more], after[more]] = at[more]
        prior = np.maximum(before[live, at], 0)
        tree[live, size + gone] = _NONE
        tree[live, size + at] = values(ids[live, at], ids[live, np.minimum(after, size - 1)], at, more)
        had = before[live, at] >= 0
        tree[live[had], size + prior[had]] = values(ids[live, prior], ids[live, at], prior, had)[had]
        for leaf in (gone, at, prior):
            node = size + leaf
            for _ in range(least):
                node >>= 1
                tree[live, node] = np.minimum(tree[live, 2 * node], tree[live, 2 * node + 1])
    flat, upto = ids[begins].astype("<u4").tobytes(), np.cumsum(4 * begins.sum(1)).tolist()
    return [flat[lo:hi] for lo, hi in itertools.pairwise([0, *upto])]


class Encoder(dict):
    """Ids of texts and back; holds matches and their ids as little-endian bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        super().__init__()
        self.ranks, self.longest, self.pairs, self.older = ranks, max(map(len, ranks), default=0), splits(ranks), {}
        self.pattern = regex.compile(pattern)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def __missing__(self, match: str) -> bytes:
        found = self.older.get(match)
        if found is None:
            raw = match.encode("utf-8", "replace")
            rank = self.ranks.get(raw)
            found = self._bytes([rank] if rank is not None else merged(raw, self.ranks, self.longest))
        if len(match) <= LONG:
            self._keep({match: found})
        return found

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def _keep(self, found: dict[str, bytes]) -> None:
        if len(self) + len(found) > KEPT // 2:
            self.older = dict(self)
            self.clear()
        self.update(found)

    def learn(self, matches: set[str]) -> None:
        """Keeps the ids of what is new among matches, merging those of a size together."""
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for match in matches.difference(self, self.older):
            raw = match.encode("utf-8", "replace")
            if raw not in self.ranks and len(raw) <= LONG:
                by_size.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append((match, raw))
        for size, some in by_size.items():
            if len(some) >= FEW:
                for lo in range(0, len(some), TOGETHER):
                    names, raws = zip(*some[lo : lo + TOGETHER], strict=True)
                    self._keep(dict(zip(names, merged_together(raws, self.ranks, self.pairs, size), strict=True)))

    def _slices(self, text: str) -> Iterator[bytes]:
        matches = (m[0] for m in self.pattern.finditer(text))
        while some := list(itertools.islice(matches, SLICE)):
            self.learn(set(some))
            yield b"".join(map(self.__getitem__, some))

    def encoded(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """The ids of each text, slice by slice."""
        matches = [self.pattern.findall(x) if len(x) <= SLICE else () for x in texts]
        self.learn(set().union(*matches))
        for text, some in zip(texts, matches, strict=True):
            yield iter((b"".join(map(self.__getitem__, some)),)) if len(text) <= SLICE else self._slices(text)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(next(self.encoded([text]))), "<u4")

    def decoded(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoder(path: str, pattern: str) -> Encoder:
    return held(("bytebpe", path, pattern), lambda: Encoder(ranks_of(path), pattern))


def _digested(path: str, pattern: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    own = encoder(path, pattern)
    for batch in batches:
        rows = []
        for slices in own.encoded([x or "" for x in batch["text"]]):
            n, ids_of, bytes_of = 0, hashlib.sha256(), hashlib.sha256()
            for ids in slices:
                n += len(ids) // 4
                ids_of.update(ids)
                bytes_of.update(own.decoded(ids))
            rows.append((n, ids_of.hexdigest(), bytes_of.hexdigest()))
        out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"], index=batch.index)
        yield pd.concat([batch[["doc_id"]].astype({"doc_id": "Int64"}), out], axis=1)


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row: its text encoded, and the ids decoded again."""
    work = lean(functools.partial(_digested, path, pattern), ("bytebpe", path, pattern))
    return text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _ids(path: str, pattern: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    own = encoder(path, pattern)
    for batch in batches:
        found = own.encoded([x or "" for x in batch["text"]])
        ids = [None if x is None else np.frombuffer(b"".join(slices), "<u4").astype(np.int32) for x, slices in zip(batch["text"], found, strict=True)]
        yield batch.drop(columns="text").assign(ids=pd.Series(ids, dtype=object, index=batch.index))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(row, ids) of docs (row, text), ids array<int>; null texts have null ids."""
    kind = docs.schema["row"].dataType.simpleString()
    return text_batches(docs).select("row", "text").mapInPandas(lean(functools.partial(_ids, path, pattern), ("bytebpe", path, pattern)), f"row {kind}, ids array<int>")


def _texts(path: str, pattern: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    own = encoder(path, pattern)
    for batch in batches:
        texts = [None if x is None else own.decoded(np.asarray(x, "<u4").tobytes()).decode("utf-8", "replace") for x in batch["ids"]]
        yield batch.drop(columns="ids").assign(text=pd.Series(texts, dtype=object, index=batch.index))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(row, text) of encoded (row, ids); bytes that are no UTF-8 become U+FFFD."""
    kind = encoded.schema["row"].dataType.simpleString()
    return text_batches(encoded).select("row", "ids").mapInPandas(lean(functools.partial(_texts, path, pattern), ("bytebpe", path, pattern)), f"row {kind}, text string")
