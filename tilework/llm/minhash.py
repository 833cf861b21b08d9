"""MinHash near-duplicate detection with min-max hashing.

Each permutation keeps both its minimum and its maximum, so 96 hash evaluations per shingle give a
signature of 192 values.  Bands of six values make candidate buckets; links are confirmed on full
shingle sets, word by word, so the signature decides only what is compared.

Work that grows with a group's size is kept linear: documents of equal words (by a
128-bit cryptographic digest of the words in order) collapse to one representative before banding; within a bucket each member is first compared with one leader (the
member met most often over all its buckets, which is the centre of a family of copies).  Only buckets
that still hold several components after that are compared in full, in blocks, inside tasks.

Null and repeated rows: a null text has an empty set; a null doc_id is its own row with a null
component and kept; rows that share a doc_id are one document, linked with whatever any of them is.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Callable, Iterator
from functools import cache, partial
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, min_label_components, only_ids, text_batches, written

WORDS = 5
NUMERATOR, DENOMINATOR = 85, 100
BANDS, ROWS = 32, 6
PERMUTATIONS = BANDS * ROWS // 2
#: Share of equal signature bytes at which a pair is compared on full sets; at similarity 0.85 the share's
#: standard deviation is 0.026, so a link is lost only beyond five of them, and shares no band with probability 3e-7.
ESTIMATE = 0.715


class Setting(NamedTuple):
    """A similarity (numerator / denominator) at which documents are linked, and the candidate search for it."""

    numerator: int
    denominator: int
    bands: int
    rows: int
    estimate: float


#: The contract of op10, and 0.8 for the stage on word shingles: a pair at exactly 0.8 shares none of the 30 bands of 5
#: with probability 7e-6, and its share of equal bytes has a standard deviation of 0.033, of which 0.63 is five below.
CONTRACT = Setting(NUMERATOR, DENOMINATOR, BANDS, ROWS, ESTIMATE)
STAGE = Setting(80, 100, 30, 5, 0.63)
#: Members per side of a block comparison.
BLOCK = 256
#: Bytes hashed at once; a longer text is hashed in pieces.
CHUNK = 1 << 18

_rng = np.random.Generator(np.random.PCG64(20240229))
_A = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_BYTES = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for n bytes; those for two chunks are kept."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    size, found = max(n, 2 * CHUNK + 4096), []
    for base in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        found.append(np.multiply.accumulate(steps))
    if n <= 2 * CHUNK + 4096:
        _POWERS[:] = found
    return found[0], found[1]


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of ASCII-lowered raw, and the words' first bytes."""
    b = np.frombuffer(raw, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _powers(len(b))
    total = np.cumsum(_BYTES[b] * up[: len(b)], dtype=np.uint64)
    space = _SPACE[b]
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    before = np.where(first > 0, total[np.maximum(first, 1) - 1], np.uint64(0))
    return _mix((total[last - 1] - before) * down[first] + (last - first).astype(np.uint64) * _STEP), first


def _pieces(raw: bytes) -> Iterator[bytes]:
    """raw in pieces of about CHUNK bytes that end at white space."""
    lo = 0
    while lo < len(raw):
        hi = lo + CHUNK
        while hi < len(raw) and not _SPACE[raw[hi]]:
            hi += 1
        yield raw[lo:hi]
        lo = hi


def _shingled(words: np.ndarray) -> np.ndarray:
    """The hash of each run of WORDS words."""
    rolled = words[: max(0, len(words) - WORDS + 1)].copy()
    for k in range(1, WORDS):
        rolled = rolled * _STEP + words[k : len(rolled) + k]
    return _mix(rolled)


def _distinct(words: np.ndarray, rolled: np.ndarray) -> np.ndarray:
    if len(words) >= WORDS:
        return np.unique(rolled)
    if not len(words):
        return words
    short = np.array([len(words)], np.uint64)
    for x in words:
        short = _mix(short * _STEP + x + np.uint64(1))
    return short


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's word shingles."""
    at = 0
    raw = (texts[0] or "").encode("utf-8", "surrogatepass") if len(texts) else b""
    while at < len(texts):
        raws, size = [], 0
        while at < len(texts) and (not raws or size + len(raw) < CHUNK):
            raws.append(raw)
            size += len(raw) + 1
            at += 1
            raw = (texts[at] or "").encode("utf-8", "surrogatepass") if at < len(texts) else b""
        if len(raws) == 1:
            words = np.concatenate([np.zeros(0, np.uint64), *(_word_hashes(x)[0] for x in _pieces(raws[0]))])
            yield _distinct(words, _shingled(words))
            continue
        words, first = _word_hashes(b"\n".join(raws))
        cuts = np.searchsorted(first, np.concatenate(([0], np.cumsum([len(x) + 1 for x in raws]))))
        rolled = _shingled(words)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield _distinct(words[lo:hi], rolled[lo : max(lo, hi - WORDS + 1)])


def word_shingles(text: str | None) -> set[tuple[bytes, ...]]:
    """The shingles themselves, as words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return {tuple(words)} - {()} if len(words) < WORDS else set(zip(*(words[k:] for k in range(WORDS)), strict=False))


@cache
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n == PERMUTATIONS:
        return _A, _B
    rng = np.random.Generator(np.random.PCG64(20240229))
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def signature(shingles: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Minimum and maximum of each permutation: 2 * permutations values."""
    factor, shift = _permutations(permutations)
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    for k in range(0, len(shingles), 2048):
        v = shingles[k : k + 2048, None] * factor + shift
        np.minimum(low, v.min(axis=0), out=low)
        np.maximum(high, v.max(axis=0), out=high)
    return np.concatenate((low, high))


def _signed(batches: Iterator[pd.DataFrame], at: Setting) -> Iterator[pd.DataFrame]:
    salt = _mix(np.arange(1, at.bands + 1, dtype=np.uint64))
    for batch in batches:
        rows = []
        for doc, text, s in zip(batch["doc_id"], batch["text"], shingle_sets(batch["text"].tolist()), strict=True):
            if not len(s):
                rows.append((doc, 0, None, None, None))
                continue
            words = hashlib.blake2b(b" ".join(text.encode("utf-8", "surrogatepass").lower().split()), digest_size=16).digest()
            v = signature(s, at.bands * at.rows // 2)
            by = v.reshape(at.rows, at.bands)
            key = salt.copy()
            for r in range(at.rows):
                key = _mix(key * _STEP + by[r])
            rows.append((doc, len(s), words, key.view(np.int64), (_mix(v) >> np.uint64(56)).astype(np.uint8).tobytes()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "words", "bands", "sig"]).astype({"doc_id": "Int64"})


#: Pairs whose hashed sets come this near to the threshold are decided on the words.
SLACK = 0.02


def _linked(x: set, y: set, at: Setting) -> bool:
    both = len(x & y)
    return both > 0 and at.denominator * both >= at.numerator * (len(x) + len(y) - both)


def _similar(x: np.ndarray, y: np.ndarray, at: Setting) -> bool:
    """Whether the hashed sets come near the threshold, so that the words have to decide."""
    least = at.numerator / at.denominator - SLACK
    if not len(x) or not len(y) or min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both)


class _Kept:
    """The hashed sets of the texts met last, and their words where they were asked for, up to KEPT bytes of text."""

    KEPT = 4 << 20

    def __init__(self) -> None:
        self.size, self.sets, self.words = 0, OrderedDict(), {}

    def hashed(self, texts: list[str]) -> list[np.ndarray]:
        new = list(dict.fromkeys(t for t in texts if t not in self.sets))
        self.sets.update(zip(new, shingle_sets(new), strict=True))
        self.size += sum(map(len, new))
        out = [self.sets[t] for t in texts]
        while self.size > self.KEPT and len(self.sets) > 1:
            old, _ = self.sets.popitem(last=False)
            self.words.pop(old, None)
            self.size -= len(old)
        return out

    def linked(self, a: str, b: str, x: np.ndarray, y: np.ndarray, at: Setting) -> bool:
        if not _similar(x, y, at):
            return False
        if len(self.words) > 64:
            self.words.clear()
        for t in (a, b):
            if t not in self.words:
                self.words[t] = word_shingles(t)
        return _linked(self.words[a], self.words[b], at)


def _confirmed(batches: Iterator[pd.DataFrame], at: Setting) -> Iterator[pd.DataFrame]:
    kept = _Kept()
    for batch in batches:
        hit = []
        for lo in range(0, len(batch), 64):
            part = batch.iloc[lo : lo + 64]
            left, right = part["ta"].fillna("").tolist(), part["tb"].fillna("").tolist()
            for a, b, x, y in zip(left, right, kept.hashed(left), kept.hashed(right), strict=True):
                hit.append(kept.linked(a, b, x, y, at))
        yield batch.loc[hit, ["a", "b"]]


def confirmed(pairs: DataFrame, docs: DataFrame, at: Setting = CONTRACT) -> DataFrame:
    """Those of the pairs (a, b) whose full shingle sets are similar enough."""
    pairs = written(pairs)
    ids = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    texts = written(only_ids(docs, "doc_id", ids))
    left, right = texts.toDF("a", "ta"), texts.toDF("b", "tb")
    return written(pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInPandas(lean(partial(_confirmed, at=at)), "a long, b long").distinct())


def _by_tile(batches: Iterator[pd.DataFrame], handle: Callable[[pd.DataFrame], pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """handle's result for each block pair; rows come sorted by (key, i, j), a block pair may span batches."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        of = batch[["key", "i", "j"]].to_numpy()
        starts = np.concatenate(([0], 1 + np.flatnonzero((of[1:] != of[:-1]).any(axis=1))))
        found = [handle(batch.iloc[lo:hi]) for lo, hi in zip(starts[:-1], starts[1:], strict=True)]
        rest = batch.iloc[starts[-1] :]
        if found := [x for x in found if len(x)]:
            yield pd.concat(found, ignore_index=True)
    if rest is not None and len(rest):
        yield handle(rest)


def _likely(g: pd.DataFrame, at: Setting) -> Iterator[tuple[int, np.ndarray]]:
    """Per row of a block pair the rows of other components that its signature is close to, each pair in its first common bucket only."""
    sig = np.frombuffer(b"".join(g["sig"]), np.uint8).reshape(len(g), -1)
    bands = np.stack(g["bands"].to_numpy())
    doc, comp, side = g["doc"].to_numpy(), g["comp"].to_numpy(), g["side"].to_numpy()
    key, i, j = g["key"].iloc[0], g["i"].iloc[0], g["j"].iloc[0]
    right = np.flatnonzero(side == j)
    for x in np.flatnonzero(side == i):
        y = right[(comp[right] != comp[x]) & ((doc[right] > doc[x]) if i == j else True)]
        if len(y):
            y = y[(sig[y] == sig[x]).mean(axis=1) >= at.estimate]
        if len(y):
            y = y[bands[x][(bands[y] == bands[x]).argmax(axis=1)] == key]
        if len(y):
            yield x, y


def _close(batches: Iterator[pd.DataFrame], at: Setting) -> Iterator[pd.DataFrame]:
    def rows(g: pd.DataFrame) -> pd.DataFrame:
        hit = sorted({k for x, y in _likely(g, at) for k in (x, *y)})
        return g.iloc[hit]

    return _by_tile(batches, rows)


def _compared(batches: Iterator[pd.DataFrame], at: Setting) -> Iterator[pd.DataFrame]:
    """Links of each block pair, without those that links found before already imply."""

    def links(g: pd.DataFrame) -> pd.DataFrame:
        texts = g["text"].fillna("").tolist()
        sets, kept = list(shingle_sets(texts)), _Kept()
        doc, root, out = g["doc"].tolist(), {c: c for c in g["comp"]}, []
        comp = g["comp"].tolist()

        def top(c: int) -> int:
            while root[c] != c:
                c = root[c]
            return c

        for x, many in _likely(g, at):
            for y in many:
                a, b = top(comp[x]), top(comp[y])
                if a != b and kept.linked(texts[x], texts[y], sets[x], sets[y], at):
                    root[max(a, b)] = min(a, b)
                    out.append((min(doc[x], doc[y]), max(doc[x], doc[y])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return _by_tile(batches, links)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at: Setting = CONTRACT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs, linked at the similarity of at; see the module's text."""
    docs = text_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = written(docs.mapInPandas(lean(partial(_signed, at=at)), "doc_id long, n_shingles long, words binary, bands array<long>, sig binary"))
    known = signed.filter("doc_id is not null and n_shingles > 0")
    groups = written(known.groupBy("words").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    members = written(signed.join(groups, "words", "left").withColumn("rep", F.coalesce(F.when(F.col("n_shingles") > 0, F.col("rep")), "doc_id")).drop("words"))
    reps = members.filter("rep = doc_id and n_shingles > 0")

    keyed = reps.select(F.col("doc_id").alias("doc"), F.explode("bands").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = written(keyed.join(written(sizes).hint("merge"), "key"))  # both sides grow with the rows
    often = written(met.groupBy("doc").agg(F.sum("n").alias("met")))
    leaders = written(met.join(often, "doc").groupBy("key").agg(F.max_by("doc", F.struct("met", -F.col("doc"))).alias("leader")))
    star = met.join(leaders, "key").filter("doc <> leader").select(F.least("doc", "leader").alias("a"), F.greatest("doc", "leader").alias("b")).distinct()
    star = written(star)
    links = confirmed(star, docs, at)

    labels = min_label_components(links)
    labelled = written(met.join(labels.toDF("doc", "comp"), "doc", "left").withColumn("comp", F.coalesce("comp", "doc")))
    still = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).filter("lo <> hi and n > 2")
    split = labelled.drop("n").join(written(still.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))), "key")
    split = split.withColumn("side", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    split = written(split.select("doc", "comp", "key", "side", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")))
    ids = written(split.select("doc").distinct())
    signs = written(only_ids(reps.select(F.col("doc_id").alias("doc"), "sig", "bands"), "doc", ids).dropDuplicates(["doc", "sig"]))
    tiles = split.select("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "doc", "comp", "side").join(signs, "doc")
    tiles = tiles.select("key", "i", "j", "doc", "comp", "side", "sig", "bands")
    close = written(tiles.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInPandas(lean(partial(_close, at=at)), tiles.schema))
    texts = written(only_ids(docs.toDF("doc", "text"), "doc", written(close.select("doc").distinct())))
    more = close.join(texts, "doc").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInPandas(lean(partial(_compared, at=at)), "a long, b long")
    links = links.union(written(more.distinct()))
    repeated = members.filter("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("lo"), F.count("*").alias("n")).filter("n > 1")
    links = links.union(members.join(written(repeated.select("doc_id")), "doc_id", "left_semi").filter("rep <> doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))

    labels = min_label_components(links)
    found = members.join(labels.toDF("rep", "component"), "rep", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


#: The same in SQL: all shingles joined, all links, the least document that each reaches.
SQL = r"""
with w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda x: x <> '') as words
  from documents
), s as (
  select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as shingles
  from w
), e as (select doc_id, unnest(shingles) as x from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
l as (select p.a, p.b from p join s x on x.doc_id = p.a join s y on y.doc_id = p.b where 100 * k >= 85 * (len(x.shingles) + len(y.shingles) - k)),
u as (select a, b from l union select b, a from l),
reached as (with recursive r as (select doc_id as node, doc_id as seen from documents union select r.node, u.b from r join u on u.a = r.seen) select node, min(seen) as component_id from r group by node)
select doc_id, cast(len(shingles) as bigint) as n_shingles, component_id, doc_id = component_id as kept from s join reached on node = doc_id
"""
