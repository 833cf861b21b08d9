"""Packing token sequences by cutting stock: column generation over a histogram of piece lengths.

A document's ids are cut every 2048 tokens; the pieces are counted by length class (8 tokens wide,
rounded up, so a pattern of classes always fits; short pieces of one length are first bundled to whole classes).  A linear program over patterns is solved by
revised simplex, with an unbounded-knapsack dynamic program that prices columns; its input is at most
256 counts, however many documents there are.  Rounded patterns give each class a list of rank ranges;
pieces are ranked within their class in two levels (row numbers within a salt of the row's number, plus offsets of the
salts), so no class is ever ranked in one task, whatever rows repeat.

Null and empty texts are one piece holding the end id alone; rows that share a doc_id are packed each;
an empty table gives no pieces.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, held, lean, text_batches, written

CAPACITY = 2048
WIDTH = 8
#: Pieces of so many tokens or fewer are bundled by their exact length.
SHORT = 64
END_ID = 1
#: How far prices are drawn to the best bound's, and the share above the bound at which the program counts as solved.
SMOOTHING, GAP = 0.8, 0.0005
#: Pieces of one salt of one class at about this many.
RANKED = 500_000
#: Words whose ids a worker keeps (about 60 MB), and the bytes of a batch of texts: fewer of either take less memory and more time.
KEPT_WORDS, BATCH = 300_000, 4 << 20
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _loaded(path: str, kept: int = KEPT_WORDS) -> WordIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return WordIds(Tokenizer.from_file(path), kept)


#: Texts that show how a tokenizer treats words: white space of all kinds, marks at a letter, capitals, joined letters.
_SHOWN = ("It was,  late\tin May.\nNo\r\none; SPOKE", " a b ", "été, naïve. Straße. ﬁn. ÉTÉ", "x1, y2. 3.4, z.", "one\x0btwo\x0cthree", "A. b, C., d.,", "unforeseeable wordsmiths qzx")
#: Words that are encoded as one text, and words that are encoded at once: what the tokenizer gives takes far more room than the ids.
_JOINED, _AT_ONCE = 512, 8_192


class WordIds:
    """Ids of texts by a tokenizer that never joins ids over ASCII white space: a word's ids are the same in any text.

    How it treats words is tried on a few texts when the tokenizer is loaded; one that doesn't keep words apart encodes
    whole texts, and so does a text that holds an added token's string in any case (these are matched before
    the text is normalised).  New words are learnt a batch at a time, many as one text where each is known to end at a
    token that ends a word.
    """

    def __init__(self, tokenizer, kept: int) -> None:
        self.tokenizer, self.kept = tokenizer, kept
        self.added = [t.content.encode().lower() for t in tokenizer.get_added_tokens_decoder().values() if t.content]
        plain = lambda x: tokenizer.encode(x, add_special_tokens=False).ids
        self.by_word, self.by_case, self.by_mark = True, False, False
        self.ends = np.zeros(1 + max(tokenizer.get_vocab().values(), default=0), bool)
        self.clear()
        same = lambda: all(plain(x) == self.encode(x).tolist() for x in _SHOWN)
        self.by_word = same()
        self.by_case = self.by_word and all(plain(x) == plain(x.encode().lower().decode()) for x in _SHOWN)
        self.by_mark = self.by_word and all(plain(w[:-1]) + plain(w[-1:]) == plain(w) for x in _SHOWN for w in x.split() if len(w) > 1 and w[-1] in ".," and w[-2].isalpha() and w[-2].isascii())
        for token, k in tokenizer.get_vocab().items():
            self.ends[k] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.first = self.count = self.hits = np.zeros(0, np.int64)

    def _add(self, words: list[bytes], n: np.ndarray, ids: np.ndarray) -> None:
        """Words with the number of their ids, and these ids one after the other."""
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words)), strict=True))
        self.first = np.concatenate((self.first, len(self.flat) + np.cumsum(n) - n))
        self.flat = np.concatenate((self.flat, ids.astype(np.uint32)))
        self.count, self.hits = np.concatenate((self.count, n)), np.concatenate((self.hits, np.zeros(len(n), np.int64)))

    def _at(self, places: np.ndarray) -> np.ndarray:
        """The ids of the words at these places, one after the other."""
        n = self.count[places]
        ends = np.cumsum(n)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[places] - (ends - n), n)]

    def _forget(self) -> None:
        """Drops the words that were met least since the last time."""
        keep = np.flatnonzero(self.hits > max(1, np.median(self.hits)))
        words, n, ids, hits = list(self.index), self.count[keep], self._at(keep), self.hits[keep] // 2
        self.clear()
        self._add([words[k] for k in keep], n, ids)
        self.hits = hits

    def _each(self, words: list[bytes], texts: list[str]) -> None:
        for lo in range(0, len(words), _AT_ONCE):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[lo : lo + _AT_ONCE], add_special_tokens=False)]
            n = np.fromiter(map(len, found), np.int64, len(found))
            self._add(words[lo : lo + _AT_ONCE], n, np.fromiter(chain.from_iterable(found), np.int64, int(n.sum())))

    def _joined_ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of texts of _JOINED words each, few texts at a time."""
        for lo in range(0, len(texts), _AT_ONCE // _JOINED):
            for e in self.tokenizer.encode_batch_fast(texts[lo : lo + _AT_ONCE // _JOINED], add_special_tokens=False):
                yield np.array(e.ids, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        """Words of letters have one end token each.  A letter followed by one mark at the end is split there by the tokenizer
        too, so both parts' ids are kept words' ids."""
        cut = {w: (w[:-1], w[-1:]) for w in words if len(w) > 1 and w[-1:] in (b".", b",") and w[-2:-1].isalpha()} if self.by_mark else {}
        plain = list(dict.fromkeys(x for w in words for x in cut.get(w, (w,)) if x not in self.index))
        texts = b" ".join(plain).decode("utf-8", "surrogatepass").split(" ") if plain else []
        letters, others, sizes, known = [], [], [], []
        for k, x in enumerate(texts):
            (letters if x.isalpha() else others).append(k)
        groups = [letters[lo : lo + _JOINED] for lo in range(0, len(letters), _JOINED)]
        for some, ids in zip(groups, self._joined_ids([" ".join(texts[k] for k in some) for some in groups]), strict=True):
            last = np.flatnonzero(self.ends[ids]) if len(ids) else ids
            if len(last) == len(some) and last[-1] == len(ids) - 1:
                known += some
                sizes.append((np.diff(last, prepend=-1), ids))
            else:
                others += some
        if known:
            self._add([plain[k] for k in known], *map(np.concatenate, zip(*sizes, strict=True)))
        self._each([plain[k] for k in others], [texts[k] for k in others])
        joined = [w for w in cut if w not in self.index]
        if joined:
            parts = np.fromiter((self.index[x] for w in joined for x in cut[w]), np.int64, 2 * len(joined))
            self._add(joined, self.count[parts].reshape(-1, 2).sum(1), self._at(parts))

    def encode_many(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        raws = [x.encode("utf-8", "surrogatepass") for x in texts]
        low = [x.lower() for x in raws]
        whole = [not self.by_word or any(x in raw for x in self.added) for raw in low]
        words = [[] if alone else raw.split() for raw, alone in zip(low if self.by_case else raws, whole, strict=True)]
        if len(self.index) > self.kept:
            self._forget()
        sizes, flat = [len(x) for x in words], list(chain.from_iterable(words))
        at = np.fromiter(map(self.index.get, flat, repeat(-1)), np.int64, len(flat))
        if len(new := np.flatnonzero(at < 0)):
            unknown = [flat[k] for k in new.tolist()]
            self._learn(list(set(unknown)))
            at[new] = np.fromiter(map(self.index.__getitem__, unknown), np.int64, len(unknown))
        self.hits += np.bincount(at, minlength=len(self.hits))
        ids, upto = self._at(at), np.concatenate(([0], np.cumsum(self.count[at])))
        ends = upto[np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))]
        for k, text in enumerate(texts):
            if whole[k]:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                yield ids[ends[k] : ends[k + 1]]

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_many([text]))


def pieces(docs: DataFrame, tokenizer: str, words: int = KEPT_WORDS, batch_bytes: int = BATCH) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids and the end id, cut every CAPACITY ids."""

    key = ("packing", tokenizer, words)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = held(key, lambda: _loaded(tokenizer, words))
        for batch in batches:
            rows = []
            for doc, found in zip(batch["doc_id"], encoder.encode_many([x or "" for x in batch["text"]]), strict=True):
                ids = np.append(found, np.uint32(END_ID)).astype("<u4")
                rows += [(doc, lo, min(CAPACITY, len(ids) - lo), zlib.crc32(ids[lo : lo + CAPACITY].tobytes()), len(ids)) for lo in range(0, len(ids), CAPACITY)]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).astype({"doc_id": "Int64"})

    return text_batches(docs, batch_bytes).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(lean(cut, key), PIECE)


def _best_pattern(values: np.ndarray, units: int) -> np.ndarray:
    """Unbounded knapsack: the counts by class (class i is i + 1 units long) of the most valuable pattern."""
    best, taken = np.zeros(units + 1), np.full(units + 1, -1)
    for c in range(1, units + 1):
        options = values[:c] + best[c - 1 :: -1][:c]
        k = int(np.argmax(options))
        best[c], taken[c] = (options[k], k) if options[k] > best[c - 1] else (best[c - 1], -1)
    counts, c = np.zeros(units), units
    while c > 0:
        if taken[c] < 0:
            c -= 1
        else:
            counts[taken[c]] += 1
            c -= taken[c] + 1
    return counts


def patterns(demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(counts by class, times used) covering the demand exactly, or with the last use of a pattern in part."""
    units = len(demand)
    live = np.flatnonzero(demand)
    if not len(live):
        return []
    basis = np.diag([float(units // (i + 1)) for i in live])
    inverse = np.diag(1 / np.diag(basis))
    amount = inverse @ demand[live]
    centre, bound = np.zeros(len(live)), 0.0

    def priced(price: np.ndarray) -> np.ndarray:
        values = np.full(units, -1.0)
        values[live] = price
        return _best_pattern(values, units)[live]

    for _ in range(20 * units):
        price = np.ones(len(live)) @ inverse
        smooth = SMOOTHING * centre + (1 - SMOOTHING) * price  # prices swing less around the best bound's
        column = priced(smooth)
        below = np.maximum(smooth, 0) @ demand[live] / max(1.0, smooth @ column)
        if below > bound:
            centre, bound = np.maximum(smooth, 0) / max(1.0, smooth @ column), below
        if price @ column <= 1 + 1e-7:
            column = priced(price)
        if price @ column <= 1 + 1e-7 or amount.sum() <= bound * (1 + GAP):
            break
        step = inverse @ column
        ratio = np.full(len(live), np.inf)
        np.divide(amount, step, out=ratio, where=step > 1e-9)
        leaves = int(np.argmin(ratio))
        basis[:, leaves] = column
        amount = np.maximum(amount - ratio[leaves] * step, 0)
        amount[leaves] = ratio[leaves]
        row = inverse[leaves] / step[leaves]
        inverse = inverse - np.outer(step, row)
        inverse[leaves] = row
    times = np.floor(amount + 1e-9).astype(np.int64)
    out, rest = [], demand.astype(np.int64).copy()
    for k in np.argsort(-amount, kind="stable"):
        counts = np.zeros(units, np.int64)
        counts[live] = np.rint(basis[:, k]).astype(np.int64)
        some = counts > 0
        n = int(min(times[k], (rest[some] // counts[some]).min()))
        if n > 0:
            out.append((counts, n))
            rest -= n * counts
    while rest.any():  # what rounding left: largest first, each such pattern as often as it goes
        counts, room = np.zeros(units, np.int64), units
        for i in range(units - 1, -1, -1):
            counts[i] = min(rest[i], room // (i + 1))
            room -= counts[i] * (i + 1)
        some = counts > 0
        n = int((rest[some] // counts[some]).min())
        out.append((counts, n))
        rest -= n * counts
    return out


def _ranges(spark: SparkSession, found: list[tuple[np.ndarray, int]]) -> DataFrame:
    """For each class the items that each pattern takes: per uses of a sequence, from its first sequence on."""
    rows, sequence = [], 0
    rank = np.zeros(CAPACITY // WIDTH + 1, np.int64)
    for counts, n in found:
        for i in np.flatnonzero(counts):
            per = int(counts[i])
            rows.append((int(i) + 1, int(rank[i]), int(rank[i]) + per * n, per, sequence))
            rank[i] += per * n
        sequence += n
    return spark.createDataFrame(rows, "units int, lo long, hi long, per long, base long")


def _items(histogram: dict[int, int]) -> tuple[np.ndarray, list[tuple]]:
    """The number of items of each class, and for each size (SHORT and less: a length; above: SHORT + class) the ranks of pieces that
    make them up: (size, lo, hi, pieces of an item, class, items of the class before).

    Pieces of SHORT tokens and less are bundled, as many of one length as make whole classes, so that none is rounded up;
    the few left over are items each.
    """
    demand, rows = np.zeros(CAPACITY // WIDTH, np.int64), []
    for size, n in sorted(histogram.items()):
        many = WIDTH // math.gcd(size, WIDTH) if size <= SHORT else 1
        units = many * size // WIDTH if size <= SHORT else size - SHORT
        full = n - n % many
        for lo, hi, per, kind in ((0, full, many, units), (full, n, 1, -(-size // WIDTH))):
            if lo < hi:
                rows.append((size, lo, hi, per, kind, int(demand[kind - 1])))
                demand[kind - 1] += (hi - lo) // per
    return demand, rows


def pack(docs: DataFrame, tokenizer: str, words: int = KEPT_WORDS, batch_bytes: int = BATCH) -> DataFrame:
    """The pieces with sequence_id and offset; sequences hold at most CAPACITY tokens, pieces are gapless from 0."""
    spark = docs.sparkSession
    length = F.col("length")
    size = F.when(length <= SHORT, length).otherwise(SHORT + F.ceil(length / WIDTH)).cast("int")
    cut = written(pieces(docs, tokenizer, words, batch_bytes).withColumns({"size": size, "row": F.monotonically_increasing_id()}))
    histogram = {r["size"]: r["n"] for r in cut.groupBy("size").agg(F.count("*").alias("n")).collect()}  # SHORT + 256 rows at most
    demand, rows = _items(histogram)
    salts = max(64, max(histogram.values(), default=0) // RANKED)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("size", "salt").agg(F.count("*").alias("n")).select("size", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    if salts * (SHORT + len(demand)) <= BROADCAST_IDS:
        offsets = F.broadcast(offsets)
    order = Window.partitionBy("size", "salt").orderBy("doc_id", "start", "ids_crc32", "row")
    ranked = salted.withColumn("rank", F.row_number().over(order)).join(offsets, ["size", "salt"]).withColumn("rank", F.col("rank") - 1 + F.col("skip"))
    made = spark.createDataFrame(rows, "size int, from long, upto long, pieces long, units int, skipped long")
    items = ranked.join(F.broadcast(made), "size").filter("rank >= from and rank < upto").withColumn("item", F.col("skipped") + F.floor((F.col("rank") - F.col("from")) / F.col("pieces")))
    placed = items.join(F.broadcast(_ranges(spark, patterns(demand.astype(np.float64)))), "units").filter("item >= lo and item < hi")
    placed = placed.withColumn("sequence_id", F.col("base") + F.floor((F.col("item") - F.col("lo")) / F.col("per")))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "item", "rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset)
