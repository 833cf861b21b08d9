"""Line dedup by content-defined chunks of lines and by runs of lines.

A rolling hash over the hashes of neighbouring lines chooses the chunk boundaries, so an insertion
moves only the boundaries next to it.  A line of over 50 words is a chunk of its own (the boundaries
on both its sides depend on that line alone).  Chunks of two or more lines with at least ten words,
and those long lines, are compared over all documents.  So are, from every line on and up to every
line, the shortest runs of lines that hold over 50 words: any repeated passage of over 50 words is
covered by such runs that repeat, wherever the chunk boundaries fall.  Runs begin and end at lines with text.

Hashes find what repeats, the texts of the repeated ones are then grouped byte by byte, and the lines of
every occurrence after the first (by doc_id, then place) go; lines that the first occurrence holds itself
(runs that overlap their own repeat) stay.

Null and empty texts have no chunks and stay as they are.  Every row has a number of its own, so rows with
a null doc_id (they come first) and rows that share a doc_id (by a hash of the text, then the number) are
compared like any others, and what a task keeps of a row is bounded by that row.  removed_chunks counts
the chunks that lost lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..checkpoints import bucketed
from .common import free, lean, text_batches, written

LONG_WORDS = 50
LEAST_WORDS = 10
#: Lines in the rolling window, and the modulus that sets the mean chunk length.
WINDOW, MODULUS = 2, 3
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def chunks(text: str) -> list[tuple[int, int, int]]:
    """(first line, line after the last, words) of each chunk, in order, without gaps."""
    lines = text.split("\n")
    out, start, words, before = [], 0, 0, [0] * WINDOW
    for k, line in enumerate(lines):
        n = line.count(" ") + 1 if line else 0
        if n > LONG_WORDS:
            if k > start:
                out.append((start, k, words))
            out.append((k, k + 1, n))
            start, words, before = k + 1, 0, [0] * WINDOW
            continue
        words += n
        before = [*before[1:], xxhash.xxh3_64_intdigest(line)]
        rolled = 0
        for h in before:
            rolled = (rolled * _STEP + h) & _MASK
        if (rolled >> 32) % MODULUS == 0:
            out.append((start, k + 1, words))
            start, words = k + 1, 0
    if start < len(lines):
        out.append((start, len(lines), words))
    return out


def _eligible(first: int, after: int, words: int) -> bool:
    return words > LONG_WORDS or after - first >= 2 and words >= LEAST_WORDS


def _runs(sizes: list[int]) -> set[tuple[int, int]]:
    """(first line, line after the last) of the shortest runs of over LONG_WORDS words from each line on and up to each line."""
    full, n = [k for k, size in enumerate(sizes) if size], 0
    out, hi = set(), 0
    for lo in range(len(full)):
        while hi < len(full) and n <= LONG_WORDS:
            n, hi = n + sizes[full[hi]], hi + 1
        if n <= LONG_WORDS:
            break
        out.add((full[lo], full[hi - 1] + 1))
        n -= sizes[full[lo]]
    n, lo = 0, len(full)
    for hi in range(len(full), 0, -1):
        while lo > 0 and n <= LONG_WORDS:
            lo -= 1
            n += sizes[full[lo]]
        if n <= LONG_WORDS:
            break
        out.add((full[lo], full[hi - 1] + 1))
        n -= sizes[full[hi - 1]]
    return out


def spans(text: str, runs: bool) -> list[tuple[int, int]]:
    """(first line, line after the last) of what is compared: eligible chunks and, if runs, the runs, each once."""
    own = {(lo, hi) for lo, hi, words in chunks(text) if _eligible(lo, hi, words)}
    if not runs:
        return sorted(own)
    return sorted(own | _runs([line.count(" ") + 1 if line else 0 for line in text.split("\n")]))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _hashed(runs: bool):
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row, text in zip(batch["row"], batch["text"], strict=True):
                lines = text.split("\n")
                rows += [(row, lo, _hash("\n".join(lines[lo:hi]))) for lo, hi in spans(text, runs)]
            yield pd.DataFrame(rows, columns=["row", "line", "h"])

    return lean(hashed)


def _texts(runs: bool):
    """The texts of the spans named in seen, of one row's text."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row, doc, order, text, seen in zip(batch["row"], batch["doc_id"], batch["th"], batch["text"], batch["seen"], strict=True):
                lines, asked = text.split("\n"), {(x["line"], x["h"]) for x in seen}
                starts = {line for line, _ in asked}
                for lo, hi in spans(text, runs):
                    if lo in starts:
                        part = "\n".join(lines[lo:hi])
                        if (lo, _hash(part)) in asked:
                            rows.append((doc, order, row, lo, _hash(part), part))
            yield pd.DataFrame(rows, columns=["doc_id", "th", "row", "line", "h", "part"]).astype({"doc_id": "Int64"})

    return lean(texts)


_CUT = T.StructType().add("text", "string").add("removed_lines", "integer").add("removed_chunks", "integer")


def _cut(texts: pd.Series, gone: pd.Series, with_runs: pd.Series) -> pd.DataFrame:
    out = []
    for text, marks, runs in zip(texts, gone, with_runs, strict=True):
        if text is None or marks is None or not len(marks):
            out.append((text, 0, 0))
            continue
        lines, asked = text.split("\n"), {(x["line"], x["h"]): x["own"] for x in marks}
        starts = {line for line, _ in asked}
        cut = set()
        for lo, hi in spans(text, runs):
            if lo not in starts:
                continue
            h = _hash("\n".join(lines[lo:hi]))
            own = asked.get((lo, h), lo)
            if own == lo:
                continue
            after = own + hi - lo
            if own < 0 or after <= lo:
                after = lo
            cut.update(range(after, hi))
        kept = [line for k, line in enumerate(lines) if k not in cut]
        out.append(("\n".join(kept) if cut else text, len(cut), sum(any(k in cut for k in range(lo, hi)) for lo, hi, _ in chunks(text)) if cut else 0))
    return pd.DataFrame(out, columns=["text", "removed_lines", "removed_chunks"])


@F.pandas_udf(_CUT)
def _without(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    yield from lean(lambda rest: (_cut(*x) for x in rest))(batches)


def _per_row(rows: DataFrame, out: str) -> DataFrame:
    """(row, out: array of the other columns); it grows with the rows, so its joins shuffle at every size."""
    return written(rows.groupBy("row").agg(F.collect_set(F.struct([c for c in rows.columns if c != "row"])).alias(out))).hint("merge")


def dedup_lines(docs: DataFrame, runs: bool = False) -> DataFrame:
    """docs with repeated chunks (runs: and repeated runs of lines) cut from text, and removed_lines, removed_chunks; all rows stay."""
    row, gone, cut = (free(x, docs) for x in ("row", "gone", "cut"))
    numbered = bucketed(text_batches(docs).withColumn(row, F.monotonically_increasing_id()), row)  # both joins of the texts are on it
    texts = numbered.filter("text <> ''").select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    hashed = written(texts.select("row", "text").mapInPandas(_hashed(runs), "row long, line int, h long"))
    often = written(hashed.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"))
    seen = hashed.join(often, "h", "left_semi")
    parts = written(texts.join(_per_row(seen, "seen"), "row").mapInPandas(_texts(runs), "doc_id long, th long, row long, line int, h long, part string"))
    place = F.struct("doc_id", "th", "row", "line")
    first = written(parts.groupBy("h", "part").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    later = parts.join(first, ["h", "part"]).filter(~place.eqNullSafe(F.col("first")))
    marks = later.select("row", "line", "h", F.when(F.col("first.row") == F.col("row"), F.col("first.line")).otherwise(-1).alias("own"))
    found = numbered.join(_per_row(marks, gone).withColumnRenamed("row", row), row, "left").withColumn(cut, _without("text", gone, F.lit(runs)))
    return found.select(*(F.col(f"{cut}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns), f"{cut}.removed_lines", f"{cut}.removed_chunks")


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs after dedup_lines, n_chars counted anew; documents of which nothing is left go, those empty before stay.

    A null text stays null; columns named removed_lines or removed_chunks pass through as they are."""
    aside = {c: free(f"own_{c}", docs) for c in docs.columns if c.lower() in ("removed_lines", "removed_chunks")}
    cut = dedup_lines(docs.withColumnsRenamed(aside), runs=True)
    cut = cut.filter((F.col("removed_chunks") == 0) | (F.trim("text") != "")).withColumn("n_chars", F.when(F.col("removed_chunks") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.drop("removed_lines", "removed_chunks").withColumnsRenamed({new: old for old, new in aside.items()}).select([F.col(f"`{c}`") for c in docs.columns])
