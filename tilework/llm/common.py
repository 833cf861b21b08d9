"""Helpers shared by the corpus operators: tables, vocabularies, worker caches, size-checked broadcasts."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import written
from ..operators.graphs import components as min_label_components

#: Ids that a broadcast may hold (8 bytes each, under 10 MB as a hash relation of longs per million
#: halves of it); beyond it the join shuffles.
BROADCAST_IDS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bounds of an Arrow batch where rows are whole texts: rows, and bytes (a single longer text is a batch of its own).
TEXT_ROWS, TEXT_BYTES = 1_000, 2 << 20


def text_batches(df: DataFrame, size: int = TEXT_BYTES) -> DataFrame:
    """df, with the session's Arrow batches held to TEXT_ROWS rows and so many bytes; these settings are read when a
    plan runs, so they stay set in the session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return df


_held: dict = {}


def held(key, make: Callable):
    """make(), kept in this Python worker under key.  A worker keeps one key at a time, so that the caches of
    operators that ran before in it don't add up."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def _keep_only(key) -> None:
    if key not in _held:
        _held.clear()


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of the usual clusters; others have no such call
    if trim:
        trim(0)


def lean(function: Callable[[Iterator], Iterator], key=None) -> Callable[[Iterator], Iterator]:
    """function over batches that keeps nothing in the worker but the cache under key: a Python worker lives on after its
    task, and what one operator left free in it would add to what the next one needs."""

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        _keep_only(key)
        try:
            yield from function(batches)
        finally:
            _give_back()

    return run


def free(name: str, *frames: DataFrame) -> str:
    """name, lengthened until no column of the frames is called so."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def only_ids(df: DataFrame, key: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of df whose key is (left_anti: is not) in ids (one column, distinct, already written); broadcast only up to BROADCAST_IDS."""
    right = ids.toDF(key)
    return df.join(F.broadcast(right) if ids.count() <= BROADCAST_IDS else right, key, how)


__all__ = ["BROADCAST_IDS", "free", "held", "lean", "min_label_components", "only_ids", "table", "text_batches", "vocabulary", "written"]
