"""Cutting lineage by tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths written since each temporary() began that is open here: threads and tasks have their own.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where the session names none, a folder of this machine in local mode, an error on a cluster."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = current.get() if current.isDefined() else None
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def new_path(spark: SparkSession) -> str:
    """A new place for a table in the shared folder."""
    path = f"{shared_dir(spark)}/tilework-{uuid.uuid4().hex}"
    for paths in _open.get():
        paths.append(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, read back: what executors lose later is read again, not recomputed."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1].replace("-", "_")


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """df as a table in the shared folder, in as many buckets of the key as the session has shuffle partitions: joins on the
    key don't shuffle it again."""
    spark = df.sparkSession
    n, path = int(spark.conf.get("spark.sql.shuffle.partitions")), new_path(spark)
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).format("parquet").saveAsTable(_name(path))
    return spark.table(_name(path))


#: Rows of a task where each is multiplied or walked: a compact file of few splits may stand for very many.
DEALT = 1 << 20


def dealt(df: DataFrame, weight: int, *keys: str) -> DataFrame:
    """df, by the keys if any, in tasks of about DEALT rows, each counted weight times: for what makes weight rows of one, or takes as
    long.  More rows make more tasks, not larger ones."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() * weight // DEALT))
    return df.repartition(n, *keys)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that writes what is to stay; all other tables written inside are deleted at the end."""
    outer = _open.set((*_open.get(), paths := []))
    kept: list[str] = []

    def stay(df: DataFrame) -> DataFrame:
        before = len(paths)
        found = written(df)
        kept.extend(paths[before:])
        return found

    try:
        yield stay
    finally:
        _open.reset(outer)
        for path in set(paths) - set(kept):
            spark.sql(f"drop table if exists {_name(path)}")
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
