"""From raw documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
documents; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilework.checkpoints import temporary
from tilework.llm import linededup, minhash, packing, pii, toxicity
from tilework.llm.common import only_ids, table, vocabulary, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = minhash.near_duplicates(docs, at=minhash.STAGE).filter(~F.col("kept")).select("doc_id").distinct()
    return only_ids(docs, "doc_id", written(copies), "left_anti").select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), words=150_000, batch_bytes=1 << 20)  # executors still hold what earlier stages took


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: A fitted model, rolling hashes and tokenizer ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of documents; each stage's own tables are deleted once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with temporary(spark) as stay:
            docs = stay(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
