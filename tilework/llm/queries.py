"""One query per corpus operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, bytebpe, chat, clusters, linededup, mainhtml, merkle, minhash, packing, pii, sampling, topk, toxicity
from .common import table, vocabulary


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(chat.with_probe(table(spark, sf_dir, "conversations")), vocabulary("byte_bpe_50k.json"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


def op3_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), runs=True)


def op6_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op7_mainhtml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainhtml.extract(table(spark, sf_dir, "pages"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


def op13_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bytebpe.digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_toxicity": op1_toxicity, "op2_ann": op2_ann, "op3_linededup": op3_linededup, "op4_chat": op4_chat, "op5_topk": op5_topk, "op6_sampling": op6_sampling, "op7_mainhtml": op7_mainhtml, "op8_pii": op8_pii, "op9_packing": op9_packing, "op10_minhash": op10_minhash, "op11_merkle": op11_merkle, "op12_clusters": op12_clusters, "op13_bytebpe": op13_bytebpe}
ORACLES: dict[str, str] = {"op5_topk": topk.SQL, "op10_minhash": minhash.SQL, "op11_merkle": merkle.SQL, "op12_clusters": clusters.SQL}
