"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Sentence probabilities are logistic in the sentence's word features
(each word, and its first three to six letters); a leaky noisy-or combines them to the document's
probability, 1 - (1 - leak) * prod(1 - p(sentence)).  Only document labels are seen in training, yet
the fitted sentence probabilities say where the offence is.

The model is fitted on a bounded sample of labelled rows (TRAIN_TOXIC and TRAIN_CLEAN, least hash of the
id first): Spark counts the features and picks those that evidence of toxicity favours, at most FEATURES of
them, and hands the driver only these features' places.  Every row is then scored, whole text, in one pass
without a shuffle.

Null and empty texts have no sentence and get the leak as score.  A null doc_id is not held out and
never trains.  Repeated labels of an id count as toxic if any is; of rows that share an id the least text
trains, so the sample holds one row an id.  Without toxic training rows everything scores 0, without clean
ones 1.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, text_batches, written

TRAIN_TOXIC, TRAIN_CLEAN = 4_000, 8_000
FEATURES = 4_096
#: Least likelihood ratio statistic of a feature; chance alone passes it less than once in 10^6.
EVIDENCE = 25.0
FOLDS = 5
PREFIXES = (3, 4, 5, 6)
#: Words whose features a task keeps: about 40 MB.
KEPT_WORDS = 200_000
OFFENDING = 0.5
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")
SCORED = "doc_id long, score double, predicted int, sentences array<struct<start:int,end:int,score:double>>"


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    leak: float


def features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) >= k)]


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, lower-case words) of each sentence with a word."""
    for m in _SENTENCE.finditer(text):
        if words := _WORD.findall(m.group().lower()):
            yield m.start(), m.end(), words


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            seen[int(toxic)].update({f for w in set(_WORD.findall(text.lower())) for f in features(w)})
        if sum(map(len, seen.values())) > 200_000:
            yield from _told(seen)
    yield from _told(seen)


def _told(seen: dict[int, Counter]) -> Iterator[pd.DataFrame]:
    for toxic, found in seen.items():
        yield pd.DataFrame({"feature": pd.Series(list(found), dtype=object), "toxic": toxic, "n": list(found.values())})
        found.clear()


def _training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    marks = labels.select("doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~held_out(F.col("doc_id")))
    order = F.xxhash64(F.col("doc_id").cast("string")), "doc_id"
    some = [marks.filter(F.col("toxic") == k).orderBy(*order).limit(n) for k, n in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN))]
    rows = docs.select("doc_id", "text").dropna().join(F.broadcast(written(some[0].union(some[1]))), "doc_id")
    return written(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = _training_rows(text_batches(docs), labels)
    totals = {int(r["toxic"]): r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Model({}, -math.inf, 0.0 if not toxic else 1.0)
    share = toxic / (toxic + clean)
    counted = rows.mapInPandas(lean(_counts), "feature string, toxic int, n long").groupBy("feature").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"), F.sum("n").alias("n"))
    rate = F.col("p") / F.col("n")
    term = lambda k, q, r: F.when(k > 0, k * F.log(q / r)).otherwise(0.0)
    gain = 2 * (term(F.col("p"), rate, F.lit(share)) + term(F.col("n") - F.col("p"), 1 - rate, F.lit(1 - share)))
    best = counted.withColumn("gain", gain).filter((rate > share) & (F.col("gain") >= EVIDENCE)).orderBy(F.desc("gain"), "feature").limit(FEATURES)
    known = {r["feature"]: k for k, r in enumerate(best.select("feature").collect())}

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, y in zip(batch["text"], batch["toxic"], strict=True):
                n, bags = 0, []
                for _, _, words in sentences(text):
                    n += 1
                    if bag := sorted({known[f] for w in set(words) for f in features(w) if f in known}):
                        bags.append(bag)
                out.append((int(y), n, bags))
            yield pd.DataFrame(out, columns=["toxic", "sentences", "bags"])

    sample = rows.mapInPandas(lean(places), "toxic int, sentences int, bags array<array<int>>").toPandas()
    return _noisy_or(sample, list(known))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Bags:
    """The sample as arrays: labels, sentences without a known feature by document, and the rest as (document of a
    sentence, sentence of a feature, feature)."""

    y: np.ndarray
    bare: np.ndarray
    doc: np.ndarray
    sentence: np.ndarray
    feature: np.ndarray

    @staticmethod
    def of(sample: pd.DataFrame) -> Bags:
        y = sample["toxic"].to_numpy(np.float64)
        bags = [(d, bag) for d, many in enumerate(sample["bags"]) for bag in many]
        doc = np.array([d for d, _ in bags], np.int64)
        sentence = np.repeat(np.arange(len(bags)), [len(b) for _, b in bags]) if bags else np.zeros(0, np.int64)
        feature = np.concatenate([np.asarray(b, np.int64) for _, b in bags]) if bags else np.zeros(0, np.int64)
        return Bags(y, sample["sentences"].to_numpy(np.float64) - np.bincount(doc, minlength=len(y)), doc, sentence, feature)


def slope_at(theta: np.ndarray, x: Bags) -> tuple[float, np.ndarray]:
    """The documents' mean log loss under theta (weights, bias, leak as logits) and its gradient."""
    w, bias, leak = theta[:-2], theta[-2], theta[-1]
    p, p0, eps = _sigmoid(bias + np.bincount(x.sentence, w[x.feature], len(x.doc))), _sigmoid(bias), _sigmoid(leak)
    log_clean = np.bincount(x.doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(x.y)) + x.bare * np.log1p(-p0) + np.log1p(-eps)
    clean = np.exp(log_clean)
    loss = -np.where(x.y > 0, np.log(np.maximum(1 - clean, 1e-12)), log_clean).mean()
    # d loss / d log_clean: for y = 0 it is -1, for y = 1 it is clean / (1 - clean)
    slope = np.where(x.y > 0, clean / np.maximum(1 - clean, 1e-9), -1.0) / len(x.y)
    by_sentence = -slope[x.doc] * p
    return float(loss), np.concatenate((np.bincount(x.feature, by_sentence[x.sentence], len(w)), [by_sentence.sum() - (slope * x.bare).sum() * p0, -slope.sum() * eps]))


def _noisy_or(sample: pd.DataFrame, names: list[str]) -> Model:
    """Adam on the documents' log loss; sentences without a known feature share one probability."""
    x = Bags.of(sample)
    theta = np.concatenate((np.full(len(names), 0.5), [-6.0, -3.0]))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, 601):
        _, grad = slope_at(theta, x)
        grad[:-2] += 1e-5 * theta[:-2]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(dict(zip(names, theta[:-2].tolist(), strict=True)), float(theta[-2]), float(_sigmoid(theta[-1])))


class _Words(dict):
    """The weight of each word met so far: the sum over its known features."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) > KEPT_WORDS:
            self.clear()
        found = tuple(f for f in features(word) if f in self.weights)
        self[word] = found
        return found


class Scorer:
    """A text's score and its offending sentences under a model."""

    def __init__(self, model: Model) -> None:
        self.model, self.words = model, _Words(model.weights)
        self.bare = float(np.log1p(-1 / (1 + math.exp(-model.bias)))) if model.bias > -700 else 0.0
        self.none = float(np.log1p(-min(model.leak, 1 - 1e-12)))

    def __call__(self, text: str | None) -> tuple[float, list[dict]]:
        clean, found = self.none, []
        for start, end, words in sentences(text or ""):
            bag = set().union(*filter(None, map(self.words.__getitem__, words)))
            if not bag:
                clean += self.bare
                continue
            z = self.model.bias + sum(map(self.model.weights.__getitem__, bag))
            p = 1 / (1 + np.exp(-min(max(z, -40.0), 27.0)))
            clean += float(np.log1p(-p))
            if p >= OFFENDING:
                found.append({"start": start, "end": end, "score": float(p)})
        return float(-np.expm1(clean)), found


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted, sentences): sentences are those whose own probability reaches OFFENDING."""

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for batch in batches:
            rows = [(doc, value, int(value >= 0.5), found) for doc, (value, found) in zip(batch["doc_id"], map(scorer, batch["text"]), strict=True)]
            yield pd.DataFrame(rows, columns=["doc_id", "score", "predicted", "sentences"]).astype({"doc_id": "Int64"})

    return text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(lean(scored), SCORED)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that a model fitted on docs and labels scores 0.5 or more."""
    model = fit(docs, labels)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series([scorer(t)[0] for t in texts], dtype="float64")

    @F.pandas_udf("double")
    def value(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from lean(scores)(batches)

    return docs.filter(value("text") < 0.5)


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score(docs, fit(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "sentences")
