"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has probability p = sigmoid(bias + weights of its
words and of their beginnings), the document 1 - prod(1 - p), the noisy-or. Only documents are
labelled; the weights are fitted to the documents' likelihood, and the sentence scores then
tell where a document offends.

Fitting takes about MAX_PER_CLASS labelled documents of each class, chosen by a hash of the id,
and MAX_FEATURES features; scoring reads every text whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.shared import written

MAX_PER_CLASS = 8000
MAX_FEATURES = 4096
MIN_SENTENCES = 3
MIN_LOG_ODDS = 1.0
PREFIXES = (4, 5, 6)
FOLDS = 5
PREDICT_FROM = 0.5
ROUNDS = 400
PENALTY = 1e-4
_CACHE = 500_000
_SENTENCE = re.compile(r"[^.!?\n]*[^.!?\s][^.!?\n]*")
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """The word, and its beginnings marked by a star."""
    return [word, *[word[:n] + "*" for n in PREFIXES if len(word) > n]]


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]


def _training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, y, text of the sample; held-out rows never get here."""
    known = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y"))
             .where(~held_out("doc_id")))
    sizes = {row["y"]: row["count"] for row in known.groupBy("y").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    limit = F.lit(0.0)
    for y, n in sizes.items():
        limit = F.when(F.col("y") == y, min(1.0, MAX_PER_CLASS / n)).otherwise(limit)
    sample = written(known.where(place < limit), "sample")
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # About 2 * MAX_PER_CLASS rows of two numbers, whatever the input.
    return texts.join(F.broadcast(sample), "doc_id")


def held_out(doc_id: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % FOLDS == 0, F.lit(False))


def _features(rows: DataFrame) -> list[str]:
    """Features of distinct sentences that lean to toxic documents, the strongest first.

    A sentence that occurs in an untoxic document is untoxic, and copies count once.
    """
    sentences = (rows.select("y", F.explode(F.regexp_extract_all(
        F.lower("text"), F.lit(r"([^.!?\n]+)"), F.lit(1))).alias("sentence"))
        .groupBy("sentence").agg(F.min("y").alias("y")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for sentence, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[y].update({f for w in _WORD.findall(sentence) for f in features_of(w)})
                counts[y][""] += 1
            names = list(counts[1])  # what no toxic document has is no evidence
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([counts[1][f] for f in names], pa.int64()),
                 pa.array([counts[0][f] for f in names], pa.int64())], ["feature", "pos", "neg"])
            rest = [f for f in counts[0] if f not in counts[1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rest, pa.string()), pa.array([0] * len(rest), pa.int64()),
                 pa.array([counts[0][f] for f in rest], pa.int64())], ["feature", "pos", "neg"])

    counted = written(sentences.mapInArrow(run, "feature string, pos long, neg long")
                      .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
                      .where(f"pos >= {MIN_SENTENCES} OR feature = ''"), "features")
    whole = counted.where("feature = ''").first()
    if whole is None:
        return []
    lean = (F.log((F.col("pos") + 0.5) / (whole["pos"] + 1)) - F.log((F.col("neg") + 0.5) / (whole["neg"] + 1)))
    best = (counted.where("feature <> ''").withColumn("lean", lean).where(F.col("lean") > MIN_LOG_ODDS)
            .orderBy((F.col("lean") * F.col("pos")).desc(), "feature").limit(MAX_FEATURES))
    return [row["feature"] for row in best.select("feature").collect()]


def _bags(rows: DataFrame, names: list[str]) -> pa.Table:
    """y, number of sentences, and the features of those sentences that have some."""
    index = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ids, lengths = [], [], []
            for text in batch.column(2).to_pylist():
                found = [sorted({index[f] for w in _WORD.findall(s) for f in features_of(w) if f in index})
                         for s in _SENTENCE.findall(text.lower())]
                counts.append(len(found))
                ids.append([f for s in found for f in s])
                lengths.append([len(s) for s in found if s])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(lengths, pa.list_(pa.int32()))],
                ["doc_id", "y", "n", "ids", "lengths"])

    schema = "doc_id long, y int, n long, ids array<int>, lengths array<int>"
    bags = rows.select("doc_id", "y", "text").mapInArrow(run, schema)
    return bags.toArrow().sort_by([("doc_id", "ascending"), ("n", "ascending")])


def _fit(bags: pa.Table, n_features: int) -> tuple[float, np.ndarray]:
    """Full-batch Adam on the noisy-or likelihood."""
    y = bags["y"].to_numpy().astype(float)
    lengths = bags["lengths"].combine_chunks()
    ids = bags["ids"].combine_chunks().flatten().to_numpy()
    sizes = lengths.flatten().to_numpy()
    bag = np.repeat(np.arange(len(y)), lengths.value_lengths().to_numpy())
    blank = bags["n"].to_numpy() - lengths.value_lengths().to_numpy()
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    params, m, v = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    params[-1] = -5.0
    for step in range(1, ROUNDS + 1):
        z = params[-1] + np.bincount(sentence, params[ids], len(sizes))
        log_q = -np.logaddexp(0, z)
        log_q_blank = -np.logaddexp(0, params[-1])
        log_none = np.minimum(np.bincount(bag, log_q, len(y)) + blank * log_q_blank, -1e-12)
        # d loss / d z of a sentence is p for an untoxic document, -p (1 - P) / P for a toxic one.
        factor = np.where(y > 0, -np.exp(log_none) / -np.expm1(log_none), 1.0) / len(y)
        slope = factor[bag] * np.exp(z + log_q)
        gradient = np.zeros_like(params)
        gradient[:-1] = np.bincount(ids, slope[sentence], n_features) + PENALTY * params[:-1]
        gradient[-1] = slope.sum() + (factor * blank).sum() * math.exp(params[-1] + log_q_blank)
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient ** 2
        params -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return float(params[-1]), params[:-1]


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """A model, or None where the labels lack one of the classes."""
    rows = written(_training_rows(docs, labels, doc_id, text), "training")
    sizes = {row["y"]: row["count"] for row in rows.groupBy("y").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    names = _features(rows)
    bias, weights = _fit(_bags(rows, names), len(names))
    return Model(bias, {f: float(w) for f, w in zip(names, weights, strict=True)})


class _Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.cache = model, {}

    def counts(self, word: str) -> bool:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= _CACHE:
                self.cache.clear()
            found = self.cache[word] = any(f in self.model.weights for f in features_of(word))
        return found

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of a text, and start, end and score of each sentence that has evidence."""
        lower = text.lower()
        bias, weights = self.model.bias, self.model.weights
        n = 0
        log_none, found = 0.0, []
        some = any(map(self.counts, set(_WORD.findall(lower))))
        for match in _SENTENCE.finditer(text):
            n += 1
            if some:
                hits = {f for w in _WORD.findall(match[0].lower()) for f in features_of(w) if f in weights}
                if hits:
                    n -= 1
                    z = bias + math.fsum(weights[f] for f in hits)
                    log_q = -z - math.log1p(math.exp(-z)) if z > 0 else -math.log1p(math.exp(z))
                    log_none += log_q
                    found.append((match.start(), match.end(), -math.expm1(log_q)))
        log_none -= n * math.log1p(math.exp(bias))
        return -math.expm1(log_none), found


def scored(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, offending of each row of docs.

    offending: start, end (code points) and score of the sentences scored PREDICT_FROM or more.
    Null and empty texts score 0, as do all texts without a model. Repeated rows are scored
    alike; other columns are ignored whatever their names; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model or Model(-1000.0, {}))
        for batch in batches:
            scores, spans = [], []
            for value in batch.column(1).to_pylist():
                score, found = scorer.score(value or "")
                scores.append(score)
                spans.append([{"start": a, "end": b, "score": s} for a, b, s in found if s >= PREDICT_FROM])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pa.struct(
                    [("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))],
                ["doc_id", "score", "offending"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = rows.mapInArrow(run, "doc_id long, score double, "
                            "offending array<struct<start: long, end: long, score: double>>")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"), "offending")
