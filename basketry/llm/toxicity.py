"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import append_columns, id_remainder
from basketry.llm.ngrams import hashed, slices

SIZES = (4, 5, 6)
WIDTH = 18
# The classifier is fitted on so many labelled documents at most, those with the smallest hash of the id.
LABELLED_DOCS = 12_000
# N-grams that the fit looks at: the most telling ones that occur in MIN_DOCS documents or more.
FEATURES = 4096
MIN_DOCS = 5
SMOOTHING = 1.0
PENALTY = 0.002
STEPS = 300
THRESHOLD = 0.3
HELD_OUT = 2


@dataclass(frozen=True)
class Model:
    bias: float
    weight: np.ndarray  # by hashed n-gram; zero where the n-gram tells nothing

    def score(self, texts: list[str | None]) -> np.ndarray:
        margin = np.full(len(texts), self.bias)
        found: dict[int, list[np.ndarray]] = {}
        for size, feature, counts in hashed(texts, SIZES, WIDTH):
            telling = np.flatnonzero(self.weight[feature])
            owner = np.repeat(np.arange(len(texts), dtype=np.int64), counts)[telling]
            found.setdefault(size, []).append(np.unique((owner << WIDTH) | feature[telling]))
        for pairs in found.values():
            # Presence counts, not frequency: each n-gram once per text.
            pair = np.unique(np.concatenate(pairs))
            np.add.at(margin, pair >> WIDTH, self.weight[pair & ((1 << WIDTH) - 1)])
        return 1 / (1 + np.exp(-margin))


def sample(docs: DataFrame, labels: DataFrame, size: int = LABELLED_DOCS) -> DataFrame:
    """(doc_id, toxic, text) of at most ``size`` labelled documents, none of them held out.

    Labels are drawn first, so that the join is with a bounded table. A document labelled more than
    once is toxic if one label says so; of several texts with one id the smallest counts.
    """
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(id_remainder(F.col("doc_id")) != HELD_OUT)
    )
    n = rows.count()
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 31))
    thinned = rows.where(draw < min(1.0, 2.0 * size / max(n, 1)) * (1 << 31)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = thinned.orderBy(draw, "doc_id").limit(size)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _presence(text: str | None) -> np.ndarray:
    return np.unique(np.concatenate([np.unique(f) for _, f, _ in hashed([text], SIZES, WIDTH)]))


def _doc_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's documents: their number and, for each n-gram, how many hold it; by class."""
    counts, docs = np.zeros((2, 1 << WIDTH), dtype=np.int32), [0, 0]
    for batch in batches:
        toxic = batch.column("toxic").to_pylist()
        for start, texts in slices(batch):
            for i, text in enumerate(texts, start):
                side = int(toxic[i] == 1)
                docs[side] += 1
                counts[side, _presence(text)] += 1
    yield pa.RecordBatch.from_pydict(
        {"side": [0, 1], "docs": docs, "counts": [c.tobytes() for c in counts]},
        schema=pa.schema([("side", pa.int32()), ("docs", pa.int64()), ("counts", pa.binary())]),
    )


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """How much likelier an n-gram is among toxic documents' n-grams than among the others', as a log."""
    smooth = counts + SMOOTHING
    share = smooth / smooth.sum(axis=1, keepdims=True)
    return np.log(share[1]) - np.log(share[0])


def telling(counts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The n-grams whose share of documents differs most between the classes, measured in standard errors."""
    both = counts.sum(axis=0)
    share = (both + 1) / (docs.sum() + 2)
    apart = counts[1] / max(docs[1], 1) - counts[0] / max(docs[0], 1)
    error = np.sqrt(share * (1 - share) * (1 / max(docs[1], 1) + 1 / max(docs[0], 1)))
    strength = np.where(both >= MIN_DOCS, np.abs(apart) / error, 0.0)
    best = np.argsort(-strength, kind="stable")[:FEATURES]
    return np.sort(best[strength[best] > 3])


def _logistic(cells: np.ndarray, owner: np.ndarray, scale: np.ndarray, toxic: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic regression with a ridge penalty by accelerated gradient steps; cells are (document, n-gram) pairs."""
    n, width = len(toxic), len(scale)
    weight, ahead, bias, bias_ahead = np.zeros(width), np.zeros(width), 0.0, 0.0
    # The step is safe for the largest curvature that the rows' squared lengths allow.
    lengths = np.bincount(owner, weights=scale[cells] ** 2, minlength=n)
    step = 4 / (1 + max(lengths.mean() * 4, 1e-9))
    for k in range(STEPS):
        margin = bias_ahead + np.bincount(owner, weights=(ahead * scale)[cells], minlength=n)
        error = 1 / (1 + np.exp(-margin)) - toxic
        slope = np.bincount(cells, weights=error[owner], minlength=width) * scale / n + PENALTY * ahead
        fresh, fresh_bias = ahead - step * slope, bias_ahead - 4 * step * error.mean()
        pace = k / (k + 3)
        ahead, bias_ahead = fresh + pace * (fresh - weight), fresh_bias + pace * (fresh_bias - bias)
        weight, bias = fresh, fresh_bias
    return float(bias), weight


def fit(docs: DataFrame, labels: DataFrame, work, size: int = LABELLED_DOCS, tasks: int = 16) -> Model:
    """Fit the classifier. The driver gets counts and n-gram numbers of the bounded sample, never texts.

    With no toxic or no other document in the sample every text gets the share of toxic ones, or 0
    without a sample.
    """
    rows = work.keep(sample(docs, labels, size).repartition(tasks), "labelled")
    counts, n = np.zeros((2, 1 << WIDTH)), np.zeros(2)
    for r in rows.mapInArrow(_doc_counts, "side int, docs long, counts binary").collect():
        counts[r.side] += np.frombuffer(r.counts, dtype=np.int32)
        n[r.side] += r.docs
    weight = np.zeros(1 << WIDTH)
    if not n.all():
        share = n[1] / max(n.sum(), 1)
        return Model(float(np.log((share + 1e-9) / (1 - share + 1e-9))), weight)
    chosen = telling(counts, n)
    place = np.full(1 << WIDTH, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = [int(t == 1) for t in batch.column("toxic").to_pylist()]
            for start, texts in slices(batch):
                held = [place[_presence(t)] for t in texts]
                yield pa.RecordBatch.from_pydict(
                    {"toxic": toxic[start : start + len(texts)], "cells": [h[h >= 0].tobytes() for h in held]},
                    schema=pa.schema([("toxic", pa.int32()), ("cells", pa.binary())]),
                )

    found = rows.orderBy("doc_id").mapInArrow(cells, "toxic int, cells binary").collect()
    each = [np.frombuffer(r.cells, dtype=np.int32) for r in found]
    owner = np.repeat(np.arange(len(each)), [len(e) for e in each])
    scale = log_ratio(counts)[chosen]
    bias, fitted = _logistic(np.concatenate(each), owner, scale, np.array([r.toxic for r in found], dtype=float))
    weight[chosen] = fitted * scale
    return Model(bias, weight)


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (with a column text) and score, predicted; columns of these names give way.

    ``score`` is the probability of the label toxic; ``predicted`` is 1 from the threshold on. A null
    text counts as empty; an empty text has no n-gram and gets the score of the bias alone. Very long texts
    are read whole, in parts; repeated rows get the same each; an empty table gives an empty result.

    Only the FEATURES n-grams that tell the sides apart most surely have a weight; all others count for
    nothing, in every text alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def columns(texts: list[str | None]) -> dict[str, np.ndarray]:
        score = shared.value.score(texts)
        return {"score": score, "predicted": (score >= threshold).astype(np.int32)}

    return append_columns(docs, columns, "score double, predicted int")


def op5_toxicity(docs: DataFrame, labels: DataFrame, work) -> DataFrame:
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return classify(own, fit(docs, labels, work)).select(
        "doc_id", (id_remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", "predicted"
    )
