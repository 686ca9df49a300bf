"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import append_columns, id_remainder
from basketry.llm.ngrams import hashed, per_text, slices
from basketry.scratch import Scratch

SIZES = (1, 2, 3)
WIDTH = 16
# The model is fitted on so many documents of a language at most, those with the smallest hash of the id.
DOCS_PER_LANGUAGE = 1000
# Texts are scored against so many languages at once: this bounds the matrix that is broadcast (64 MB). All are learned.
BLOCK = 256
# Numbers of documents by language are broadcast if there are no more languages than this.
FEW = 100_000
# Added to each count, so that an n-gram which a language never showed is unlikely, not impossible.
SMOOTHING = 0.1
UNKNOWN = "und"
HELD_OUT = 2


@dataclass(frozen=True)
class Block:
    """Some languages, in the order of their names."""

    languages: tuple[str, ...]
    log_prior: np.ndarray  # languages
    log_prob: np.ndarray  # features x languages


@dataclass(frozen=True)
class Model:
    """What was learned: a written table (lang, docs, log_prob) with a row for each language, and their names in order."""

    learned: DataFrame
    languages: tuple[str, ...]
    docs: int

    def blocks(self, size: int = BLOCK) -> Iterator[Block]:
        """All languages, ``size`` at a time: the driver holds no more."""
        for at in range(0, len(self.languages), size):
            own = self.languages[at : at + size]
            rows = self.learned.where(F.col("lang").between(own[0], own[-1])).collect()
            rows = sorted(rows, key=lambda r: own.index(r.lang))
            prior = np.log(np.array([r.docs for r in rows]) / self.docs)
            yield Block(own, prior, np.array([np.frombuffer(r.log_prob, dtype="<f4") for r in rows]).T)


def sample(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """(lang, text) of at most ``per_language`` documents of each language, none of them held out.

    Rows are first thinned by a hash to about twice that number, so that only few are ranked and only
    their texts are shuffled.
    """
    rows = docs.select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.col("doc_id").cast("long").alias("doc_id"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.where(id_remainder(F.col("doc_id")) != HELD_OUT).withColumn(
        "draw", F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 31))
    )
    sizes = rows.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    sizes = F.broadcast(sizes) if sizes.count() <= FEW else sizes
    share = F.lit(2.0 * per_language) / F.col("n") * (1 << 31)
    thinned = rows.join(sizes, F.col("lang") == F.col("of")).where(F.col("draw") < share)
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    return (
        thinned.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language).select("lang", "text")
    )


COUNTED = pa.schema([("lang", pa.string()), ("docs", pa.int64()), ("features", pa.binary()), ("counts", pa.binary())])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each language of a slice of texts, which features it has and how often."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for start, texts in slices(batch):
            rows = []
            for lang in sorted(set(langs[start : start + len(texts)])):
                own = [t for t, of in zip(texts, langs[start:], strict=False) if of == lang]
                total = np.zeros(1 << WIDTH, dtype=np.int64)
                for _, feature, _ in hashed(own, SIZES, WIDTH):
                    total += np.bincount(feature, minlength=1 << WIDTH)
                some = np.flatnonzero(total)
                rows.append((lang, len(own), some.astype("<i4").tobytes(), total[some].astype("<i4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), COUNTED, strict=True)], schema=COUNTED)


def _learned(held: pa.Table) -> pa.Table:
    """One language's smoothed log-probabilities."""
    total = np.full(1 << WIDTH, SMOOTHING)
    for features, counts in zip(held.column("features").to_pylist(), held.column("counts").to_pylist(), strict=True):
        total[np.frombuffer(features, dtype="<i4")] += np.frombuffer(counts, dtype="<i4")
    log_prob = np.log(total / total.sum()).astype("<f4").tobytes()
    docs = sum(held.column("docs").to_pylist())
    return pa.table({"lang": held.column("lang")[:1], "docs": pa.array([docs]), "log_prob": pa.array([log_prob], pa.binary())})


def fit(docs: DataFrame, work: Scratch, per_language: int = DOCS_PER_LANGUAGE, tasks: int = 16) -> Model:
    """Learn every language of the labelled documents, from ``per_language`` of each at most.

    Counts are summed by language in Spark; a task holds those of one language's sample. The driver gets
    the languages' names and, block by block when scoring, a vector for each.
    """
    counted = sample(docs, per_language).repartition(tasks).mapInArrow(_counts, "lang string, docs long, features binary, counts binary")
    learned = counted.groupBy("lang").applyInArrow(_learned, "lang string, docs long, log_prob binary")
    learned = work.keep(learned, "learned")
    rows = learned.select("lang", "docs").collect()
    return Model(learned, tuple(sorted(r.lang for r in rows)), sum(r.docs for r in rows))


@dataclass
class Scores:
    """Of some texts, over the languages looked at so far: the best one, its log-probability, and the sum of all in logs."""

    lang: list[str]
    best: np.ndarray
    total: np.ndarray


def look_at(texts: list[str | None], block: Block, before: Scores | None) -> Scores:
    """Go on with one block of languages. Of equally likely ones the first stays."""
    own = np.tile(block.log_prior, (len(texts), 1))
    for _, feature, counts in hashed(texts, SIZES, WIDTH):
        own += per_text(block.log_prob[feature], counts)
    top = own.argmax(axis=1)
    best = own[np.arange(len(texts)), top]
    total = best + np.log(np.exp(own - best[:, None]).sum(axis=1))
    lang = [block.languages[k] for k in top]
    if before is None:
        return Scores(lang, best, total)
    better = best > before.best
    lang = [new if b else old for new, old, b in zip(lang, before.lang, better, strict=True)]
    return Scores(lang, np.where(better, best, before.best), np.logaddexp(total, before.total))


def verdict(texts: list[str | None], scores: Scores) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its probability; ``und`` and 0 for a text without a letter."""
    letters = [t is not None and any(map(str.isalpha, t)) for t in texts]
    lang = [x if ok else UNKNOWN for x, ok in zip(scores.lang, letters, strict=True)]
    return lang, np.where(letters, np.exp(np.minimum(scores.best - scores.total, 0.0)), 0.0)


def scorer(spark: SparkSession, model: Model, block: int = BLOCK) -> Callable[[list[str | None]], tuple[list[str], np.ndarray]]:
    """A function for the tasks: language and score of each text. Languages are broadcast ``block`` at a time; a worker
    that uses it holds a quarter of a MB for each language."""
    shared = [spark.sparkContext.broadcast(b) for b in model.blocks(block)]

    def score(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        found = None
        for one in shared:
            found = look_at(texts, one.value, found)
        return verdict(texts, found) if found else ([UNKNOWN] * len(texts), np.zeros(len(texts)))

    return score


def identify(docs: DataFrame, model: Model, block: int = BLOCK) -> DataFrame:
    """``docs`` (with a column text) and lang_pred, score; columns of these names give way.

    A null text, an empty one and one without a letter get ``und`` and score 0. Of two equally likely
    languages the first by name wins. Without any labelled document all is ``und``. Very long texts are
    scored whole, in parts; repeated rows get the same each; an empty table gives an empty result.
    """
    score = scorer(docs.sparkSession, model, block)

    def columns(texts: list[str | None]) -> dict[str, list | np.ndarray]:
        langs, scores = score(texts)
        return {"lang_pred": langs, "score": scores}

    return append_columns(docs, columns, "lang_pred string, score double")


def op10_language(docs: DataFrame, work: Scratch) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = (id_remainder(F.col("doc_id")) == HELD_OUT).alias("held_out")
    return identify(rows, fit(docs, work)).select("doc_id", held_out, "lang_pred", "score")
