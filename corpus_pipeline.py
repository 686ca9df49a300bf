"""The corpus pipeline: documents in, packed training sequences out; each stage applies one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketry.llm import exact_dedup, language, packing, simhash, toxicity
from basketry.llm.common import filter_texts, retain, scratch, table
from basketry.scratch import Scratch

# A document must be of its likeliest language with this probability at least.
LEAST_LANGUAGE_SCORE = 0.5


# Intermediate tables of the stages of a run, until the stage's result is written.
_opened: list[Scratch] = []


def tables(spark: SparkSession) -> Scratch:
    _opened.append(scratch(spark))
    return _opened[-1]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from the labels of these documents.

    Every row is judged by its own text: repeated ids and rows alike, null and empty texts as empty ones,
    very long ones whole. An empty table gives an empty result.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), tables(spark))
    shared = spark.sparkContext.broadcast(model)
    return filter_texts(docs, lambda texts: shared.value.score(texts) < toxicity.THRESHOLD)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null texts too) go, and those of no clear language.

    Every row is judged by its own text, very long ones whole; ties go to the first language by name. An
    empty table, or one without a labelled document, gives an empty result.
    """
    score = language.scorer(spark, language.fit(docs, tables(spark)))

    def clear(texts: list[str | None]) -> list[bool]:
        langs, scores = score(texts)
        return [lang != language.UNKNOWN and s >= LEAST_LANGUAGE_SCORE for lang, s in zip(langs, scores, strict=True)]

    return filter_texts(docs, clear)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest id stays: one row, also of repeated rows and ids.

    Null and empty texts are equal; very long ones are compared whole. An empty table gives an empty result.
    """
    work = tables(spark)
    decided = work.keep(exact_dedup.exact_dedup(docs, work), "decided")
    return retain(docs, work.keep(exact_dedup.verdicts(decided), "verdicts"), decided.count())


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with fingerprints up to 3 bits apart the one with the smallest id stays.

    Of repeated rows with that id one stays, of other rows with it the one with the smallest hash of its
    text. Null, empty and blank texts are one group. An empty table gives an empty result.
    """
    work = tables(spark)
    decided = work.keep(simhash.near_duplicates(docs, work).drop("component_id"), "decided")
    return retain(docs, work.keep(simhash.verdicts(decided, work), "verdicts"), decided.count())


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences; repeated rows go in one by one.

    Null and empty texts are their end mark, very long ones are cut into pieces. An empty table gives an
    empty result.
    """
    return packing.pack(docs, tables(spark), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("packing", packing_stage),
]

# Models, fingerprints and token ids can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again.

    Once it is written, the tables of the stage and the result it came from are deleted.
    """
    docs, held = table(spark, sf_dir, "documents"), None
    _opened.clear()
    for name, stage in STAGES[:-1]:
        work = scratch(spark)
        docs = work.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        for done in (*_opened, *([held] if held else [])):
            done.close()
        _opened.clear()
        held = work
    return STAGES[-1][1](spark, docs, sf_dir)
