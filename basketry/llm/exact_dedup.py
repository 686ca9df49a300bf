"""Exact deduplication by progressive refinement: byte length, then a hash of the start, then a hash of all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import ascii_lower, attach, bits, flagged, texts
from basketry.scratch import Scratch

PREFIX_CHARS = 256
# Stands for a null id where rows are compared.
LOWEST = -(1 << 63)


def exact_dedup(
    docs: DataFrame, work: Scratch, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False
) -> DataFrame:
    """Group equal texts (equal after lower-casing A-Z); of each group the row with the largest id stays.

    One row per row of ``docs``: doc_id, text_hash (xxhash64 of the text as given), keep_id,
    group_size, kept, text_sha256. The digest is there for rows whose length and start another row
    shares, which are the only ones read to their end; with ``digest_all`` for every row.

    1. Lengths that occur once are settled. 2. Of the others, those whose start occurs once at that
    length. 3. The rest are hashed whole. What each step has left is handed on as a filter of bounded
    size, so texts are never shuffled; a filter lets too many pass at worst, never too few.

    A null text counts as empty. Ids may repeat or be null (null sorts lowest): of rows that tie for
    the largest id one stays. Very long texts are compared whole. An empty table gives an empty result.
    """
    rows = texts(docs, id_col, text_col).withColumn("whole", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("length", F.octet_length("whole")).withColumn(
        "start", F.xxhash64(ascii_lower(F.substring("whole", 1, PREFIX_CHARS)))
    )
    sketch = work.keep(rows.select("length", "start"), "sketch")

    lengths = sketch.groupBy("length").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = bits(lengths.select(F.xxhash64("length").alias("key")), "key")
    starts = (
        flagged(sketch, F.xxhash64("length"), shared, "shared")
        .where("shared")
        .groupBy("length", "start")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    surviving = work.keep(bits(starts.select(F.xxhash64("length", "start").alias("key")), "key"), "surviving")

    digest = F.sha2(ascii_lower(F.col("whole")), 256)
    hashed = work.keep(
        flagged(rows, F.xxhash64("length", "start"), surviving, "survives").select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            "length",
            "survives",
            (digest if digest_all else F.when(F.col("survives"), digest)).alias("text_sha256"),
            F.monotonically_increasing_id().alias("tag"),
        ),
        "hashed",
    )
    survivors = hashed.where("survives")
    groups = work.keep(
        survivors.groupBy("length", "text_sha256").agg(
            F.count(F.lit(1)).alias("group_size"),
            F.max("doc_id").alias("keep_id"),
            F.max_by("tag", F.coalesce("doc_id", F.lit(LOWEST))).alias("keep_tag"),
        ),
        "groups",
    )
    grouped = attach(survivors, groups, ["length", "text_sha256"], "group_size", hashed.count())
    columns = ["doc_id", "text_hash", "keep_id", "group_size", "kept", "text_sha256"]
    return (
        grouped.withColumn("kept", F.col("tag") == F.col("keep_tag"))
        .select(*columns)
        .unionByName(
            hashed.where("NOT survives")
            .withColumn("keep_id", F.col("doc_id"))
            .withColumn("group_size", F.lit(1).cast("long"))
            .withColumn("kept", F.lit(True))
            .select(*columns)
        )
    )


def verdicts(decided: DataFrame) -> DataFrame:
    """What ``retain`` needs: rows that go, and rows of which one stays because a twin has the same id and text."""
    return (
        decided.where("group_size > 1")
        .groupBy("doc_id", "text_hash")
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or("kept").alias("once"))
        .where("NOT once OR n > 1")
    )


def op7_exact_dedup(docs: DataFrame, work: Scratch) -> DataFrame:
    return exact_dedup(docs, work, digest_all=True).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = """
WITH rows_ AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM rows_
WINDOW same AS (PARTITION BY norm)
"""
