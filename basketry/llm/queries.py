"""The queries of this package: name -> function of (spark, folder); and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import (
    alignment, bpe, embedding_dedup, exact_dedup, language, licenses, nearest, packing, resampling, sharding, simhash, token_counts, toxicity,
)
from basketry.llm.common import scratch, table
from basketry.scratch import Scratch


def over(name: str, build: Callable[[DataFrame, Scratch], DataFrame]):
    """A query that applies ``build`` to a whole table."""
    return lambda spark, folder: build(table(spark, folder, name), scratch(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": over("documents", sharding.op1_sharding),
    "op2_byte_bpe": over("documents", bpe.op2_byte_bpe),
    "op3_token_counts": over("documents", token_counts.op3_token_counts),
    "op4_nearest": over("embeddings", nearest.op4_nearest),
    "op5_toxicity": lambda spark, folder: toxicity.op5_toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels"), scratch(spark)
    ),
    "op6_packing": over("documents", packing.op6_packing),
    "op7_exact_dedup": over("documents", exact_dedup.op7_exact_dedup),
    "op8_simhash": over("documents", simhash.op8_simhash),
    "op9_licenses": over("documents", licenses.op9_licenses),
    "op10_language": over("documents", language.op10_language),
    "op11_alignment": over("documents", alignment.op11_alignment),
    "op12_embedding_dedup": over("embeddings", embedding_dedup.op12_embedding_dedup),
    "op13_resampling": lambda spark, folder: resampling.op13_resampling(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), scratch(spark)
    ),
}

ORACLES: dict[str, str] = {"op7_exact_dedup": exact_dedup.ORACLE_SQL}
