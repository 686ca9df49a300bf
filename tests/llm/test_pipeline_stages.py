from __future__ import annotations

import __spark_entry__ as entry
import corpus_pipeline as cp
import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from basketry.llm import queries as llm_queries

OPERATORS = {f"op{n}" for n in range(1, 14)}


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == OPERATORS and "pipeline" in names


@pytest.mark.parametrize("name", sorted(llm_queries.ORACLES))
def test_sql_gives_the_same_rows(spark, sf, name):
    assert difference(spark, duck(sf), llm_queries.QUERIES[name], llm_queries.ORACLES[name], sf) is None


@pytest.fixture
def folder(spark, odd_docs, tmp_path):
    """The odd documents with labels, as a data folder."""
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i == 14)) for i in range(16)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_keep_columns_and_survive_odd_rows(spark, folder, odd_rows, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, len(odd_rows)
    for k, (_, stage) in enumerate(cp.STAGES[:-1]):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
    packed = cp.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id", "piece").where("piece = 0").count() == before


def test_stages_on_no_rows(spark, no_docs, folder):
    for _, stage in cp.STAGES:
        assert stage(spark, no_docs, folder).count() == 0


def test_stages_decide_what_their_operators_decide(spark, sf, docs, work):
    from basketry.llm import language

    toxic = entry.queries()["op5_toxicity"](spark, sf).where("predicted = 1")
    left = cp.toxicity_stage(spark, docs, sf)
    assert left.select("doc_id").exceptAll(docs.join(toxic, "doc_id", "left_anti").select("doc_id")).count() == 0
    assert left.count() == docs.count() - toxic.count()
    clear = language.op10_language(docs, work).where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5))
    assert cp.language_stage(spark, docs, sf).count() == clear.count()
    kept = entry.queries()["op7_exact_dedup"](spark, sf).where("kept").select("doc_id")
    assert cp.exact_stage(spark, docs, sf).select("doc_id").exceptAll(kept).count() == 0
    assert cp.exact_stage(spark, docs, sf).count() == kept.count()


def test_run(spark, sf):
    packed = cp.run(spark, sf)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    held = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.count("*")).first()
    assert held[0] <= 4096 and packed.select("doc_id").distinct().count() > 100
