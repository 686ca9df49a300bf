"""The shop's tables made of the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from basketry.scratch import Scratch
from basketry.sources.sales_tables import SalesTables

FOLDER = "/root/testdata/sf0.001"


def test_line_keys_of_a_very_long_order_are_unique(spark, tmp_path):
    lineitem = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    long_order = spark.range(1500).select(
        F.lit(1).cast("long").alias("l_orderkey"), (F.col("id") % 9 + 1).alias("l_partkey"), F.col("id").alias("l_linenumber")
    )
    some = lineitem.where("l_orderkey between 2 and 40")
    lines = some.unionByName(long_order, allowMissingColumns=True)
    lines = lines.withColumns({"l_quantity": F.lit(1), "l_shipdate": F.lit(date(2000, 1, 1))})
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{FOLDER}/part.parquet").write.parquet(f"{tmp_path}/part.parquet")
    items = SalesTables(spark, str(tmp_path), Scratch(spark))["order_items"]
    n, keys, least, most = items.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
    assert n == keys == most == 1500 + some.count() and least == 1
    in_order = items.groupBy("order_id").agg(F.max("id").alias("last"), F.min("id").alias("first"), F.count("*").alias("n"))
    assert in_order.where("last - first + 1 <> n").count() == 0, "the lines of an order stand together"
