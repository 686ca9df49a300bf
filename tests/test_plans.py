"""Physical plans: what is read, pushed down, shuffled, and never gathered into one task."""

from __future__ import annotations

import re
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from query_set import PARAMS, Shop
from basketry.plans import core, marts, pipeline, verify

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models(spark):
    """Written core tables, joined as they would be when too big to broadcast."""
    shop = Shop(spark, FOLDER)
    keep = shop.scratch.keep
    made = {
        "orders": keep(shop.tables["orders"], "orders"),
        "order_items": keep(shop.tables["order_items"], "items"),
        "dim_customers": keep(shop.dim_customers(), "customers"),
        "dim_products": keep(shop.dim_products(), "products"),
        "fact_orders": keep(shop.fact_orders(), "fact"),
        "shop": shop,
    }
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield made
    for k in keys:
        spark.conf.unset(k)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [line for line in text.splitlines() if "FileScan" in line]


def test_fact_reads_what_it_needs_and_filters_in_the_scan(models):
    text = plan(core.fact_orders(models["order_items"], models["orders"], PARAMS))
    (orders,) = [s for s in scans(text) if "created_at" in s]
    assert "GreaterThanOrEqual(created_at" in orders
    assert text.count("Exchange hashpartitioning") == 2, "one shuffle per side"
    assert "SinglePartition" not in text


def test_mart_scans_are_pruned(models):
    text = plan(marts.mart_sales_overview(models["fact_orders"], models["dim_products"], models["dim_customers"]))
    schemas = [s.split("ReadSchema: ")[1] for s in scans(text)]
    assert any(s.startswith("struct<product_key:bigint,product_category:string>") for s in schemas)
    assert any(s.startswith("struct<customer_key:bigint,customer_segment:string>") for s in schemas)
    fact = next(s for s in schemas if "line_revenue" in s)
    assert "payment_method" not in fact and "order_item_key" not in fact
    assert "EqualTo(is_completed,1)" in text
    assert "SinglePartition" not in text and "BroadcastNestedLoopJoin" not in text


def test_metrics_are_aggregated_before_the_shuffle(models):
    text = plan(marts.customer_metrics(models["fact_orders"], PARAMS))
    assert "hashpartitioning(customer_key" in text and "order_key" in text
    first = text.index("Exchange hashpartitioning")
    assert "partial_sum(line_revenue" in text[first:], "summed in the map tasks"
    product = plan(marts.product_metrics(models["fact_orders"], models["dim_products"]))
    join = product.index("SortMergeJoin")
    assert "HashAggregate" in product[join:], "lines are aggregated before they meet the dimension"


@pytest.mark.parametrize("model", ["ltv", "performance"])
def test_marts_gather_nothing(models, model):
    shop, params = models["shop"], PARAMS
    if model == "ltv":
        df = marts.mart_customer_ltv(models["dim_customers"], models["fact_orders"], params, shop.scratch)
    else:
        df = marts.mart_product_performance(models["fact_orders"], models["dim_products"], params, shop.scratch)
    text = plan(df)
    without_subqueries = text.split("Subqueries")[0]
    assert "Window [" not in without_subqueries or "windowspecdefinition(_range" in without_subqueries
    gathered = [line for line in without_subqueries.splitlines() if "SinglePartition" in line]
    # The one gathered exchange is that of the revenue total: a row per task.
    assert len(gathered) <= (1 if model == "performance" else 0)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_lists_do_not_sort_the_whole_mart(models):
    shop = models["shop"]
    mart = shop.scratch.keep(shop.mart_customer_ltv())
    assert "TakeOrderedAndProject" in plan(verify.top_customers(mart))


def test_hot_keys_are_split_or_combined(spark, models):
    """A third of all lines belong to one order, product and customer: results stay right."""
    lines = models["order_items"]
    hot = lines.withColumns({k: F.when(F.col("id") % 3 == 0, 1).otherwise(F.col(k)) for k in ("order_id", "product_id")})
    orders = models["orders"]
    fact = models["shop"].scratch.keep(core.fact_orders(hot, orders, replace(PARAMS, start_date=PARAMS.start_date.replace(1990))))
    assert fact.count() == hot.join(orders.select(F.col("id").alias("order_id")), "order_id", "left_semi").count()
    metrics = marts.product_metrics(fact, models["dim_products"])
    assert metrics.agg(F.sum("total_revenue")).first()[0] == fact.where("is_completed = 1").agg(F.sum("line_revenue")).first()[0]


@pytest.fixture
def eager_splits(spark):
    """Limits that make the small test tables' hot partitions count as skewed."""
    wanted = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    kept = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_join_keys_are_split(spark, models, eager_splits):
    """Two thirds of all lines belong to one order; of the fact, to one product or one customer."""
    keep = models["shop"].scratch.keep
    hot = F.col("id") % 3 > 0
    lines = models["order_items"]
    items = keep(lines.withColumn("order_id", F.when(hot, 1).otherwise(F.col("order_id"))).repartition(8))
    params = replace(PARAMS, start_date=PARAMS.start_date.replace(1990))
    assert "skew=true" in final_plan(core.fact_orders(items, models["orders"], params))
    for key in ("product_key", "customer_key"):
        fact = models["fact_orders"].withColumn(key, F.when(F.col("order_item_key") % 3 > 0, 1).otherwise(F.col(key)))
        fact = keep(fact.withColumn("is_completed", F.lit(1)).repartition(8))
        overview = marts.mart_sales_overview(fact, models["dim_products"], models["dim_customers"])
        assert "skew=true" in final_plan(overview), key


def test_orders_are_aggregated_before_the_distinct_counts(models):
    text = plan(marts.mart_sales_overview(models["fact_orders"], models["dim_products"], models["dim_customers"]))
    below_expand = text[text.index("Expand"):]
    assert "sum(line_revenue" in below_expand, "Expand sees one row per order, not per line"


def test_no_python_in_the_plans(models):
    shop = models["shop"]
    for df in (shop.mart_sales_overview(), shop.mart_customer_ltv(), shop.mart_product_performance()):
        text = plan(df)
        assert "Python" not in text and "ArrowEval" not in text


def exchanges(df):
    return [line for line in plan(df).splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_lines_are_dealt_out_before_they_are_grouped(spark, models):
    """No task that joins lines also holds them by group, and groups made in ranges do not move as single lines again."""
    fact, products, customers = models["fact_orders"], models["dim_products"], models["dim_customers"]
    overview = exchanges(marts.mart_sales_overview(fact, products, customers))
    assert sum("rangepartitioning(sale_date" in e for e in overview) == 1
    assert not any("hashpartitioning(sale_date" in e and "order_key" in e for e in overview)
    assert any("rangepartitioning(product_key" in e and "order_key" in e for e in exchanges(marts.product_metrics(fact, products)))
    assert any("rangepartitioning(product_id" in e and "order_id" in e for e in exchanges(core.product_stats(models["order_items"])))


def test_stored_fact_moves_without_what_follows_from_it(models):
    """Only what lines and orders hold is gathered by month; the rows are those of the fact."""
    items, orders = models["order_items"], models["orders"]
    stored = core.fact_by_month(items, orders, PARAMS)
    lines = plan(stored).splitlines()
    at = next(k for k, line in enumerate(lines) if "Exchange hashpartitioning(order_month" in line)
    below = "\n".join(lines[at:])
    assert "order_timestamp" in below and not any(c in below for c in ("date_key", "estimated_margin", "is_completed"))
    want = core.with_month(core.fact_orders(items, orders, PARAMS))
    assert stored.dtypes == want.dtypes
    assert sorted(map(str, stored.collect())) == sorted(map(str, want.collect()))


def test_overview_rows_move_in_the_order_of_their_groups(models):
    lines = plan(marts.mart_sales_overview(models["fact_orders"], models["dim_products"], models["dim_customers"])).splitlines()
    at = next(k for k, line in enumerate(lines) if "Exchange hashpartitioning(sale_date" in line)
    expand = next(k for k in range(at, len(lines)) if "Expand" in lines[k])
    assert any("Sort [sale_date" in line for line in lines[expand : expand + 4])


def test_overview_counts_keys_that_repeat_once(spark):
    """An order id of two customers is one order; a customer of two orders is one customer; a country may be null."""
    lines = [(1, 1, "fr", 1), (1, 2, "fr", 2), (2, 1, "fr", 3), (2, 1, "fr", 4), (3, 2, None, 5)]
    fact = spark.createDataFrame(lines, "order_key long, customer_key long, country_code string, quantity_sold int").select(
        "*",
        F.lit(1).alias("is_completed"),
        F.lit(1).cast("long").alias("product_key"),
        F.lit("2020-01-01").cast("date").alias("date_key"),
        *[F.lit(2).cast("decimal(12,2)").alias(c) for c in ("line_revenue", "estimated_margin")],
        F.when(F.col("quantity_sold") < 4, 8).cast("decimal(12,2)").alias("order_total"),
    )
    products = spark.createDataFrame([(1, "a")], "product_key long, product_category string")
    customers = spark.createDataFrame([(1, "s"), (2, "s")], "customer_key long, customer_segment string")
    got = marts.mart_sales_overview(fact, products, customers)
    found = {r.country_code: (r.total_orders, r.unique_customers, r.total_quantity, float(r.total_revenue), r.avg_order_value) for r in got.collect()}
    assert found == {"fr": (2, 2, 10, 8.0, 8.0), None: (1, 1, 5, 2.0, None)}


def test_built_overview_moves_its_lines_once(spark, models):
    """With a scratch, where the lookups are small enough to send: no line moves for a dimension, nor again for the counts."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, str(64 * 1024))
    try:
        fact, scratch = models["fact_orders"], models["shop"].scratch
        overview = exchanges(marts.mart_sales_overview(fact, models["dim_products"], models["dim_customers"], scratch))
    finally:
        for k in keys:
            spark.conf.set(k, "-1")
    assert len(overview) == 1 and "rangepartitioning(sale_date" in overview[0]


def test_stored_fact_moves_what_lines_differ_in_first(models):
    """What an order's lines have in common stands together behind it and shrinks as one piece."""
    stored = plan(core.fact_by_month(models["order_items"], models["orders"], PARAMS)).splitlines()
    at = next(k for k, line in enumerate(stored) if "Exchange hashpartitioning(order_month" in line)
    moved = next(line for line in stored[at:] if "Project" in line)
    names = re.findall(r"(\w+)#\d+L?(?=[,\]])", moved)
    own = ["product_key", "unit_price", "line_revenue", "quantity_sold", "order_item_key"]
    assert names[:5] == own and set(names[5:]) > {"order_key", "customer_key", "order_total", "order_status"}


def test_models_built_again_read_tables_made_once(spark, tmp_path, monkeypatch):
    """Source tables are mapped, and their lines numbered, once; what a build kept for itself goes with it."""
    shop, given = Shop(spark, FOLDER), []
    real = pipeline.build_models

    def build(spark, tables, root, params, scratch, **more):
        given.append((tables, scratch.root))
        return real(spark, tables, root, params, scratch, **more)

    monkeypatch.setattr(pipeline, "build_models", build)
    counts = []
    for run in ("a_", "b_"):
        counts.append({n: df.count() for n, df in shop.models(str(tmp_path / "warehouse"), run).items()})
    (first, kept), (second, kept_again) = given
    assert counts[0] == counts[1] and kept != kept_again
    for name in ("users", "products", "orders", "order_items"):
        assert first[name] is second[name] and not exchanges(first[name]), name
        assert sorted(map(str, first[name].drop("_loaded_at").collect())) == sorted(map(str, shop.tables[name].collect()))
    assert not any(Path(k).exists() for k in (kept, kept_again)) and Path(shop.scratch.root).exists()
