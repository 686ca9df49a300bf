"""Summaries a person reads after a run: counts, totals, top lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import ratio
from basketry.sources.load import union_all

# What the summaries cover, and the titles of their sections.
STAGING = ("users", "products", "orders", "order_items", "crm_contacts")
STAGING_WITH_EVENTS = (*STAGING, "events")
MUST_NOT_BE_EMPTY = (
    "stg_users", "stg_orders", "dim_customers", "fact_orders", "mart_sales_overview", "mart_customer_ltv",
)
STAGING_SECTION = "STAGING TABLES"
CORE_SECTION = "CORE TABLES"
MART_SECTION = "DATA MARTS"
TOP = 5

Frames = Mapping[str, DataFrame]


def row_counts(frames: Frames) -> DataFrame:
    """(table_name, row_count): one row per table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in frames.items()
        ]
    )


def staging_counts(tables: Frames, with_events: bool = True) -> DataFrame:
    names = STAGING_WITH_EVENTS if with_events else STAGING
    return row_counts({f"stg_{n}": tables[n] for n in names})


def non_empty(frames: Frames) -> DataFrame:
    """Row counts with a flag on empty tables. An empty table is reported, it does not stop a run."""
    return row_counts(frames).withColumn("is_empty", F.col("row_count") == 0)


def _summary(name: str, df: DataFrame, **measures) -> DataFrame:
    totals = df.agg(F.count(F.lit(1)).alias("total_rows"), *[m.alias(n) for n, m in measures.items()])
    return totals.select(F.lit(name).alias("table_name"), "*")


def core_summary(dim_customers: DataFrame, dim_products: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """One row per core table; measures a table does not have are null."""
    return union_all(
        [
            _summary(
                "dim_customers",
                dim_customers,
                unique_customers=F.countDistinct("customer_key"),
                countries=F.countDistinct("country_code"),
            ),
            _summary(
                "dim_products",
                dim_products,
                unique_products=F.countDistinct("product_key"),
                categories=F.countDistinct("product_category"),
            ),
            _summary(
                "fact_orders",
                fact_orders,
                unique_orders=F.countDistinct("order_key"),
                total_revenue=F.sum("line_revenue").cast("decimal(38,2)"),
            ),
        ]
    )


def mart_summary(sales_overview: DataFrame, customer_ltv: DataFrame, product_performance: DataFrame) -> DataFrame:
    """One row per mart. Order totals add up groups, so an order in two categories counts twice."""
    return union_all(
        [
            _summary(
                "mart_sales_overview",
                sales_overview,
                grand_total_revenue=F.sum("total_revenue").cast("decimal(38,2)"),
                grand_total_orders=F.sum("total_orders"),
            ),
            _summary(
                "mart_customer_ltv",
                customer_ltv,
                avg_ltv=ratio(F.sum("lifetime_value"), F.count("lifetime_value")),
                rfm_segments=F.countDistinct("rfm_segment"),
            ),
            _summary(
                "mart_product_performance",
                product_performance,
                total_product_revenue=F.sum("total_revenue").cast("decimal(38,2)"),
                abc_classes=F.countDistinct("abc_class"),
            ),
        ]
    )


def top_customers(customer_ltv: DataFrame, n: int = TOP) -> DataFrame:
    """Customers with the highest lifetime value; the key settles ties."""
    return (
        customer_ltv.orderBy(F.col("lifetime_value").desc_nulls_first(), F.col("customer_key").asc_nulls_last())
        .limit(n)
        .select("full_name", "email", "lifetime_value", "rfm_segment", "churn_risk")
    )


def top_products(product_performance: DataFrame, n: int = TOP) -> DataFrame:
    """Products of the first revenue ranks."""
    return (
        product_performance.orderBy("revenue_rank")
        .limit(n)
        .select("product_name", "product_category", "total_revenue", "abc_class", "revenue_rank")
    )


def sales_by_country(sales_overview: DataFrame) -> DataFrame:
    """Orders and revenue per country, by revenue. Orders add up groups (see ``mart_summary``)."""
    return (
        sales_overview.groupBy("country_code")
        .agg(F.sum("total_orders").alias("orders"), F.sum("total_revenue").cast("decimal(32,2)").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_first(), F.col("country_code").asc_nulls_last())
    )


def _long(section: str, summary: DataFrame) -> DataFrame:
    """Summary columns as rows: section, table_name, metric, value."""
    measures = [c for c in summary.columns if c != "table_name"]
    return (
        summary.select("table_name", *[F.col(c).cast("double").alias(c) for c in measures])
        .unpivot("table_name", measures, "metric", "value")
        .where(F.col("value").isNotNull())
        .select(F.lit(section).alias("section"), "table_name", "metric", "value")
    )


def verify_report(tables: Frames, models: Frames) -> DataFrame:
    """All summaries in one table: section, table_name, metric, value."""
    return union_all(
        [
            _long(STAGING_SECTION, staging_counts(tables, with_events=False)),
            _long(
                CORE_SECTION, core_summary(models["dim_customers"], models["dim_products"], models["fact_orders"])
            ),
            _long(
                MART_SECTION,
                mart_summary(
                    models["mart_sales_overview"], models["mart_customer_ltv"], models["mart_product_performance"]
                ),
            ),
        ]
    )
