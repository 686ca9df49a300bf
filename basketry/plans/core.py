"""Star schema: two dimensions and the order-line fact. Keys are the source keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import MONEY_SUM, day_diff, first_match, ntz
from basketry.params import ACTIVE_WITHIN_DAYS, AT_RISK_WITHIN_DAYS, CANCELLED_STATUS, Params
from basketry.plans.staging import clean_orders
from basketry.session import tasks_of

UPDATED_AT = "_dbt_updated_at"


def is_completed(status: Column, params: Params) -> Column:
    return status.isin(*params.completed_statuses)


def customer_order_agg(orders: DataFrame, params: Params) -> DataFrame:
    """Per customer, completed orders only: first, last, distinct count and value."""
    return (
        orders.where(is_completed(F.col("status"), params))
        .groupBy("user_id")
        .agg(
            F.min("created_at").alias("first_order_date"),
            F.max("created_at").alias("last_order_date"),
            F.countDistinct("id").alias("total_orders"),
            F.sum("total_amount").cast(MONEY_SUM).alias("lifetime_value"),
        )
    )


def dim_customers(users: DataFrame, orders: DataFrame, params: Params) -> DataFrame:
    """One row per user, with or without orders. Orders are aggregated before the join."""
    last = F.col("last_order_date")
    age = day_diff(last, F.lit(params.as_of))
    return users.join(
        customer_order_agg(orders, params), F.col("id") == F.col("user_id"), "left"
    ).select(
        F.col("id").alias("customer_key"),
        "email",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        F.upper("country").alias("country_code"),
        first_match([(F.col("plan_type").isin(*params.premium_plans), "Premium")], "Freemium").alias(
            "customer_segment"
        ),
        "plan_type",
        "is_active",
        F.col("created_at").alias("registration_date"),
        "last_login",
        "first_order_date",
        "last_order_date",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("lifetime_value", F.lit(0)).cast(MONEY_SUM).alias("lifetime_value"),
        first_match(
            [(age <= ACTIVE_WITHIN_DAYS, "Active"), (age <= AT_RISK_WITHIN_DAYS, "At Risk"), (last.isNotNull(), "Churned")],
            "No Purchase",
        ).alias("customer_status"),
        ntz(params.run_ts).alias(UPDATED_AT),
    )


def product_stats(order_items: DataFrame) -> DataFrame:
    """Per product, orders of every status: quantity, revenue, distinct orders.

    Lines are dealt out by ranges of products and orders: little moves after that, and a best-seller's are
    cut between tasks.
    """
    lines = order_items.select("product_id", "order_id", "quantity", "line_total")
    return lines.repartitionByRange(tasks_of(order_items), "product_id", "order_id").groupBy("product_id").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("line_total").cast(MONEY_SUM).alias("total_revenue"),
        F.countDistinct("order_id").alias("total_orders"),
    )


def dim_products(products: DataFrame, order_items: DataFrame, params: Params) -> DataFrame:
    """One row per product, sold or not."""
    return products.join(
        product_stats(order_items), F.col("id") == F.col("product_id"), "left"
    ).select(
        F.col("id").alias("product_key"),
        F.col("name").alias("product_name"),
        F.col("description").alias("product_description"),
        F.col("category").alias("product_category"),
        "merchant_id",
        F.col("price").alias("current_price"),
        F.col("stock_quantity").alias("current_stock"),
        F.coalesce("total_quantity_sold", F.lit(0)).alias("total_quantity_sold"),
        F.coalesce("total_revenue", F.lit(0)).cast(MONEY_SUM).alias("total_revenue"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        first_match([(F.col("total_revenue").isNull(), "No Sales")], "Active").alias("product_status"),
        F.col("created_at").alias("product_created_at"),
        F.col("updated_at").alias("product_updated_at"),
        ntz(params.run_ts).alias(UPDATED_AT),
    )


def fact_orders(order_items: DataFrame, orders: DataFrame, params: Params) -> DataFrame:
    """One row per order line since the start date. Raw status and country case is kept.

    Lines without an order drop out here; the reference checks report them. The date filter reaches
    the order scan. A hot order is split by adaptive execution: both sides meet in a plain join.
    """
    return _fact(_lines_of_orders(order_items, orders, params), params)


def _lines_of_orders(order_items: DataFrame, orders: DataFrame, params: Params) -> DataFrame:
    """What the fact takes from lines and their orders."""
    if params.use_clean_orders:
        orders = clean_orders(orders)
    heads = orders.where(F.col("created_at") >= ntz(params.start_date)).select(
        F.col("id").alias("order_key"),
        F.col("user_id").alias("customer_key"),
        F.col("created_at").alias("order_timestamp"),
        F.col("status").alias("order_status"),
        F.col("country").alias("country_code"),
        "payment_method",
        F.col("total_amount").alias("order_total"),
    )
    return order_items.join(heads, F.col("order_id") == F.col("order_key")).select(
        F.col("id").alias("order_item_key"),
        "order_key",
        "customer_key",
        F.col("product_id").alias("product_key"),
        "order_status",
        "country_code",
        "payment_method",
        "order_timestamp",
        F.col("quantity").alias("quantity_sold"),
        "unit_price",
        F.col("line_total").alias("line_revenue"),
        "order_total",
    )


def _fact(lines: DataFrame, params: Params, *more: str) -> DataFrame:
    """The fact's columns: those of ``lines`` and what follows from them, and then ``more`` of ``lines``."""
    status = F.col("order_status")
    return lines.select(
        "order_item_key",
        "order_key",
        "customer_key",
        "product_key",
        F.to_date("order_timestamp").alias("date_key"),
        "order_status",
        "country_code",
        "payment_method",
        "order_timestamp",
        "quantity_sold",
        "unit_price",
        "line_revenue",
        "order_total",
        (F.col("line_revenue") * F.lit(params.margin_rate)).alias("estimated_margin"),
        F.coalesce(is_completed(status, params), F.lit(False)).cast("int").alias("is_completed"),
        F.coalesce(status == CANCELLED_STATUS, F.lit(False)).cast("int").alias("is_cancelled"),
        *more,
    )


# The fact is stored by month of the order, each month's rows in the order of days.
ORDER_MONTH = "order_month"


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(ORDER_MONTH, F.trunc("date_key", "month"))


def fact_by_month(order_items: DataFrame, orders: DataFrame, params: Params) -> DataFrame:
    """The fact with its month, rows gathered by month and sorted by day and order, as it is stored.

    What follows from other columns is made after the rows have moved, so it does not move with them. What an
    order's lines differ in stands first: the rest is alike in the rows before and shrinks as one piece. A month
    with very many lines is split by size.
    """
    lines = _lines_of_orders(order_items, orders, params)
    own = ["product_key", "unit_price", "line_revenue", "quantity_sold", "order_item_key"]
    of_order = ["order_key", "customer_key", "order_total", "order_timestamp", "order_status", "country_code", "payment_method"]
    dated = lines.select(*own, *of_order, F.trunc("order_timestamp", "month").alias(ORDER_MONTH))
    moved = dated.hint("rebalance", F.col(ORDER_MONTH))
    return _fact(moved, params, ORDER_MONTH).sortWithinPartitions(ORDER_MONTH, "date_key", "order_key")


def in_period(fact: DataFrame, first: date, last: date) -> DataFrame:
    """Lines of the days from ``first`` to ``last``: other months' folders are not read."""
    month = F.col(ORDER_MONTH)
    months = (month >= F.lit(first.replace(day=1))) & (month <= F.lit(last.replace(day=1)))
    return fact.where(months & F.col("date_key").between(F.lit(first), F.lit(last)))
