"""Daily states of the marts: what a day adds, kept by day, so that a changed day is all that is computed again.

Counts of different orders and customers are kept as sets (see ``bitsets``). Days unite to any period, and
fine groups to coarser ones, with exactly the numbers that a count over all lines gives.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import MARGIN_SUM, MONEY_SUM, day_diff, ratio
from basketry.operators.bitsets import BITS, WORD, bit_of, size, united, word_of
from basketry.params import Params
from basketry.plans.core import ORDER_MONTH
from basketry.plans.marts import OVERVIEW_MEASURES, completed
from basketry.session import tasks_of
from basketry.warehouse import Change

OVERVIEW_KEYS = ("sale_date", "country_code", "product_category", "customer_segment")
ORDERS, CUSTOMERS = "order_key", "customer_key"


def _month(day: str):
    return F.trunc(day, "month").alias(ORDER_MONTH)


def customer_days(fact_orders: DataFrame) -> DataFrame:
    """Per day, customer and word of order keys: the orders, sums and first and last moment of completed lines."""
    return (
        completed(fact_orders)
        .groupBy(_month("date_key"), "date_key", "customer_key", word_of(F.col("order_key")).alias(WORD))
        .agg(
            united(bit_of(F.col("order_key"))).alias(BITS),
            F.min("order_timestamp").alias("first_order_date"),
            F.max("order_timestamp").alias("last_order_date"),
            F.sum("line_revenue").alias("revenue"),
            F.sum("order_total").alias("order_totals"),
            F.count("order_total").alias("totals"),
        )
    )


def customer_metrics(days: DataFrame, params: Params) -> DataFrame:
    """What ``marts.customer_metrics`` gives, from the daily states."""
    first, last = F.col("first_order_date"), F.col("last_order_date")
    words = days.groupBy("customer_key", WORD).agg(
        united().alias(BITS),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        *[F.sum(c).alias(c) for c in ("revenue", "order_totals", "totals")],
    )
    return (
        words.groupBy("customer_key")
        .agg(
            F.max("last_order_date").alias("last_order_date"),
            F.min("first_order_date").alias("first_order_date"),
            size().alias("total_orders"),
            F.sum("revenue").cast(MONEY_SUM).alias("lifetime_value"),
            ratio(F.sum("order_totals"), F.sum("totals")).alias("avg_order_value"),
        )
        .select(
            "customer_key",
            "last_order_date",
            day_diff(last, F.lit(params.as_of)).alias("days_since_last_order"),
            "total_orders",
            day_diff(first, last).alias("customer_lifespan_days"),
            "lifetime_value",
            "avg_order_value",
            "first_order_date",
        )
    )


def product_days(fact_orders: DataFrame) -> DataFrame:
    """Per day, product and word of order keys: the orders, sums and first and last moment of completed lines.

    Few lines meet in a group. They are dealt out once, by ranges of days and products, so that states of a
    month are made in few tasks and need not be gathered.
    """
    columns = ("date_key", "product_key", "order_key", "quantity_sold", "line_revenue", "estimated_margin", "unit_price")
    return (
        completed(fact_orders)
        .select(*columns, "order_timestamp")
        .repartitionByRange(tasks_of(fact_orders), "date_key", "product_key")
        .groupBy(_month("date_key"), "date_key", "product_key", word_of(F.col("order_key")).alias(WORD))
        .agg(
            united(bit_of(F.col("order_key"))).alias(BITS),
            F.sum("quantity_sold").alias("quantity"),
            F.sum("line_revenue").alias("revenue"),
            F.sum("estimated_margin").alias("margin"),
            F.sum("unit_price").alias("prices"),
            F.count("unit_price").alias("priced"),
            F.min("order_timestamp").alias("first_sale_date"),
            F.max("order_timestamp").alias("last_sale_date"),
        )
    )


def product_sales(days: DataFrame) -> DataFrame:
    """Per product: orders, quantity, revenue, mean price, margin, first and last sale, from the daily states."""
    sums = ("quantity", "revenue", "margin", "prices", "priced")
    words = days.groupBy("product_key", WORD).agg(
        united().alias(BITS),
        F.min("first_sale_date").alias("first_sale_date"),
        F.max("last_sale_date").alias("last_sale_date"),
        *[F.sum(c).alias(c) for c in sums],
    )
    return words.groupBy("product_key").agg(
        size().alias("total_orders"),
        F.sum("quantity").alias("quantity"),
        F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
        ratio(F.sum("prices"), F.sum("priced")).alias("avg_unit_price"),
        F.sum("margin").cast(MARGIN_SUM).alias("margin"),
        F.min("first_sale_date").alias("first_sale_date"),
        F.max("last_sale_date").alias("last_sale_date"),
    )


def overview_days(fact_orders: DataFrame, dim_products: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Per day, country, category and segment: sums of completed lines, and the sets of orders and of customers.

    ``of`` says what a row's set holds; the sums stand in one row more, without a set. Lines are dealt out
    once, by ranges of the groups, and so of days: states of a month need not be gathered.
    """
    lines = (
        completed(fact_orders)
        .join(dim_products.select("product_key", "product_category"), "product_key")
        .join(dim_customers.select("customer_key", "customer_segment"), "customer_key")
        .select(F.col("date_key").alias("sale_date"), *OVERVIEW_KEYS[1:], CUSTOMERS, ORDERS, *OVERVIEW_MEASURES)
        .repartitionByRange(tasks_of(fact_orders), *OVERVIEW_KEYS)
    )
    none = F.lit(None).cast("long")
    parts = [F.struct(F.lit(k).alias("of"), F.col(k).cast("long").alias("member")) for k in (ORDERS, CUSTOMERS)]
    parts.append(F.struct(F.lit("sums").alias("of"), none.alias("member")))
    of, member = F.col("part.of"), F.col("part.member")

    def total(measure: str) -> Column:
        return F.sum(F.when(of == "sums", F.col(measure)))

    def money(measure: str) -> Column:
        kept = lines.agg(F.sum(measure)).agg(F.sum(f"sum({measure})")).schema[0].dataType
        return total(measure).cast(kept)

    return (
        lines.withColumn("part", F.explode(F.array(*parts)))
        .withColumn("priced", F.col("order_total").isNotNull().cast("int"))
        .groupBy(_month("sale_date"), *OVERVIEW_KEYS, of.alias("of"), word_of(member).alias(WORD))
        .agg(
            united(bit_of(member)).alias(BITS),
            total("quantity_sold").alias("quantity"),
            money("line_revenue").alias("revenue"),
            money("estimated_margin").alias("margin"),
            money("order_total").alias("order_totals"),
            total("priced").alias("totals"),
        )
    )


def overview(days: DataFrame, keys: Sequence[str] = OVERVIEW_KEYS) -> DataFrame:
    """Sales by any of the states' keys, or by what is derived from them; by all of them it is the mart.

    Orders and customers of united days and groups count once.
    """
    measures = ("quantity", "revenue", "margin", "order_totals", "totals")
    words = days.groupBy(*keys, "of", WORD).agg(united().alias(BITS), *[F.sum(m).alias(m) for m in measures])

    def members(of: str):
        return size(F.when(F.col("of") == of, F.col(BITS)))

    orders, revenue, margin = members(ORDERS), F.sum("revenue"), F.sum("margin")
    return words.groupBy(*keys).agg(
        orders.alias("total_orders"),
        members(CUSTOMERS).alias("unique_customers"),
        F.sum("quantity").alias("total_quantity"),
        revenue.cast(MONEY_SUM).alias("total_revenue"),
        margin.cast(MARGIN_SUM).alias("total_margin"),
        ratio(F.sum("order_totals"), F.sum("totals")).alias("avg_order_value"),
        ratio(revenue, orders).alias("revenue_per_order"),
        ratio(margin, revenue).alias("margin_rate"),
    )


def refresh(
    change: Change, fact_orders: DataFrame, dim_products: DataFrame, dim_customers: DataFrame, months: Iterable[str] | None = None
) -> None:
    """Write the states of all months, or only of those whose lines have changed; the others' folders stay.

    ``fact_orders`` is the stored fact with its months. The overview's states hang on the category and
    the segment of the time they are built: after a change of these in a dimension build all months.
    """
    months = None if months is None else sorted(months)
    fact = fact_orders if months is None else fact_orders.where(F.col(ORDER_MONTH).isin([F.lit(m).cast("date") for m in months]))
    change.write("customer_days", customer_days(fact), "states", by=ORDER_MONTH, within=("date_key",), only=months)
    # These are made in ranges of days, which hold few months each: they are written from where they are.
    ranged = (("product_days", product_days(fact), "date_key"), ("overview_days", overview_days(fact, dim_products, dim_customers), "sale_date"))
    for name, df, day in ranged:
        rows = df.sortWithinPartitions(ORDER_MONTH, day)
        change.write(name, rows, "states", by=ORDER_MONTH, gather=False, only=months)
