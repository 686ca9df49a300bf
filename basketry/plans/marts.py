"""Data marts: daily sales, customer value, product performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from basketry.functions.columns import MARGIN_SUM, MONEY_SUM, day_diff, first_match, mean, ratio
from basketry.operators.lookup import lookup
from basketry.operators.windows import asc, desc, global_ntile, global_window, with_total
from basketry.params import (
    CHURN_HIGH_AFTER_DAYS,
    CHURN_MEDIUM_AFTER_DAYS,
    CLASS_A_SHARE,
    CLASS_B_SHARE,
    SCORE_BUCKETS,
    SECOND_TIER_RANK,
    TOP_TIER_RANK,
    Params,
)
from basketry.scratch import Scratch
from basketry.session import tasks_of

# Fixed value: the segment of customers that no rule fits.
NO_SEGMENT = "Others"
# What the sales overview adds up from lines.
OVERVIEW_MEASURES = ("quantity_sold", "line_revenue", "estimated_margin", "order_total")


def segment_rules(r: Column, f: Column, m: Column) -> list[tuple[Column, str]]:
    """The segments' labels and rules by recency, frequency and monetary score; the first that holds decides."""
    return [
        ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
        ((r >= 3) & (f >= 3), "Loyal Customers"),
        ((r >= 4) & (f <= 2), "Promising"),
        ((r >= 3) & (m >= 3), "Potential Loyalists"),
        ((r <= 2) & (f >= 3), "At Risk"),
        ((r <= 2) & (m >= 4), "Cant Lose Them"),
        (r <= 2, "Hibernating"),
    ]


def completed(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.where(F.col("is_completed") == 1)


def _with_text(df: DataFrame, dim: DataFrame, key: str, attribute: str, scratch: Scratch | None) -> DataFrame:
    """An inner join with a dimension's key and one text; with a ``scratch`` by its lookup, if it has one."""
    known = lookup(dim, key, attribute, scratch) if scratch else None
    return known.join(df, key, attribute) if known else df.join(dim.select(key, attribute), key)


def mart_sales_overview(
    fact_orders: DataFrame, dim_products: DataFrame, dim_customers: DataFrame, scratch: Scratch | None = None
) -> DataFrame:
    """Completed sales by day, country, category and customer segment.

    The mean order value weighs an order by its lines. An order with lines in two categories counts
    in both, so order counts do not add up over categories. Dimensions are cut down to key and
    attribute before the joins; whether one is small enough to broadcast is Spark's size check.
    With a ``scratch`` less is moved and the rows are the same: dimensions are written as lookups, which are
    small, and what is dealt out is counted where it lies, by its first row for each order and customer.
    """
    keys = ["sale_date", "country_code", "product_category", "customer_segment"]
    # Lines are dealt out by ranges of their groups, so groups of a day lie together and are small to send.
    # An order then stands there for itself, with the sums, and once more for its customer: both distinct
    # counts are counts of rows.
    sold = _with_text(completed(fact_orders), dim_products, "product_key", "product_category", scratch)
    lines = (
        _with_text(sold, dim_customers, "customer_key", "customer_segment", scratch)
        .select(F.col("date_key").alias("sale_date"), *keys[1:], "customer_key", "order_key", *OVERVIEW_MEASURES)
        .repartitionByRange(tasks_of(fact_orders), *keys)
    )
    per_order = lines.groupBy(*keys, "customer_key", "order_key").agg(
        F.sum("quantity_sold").alias("quantity"),
        F.sum("line_revenue").alias("revenue"),
        F.sum("estimated_margin").alias("margin"),
        F.sum("order_total").alias("order_totals"),
        F.count("order_total").alias("totals"),
    )
    if scratch:
        flagged = per_order.withColumns(
            {
                "_order": _is_first([*keys, "order_key"], "customer_key") & F.col("order_key").isNotNull(),
                "_customer": _is_first([*keys, "customer_key"], "order_key") & F.col("customer_key").isNotNull(),
            }
        )
        return _overview(flagged.groupBy(*keys), F.count_if("_order"), F.count_if("_customer"))
    measures = ("quantity", "revenue", "margin", "order_totals", "totals")
    # Rows of a group stand together when they move, so they shrink more.
    members = per_order.sortWithinPartitions(*keys).unpivot([*keys, *measures], ["order_key", "customer_key"], "of", "member")
    is_order = F.col("of") == "order_key"
    per_member = (
        members.select(*keys, "of", "member", *[F.when(is_order, F.col(m)).alias(m) for m in measures])
        .repartition(tasks_of(fact_orders), *keys)
        .groupBy(*keys, "of", "member")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    orders, customers = (F.count(F.when(which, F.col("member"))) for which in (is_order, ~is_order))
    return _overview(per_member.groupBy(*keys), orders, customers)


def _is_first(of: list[str], by: str) -> Column:
    return F.row_number().over(Window.partitionBy(*of).orderBy(by)) == 1


def _overview(groups: GroupedData, orders: Column, customers: Column) -> DataFrame:
    """The mart's columns, from sums per order and the two counts."""
    revenue, margin = F.sum("revenue"), F.sum("margin")
    return groups.agg(
        orders.alias("total_orders"),
        customers.alias("unique_customers"),
        F.sum("quantity").alias("total_quantity"),
        revenue.cast(MONEY_SUM).alias("total_revenue"),
        margin.cast(MARGIN_SUM).alias("total_margin"),
        ratio(F.sum("order_totals"), F.sum("totals")).alias("avg_order_value"),
        ratio(revenue, orders).alias("revenue_per_order"),
        ratio(margin, revenue).alias("margin_rate"),
    )


def customer_metrics(fact_orders: DataFrame, params: Params) -> DataFrame:
    """Recency, frequency and value per customer with a completed order."""
    first, last = F.col("first_order_date"), F.col("last_order_date")
    return (
        completed(fact_orders)
        .groupBy("customer_key")
        .agg(
            F.max("order_timestamp").alias("last_order_date"),
            F.min("order_timestamp").alias("first_order_date"),
            F.countDistinct("order_key").alias("total_orders"),
            F.sum("line_revenue").cast(MONEY_SUM).alias("lifetime_value"),
            mean(F.col("order_total")).alias("avg_order_value"),
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


def rfm_scores(metrics: DataFrame, params: Params) -> DataFrame:
    """Fifths by recency, frequency and value, over all customers; the key settles ties.

    Fifth 1 holds the most recent, most frequent and most valuable customers, so 5 is the worst.
    ``params.best_is_high`` turns that round.
    """
    high, low = (asc, desc) if params.best_is_high else (desc, asc)
    key = asc("customer_key")
    return global_ntile(
        metrics,
        SCORE_BUCKETS,
        {
            "recency_score": [low("days_since_last_order"), key],
            "frequency_score": [high("total_orders"), key],
            "monetary_score": [high("lifetime_value"), key],
        },
    )


def rfm_segments(scores: DataFrame) -> DataFrame:
    """Sum of the scores and the segment they fall into."""
    r, f, m = (F.col(f"{s}_score") for s in ("recency", "frequency", "monetary"))
    segment = first_match(segment_rules(r, f, m), NO_SEGMENT)
    return scores.withColumns({"rfm_total_score": r + f + m, "rfm_segment": segment})


def mart_customer_ltv(
    dim_customers: DataFrame, fact_orders: DataFrame, params: Params, scratch: Scratch
) -> DataFrame:
    """Value, scores, segment and churn risk of every customer with a completed order.

    The metrics are written once: they are counted, ordered three ways and joined.
    """
    metrics = scratch.keep(customer_metrics(fact_orders, params), "customer_metrics")
    scored = rfm_segments(rfm_scores(metrics, params))
    days = F.col("days_since_last_order")
    return (
        dim_customers.select(
            "customer_key", "email", "full_name", "country_code", "customer_segment", "customer_status"
        )
        .join(scored, "customer_key")
        .select(
            "*",
            first_match([(days > CHURN_HIGH_AFTER_DAYS, "High"), (days > CHURN_MEDIUM_AFTER_DAYS, "Medium")], "Low").alias(
                "churn_risk"
            ),
        )
    )


def product_metrics(fact_orders: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Volume, revenue and margin per product with a completed order.

    Lines are aggregated before they meet the dimension, so the join sees one row per product and a
    best-seller cannot overload it. Few lines of a task share product and order, so lines are dealt out
    first, by ranges of both: no task that joins lines also holds them by group, a best-seller's lines are
    cut between tasks by order, and a range has few products to hand on.
    """
    lines = completed(fact_orders).select(
        "product_key", "order_key", "quantity_sold", "line_revenue", "unit_price", "estimated_margin", "order_timestamp"
    )
    sold = (
        lines.repartitionByRange(tasks_of(fact_orders), "product_key", "order_key")
        .groupBy("product_key")
        .agg(
            F.countDistinct("order_key").alias("total_orders"),
            F.sum("quantity_sold").alias("quantity"),
            F.sum("line_revenue").cast(MONEY_SUM).alias("revenue"),
            mean(F.col("unit_price")).alias("avg_unit_price"),
            F.sum("estimated_margin").cast(MARGIN_SUM).alias("margin"),
            F.min("order_timestamp").alias("first_sale_date"),
            F.max("order_timestamp").alias("last_sale_date"),
        )
    )
    return named_products(sold, dim_products)


def named_products(sold: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Products' sales with name and category. If the dimension repeats a product, every copy counts, as it
    would when joining line by line."""
    named = dim_products.groupBy("product_key", "product_name", "product_category").agg(
        F.count(F.lit(1)).alias("copies")
    )
    return sold.join(named, "product_key").select(
        "product_key",
        "product_name",
        "product_category",
        "total_orders",
        (F.col("quantity") * F.col("copies")).alias("total_quantity_sold"),
        (F.col("revenue") * F.col("copies")).cast(MONEY_SUM).alias("total_revenue"),
        "avg_unit_price",
        (F.col("margin") * F.col("copies")).cast(MARGIN_SUM).alias("total_margin"),
        ratio(F.col("margin"), F.col("revenue")).alias("margin_rate"),
        "first_sale_date",
        "last_sale_date",
    )


def ranked_products(metrics: DataFrame, params: Params, scratch: Scratch) -> DataFrame:
    """Rank by revenue, running revenue in that order, and revenue of all products."""
    # Key, name and category identify a row, so the order is total.
    order = [desc("total_revenue"), asc("product_key"), asc("product_name"), asc("product_category")]
    ranked = global_window(
        metrics,
        order,
        scratch,
        rank="revenue_rank",
        running={"cumulative_revenue": "total_revenue"},
    )
    return with_total(ranked, "total_revenue_all", metrics, "total_revenue")


def abc_classes(ranked: DataFrame) -> DataFrame:
    """Revenue shares, class by running share including the row itself, and tier by rank.

    Without any revenue the shares are null and every product is in class C.
    """
    total, rank = F.col("total_revenue_all"), F.col("revenue_rank")
    share = F.col("cumulative_revenue_pct")
    return ranked.withColumns(
        {
            "revenue_pct": ratio(F.col("total_revenue"), total),
            "cumulative_revenue_pct": ratio(F.col("cumulative_revenue"), total),
        }
    ).withColumns(
        {
            "abc_class": first_match([(share <= CLASS_A_SHARE, "A"), (share <= CLASS_B_SHARE, "B")], "C"),
            "performance_tier": first_match(
                [(rank <= TOP_TIER_RANK, "Top 10"), (rank <= SECOND_TIER_RANK, "Top 50")], "Long Tail"
            ),
        }
    )


def mart_product_performance(
    fact_orders: DataFrame, dim_products: DataFrame, params: Params, scratch: Scratch
) -> DataFrame:
    """Products by revenue rank, with shares, class and tier."""
    metrics = scratch.keep(product_metrics(fact_orders, dim_products), "product_metrics")
    return (
        abc_classes(ranked_products(metrics, params, scratch))
        .drop("cumulative_revenue", "total_revenue_all")
        .orderBy("revenue_rank")
    )
