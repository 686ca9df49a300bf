"""Models on edge cases the test tables do not hold."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import frames as t
import pytest
from frames import PARAMS, days_ago
from pyspark.sql import functions as F

from basketry.functions.columns import stamp
from basketry.plans import core, marts, staging
from basketry.scratch import Scratch



def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_stg_orders_keeps_positive_amounts(spark):
    o = t.orders(spark, (1, 1, days_ago(1), -1, "paid"), (2, 1, days_ago(1), 0, "paid"), (3, 1, days_ago(1), None, "paid"),
                 (4, 1, days_ago(1), "0.01", "paid"))
    rows = staging.stg_orders(stamp(o, t.RUN_TS)).collect()
    assert [r.order_id for r in rows] == [4]
    assert (rows[0].order_status, rows[0].country_code, rows[0].payment_method) == ("PAID", "FRA", "paypal")


def test_dim_customers(spark):
    u = t.users(spark, (1, "fra", "premium"), (2, None, None), (3, "usa", "enterprise", None), (4, "usa", "freemium"))
    o = t.orders(
        spark,
        (1, 1, days_ago(5), 10, "paid"),
        (2, 1, days_ago(3), 20, "shipped"),
        (3, 1, days_ago(1), 40, "cancelled"),
        (4, 4, days_ago(1), 40, "pending"),
        (5, 9, days_ago(1), 40, "paid"),
    )
    rows = by_key(core.dim_customers(u, o, PARAMS), "customer_key")
    assert set(rows) == {1, 2, 3, 4}
    one = rows[1]
    assert (one.total_orders, one.lifetime_value, one.last_order_date) == (2, Decimal("30.00"), days_ago(3))
    assert (one.customer_segment, one.customer_status, one.country_code, one.full_name) == ("Premium", "Active", "FRA", "Ann L1")
    assert (rows[2].country_code, rows[2].customer_segment) == (None, "Freemium")
    assert rows[3].full_name is None and rows[3].customer_segment == "Premium"
    assert (rows[4].customer_status, rows[4].total_orders, rows[4].lifetime_value) == ("No Purchase", 0, 0)


@pytest.mark.parametrize(
    "last, status",
    [
        (days_ago(30), "Active"),
        (days_ago(30, 0), "Active"),
        (days_ago(31, 23), "At Risk"),
        (days_ago(90, 1), "At Risk"),
        (days_ago(91, 23), "Churned"),
    ],
)
def test_status_ladder(spark, last, status):
    df = core.dim_customers(t.users(spark, (1, "fra", None)), t.orders(spark, (1, 1, last, 5, "paid")), PARAMS)
    assert df.first().customer_status == status


def test_dim_products(spark):
    p = t.products(spark, (1, "ring", "Toys"), (2, "box", "Home"))
    i = t.items(spark, (1, 1, 1, 2, "3.00"), (2, 1, 1, 1, "3.00"), (3, 2, 1, 1, "3.00"))
    rows = by_key(core.dim_products(p, i, PARAMS), "product_key")
    assert (rows[1].product_status, rows[1].total_quantity_sold, rows[1].total_revenue, rows[1].total_orders) == ("Active", 4, 12, 2)
    assert (rows[2].product_status, rows[2].total_quantity_sold, rows[2].total_revenue, rows[2].total_orders) == ("No Sales", 0, 0, 0)


def test_fact_orders(spark):
    start = datetime(2022, 1, 1)
    o = t.orders(spark, (1, 1, start, 5, "paid"), (2, 1, start - timedelta(microseconds=1), 5, "paid"),
                 (3, None, days_ago(1), 0, "cancelled"), (4, 1, days_ago(1, 23), 5, "pending"), (5, 1, None, 5, "paid"),
                 (6, 1, days_ago(1), 5, None))
    i = t.items(spark, *[(k, k, 1, 2, "1.25") for k in (1, 2, 3, 4, 5, 6, 7)])
    rows = by_key(core.fact_orders(i, o, PARAMS), "order_key")
    assert set(rows) == {1, 3, 4, 6}
    assert (rows[1].is_completed, rows[1].is_cancelled, rows[1].estimated_margin) == (1, 0, Decimal("0.500"))
    assert (rows[3].is_completed, rows[3].is_cancelled) == (0, 1)
    assert (rows[4].is_completed, rows[4].is_cancelled, rows[4].date_key) == (0, 0, days_ago(1).date())
    assert (rows[6].is_completed, rows[6].is_cancelled, rows[6].country_code) == (0, 0, "fra")
    clean = by_key(core.fact_orders(i, o, replace(PARAMS, use_clean_orders=True)), "order_key")
    assert set(clean) == {1, 4, 6}


def shop(spark, revenues, copies=1):
    """One paid order and line per revenue, each of another product and customer."""
    keys = range(1, len(revenues) + 1)
    u = t.users(spark, *[(k, "fra", None) for k in keys])
    p = t.products(spark, *[(k, f"p{k}", "Toys") for k in keys for _ in range(copies)])
    o = t.orders(spark, *[(k, k, days_ago(k), 10, "paid") for k in keys])
    i = t.items(spark, *[(k, k, k, 1, r) for k, r in zip(keys, revenues)])
    fact = core.fact_orders(i, o, PARAMS)
    return core.dim_customers(u, o, PARAMS), core.dim_products(p, i, PARAMS), fact


def test_classes_at_the_borders(spark, params=PARAMS):
    _, p, fact = shop(spark, [15, 50, 5, 30])
    rows = marts.mart_product_performance(fact, p, params, Scratch(spark)).collect()
    assert [(r.product_key, r.revenue_rank, r.abc_class) for r in rows] == [
        (2, 1, "A"), (4, 2, "A"), (1, 3, "B"), (3, 4, "C"),
    ]
    assert [r.cumulative_revenue_pct for r in rows] == [0.5, 0.8, 0.95, 1.0]
    assert sum(r.revenue_pct for r in rows) == pytest.approx(1)


def test_single_product_and_no_revenue(spark, params=PARAMS):
    _, p, fact = shop(spark, [7])
    assert marts.mart_product_performance(fact, p, params, Scratch(spark)).first().abc_class == "C"
    _, p, fact = shop(spark, [0, 0])
    rows = marts.mart_product_performance(fact, p, params, Scratch(spark)).collect()
    assert [(r.revenue_pct, r.margin_rate, r.abc_class) for r in rows] == [(None, None, "C")] * 2


def test_tiers_and_ties(spark):
    _, p, fact = shop(spark, [3] * 51)
    for params in (PARAMS,):
        rows = marts.mart_product_performance(fact, p, params, Scratch(spark)).collect()
        assert [r.product_key for r in rows] == list(range(1, 52)), "ties go by key"
        tiers = [r.performance_tier for r in rows]
        assert (tiers[9], tiers[10], tiers[49], tiers[50]) == ("Top 10", "Top 50", "Top 50", "Long Tail")


def test_repeated_dimension_rows_count_as_often(spark):
    """A product listed three times: sums triple, counts of orders and means do not."""
    _, p, fact = shop(spark, [8, 2], copies=3)
    rows = by_key(marts.product_metrics(fact, p), "product_key")
    joined = (
        marts.completed(fact).join(p, "product_key").groupBy("product_key", "product_name", "product_category")
        .agg(F.sum("line_revenue").alias("revenue"), F.sum("quantity_sold").alias("quantity"),
             F.countDistinct("order_key").alias("orders"))
    )
    for r in joined.collect():
        got = rows[r.product_key]
        assert (got.total_revenue, got.total_quantity_sold, got.total_orders) == (r.revenue, r.quantity, r.orders)


def test_lines_without_dimension_drop_out(spark):
    c, p, fact = shop(spark, [8, 2, 4])
    overview = marts.mart_sales_overview(fact, p.where("product_key <> 1"), c.where("customer_key <> 2"))
    assert overview.agg(F.sum("total_revenue")).first()[0] == 4
    whole = marts.mart_sales_overview(fact, p, c).agg(F.sum("total_revenue")).first()[0]
    assert whole == marts.completed(fact).agg(F.sum("line_revenue")).first()[0]


def test_order_in_two_categories_counts_twice_and_means_weigh_lines(spark):
    u, p = t.users(spark, (1, "fra", None)), t.products(spark, (1, "a", "Toys"), (2, "b", "Home"))
    o = t.orders(spark, (1, 1, days_ago(1), 10, "paid"), (2, 1, days_ago(1, 1), 40, "paid"))
    i = t.items(spark, (1, 1, 1, 1, 1), (2, 1, 1, 1, 1), (3, 1, 2, 1, 1), (4, 2, 1, 1, 1))
    fact = core.fact_orders(i, o, PARAMS)
    overview = by_key(
        marts.mart_sales_overview(fact, core.dim_products(p, i, PARAMS), core.dim_customers(u, o, PARAMS)), "product_category"
    )
    assert (overview["Toys"].total_orders, overview["Home"].total_orders) == (2, 1)
    assert overview["Toys"].avg_order_value == 20.0
    assert overview["Toys"].margin_rate == pytest.approx(0.2)


@pytest.mark.parametrize("n", [1, 3, 7])
def test_scores_with_few_customers(spark, n):
    c, _, fact = shop(spark, [10 * k for k in range(1, n + 1)])
    for params in (PARAMS,):
        rows = by_key(marts.mart_customer_ltv(c, fact, params, Scratch(spark)), "customer_key")
        assert len(rows) == n
        assert rows[1].recency_score == 1, "fewest days come first"
        assert rows[n].monetary_score == 1, "highest value comes first"
    turned = by_key(marts.mart_customer_ltv(c, fact, replace(PARAMS, best_is_high=True), Scratch(spark)), "customer_key")
    assert turned[1].recency_score == min(n, 5) and turned[n].monetary_score == min(n, 5)


def test_customers_without_key_take_part_in_scores_only(spark):
    u = t.users(spark, (1, "fra", None))
    o = t.orders(spark, (1, 1, days_ago(1), 10, "paid"), (2, None, days_ago(2), 10, "paid"))
    i = t.items(spark, (1, 1, 1, 1, 5), (2, 2, 1, 1, 9))
    fact, c = core.fact_orders(i, o, PARAMS), core.dim_customers(u, o, PARAMS)
    for params in (PARAMS,):
        (row,) = marts.mart_customer_ltv(c, fact, params, Scratch(spark)).collect()
        assert (row.recency_score, row.monetary_score) == (1, 2)


@pytest.mark.parametrize("days, risk", [(90, "Low"), (91, "Medium"), (180, "Medium"), (181, "High")])
def test_churn_risk(spark, days, risk):
    u, o = t.users(spark, (1, "fra", None)), t.orders(spark, (1, 1, days_ago(days, 23), 10, "paid"))
    fact = core.fact_orders(t.items(spark, (1, 1, 1, 1, 5)), o, PARAMS)
    row = marts.mart_customer_ltv(core.dim_customers(u, o, PARAMS), fact, PARAMS, Scratch(spark)).first()
    assert (row.churn_risk, row.days_since_last_order) == (risk, days)


def test_lifespan_counts_date_borders(spark):
    o = t.orders(spark, (1, 1, datetime(2024, 5, 1, 23), 10, "paid"), (2, 1, datetime(2024, 5, 2, 1), 10, "paid"))
    fact = core.fact_orders(t.items(spark, (1, 1, 1, 1, 5), (2, 2, 1, 1, 5)), o, PARAMS)
    assert marts.customer_metrics(fact, PARAMS).first().customer_lifespan_days == 1


def test_every_segment(spark):
    """All 125 score combinations, by the rules spelled out once more."""
    rows = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(rows, "recency_score int, frequency_score int, monetary_score int")

    def expected(r, f, m):
        if min(r, f, m) >= 4:
            return "Champions"
        if r >= 3:
            if f >= 3:
                return "Loyal Customers"
            if r >= 4:
                return "Promising"
            return "Potential Loyalists" if m >= 3 else "Others"
        if f >= 3:
            return "At Risk"
        return "Cant Lose Them" if m >= 4 else "Hibernating"

    for row in marts.rfm_segments(df).collect():
        r, f, m = row[:3]
        assert (row.rfm_total_score, row.rfm_segment) == (r + f + m, expected(r, f, m))


def test_empty_tables(spark):
    c, p, fact = shop(spark, [5])
    nothing = fact.where("false")
    for params in (PARAMS,):
        assert marts.mart_customer_ltv(c, nothing, params, Scratch(spark)).count() == 0
        assert marts.mart_product_performance(nothing, p, params, Scratch(spark)).count() == 0
    assert marts.mart_sales_overview(nothing, p, c).count() == 0


@pytest.mark.parametrize("repeated", [False, True])
def test_overview_counted_where_its_lines_lie_has_the_same_rows(spark, repeated):
    """Keys, countries and texts that are null or unknown, an order of two customers, dimensions that repeat a key."""
    orders, customers = (1, 2, 3, 4, 5, None), (1, 2, 3, None, 65, 700)
    lines = [(orders[n % 6], customers[n % 5 if n % 4 else n % 6], n % 7 or None, ("fr", "de", None)[n % 3], n % 4, n) for n in range(400)]
    fact = spark.createDataFrame(
        lines, "order_key long, customer_key long, product_key long, country_code string, day int, quantity_sold int"
    ).select(
        "*",
        F.lit(1).alias("is_completed"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("day")).alias("date_key"),
        F.when(F.col("quantity_sold") % 9 > 0, F.col("quantity_sold")).cast("decimal(12,2)").alias("line_revenue"),
        F.col("quantity_sold").cast("decimal(15,4)").alias("estimated_margin"),
        F.when(F.col("quantity_sold") % 11 > 0, F.col("order_key") * 3).cast("decimal(12,2)").alias("order_total"),
    )
    twice = [(2, "b"), (2, "a")] if repeated else [(2, "b")]
    p = spark.createDataFrame([(1, "a"), *twice, (3, None), (4, "a"), (5, "b"), (None, "a")], "product_key long, product_category string")
    c = spark.createDataFrame([(1, "s"), (2, "t"), (65, "s"), (None, "s"), (9, "t")], "customer_key long, customer_segment string")
    plain, counted = marts.mart_sales_overview(fact, p, c), marts.mart_sales_overview(fact, p, c, Scratch(spark))
    assert counted.dtypes == plain.dtypes
    want = sorted(map(str, plain.collect()))
    assert sorted(map(str, counted.collect())) == want and len(want) > 20
