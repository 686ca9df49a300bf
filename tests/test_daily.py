"""Sets of numbers, daily states, and the fact brought from one day to the next."""

from __future__ import annotations

from datetime import date

import frames as t
import pytest
from frames import days_ago
from pyspark.sql import functions as F

from basketry.operators import bitsets
from basketry.plans import core, daily, incremental, marts
from basketry.warehouse import Warehouse


def test_sets_of_any_numbers(spark):
    members = [-(1 << 63), -65, -64, -1, 0, 1, 63, 64, 1000, (1 << 63) - 1, None, 0, 0]
    df = spark.createDataFrame([(m, k % 2) for k, m in enumerate(members)], "m long, part int")
    found = bitsets.set_of(df, "m", ["part"])
    whole = found.groupBy(bitsets.WORD).agg(bitsets.united().alias(bitsets.BITS))
    assert whole.agg(bitsets.size()).first()[0] == len({m for m in members if m is not None})
    asked = spark.createDataFrame([(m,) for m in [*members, 2, 62, -2, 65, 1001]], "q long")
    told = asked.join(whole, bitsets.word_of(F.col("q")) == F.col(bitsets.WORD), "left")
    got = {r.q: r.known for r in told.select("q", bitsets.has(F.col(bitsets.BITS), F.col("q")).alias("known")).collect()}
    assert got == {m: m is not None and m in members for m in [*members, 2, 62, -2, 65, 1001]}


def test_only_bounded_sets_are_sent_to_all(spark):
    df = spark.range(100).select("id", F.col("id").cast("string").alias("text"))
    assert bitsets.small_set(df, "id").count() == 2 and bitsets.small_set(df, "id", max_words=1) is None
    assert bitsets.small_set(df, "text") is None and bitsets.small_set(df.limit(0), "id").count() == 0


@pytest.fixture(scope="module")
def before(spark):
    rows = [(k, k % 7, days_ago(3 * k), 10 + k, "paid" if k % 5 else "pending") for k in range(1, 90)]
    lines = [(3 * k + j, k, (k + j) % 11, 1 + j, 5) for k in range(1, 90) for j in range(3)]
    return {"orders": t.orders(spark, *rows), "order_items": t.items(spark, *lines)}


@pytest.fixture(scope="module")
def dims(spark, before):
    users = t.users(spark, *[(k, "fra" if k % 2 else "deu", "premium" if k % 3 else None) for k in range(7)])
    products = t.products(spark, *[(k, f"p{k}", "Toys" if k % 2 else "Books") for k in range(11)])
    return core.dim_products(products, before["order_items"], t.PARAMS), core.dim_customers(users, before["orders"], t.PARAMS)


def full(tables):
    return core.with_month(core.fact_orders(tables["order_items"], tables["orders"], t.PARAMS))


@pytest.fixture
def house(spark, tmp_path, before, dims):
    made = Warehouse(spark, str(tmp_path))
    change = made.change()
    fact = change.write("fact_orders", full(before), "core", by=core.ORDER_MONTH, within=["date_key"])
    daily.refresh(change, fact, *dims)
    change.commit()
    return made


def rows(df):
    return sorted(df.select(sorted(df.columns)).collect(), key=str)


def check_states(house, tables, dims):
    assert rows(house.read("fact_orders")) == rows(full(tables))
    fact = full(tables)
    assert rows(daily.customer_metrics(house.read("customer_days"), t.PARAMS)) == rows(marts.customer_metrics(fact, t.PARAMS))
    from_days = marts.named_products(daily.product_sales(house.read("product_days")), dims[0])
    assert rows(from_days) == rows(marts.product_metrics(fact, dims[0]))
    assert rows(daily.overview(house.read("overview_days"))) == rows(marts.mart_sales_overview(fact, *dims))


def test_marts_from_states_equal_the_full_build(house, before, dims):
    check_states(house, before, dims)


def test_periods_and_groups_unite_without_counting_twice(house, before, dims):
    got = daily.overview(house.read("overview_days"), ["country_code"])
    done = marts.completed(full(before)).join(dims[0], "product_key").join(dims[1].select("customer_key"), "customer_key")
    want = done.groupBy("country_code").agg(F.countDistinct("order_key").alias("o"), F.countDistinct("customer_key").alias("c"))
    assert {(r.country_code, r.total_orders, r.unique_customers) for r in got.collect()} == {tuple(r) for r in want.collect()}


def moved(before, spark):
    """One order each: paid now, moved to another month, gone, new; one with a line more. And nothing else."""
    o, i = before["orders"], before["order_items"]
    o = o.withColumn("status", F.when(F.col("id") == 5, "paid").otherwise(F.col("status")))
    o = o.withColumn("created_at", F.when(F.col("id") == 20, F.lit("2024-01-09").cast("timestamp_ntz")).otherwise(F.col("created_at")))
    o = o.where("id <> 40").unionByName(t.orders(spark, (500, 3, days_ago(1), 7, "paid")))
    return {"orders": o, "order_items": i.unionByName(t.items(spark, (900, 500, 2, 1, 5), (901, 60, 3, 1, 5)))}


def test_only_changed_months_are_built_again(spark, house, before, dims, tmp_path):
    after = moved(before, spark)
    months = incremental.changed_months(before, after, t.PARAMS)
    times = {r.id: r.created_at for df in (before, after) for r in df["orders"].collect()}
    old = {r.id: r.created_at for r in before["orders"].collect()}
    touched = [old[5], old[20], times[20], old[40], times[500], old[60]]
    assert months == sorted({str(x.date().replace(day=1)) for x in touched})
    change = house.change()
    assert incremental.refresh_sales(change, before, after, *dims, t.PARAMS) == months
    change.commit()
    check_states(house, after, dims)
    kept = [f for f in house.tables()["fact_orders"].folders if f not in months]
    assert kept and all(house.tables(1)["fact_orders"].folders[m] == house.tables()["fact_orders"].folders[m] for m in kept)


def test_nothing_changed_builds_nothing(house, before, dims):
    change = house.change()
    again = {n: df.withColumn("_loaded_at", F.lit(None).cast("timestamp_ntz")) for n, df in before.items()}
    assert incremental.refresh_sales(change, before, again, *dims, t.PARAMS) == []
    assert change.tables == house.tables()


def test_a_month_that_loses_all_its_orders_goes(house, before, dims):
    after = {**before, "orders": before["orders"].where("created_at < timestamp_ntz'2024-03-01' OR created_at >= timestamp_ntz'2024-04-01'")}
    change = house.change()
    assert incremental.refresh_sales(change, before, after, *dims, t.PARAMS) == ["2024-03-01"]
    change.commit()
    assert "2024-03-01" not in house.tables()["fact_orders"].folders
    check_states(house, after, dims)


def test_changes_move_keys_and_hashes_only(before):
    text = incremental.changed_keys(before["orders"], before["orders"], "id")._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        if "Exchange" in line:
            assert "payment_method" not in line and "created_at" not in line


def test_states_have_no_expand(house, dims):
    fact = house.read("fact_orders")
    for df in (daily.customer_days(fact), daily.product_days(fact), daily.overview(house.read("overview_days"))):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
    one = core.in_period(fact, date(2024, 5, 1), date(2024, 5, 31))
    assert "PartitionFilters: [isnotnull(order_month" in one._jdf.queryExecution().executedPlan().toString()


def test_states_move_once(spark, tmp_path, before, dims):
    """Lines go to the ranges of their days' groups once: neither states nor gathered months move again."""
    path = f"{tmp_path}/fact"
    full(before).write.parquet(path)
    fact = spark.read.parquet(path)
    kept = [spark.createDataFrame(d.collect(), d.schema) for d in dims]
    for made in (daily.product_days(fact), daily.overview_days(fact, *kept)):
        text = made._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in text.splitlines() if "Exchange" in line and "Broadcast" not in line and "hashpartitioning(product_key" not in line]
        moved = [line for line in moved if "hashpartitioning(customer_key" not in line]
        assert len(moved) == 1 and "rangepartitioning(" in moved[0], text
