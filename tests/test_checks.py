"""Data checks on tables with known faults."""

from __future__ import annotations

import frames as t
import pytest
from frames import days_ago

from basketry.operators import checks
from basketry.operators.checks import Check
from basketry.schemas import TABLES


@pytest.fixture(scope="module")
def tables(spark):
    u = t.users(spark, (1, "fra", None), (2, "fra", None), (2, "fra", None))
    o = t.orders(spark, (1, 1, days_ago(1), 5, "paid"), (1, 9, days_ago(1), 5, "paid"), (1, 9, days_ago(1), 5, "paid"),
                 (None, None, days_ago(1), 5, "paid"))
    return {
        "users": u.withColumn("email", u.country),
        "products": t.products(spark, (1, "a", "Toys")),
        "orders": o,
        "order_items": t.items(spark, (1, 1, 1, 1, 5), (2, 7, 2, 1, 5), (3, 8, 1, 1, 5)),
        "events": t.events(spark, (1, None, "error", days_ago(1), "{}"), (2, 5, "error", days_ago(1), "{}")),
        "crm_contacts": t.contacts(spark),
    }


def failures(df):
    return {(r.test, r.table_name, r.column_name): r.failures for r in df.collect()}


def test_report(tables):
    found = failures(checks.report(tables))
    assert len(found) == 13
    assert {k: v for k, v in found.items() if v} == {
        ("unique", "users", "id"): 1,
        ("unique", "users", "email"): 1,
        ("unique", "orders", "id"): 1,
        ("not_null", "orders", "id"): 1,
        ("not_null", "orders", "user_id"): 1,
        ("relationships", "orders", "user_id"): 2,
        ("relationships", "order_items", "order_id"): 2,
    }


def test_constraints_cover_the_schema(tables):
    listed = checks.constraint_checks()
    assert len(listed) == sum(len(x.unique) + len(x.required) + len(x.references) for x in TABLES.values())
    found = failures(checks.report(tables, listed))
    assert found["relationships", "order_items", "product_id"] == 1
    assert found["relationships", "events", "user_id"] == 1
    assert found["not_null", "crm_contacts", "id"] == 0


def test_status_and_severity(tables):
    df = checks.report(tables, [Check("unique", "orders", "id", severity="error"), Check("not_null", "users", "id")])
    assert {(r.severity, r.status) for r in df.collect()} == {("error", "error"), ("warn", "pass")}
    assert checks.enforce(df) is df
    assert checks.enforce(df, "warn") is df
    with pytest.raises(checks.ChecksFailed, match="unique orders.id: 1"):
        checks.enforce(df, "error")


def test_unknown_check(tables):
    with pytest.raises(ValueError):
        checks.report(tables, [Check("odd", "users", "id")])


def test_hot_value_reaches_the_join_once(spark):
    child = spark.range(9000).selectExpr("if(id < 3000, 42, id) AS fk")
    parent = spark.range(9000).selectExpr("if(id < 3000, 43, id) AS k")
    lost = checks.orphans(child, "fk", parent, "k")
    assert [(r.value, r.rows) for r in lost.collect()] == [(42, 3000)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_references_move_nothing(spark):
    """Only orphans reach the exchange: with none there is nothing to shuffle."""
    child = spark.range(50_000).selectExpr("id % 1000 * 3 AS fk", "id")
    parent = spark.range(1000).selectExpr("id * 3 AS k")
    lost = checks.orphans(child, "fk", parent, "k")
    assert lost.count() == 0 and "SortMergeJoin" not in plan(lost) and "BroadcastHashJoin" in plan(lost)
    more = child.unionByName(spark.createDataFrame([(1, 0), (1, 0), (-3, 0), (None, 0), (3000, 0)], "fk long, id long"))
    assert sorted((r.value, r.rows) for r in checks.orphans(more, "fk", parent, "k").collect()) == [(-3, 1), (1, 2), (3000, 1)]


def test_references_of_other_types_and_wide_ranges(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert [tuple(r) for r in checks.orphans(child, "fk", parent, "k").collect()] == [("b", 2)]
    wide = spark.createDataFrame([(-(1 << 62),), (1 << 62,)], "k long")
    lost = checks.orphans(spark.createDataFrame([(1 << 62,), (7,)], "fk long"), "fk", wide, "k")
    assert [tuple(r) for r in lost.collect()] == [(7, 1)]
    tables = {"users": parent.withColumnRenamed("k", "id"), "orders": child.withColumnRenamed("fk", "user_id")}
    found = failures(checks.report(tables, [Check("relationships", "orders", "user_id", ("users", "id")), Check("unique", "orders", "user_id")]))
    assert found == {("relationships", "orders", "user_id"): 2, ("unique", "orders", "user_id"): 1}


def test_all_checks_of_a_table_take_one_scan_and_one_shuffle(spark, tables, tmp_path):
    tables["users"].write.parquet(f"{tmp_path}/users")
    users = spark.read.parquet(f"{tmp_path}/users")
    own = [c for c in checks.STAGING_CHECKS if c.table == "users"]
    assert len(own) == 4
    text = plan(checks.table_failures({"users": users}, "users", own))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_empty_tables_have_no_failures(spark, tables):
    none = {n: df.limit(0) for n, df in tables.items()}
    assert set(failures(checks.report(none, checks.constraint_checks())).values()) == {0}
