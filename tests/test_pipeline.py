"""The daily run on generated tables, with faults, twice, and with an empty table."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import frames as t
import pytest
from pyspark.sql import functions as F

from basketry.operators.checks import ChecksFailed
from basketry.plans import core, pipeline
from basketry import journal, marks
from basketry.scratch import Scratch
from basketry.schemas import ORDERS
from basketry.sources.staging import append_staging, read_staging
from basketry.warehouse import Warehouse
from basketry.sources import generate as g

DAY = date(2024, 6, 30)


@pytest.fixture(scope="module")
def source(spark):
    scratch = Scratch(spark)
    users = g.generate_users(g.id_range(spark, 200), t.RUN_TS)
    products = g.generate_products(g.id_range(spark, 50), t.RUN_TS)
    items = scratch.keep(g.generate_order_items(g.id_range(spark, 800), products, scratch))
    return {
        "users": users,
        "products": products,
        "order_items": items,
        "orders": g.generate_orders(g.id_range(spark, 800), users, items, t.RUN_TS, scratch),
        "events": g.generate_events(g.id_range(spark, 500), users, products, t.RUN_TS, scratch),
        "crm_contacts": t.contacts(spark),
    }


def report(df):
    return {(r.section, r.table_name, r.metric): r.value for r in df.collect()}


@pytest.fixture(scope="module")
def run(spark, source, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    return root, report(pipeline.run_pipeline(spark, source, root, DAY, t.PARAMS))


def test_report(run):
    root, r = run
    assert r["STAGING TABLES", "stg_orders", "row_count"] == 800
    assert r["STAGING TABLES", "stg_crm_contacts", "row_count"] == 0
    assert r["CORE TABLES", "dim_customers", "total_rows"] == 200
    assert all(v == 0 for (section, _, _), v in r.items() if section in ("REJECTS", "CHECKS", "EMPTY TABLES"))
    assert r["DATA MARTS", "mart_sales_overview", "grand_total_revenue"] == pytest.approx(
        r["DATA MARTS", "mart_product_performance", "total_product_revenue"]
    )


def test_marts_agree_with_the_fact(spark, run):
    root, _ = run
    house = Warehouse(spark, root)
    fact = house.read("fact_orders").where("is_completed = 1")
    revenue = fact.agg(F.sum("line_revenue")).first()[0]
    sales = house.read("mart_sales_overview")
    performance = house.read("mart_product_performance")
    ltv = house.read("mart_customer_ltv")
    assert sales.agg(F.sum("total_revenue")).first()[0] == revenue
    assert ltv.agg(F.sum("lifetime_value")).first()[0] == revenue
    last = performance.orderBy(F.col("revenue_rank").desc()).first()
    assert last.cumulative_revenue_pct == pytest.approx(1)
    assert performance.agg(F.sum("total_revenue")).first()[0] == revenue
    assert spark.table("staging_stg_orders").count() == 800


def test_second_run_of_a_day_changes_nothing(spark, source, run):
    root, first = run
    house = Warehouse(spark, root)

    def everything():
        tables = {n: house.read(n) for n in ("fact_orders", "mart_customer_ltv", "mart_product_performance")}
        tables["orders"] = read_staging(spark, root, ORDERS)
        return {n: sorted(df.collect(), key=str) for n, df in tables.items()}

    before, version = everything(), house.version()
    assert report(pipeline.run_pipeline(spark, source, root, DAY, t.PARAMS)) == first
    assert everything() == before and house.version() == version + 1


def test_next_day_adds_to_staging_and_replaces_the_marts(spark, source, run):
    root, first = run
    before = Warehouse(spark, root).tables()["fact_orders"].folders
    later = report(pipeline.run_pipeline(spark, source, root, date(2024, 7, 1), t.PARAMS))
    assert later == first
    assert Warehouse(spark, root).tables()["fact_orders"].folders == before, "nothing has changed, so no month is built again"
    assert read_staging(spark, root, ORDERS).count() == 1600


def test_faults_are_reported_and_may_stop_the_run(spark, source, tmp_path):
    faulty = {**source, "orders": source["orders"].withColumn("user_id", F.col("user_id") + 1_000_000)}
    r = report(pipeline.run_pipeline(spark, faulty, str(tmp_path), DAY, t.PARAMS))
    assert r["CHECKS", "orders", "relationships user_id"] == 800
    assert r["DATA MARTS", "mart_customer_ltv", "total_rows"] == 0
    assert r["EMPTY TABLES", "mart_customer_ltv", "is_empty"] == 1
    with pytest.raises(ChecksFailed):
        pipeline.run_pipeline(spark, faulty, str(tmp_path), DAY, t.PARAMS, fail_on="warn")


def test_a_failing_build_leaves_the_old_tables(spark, source, tmp_path):
    staged = {**source, "orders": source["orders"].withColumn("_loaded_at", F.lit(None).cast("timestamp_ntz"))}
    scratch, root = Scratch(spark), str(tmp_path)
    before = pipeline.build_models(spark, staged, root, t.PARAMS, scratch)["fact_orders"].count()
    broken = [*pipeline.MODELS[:-1], pipeline.Model("broken", "marts", lambda b: b.tables["no such table"])]
    fewer = {**staged, "order_items": staged["order_items"].limit(1)}
    with pytest.raises(KeyError):
        pipeline.build_models(spark, fewer, root, t.PARAMS, scratch, broken)
    assert Warehouse(spark, root).read("fact_orders").count() == before > 1
    assert Warehouse(spark, root).versions() == [1]


@pytest.mark.parametrize("breaks_at", ["mart_product_performance", "load/orders", "commit", "report"])
def test_a_run_that_broke_goes_on_where_it_broke(spark, source, tmp_path, monkeypatch, breaks_at):
    """The retry repeats the one step that failed and what comes after it; the result is that of an unbroken run."""
    root, done = str(tmp_path), []
    real_step, real_put = journal.Journal.step, marks.put

    def step(self, name, inputs, work):
        def watched():
            done.append(name)
            if name == breaks_at or name == f"model/{breaks_at}":
                raise OSError("lost")
            return work()

        return real_step(self, name, inputs, watched)

    def put(spark, path, text):
        if breaks_at == "commit" and "/manifests/" in path:
            raise OSError("lost")
        real_put(spark, path, text)

    monkeypatch.setattr(journal.Journal, "step", step)
    monkeypatch.setattr(marks, "put", put)
    if breaks_at == "report":
        monkeypatch.setattr(pipeline, "run_report", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        pipeline.run_pipeline(spark, source, root, DAY, t.PARAMS)
    assert Warehouse(spark, root).version() == (1 if breaks_at == "report" else 0)
    first, done[:] = set(done), []
    breaks = breaks_at
    breaks_at = None
    monkeypatch.undo()
    monkeypatch.setattr(journal.Journal, "step", step)
    got = report(pipeline.run_pipeline(spark, source, root, DAY, t.PARAMS))
    if breaks == "mart_product_performance":
        assert done == [f"model/{breaks}"], "exports, loads and the other models are there"
    elif breaks == "load/orders":
        assert not any(n.startswith("export/") for n in done) and "load/orders" in done
        assert {n for n in done if n.startswith("load/")} <= {"load/orders"} | {f"load/{n}" for n in source} - first
        assert "before" in done
    else:
        assert done == [], "all steps were finished"
    assert got == report(pipeline.run_pipeline(spark, source, str(tmp_path / "unbroken"), DAY, t.PARAMS))
    done.clear()
    pipeline.run_pipeline(spark, source, root, DAY, t.PARAMS)
    assert len(done) == 2 * len(source) + 7, "a finished day is run again as a whole"


def test_the_fact_is_stored_by_month(spark, source, run):
    root, _ = run
    fact = Warehouse(spark, root).read("fact_orders")
    month = core.in_period(fact, date(2024, 5, 3), date(2024, 5, 20))
    text = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in text and "DataFilters: [isnotnull(date_key" in text
    assert month.count() == fact.where("date_key between date'2024-05-03' and date'2024-05-20'").count() > 0
    assert fact.where("order_month <> trunc(date_key, 'month')").count() == 0


def test_runs_of_one_session_keep_their_views(spark, source, tmp_path):
    staged = {**source, "orders": source["orders"].withColumn("_loaded_at", F.lit(None).cast("timestamp_ntz"))}
    scratch = Scratch(spark)
    pipeline.build_models(spark, staged, str(tmp_path / "a"), t.PARAMS, scratch, views="a_")
    pipeline.build_models(spark, {**staged, "order_items": staged["order_items"].limit(1)}, str(tmp_path / "b"), t.PARAMS, scratch, views="b_")
    assert spark.table("a_core_fact_orders").count() > 1 >= spark.table("b_core_fact_orders").count()


def test_a_session_that_leaves_hot_keys_whole_is_refused(spark, source, tmp_path):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        with pytest.raises(ValueError, match="skewJoin"):
            pipeline.run_pipeline(spark, source, str(tmp_path), DAY, t.PARAMS)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_the_next_day_builds_changed_months_of_the_fact_only(spark, source, tmp_path):
    """The result is that of a whole build; a day whose staged files were replaced, or other rules, ask for one."""
    root, next_day = str(tmp_path / "a"), date(2024, 7, 1)
    house = Warehouse(spark, root)
    pipeline.run_pipeline(spark, source, root, DAY, t.PARAMS)
    orders = source["orders"].withColumn("status", F.when(F.col("id") == 7, "cancelled").otherwise(F.col("status")))
    changed = {**source, "orders": orders.where("id <> 11")}
    month = {r.id: str(r.created_at.date().replace(day=1)) for r in source["orders"].where("id in (7, 11)").collect()}
    got = report(pipeline.run_pipeline(spark, changed, root, next_day, t.PARAMS))
    old, new = house.tables(1)["fact_orders"].folders, house.tables(2)["fact_orders"].folders
    assert {m for m in old if old[m] != new.get(m)} == set(month.values())
    whole = str(tmp_path / "b")
    assert got == report(pipeline.run_pipeline(spark, changed, whole, next_day, t.PARAMS))
    fact = Warehouse(spark, whole).read("fact_orders")
    assert sorted(house.read("fact_orders").collect(), key=str) == sorted(fact.collect(), key=str)
    note = house.notes()[pipeline.FROM]
    assert pipeline.built_before(spark, root, t.PARAMS, note) is not None and pipeline.built_before(spark, root, t.PARAMS, "") is None
    assert pipeline.built_before(spark, root, replace(t.PARAMS, completed_statuses=("paid",)), note) is None
    put_away = read_staging(spark, root, ORDERS, next_day).limit(5)
    append_staging(Scratch(spark).keep(put_away), root, ORDERS, next_day)
    assert pipeline.built_before(spark, root, t.PARAMS, note) is None
