"""The daily run: export, load, models, checks, verification."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import marks
from basketry.journal import Journal, Step
from basketry.operators import checks
from basketry.params import Params
from basketry.plans import core, incremental, marts, staging, verify
from basketry.schemas import TABLES
from basketry.scratch import Scratch
from basketry.session import require_skew_handling, shuffles_removed
from basketry.sources.load import load_typed, nothing_loaded, union_all, write_loaded
from basketry.sources.raw import write_raw
from basketry.sources.staging import day_path, read_rejects, read_staging
from basketry.warehouse import Change, Stored, Warehouse


@dataclass
class Build:
    """What a model may read: staged tables, models built before it, and parameters.

    ``before`` has the staged tables that the stored models were built from, if these are still there.
    """

    spark: SparkSession
    tables: Mapping[str, DataFrame]
    params: Params
    scratch: Scratch
    before: Mapping[str, DataFrame] | None = None
    models: dict[str, DataFrame] = field(default_factory=dict)


@dataclass(frozen=True)
class Model:
    """A named table or view of a layer. A table may have a folder for each value of a column, and an order within;
    ``gathered`` says that it is built with its rows gathered and in that order.

    ``refresh`` brings a stored table up to date from what has changed, instead of building it as a whole.
    """

    name: str
    layer: str
    build: Callable[[Build], DataFrame]
    view: bool = False
    by: str | None = None
    within: tuple[str, ...] = ()
    gathered: bool = False
    refresh: Callable[[Build, Change], object] | None = None


# In the order of what reads what. Core and mart models are tables, so no mart computes core again.
MODELS = (
    Model("stg_orders", "staging", lambda b: staging.stg_orders(b.tables["orders"]), view=True),
    Model(
        "dim_customers", "core", lambda b: core.dim_customers(b.tables["users"], b.tables["orders"], b.params)
    ),
    Model(
        "dim_products", "core", lambda b: core.dim_products(b.tables["products"], b.tables["order_items"], b.params)
    ),
    Model(
        "fact_orders",
        "core",
        lambda b: core.fact_by_month(b.tables["order_items"], b.tables["orders"], b.params),
        by=core.ORDER_MONTH,
        gathered=True,
        refresh=lambda b, change: incremental.refresh_fact(change, b.before, b.tables, b.params),
    ),
    Model(
        "mart_sales_overview",
        "marts",
        lambda b: marts.mart_sales_overview(
            b.models["fact_orders"], b.models["dim_products"], b.models["dim_customers"], b.scratch
        ),
    ),
    Model(
        "mart_customer_ltv",
        "marts",
        lambda b: marts.mart_customer_ltv(b.models["dim_customers"], b.models["fact_orders"], b.params, b.scratch),
    ),
    Model(
        "mart_product_performance",
        "marts",
        lambda b: marts.mart_product_performance(
            b.models["fact_orders"], b.models["dim_products"], b.params, b.scratch
        ),
    ),
)


JOBS_AT_ONCE = 4


def together(job: Callable, items: Iterable) -> list:
    """Run a job per item, a few at a time: small tables do not wait for big ones to end."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return list(pool.map(job, items))


def as_table(df: DataFrame, path: str) -> DataFrame:
    """Replace a table as a whole and return the written one."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_models(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    params: Params,
    scratch: Scratch,
    models: Sequence[Model] = MODELS,
    views: str = "",
    journal: Journal | None = None,
    inputs: Mapping[str, str] | None = None,
    before: Mapping[str, DataFrame] | None = None,
    notes: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Build all models on staged tables; together they become the next version of the warehouse at ``root``.

    Models of one layer read other layers only, so they are built side by side. Readers see all tables
    of the version before until every one is built (see ``warehouse``). Each model also gets a view
    ``<views><layer>_<name>``; runs in one session keep apart by their own ``views``. With a
    ``journal`` models that an attempt before has built from the same ``inputs`` are not built again. With
    the staged tables of ``before``, from which the stored version was built, the fact is only brought up
    to date. ``notes`` go with the new version.
    """
    b = Build(spark, tables, params, scratch, before)
    change = Warehouse(spark, root).change()
    change.notes = dict(notes or {})
    read = {"params": str(params), **(inputs or {})}

    def build(m: Model) -> DataFrame:
        def write() -> dict:
            if m.refresh and before is not None and m.name in change.tables:
                m.refresh(b, change)
            else:
                change.write(m.name, m.build(b), m.layer, by=m.by, within=m.within, gather=not m.gathered)
            return change.tables[m.name].to_json()

        if m.view:
            return m.build(b)
        step = journal.step(f"model/{m.name}", known, write) if journal else Step("", write())
        read[m.name] = step.id
        return change.adopt(m.name, Stored.from_json(step.result))

    with shuffles_removed(spark):
        for _, layer in groupby(models, key=lambda m: m.layer):
            members, known = list(layer), dict(read)
            b.models.update(zip([m.name for m in members], together(build, members)))
    change.commit()
    for m in models:
        b.models[m.name].createOrReplaceTempView(f"{views}{m.layer}_{m.name}")
    return b.models


def export_and_load(
    spark: SparkSession, source: Mapping[str, DataFrame], root: str, day: date, params: Params, journal: Journal
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """One day's snapshot through raw files into staging; returns the staged tables of that day and their loads' ids.

    A table without rows exports no file and stages no rows. A table that was exported before the run
    broke is not exported again, so all of a run comes from one snapshot of it.
    """

    def stage(name: str) -> tuple[DataFrame, str]:
        table = TABLES[name]
        exported = journal.step(f"export/{name}", {}, lambda: {"path": write_raw(source[name], root, table, day)})

        def load() -> dict:
            path = exported.result["path"]
            multi_line = table.raw_format != "json"
            rows = nothing_loaded(spark, table) if path is None else load_typed(spark, path, table, multi_line=multi_line)
            return {"rejects": write_loaded(rows, table, params.run_ts, day_path(root, table, day))}

        loaded = journal.step(f"load/{name}", {"export": exported.id, "run_ts": str(params.run_ts)}, load)
        return read_staging(spark, root, table, day), loaded.id

    staged = dict(zip(TABLES, together(stage, TABLES)))
    return {n: df for n, (df, _) in staged.items()}, {n: step for n, (_, step) in staged.items()}


FROM = "fact_orders_from"


def built_before(spark: SparkSession, root: str, params: Params, note: str) -> dict[str, DataFrame] | None:
    """The staged tables that a stored fact was built from by the same rules, as a version's note says.

    None if there is no note, or if the files of its day have been replaced or removed since.
    """
    if not note:
        return None
    day = date.fromisoformat(json.loads(note)["day"])
    if note != incremental.built_from(params, day.isoformat(), staged_digests(spark, root, day)):
        return None
    return {n: read_staging(spark, root, TABLES[n], day) for n in incremental.READS}


def staged_digests(spark: SparkSession, root: str, day: date) -> dict[str, str]:
    return {n: marks.fingerprint(spark, day_path(root, TABLES[n], day)) for n in incremental.READS}


REPORT_SECTIONS = ("REJECTS", "CHECKS", "EMPTY TABLES")


def run_report(
    tables: Mapping[str, DataFrame], models: Mapping[str, DataFrame], rejects: Mapping[str, DataFrame], result: DataFrame
) -> DataFrame:
    """Everything worth reading after a run: section, table_name, metric, value."""
    rejects_section, checks_section, empty_section = REPORT_SECTIONS
    long = ["section", "table_name", "metric", "value"]
    observed = {**{f"stg_{n}": tables[n] for n in ("users", "orders")}, **models}
    return union_all(
        [
            verify.verify_report(tables, models).select(*long),
            verify.row_counts(rejects).select(
                F.lit(rejects_section).alias("section"),
                "table_name",
                F.lit("rejected_rows").alias("metric"),
                F.col("row_count").cast("double").alias("value"),
            ),
            result.select(
                F.lit(checks_section).alias("section"),
                "table_name",
                F.concat_ws(" ", "test", "column_name").alias("metric"),
                F.col("failures").cast("double").alias("value"),
            ),
            verify.non_empty({n: observed[n] for n in verify.MUST_NOT_BE_EMPTY}).select(
                F.lit(empty_section).alias("section"),
                "table_name",
                F.lit("is_empty").alias("metric"),
                F.col("is_empty").cast("int").cast("double").alias("value"),
            ),
        ]
    )


def run_pipeline(
    spark: SparkSession,
    source: Mapping[str, DataFrame],
    root: str,
    day: date,
    params: Params,
    fail_on: str | None = None,
    fresh: bool = False,
) -> DataFrame:
    """Run one day from source tables to marts below ``root`` and return the written report.

    A run that broke goes on where it broke when the day is run again: exports, loads and models it
    had finished are kept (``fresh`` starts anew). Running a finished day again replaces what it wrote.
    After a day whose staged files are as they were, only the months of the fact are built again in which
    an order has changed since.
    Failed checks are reported; ``fail_on="warn"`` makes them stop the run after the models are built.
    Joins of lines rely on adaptive execution to split hot orders, products and customers, so the
    session must have that on.
    """
    require_skew_handling(spark)
    with shuffles_removed(spark):
        journal = Journal(spark, f"{root}/journal/{day.isoformat()}", fresh)
        staged, loads = export_and_load(spark, source, root, day, params, journal)
        # Noted as a step: a retry after the commit must not take its own version for the one before.
        stored = journal.step("before", {}, lambda: {"note": Warehouse(spark, root).notes().get(FROM, "")}).result["note"]
        before = built_before(spark, root, params, stored)
        notes = {FROM: incremental.built_from(params, day.isoformat(), staged_digests(spark, root, day))}
        inputs = {**loads, "before": stored if before else ""}
        scratch = Scratch(spark)
        try:
            models = build_models(
                spark, staged, root, params, scratch, journal=journal, inputs=inputs, before=before, notes=notes
            )
        finally:
            scratch.close()
        found = as_table(checks.report(staged), f"{root}/reports/checks/{day.isoformat()}")
        rejects = {n: read_rejects(spark, root, t, day) for n, t in TABLES.items()}
        report = as_table(run_report(staged, models, rejects, found), f"{root}/reports/run/{day.isoformat()}")
        journal.finish()
        checks.enforce(found, fail_on)
        return report
