"""The registered queries: name -> (Spark query, reference SQL or None)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from basketry import schemas
from basketry.functions.columns import stamp
from basketry.operators import checks
from basketry.params import Params
from basketry.plans import core, daily, incremental, marts, pipeline, staging, verify
from basketry.scratch import Scratch, folder_and_files, name_local_folder
from basketry.session import shuffles_removed
from basketry.sources import generate, ledger, load, raw, snapshot
from basketry.sources import staging as sources_staging
from basketry.sources.sales_tables import SalesTables
from basketry.streaming import ingest
from basketry.warehouse import Warehouse

PARAMS = Params(as_of=date(2001, 8, 1), run_ts=datetime(2001, 8, 1, 2, 0), start_date=date(1996, 1, 1))


class Shop:
    """Source tables of one data folder and the models on top, each built when asked for."""

    def __init__(self, spark: SparkSession, folder: str, params: Params = PARAMS):
        self.spark, self.folder, self.params = spark, folder, params
        name_local_folder(spark)
        self.scratch = Scratch(spark)
        self.tables = SalesTables(spark, folder, self.scratch)
        self._staged: dict[str, DataFrame] | None = None

    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(stamp(self.tables["orders"], self.params.run_ts))

    def customer_order_agg(self) -> DataFrame:
        return core.customer_order_agg(self.tables["orders"], self.params)

    def dim_customers(self) -> DataFrame:
        return core.dim_customers(self.tables["users"], self.tables["orders"], self.params)

    def product_stats(self) -> DataFrame:
        return core.product_stats(self.tables["order_lines"])

    def dim_products(self) -> DataFrame:
        return core.dim_products(self.tables["products"], self.tables["order_lines"], self.params)

    def fact_orders(self) -> DataFrame:
        return core.fact_orders(self.tables["order_items"], self.tables["orders"], self.params)

    def sales(self) -> DataFrame:
        """The fact without its line key, which no mart reads."""
        return core.fact_orders(self.tables["order_lines"], self.tables["orders"], self.params)

    def mart_sales_overview(self) -> DataFrame:
        return marts.mart_sales_overview(self.sales(), self.dim_products(), self.dim_customers())

    def customer_metrics(self) -> DataFrame:
        return marts.customer_metrics(self.sales(), self.params)

    def rfm_scores(self) -> DataFrame:
        metrics = self.scratch.keep(self.customer_metrics(), "customer_metrics")
        return marts.rfm_scores(metrics, self.params)

    def rfm_segments(self) -> DataFrame:
        return marts.rfm_segments(self.rfm_scores())

    def mart_customer_ltv(self) -> DataFrame:
        return marts.mart_customer_ltv(self.dim_customers(), self.sales(), self.params, self.scratch)

    def product_metrics(self) -> DataFrame:
        return marts.product_metrics(self.sales(), self.dim_products())

    def ranked_products(self) -> DataFrame:
        metrics = self.scratch.keep(self.product_metrics(), "product_metrics")
        return marts.ranked_products(metrics, self.params, self.scratch)

    def loaded(self, name: str) -> tuple[DataFrame, DataFrame]:
        """Good rows and rejects of a table that went through its raw files."""
        table = schemas.TABLES[name]
        path = raw.write_raw(self.tables[name], self.scratch.path("export"), table, DAY_1)
        return load.load(self.spark, path, table, self.params.run_ts, multi_line=table.raw_format != "json")

    def ids(self, table: str, key: str) -> DataFrame:
        return self.tables.read(table).select(F.col(key).alias("id"))

    def models(self, root: str | None = None, views: str = "") -> dict[str, DataFrame]:
        """All models, written to tables."""
        root = root or self.scratch.path("warehouse")
        with shuffles_removed(self.spark):
            staged, scratch = self.staged(), Scratch(self.spark)
            try:
                return pipeline.build_models(self.spark, staged, root, self.params, scratch, views=views)
            finally:
                scratch.close()

    def staged(self) -> dict[str, DataFrame]:
        """The source tables; those that models read are written once, as a day's staging is, not made for each model."""
        if self._staged is None:
            made = {**self.tables.as_dict(), "orders": stamp(self.tables["orders"], self.params.run_ts)}
            read = ("users", "products", "orders", "order_items")
            self._staged = made | {n: self.scratch.keep(made[n], n, codec="zstd") for n in read}
        return self._staged

    def stored(self) -> Warehouse:
        """A warehouse with the fact by month and the marts' daily states."""
        house = Warehouse(self.spark, self.scratch.path("warehouse"))
        change = house.change()
        fact = change.write("fact_orders", core.with_month(self.sales()), "core", by=core.ORDER_MONTH, within=["date_key"])
        daily.refresh(change, fact, self.dim_products(), self.dim_customers())
        change.commit()
        return house

    def day_before(self) -> dict[str, DataFrame]:
        """Orders and lines of the day before: the last months' orders still pending, some not there yet, one too many."""
        orders, lines = self.tables["orders"], self.tables["order_lines"]
        late = F.col("created_at") >= F.lit("2001-06-15").cast("timestamp_ntz")
        pending = orders.withColumn("status", F.when(late, F.lit("pending")).otherwise(F.col("status")))
        gone = orders.orderBy("id").limit(1).withColumns({"id": F.lit(-1).cast("long"), "created_at": F.lit("1997-03-02").cast("timestamp_ntz")})
        early = orders.where("created_at < timestamp_ntz'1998-02-01' AND created_at >= timestamp_ntz'1998-01-01'").select(F.col("id").alias("order_id"))
        third = F.coalesce(F.col("order_id") % 3 == 0, F.lit(False))
        left = lines.where(third).join(early.where("order_id % 3 = 0"), "order_id", "left_anti").select(*lines.columns)
        fewer = lines.where(~third).unionByName(left)  # only lines that may go are shuffled
        none = lines.limit(1).withColumn("order_id", F.lit(-1).cast("long"))
        return {"orders": pending.where("id % 40 <> 1 OR created_at < timestamp_ntz'2001-07-01'").unionByName(gone), "order_items": fewer.unionByName(none)}

    def refreshed(self) -> tuple[Warehouse, list[str]]:
        """The fact and the daily states of the day before, brought to the day by its changes."""
        before = {n: self.scratch.keep(df, n) for n, df in self.day_before().items()}
        after = {"orders": self.scratch.keep(self.tables["orders"]), "order_items": self.scratch.keep(self.tables["order_lines"])}
        house = Warehouse(self.spark, self.scratch.path("warehouse"))
        change, dims = house.change(), (self.dim_products(), self.dim_customers())
        fact = core.with_month(core.fact_orders(before["order_items"], before["orders"], self.params))
        daily.refresh(change, change.write("fact_orders", fact, "core", by=core.ORDER_MONTH, within=["date_key"]), *dims)
        change.commit()
        change = house.change()
        months = incremental.refresh_sales(change, before, after, *dims, self.params)
        change.commit()
        return house, months

    def two_snapshots(self) -> tuple[DataFrame, DataFrame]:
        """Orders on two days: all still pending, then with their state and without cancelled ones."""
        orders = self.tables["orders"]
        return orders.withColumn("status", F.lit("pending")), orders.where("status <> 'cancelled'")

    def two_days(self) -> DataFrame:
        """Both snapshots in staging, the second loaded twice."""
        root = self.scratch.path("staging")
        first, second = self.two_snapshots()
        for day, df in ((DAY_1, first), (DAY_2, second), (DAY_2, second)):
            sources_staging.append_staging(stamp(df, self.params.run_ts), root, schemas.ORDERS, day)
        return sources_staging.read_staging(self.spark, root, schemas.ORDERS)

    def mart_product_performance(self) -> DataFrame:
        return marts.mart_product_performance(
            self.sales(), self.dim_products(), self.params, self.scratch
        )


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a ``Shop``."""

    def add(build: Callable[[Shop], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Shop(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


for _name, _view in {
    "customer_order_agg": "bought",
    "dim_customers": "dim_customers",
    "product_stats": "sold",
    "dim_products": "dim_products",
    "fact_orders": "fact_orders",
    "mart_sales_overview": "mart_sales_overview",
    "customer_metrics": "customer_metrics",
    "rfm_scores": "rfm_scores",
    "rfm_segments": "rfm_segments",
    "mart_customer_ltv": "mart_customer_ltv",
    "product_metrics": "product_metrics",
    "mart_product_performance": "mart_product_performance",
}.items():
    query(_name, oracle.view(_view))(lambda shop, name=_name: getattr(shop, name)())

query(
    "stg_orders",
    oracle.sql(
        f"""SELECT id AS order_id, user_id AS customer_id, created_at AS order_date, total_amount AS order_amount,
            upper(status) AS order_status, upper(country) AS country_code, lower(payment_method) AS payment_method,
            {oracle.RUN_TS} AS _loaded_at
        FROM shop_orders WHERE total_amount > 0""",
        "shop_orders",
    ),
)(lambda shop: shop.stg_orders())


@query("product_rank", oracle.view("ranked", "product_key, total_revenue, revenue_rank"))
def product_rank(shop: Shop) -> DataFrame:
    return shop.ranked_products().select("product_key", "total_revenue", "revenue_rank")


@query("product_cumulative", oracle.view("ranked", "product_key, total_revenue, cumulative_revenue"))
def product_cumulative(shop: Shop) -> DataFrame:
    return shop.ranked_products().select("product_key", "total_revenue", "cumulative_revenue")


@query("product_total_share", oracle.view("abc", "product_key, total_revenue, total_revenue_all, revenue_pct"))
def product_total_share(shop: Shop) -> DataFrame:
    return marts.abc_classes(shop.ranked_products()).select(
        "product_key", "total_revenue", "total_revenue_all", "revenue_pct"
    )


@query("abc_class", oracle.view("abc", "product_key, revenue_rank, cumulative_revenue_pct, abc_class, performance_tier"))
def abc_class(shop: Shop) -> DataFrame:
    return marts.abc_classes(shop.ranked_products()).select(
        "product_key", "revenue_rank", "cumulative_revenue_pct", "abc_class", "performance_tier"
    )


# --- scans, export and load -------------------------------------------------------------------

DAY_1, DAY_2 = date(2001, 7, 31), date(2001, 8, 1)
ORACLE_TABLES = {
    "users": "users", "products": "products", "orders": "shop_orders", "order_items": "order_items",
    "crm_contacts": "crm_contacts", "events": "shop_events",
}

for _name in ("users", "products", "orders", "order_items", "crm_contacts"):
    query(
        "scan_snapshot" if _name == "orders" else f"scan_snapshot_{_name}", oracle.view(ORACLE_TABLES[_name])
    )(lambda shop, name=_name: shop.tables[name])
    query(
        f"load_csv_{_name}",
        oracle.view(ORACLE_TABLES[_name], f"*, {oracle.RUN_TS} AS _loaded_at"),
    )(lambda shop, name=_name: shop.loaded(name)[0])


@query("scan_events", oracle.view("shop_events", "id, user_id, event_type, event_ts, metadata"))
def scan_events(shop: Shop) -> DataFrame:
    return snapshot.scan_events(shop.tables["events"])


@query(
    "export_csv_roundtrip",
    oracle.view(
        "shop_orders",
        """CAST(id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
        strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, CAST(total_amount AS VARCHAR) AS total_amount,
        status, country, payment_method""",
    ),
)
def export_csv_roundtrip(shop: Shop) -> DataFrame:
    """The orders' files as they are on disk, after the day was exported twice."""
    root = shop.scratch.path("export")
    raw.write_raw(shop.tables["orders"], root, schemas.ORDERS, DAY_1)
    path = raw.write_raw(shop.tables["orders"], root, schemas.ORDERS, DAY_1)
    return load.read_raw_csv(shop.spark, path, schemas.ORDERS, multi_line=True).drop(load.CORRUPT)


@query(
    "export_json_roundtrip",
    oracle.view(
        "shop_events",
        """CAST(id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, event_type,
        strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_ts, replace(metadata, ' ', '') AS metadata""",
    ),
)
def export_json_roundtrip(shop: Shop) -> DataFrame:
    path = raw.write_raw(shop.tables["events"], shop.scratch.path("export"), schemas.EVENTS, DAY_1)
    rows = load.read_raw_json(shop.spark, path, schemas.EVENTS).drop(load.CORRUPT)
    return rows.withColumn("metadata", F.to_json("metadata"))


@query(
    "export_skip_empty",
    oracle.sql(
        """SELECT 'all' AS part, COUNT(*) > 0 AS exported FROM shop_orders
        UNION ALL SELECT 'negative', COUNT(*) > 0 FROM shop_orders WHERE total_amount < 0
        UNION ALL SELECT 'all, then negative', COUNT(*) > 0 FROM shop_orders WHERE total_amount < 0""",
        "shop_orders",
    ),
)
def export_skip_empty(shop: Shop) -> DataFrame:
    """Whether exports left a folder; no order has a negative amount."""
    orders = shop.tables["orders"]
    none = orders.where("total_amount < 0")
    parts = {"all": [orders], "negative": [none], "all, then negative": [orders, none]}
    written = []
    for part, exports in parts.items():
        root = shop.scratch.path("export")
        for df in exports:
            raw.write_raw(df, root, schemas.ORDERS, DAY_1)
        path, files = folder_and_files(shop.spark, raw.raw_folder(root, schemas.ORDERS, DAY_1))
        written.append((part, files.exists(path)))
    return shop.spark.createDataFrame(written, "part string, exported boolean")


@query(
    "load_null_tokens",
    oracle.view(
        "users",
        f"""id, email, CASE WHEN plan_type IS NOT NULL THEN first_name END AS first_name, last_name, country,
        plan_type, created_at, last_login, is_active, {oracle.RUN_TS} AS _loaded_at""",
    ),
)
def load_null_tokens(shop: Shop) -> DataFrame:
    """Users written with three spellings of null, and loaded with all three as null tokens."""
    users = shop.tables["users"]
    text = users.select([F.col(c).cast("string").alias(c) for c in users.columns]).withColumns(
        {
            "first_name": F.when(F.col("plan_type").isNull(), "null").otherwise(F.col("first_name")),
            "plan_type": F.coalesce("plan_type", F.lit("NULL")),
            "last_login": F.coalesce("last_login", F.lit("")),
        }
    )
    path = shop.scratch.path("tokens")
    raw.write_csv(text, path)
    good, _ = load.load(shop.spark, path, schemas.USERS, shop.params.run_ts, load.NULL_TOKENS_WIDE, multi_line=False)
    return good


@query(
    "load_rejects",
    oracle.sql(
        f"""SELECT 'orders' AS table_name, CASE WHEN total_amount = 0 THEN 'malformed record'
            WHEN status = 'pending' THEN 'bad value: created_at,total_amount'
            WHEN status = 'cancelled' THEN 'bad value: total_amount' ELSE 'accepted' END AS reason,
            CASE WHEN total_amount = 0 THEN id || ',' || user_id
            WHEN status IN ('pending', 'cancelled') THEN '{{"id":"' || id || '","user_id":"' || user_id
                || '","created_at":"' || CASE status WHEN 'pending' THEN 'soon'
                    ELSE strftime(created_at, '%Y-%m-%d %H:%M:%S') END
                || '","total_amount":"n/a","status":"' || status || '","country":"' || country
                || '","payment_method":"' || payment_method || '"}}'
            ELSE CAST(id AS VARCHAR) END AS raw, {oracle.RUN_TS} AS _loaded_at
        FROM shop_orders""",
        "shop_orders",
    ),
)
def load_rejects(shop: Shop) -> DataFrame:
    """All orders as lines, some short and some with texts that are no number or time."""
    o = shop.tables["orders"]
    pending = F.col("status") == "pending"
    bad_amount = pending | (F.col("status") == "cancelled")
    full = F.concat_ws(
        ",",
        "id",
        "user_id",
        F.when(pending, "soon").otherwise(F.col("created_at").cast("string")),
        F.when(bad_amount, "n/a").otherwise(F.col("total_amount").cast("string")),
        "status",
        "country",
        "payment_method",
    )
    line = F.when(F.col("total_amount") == 0, F.concat_ws(",", "id", "user_id")).otherwise(full)
    path, staged = shop.scratch.path("lines"), shop.scratch.path("staged")
    o.select(line.alias("line")).write.text(path)
    rows = load.typed(load.read_raw_csv(shop.spark, path, schemas.ORDERS, multi_line=False, header="false"), schemas.ORDERS)
    load.write_loaded(rows, schemas.ORDERS, shop.params.run_ts, f"{staged}/{sources_staging.DAY}={DAY_1}")
    good = sources_staging.read_accepted(shop.spark, staged, sources_staging.staging_schema(schemas.ORDERS))
    bad = sources_staging.read_rejected(shop.spark, staged, schemas.ORDERS).drop(sources_staging.DAY)
    return bad.unionByName(
        good.select(
            F.lit("orders").alias("table_name"),
            F.lit("accepted").alias("reason"),
            F.col("id").cast("string").alias("raw"),
            "_loaded_at",
        )
    )


@query(
    "load_json_events",
    oracle.view(
        "shop_events",
        f"id, user_id, event_type, event_ts, replace(metadata, ' ', '') AS metadata, {oracle.RUN_TS} AS _loaded_at",
    ),
)
def load_json_events(shop: Shop) -> DataFrame:
    return shop.loaded("events")[0].withColumn("metadata", F.to_json("metadata"))


@query("load_stamp", oracle.view("order_items", f"*, {oracle.RUN_TS} AS _loaded_at"))
def load_stamp(shop: Shop) -> DataFrame:
    return stamp(shop.tables["order_items"], shop.params.run_ts)


_TWO_DAYS = """SELECT id, user_id, created_at, total_amount, 'pending' AS status, country, payment_method,
        DATE '2001-07-31' AS ingest_date FROM shop_orders
    UNION ALL SELECT id, user_id, created_at, total_amount, status, country, payment_method,
        DATE '2001-08-01' FROM shop_orders WHERE status <> 'cancelled'"""


@query("load_append", oracle.sql(f"SELECT *, {oracle.RUN_TS} AS _loaded_at FROM ({_TWO_DAYS})", "shop_orders"))
def load_append(shop: Shop) -> DataFrame:
    return shop.two_days()


@query(
    "latest_snapshot",
    oracle.sql(
        f"""SELECT id, user_id, created_at, total_amount,
            CASE status WHEN 'cancelled' THEN 'pending' ELSE status END AS status, country, payment_method,
            CASE status WHEN 'cancelled' THEN DATE '2001-07-31' ELSE DATE '2001-08-01' END AS ingest_date,
            {oracle.RUN_TS} AS _loaded_at
        FROM shop_orders""",
        "shop_orders",
    ),
)
def latest_snapshot(shop: Shop) -> DataFrame:
    """Orders as last seen: cancelled ones were only in the first day's snapshot."""
    return sources_staging.latest_snapshot(shop.two_days(), scratch=shop.scratch)


@query(
    "latest_snapshot_state",
    oracle.sql(
        f"""SELECT id, user_id, created_at, total_amount, CASE WHEN status = 'cancelled' THEN 'pending' ELSE status END AS status,
            country, payment_method, CASE WHEN status = 'cancelled' THEN DATE '2001-07-31'
                WHEN id % 7 = 0 THEN DATE '2001-08-01' ELSE DATE '2001-08-02' END AS ingest_date, {oracle.RUN_TS} AS _loaded_at
        FROM shop_orders""",
        "shop_orders",
    ),
)
def latest_snapshot_state(shop: Shop) -> DataFrame:
    """Orders as last seen on three days, from a state that was merged day by day; some are missing on the last."""
    days, state = shop.two_days(), None
    third = shop.two_snapshots()[1].where("id % 7 <> 0")
    last = DAY_2.replace(day=2)
    days = shop.scratch.keep(days.unionByName(stamp(third, shop.params.run_ts).withColumn(sources_staging.DAY, F.lit(last))))
    for day in (DAY_1, DAY_2, last):
        merged = sources_staging.merge_state(state, days.where(F.col(sources_staging.DAY) == F.lit(day)))
        state = shop.scratch.keep(merged, "state")
    return sources_staging.rows_of_best(days, state, "id", scratch=shop.scratch)


@query(
    "latest_snapshot_null_keys",
    oracle.sql(
        f"""SELECT CASE WHEN country <> 'usa' THEN id END AS id, user_id, created_at, total_amount, status, country,
            payment_method, ingest_date, {oracle.RUN_TS} AS _loaded_at
        FROM ({_TWO_DAYS})
        QUALIFY country IS NULL OR country = 'usa' OR row_number() OVER (PARTITION BY id ORDER BY ingest_date DESC) = 1""",
        "shop_orders",
    ),
)
def latest_snapshot_null_keys(shop: Shop) -> DataFrame:
    """Orders of one country have lost their id: both days' rows of these stay."""
    days = shop.two_days()
    return sources_staging.latest_snapshot(days.withColumn("id", F.when(F.col("country") != "usa", F.col("id"))))


@query("ingest_incremental", oracle.sql(f"SELECT *, {oracle.RUN_TS} AS _loaded_at FROM ({_TWO_DAYS})", "shop_orders"))
def ingest_incremental(shop: Shop) -> DataFrame:
    """Three runs over the raw folder: after the first day, with nothing new, after the second day."""
    root, target = shop.scratch.path("raw"), shop.scratch.path("target")
    first, second = shop.two_snapshots()
    for day, snapshot_of_day in ((DAY_1, first), (None, None), (DAY_2, second)):
        if day:
            raw.write_raw(snapshot_of_day, root, schemas.ORDERS, day)
        ingest.ingest(shop.spark, root, schemas.ORDERS, target, shop.params.run_ts, multi_line=False)
    return ingest.read_ingested(shop.spark, target, schemas.ORDERS)


@query(
    "ingest_ledger",
    oracle.sql(
        f"""SELECT *, {oracle.RUN_TS} AS _loaded_at FROM (
            SELECT id, user_id, created_at, total_amount, CASE WHEN status = 'cancelled' THEN 'paid' ELSE status END AS status,
                country, payment_method, DATE '2001-07-31' AS ingest_date FROM shop_orders
            UNION ALL SELECT id, user_id, created_at, total_amount, status, country, payment_method,
                DATE '2001-08-01' FROM shop_orders WHERE status <> 'cancelled')""",
        "shop_orders",
    ),
)
def ingest_ledger(shop: Shop) -> DataFrame:
    """Four runs over the raw folder: a day, nothing new, the same day exported anew, one more day."""
    root, target = shop.scratch.path("raw"), shop.scratch.path("target")
    first, second = shop.two_snapshots()
    paid = shop.tables["orders"].withColumn("status", F.when(F.col("status") == "cancelled", "paid").otherwise(F.col("status")))
    for day, exported in ((DAY_1, first), (None, None), (DAY_1, paid), (DAY_2, second)):
        if day:
            raw.write_raw(exported, root, schemas.ORDERS, day)
        ledger.ingest_files(shop.spark, root, schemas.ORDERS, target, shop.params.run_ts, multi_line=False)
    return ledger.read_loaded(shop.spark, target, schemas.ORDERS)


@query(
    "apply_defaults",
    oracle.view(
        "shop_orders",
        f"""id, user_id, {oracle.RUN_TS} AS created_at, total_amount, 'pending' AS status, country,
        payment_method""",
    ),
)
def apply_defaults(shop: Shop) -> DataFrame:
    """Orders that arrive without status and time."""
    return load.apply_defaults(shop.tables["orders"].drop("status", "created_at"), schemas.ORDERS, shop.params.run_ts)


@query(
    "apply_defaults_to_nulls",
    oracle.view(
        "users",
        f"""id, email, first_name, last_name, country, coalesce(plan_type, 'freemium') AS plan_type,
        coalesce(created_at, {oracle.RUN_TS}) AS created_at, last_login, is_active""",
    ),
)
def apply_defaults_to_nulls(shop: Shop) -> DataFrame:
    return load.apply_defaults(shop.tables["users"], schemas.USERS, shop.params.run_ts, fill_nulls=True)


@query(
    "event_metadata",
    oracle.view(
        "shop_events",
        """id, user_id, event_type, event_ts, CAST(regexp_extract(metadata, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
        CAST(NULL AS VARCHAR) AS device""",
    ),
)
def event_metadata(shop: Shop) -> DataFrame:
    return staging.event_metadata(shop.tables["events"], {"k": "bigint", "device": "string"})


# --- checks and verification ------------------------------------------------------------------

CONSTRAINTS = checks.constraint_checks()


def _check_sql(listed, tables: dict[str, str]) -> str:
    """Each check as its own count over the shop's tables."""
    parts = []
    for c in listed:
        t = tables[c.table]
        if c.kind == "not_null":
            failures = f"SELECT COUNT(*) FROM {t} WHERE {c.column} IS NULL"
        elif c.kind == "unique":
            failures = f"SELECT COUNT(*) FROM (SELECT {c.column} FROM {t} WHERE {c.column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"
        else:
            parent, column = c.parent
            failures = (
                f"SELECT COUNT(*) FROM {t} x WHERE x.{c.column} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {tables[parent]} y WHERE y.{column} = x.{c.column})"
            )
        parts.append(
            f"SELECT '{c.kind}' AS test, '{c.table}' AS table_name, '{c.column}' AS column_name, ({failures}) AS failures"
        )
    listed_sql = " UNION ALL ".join(parts)
    return f"""SELECT test, table_name, column_name, CAST(failures AS BIGINT) AS failures, 'warn' AS severity,
        CASE WHEN failures > 0 THEN 'warn' ELSE 'pass' END AS status FROM ({listed_sql})"""


def _of_kind(kind: str, listed=checks.STAGING_CHECKS):
    return tuple(c for c in listed if c.kind == kind)


for _name, _listed in {
    "check_unique": _of_kind("unique"),
    "check_not_null": _of_kind("not_null"),
    "check_relationships": _of_kind("relationships"),
    "check_report": checks.STAGING_CHECKS,
    "check_foreign_keys": _of_kind("relationships", CONSTRAINTS),
    "check_constraints": CONSTRAINTS,
}.items():
    query(_name, oracle.sql(_check_sql(_listed, ORACLE_TABLES), *ORACLE_TABLES.values()))(
        lambda shop, listed=_listed: checks.report(shop.tables, listed)
    )


def with_faults(shop: Shop) -> dict[str, DataFrame]:
    """The source tables with keys repeated, missing and leading nowhere."""
    t = shop.tables.as_dict()
    t["users"] = t["users"].withColumns(
        {"email": F.when(F.col("plan_type").isNotNull(), F.col("first_name")), "id": F.col("id") * 2}
    )
    t["orders"] = t["orders"].withColumns(
        {"id": F.floor(F.col("id") / 3) * 3, "user_id": F.when(F.col("country") != "usa", F.col("user_id"))}
    )
    return t


@query(
    "check_report_with_faults",
    oracle.sql(
        f"""SELECT * FROM (WITH u AS (SELECT id * 2 AS id, CASE WHEN plan_type IS NOT NULL THEN first_name END AS email
                FROM users),
            o AS (SELECT id // 3 * 3 AS id, CASE WHEN country <> 'usa' THEN user_id END AS user_id FROM shop_orders)
        {_check_sql(checks.STAGING_CHECKS, {**ORACLE_TABLES, "users": "u", "orders": "o"})})""",
        *ORACLE_TABLES.values(),
    ),
)
def check_report_with_faults(shop: Shop) -> DataFrame:
    return checks.report(with_faults(shop))


def _count_sql(views: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {v}" for n, v in views.items())


_STAGING_VIEWS = {f"stg_{n}": ORACLE_TABLES[n] for n in verify.STAGING_WITH_EVENTS}
_MODEL_VIEWS = {m.name: m.name for m in pipeline.MODELS if not m.view}
_STG_ORDERS = "(SELECT 1 FROM shop_orders WHERE total_amount > 0)"

query("row_counts", oracle.sql(_count_sql(_STAGING_VIEWS), *_STAGING_VIEWS.values()))(
    lambda shop: verify.staging_counts(shop.tables)
)

_OBSERVED = {
    n: {"stg_users": "users", "stg_orders": "shop_orders"}.get(n, n) for n in verify.MUST_NOT_BE_EMPTY
}


@query(
    "check_non_empty",
    oracle.sql(f"SELECT *, row_count = 0 AS is_empty FROM ({_count_sql(_OBSERVED)})", *_OBSERVED.values()),
)
def check_non_empty(shop: Shop) -> DataFrame:
    models = shop.models()
    staged = {"stg_users": shop.tables["users"], "stg_orders": shop.tables["orders"]}
    return verify.non_empty({n: staged[n] if n in staged else models[n] for n in verify.MUST_NOT_BE_EMPTY})


@query(
    "materialize_layer",
    oracle.sql(_count_sql({**_MODEL_VIEWS, "stg_orders": _STG_ORDERS}), "shop_orders", *_MODEL_VIEWS),
)
def materialize_layer(shop: Shop) -> DataFrame:
    """Rows of all models, read by name, after they were built twice into the same place."""
    root, views = shop.scratch.path("warehouse"), f"run_{uuid.uuid4().hex}_"
    for _ in range(2):
        shop.models(root, views)
    return verify.row_counts({m.name: shop.spark.table(f"{views}{m.layer}_{m.name}") for m in pipeline.MODELS})


_CORE_SUMMARY = """SELECT 'dim_customers' AS table_name, COUNT(*) AS total_rows,
        COUNT(DISTINCT customer_key) AS unique_customers, COUNT(DISTINCT country_code) AS countries,
        NULL::BIGINT AS unique_products, NULL::BIGINT AS categories, NULL::BIGINT AS unique_orders,
        NULL::DECIMAL(38,2) AS total_revenue FROM dim_customers
    UNION ALL SELECT 'dim_products', COUNT(*), NULL, NULL, COUNT(DISTINCT product_key),
        COUNT(DISTINCT product_category), NULL, NULL FROM dim_products
    UNION ALL SELECT 'fact_orders', COUNT(*), NULL, NULL, NULL, NULL, COUNT(DISTINCT order_key),
        CAST(SUM(line_revenue) AS DECIMAL(38,2)) FROM fact_orders"""
_MART_SUMMARY = """SELECT 'mart_sales_overview' AS table_name, COUNT(*) AS total_rows,
        CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS grand_total_revenue,
        CAST(SUM(total_orders) AS BIGINT) AS grand_total_orders, NULL::DOUBLE AS avg_ltv,
        NULL::BIGINT AS rfm_segments, NULL::DECIMAL(38,2) AS total_product_revenue, NULL::BIGINT AS abc_classes
        FROM mart_sales_overview
    UNION ALL SELECT 'mart_customer_ltv', COUNT(*), NULL, NULL,
        CAST(SUM(lifetime_value) AS DOUBLE) / COUNT(lifetime_value), COUNT(DISTINCT rfm_segment), NULL, NULL
        FROM mart_customer_ltv
    UNION ALL SELECT 'mart_product_performance', COUNT(*), NULL, NULL, NULL, NULL,
        CAST(SUM(total_revenue) AS DECIMAL(38,2)), COUNT(DISTINCT abc_class) FROM mart_product_performance"""
_CORE = ("dim_customers", "dim_products", "fact_orders")
_MARTS = ("mart_sales_overview", "mart_customer_ltv", "mart_product_performance")


def _long_sql(section: str, body: str, measures: list[str]) -> str:
    casts = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in measures)
    return f"""SELECT '{section}' AS section, table_name, metric, value FROM (
        UNPIVOT (SELECT table_name, {casts} FROM ({body})) ON {", ".join(measures)} INTO NAME metric VALUE value)"""


_VERIFY_SQL = " UNION ALL ".join(
    [
        _long_sql(
            "STAGING TABLES",
            _count_sql({n: v for n, v in _STAGING_VIEWS.items() if n != "stg_events"}),
            ["row_count"],
        ),
        _long_sql(
            "CORE TABLES",
            _CORE_SUMMARY,
            "total_rows unique_customers countries unique_products categories unique_orders total_revenue".split(),
        ),
        _long_sql(
            "DATA MARTS",
            _MART_SUMMARY,
            "total_rows grand_total_revenue grand_total_orders avg_ltv rfm_segments total_product_revenue "
            "abc_classes".split(),
        ),
    ]
)


@query("verify_core", oracle.sql(_CORE_SUMMARY, *_CORE))
def verify_core(shop: Shop) -> DataFrame:
    return verify.core_summary(shop.dim_customers(), shop.dim_products(), shop.sales())


@query("verify_marts", oracle.sql(_MART_SUMMARY, *_MARTS))
def verify_marts(shop: Shop) -> DataFrame:
    m = shop.models()
    return verify.mart_summary(*[m[n] for n in _MARTS])


@query("verify_report", oracle.sql(_VERIFY_SQL, *_STAGING_VIEWS.values(), *_CORE, *_MARTS))
def verify_report(shop: Shop) -> DataFrame:
    return verify.verify_report(shop.tables, shop.models())


@query(
    "sales_by_country",
    oracle.sql(
        """SELECT country_code, CAST(SUM(total_orders) AS BIGINT) AS orders,
            CAST(SUM(total_revenue) AS DECIMAL(32,2)) AS revenue FROM mart_sales_overview GROUP BY country_code""",
        "mart_sales_overview",
    ),
)
def sales_by_country(shop: Shop) -> DataFrame:
    return verify.sales_by_country(shop.mart_sales_overview())


@query(
    "top_customers",
    oracle.sql(
        """SELECT full_name, email, lifetime_value, rfm_segment, churn_risk FROM mart_customer_ltv
        ORDER BY lifetime_value DESC NULLS FIRST, customer_key LIMIT 5""",
        "mart_customer_ltv",
    ),
)
def top_customers(shop: Shop) -> DataFrame:
    return verify.top_customers(shop.mart_customer_ltv())


@query(
    "top_products",
    oracle.sql(
        """SELECT product_name, product_category, total_revenue, abc_class, revenue_rank
        FROM mart_product_performance WHERE revenue_rank <= 5""",
        "mart_product_performance",
    ),
)
def top_products(shop: Shop) -> DataFrame:
    return verify.top_products(shop.mart_product_performance())


_RUN_SQL = f"""{_VERIFY_SQL}
    UNION ALL SELECT 'REJECTS', t, 'rejected_rows', 0.0::DOUBLE
        FROM (SELECT unnest({list(ORACLE_TABLES)}) AS t)
    UNION ALL SELECT 'CHECKS', table_name, test || ' ' || column_name, CAST(failures AS DOUBLE)
        FROM ({_check_sql(checks.STAGING_CHECKS, ORACLE_TABLES)})
    UNION ALL SELECT 'EMPTY TABLES', table_name, 'is_empty', CAST(row_count = 0 AS DOUBLE)
        FROM ({_count_sql(_OBSERVED)})"""


@query("pipeline_end_to_end", oracle.sql(_RUN_SQL, *_STAGING_VIEWS.values(), *_CORE, *_MARTS))
def pipeline_end_to_end(shop: Shop) -> DataFrame:
    """The report of a day's run from source tables through files and staging to marts."""
    with shuffles_removed(shop.spark):
        return pipeline.run_pipeline(
            shop.spark, shop.tables.as_dict(), shop.scratch.path("run"), DAY_2, shop.params
        )


# --- stored by month, and from day to day -----------------------------------------------------

_FACT = """order_key, customer_key, product_key, date_key, order_status, country_code, payment_method, order_timestamp,
    quantity_sold, unit_price, line_revenue, order_total, estimated_margin, is_completed, is_cancelled"""


def fact_columns(fact: DataFrame) -> DataFrame:
    return fact.select(*[c.strip() for c in _FACT.split(",")])


@query(
    "fact_orders_month",
    oracle.sql(f"SELECT {_FACT} FROM fact_orders WHERE date_key BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'", "fact_orders"),
)
def fact_orders_month(shop: Shop) -> DataFrame:
    """Lines of one month of the stored fact; other months' folders are not read."""
    fact = shop.stored().read("fact_orders")
    return fact_columns(core.in_period(fact, date(1998, 3, 1), date(1998, 3, 31)))


@query("fact_orders_incremental", oracle.sql(f"SELECT {_FACT} FROM fact_orders", "fact_orders"))
def fact_orders_incremental(shop: Shop) -> DataFrame:
    """The fact of the day before, with only the months built again in which something has changed."""
    return fact_columns(shop.refreshed()[0].read("fact_orders"))


@query("sales_overview_from_days", oracle.view("mart_sales_overview"))
def sales_overview_from_days(shop: Shop) -> DataFrame:
    """The mart from daily states, of which only changed months were built again."""
    return daily.overview(shop.refreshed()[0].read("overview_days"))


@query("customer_metrics_from_days", oracle.view("customer_metrics"))
def customer_metrics_from_days(shop: Shop) -> DataFrame:
    return daily.customer_metrics(shop.refreshed()[0].read("customer_days"), shop.params)


@query("product_metrics_from_days", oracle.view("product_metrics"))
def product_metrics_from_days(shop: Shop) -> DataFrame:
    return marts.named_products(daily.product_sales(shop.stored().read("product_days")), shop.dim_products())


@query(
    "sales_by_month_and_country",
    oracle.sql(
        """SELECT date_trunc('month', date_key)::DATE AS sale_month, l.country_code,
            CAST(COUNT(DISTINCT order_key) AS BIGINT) AS total_orders,
            CAST(COUNT(DISTINCT l.customer_key) AS BIGINT) AS unique_customers,
            CAST(SUM(quantity_sold) AS BIGINT) AS total_quantity, CAST(SUM(line_revenue) AS DECIMAL(22,2)) AS total_revenue,
            CAST(SUM(estimated_margin) AS DECIMAL(24,3)) AS total_margin,
            CAST(SUM(order_total) AS DOUBLE) / COUNT(order_total) AS avg_order_value,
            CAST(SUM(line_revenue) AS DOUBLE) / COUNT(DISTINCT order_key) AS revenue_per_order,
            CAST(SUM(estimated_margin) AS DOUBLE) / nullif(CAST(SUM(line_revenue) AS DOUBLE), 0) AS margin_rate
        FROM done_lines l JOIN dim_products p ON p.product_key = l.product_key
            JOIN dim_customers c ON c.customer_key = l.customer_key
        GROUP BY ALL""",
        "done_lines",
        "dim_products",
        "dim_customers",
    ),
)
def sales_by_month_and_country(shop: Shop) -> DataFrame:
    """Months and countries united from the days' states: orders and customers of several days count once."""
    days = shop.stored().read("overview_days").withColumn("sale_month", F.trunc("sale_date", "month"))
    return daily.overview(days, ("sale_month", "country_code"))


# --- generated tables -------------------------------------------------------------------------
# Their ids come from the given tables, so their size follows them.


@query("gen_users", oracle.view("gen_users"))
def gen_users(shop: Shop) -> DataFrame:
    return generate.generate_users(shop.ids("customer", "c_custkey"), shop.params.run_ts)


@query("gen_products", oracle.view("gen_products"))
def gen_products(shop: Shop) -> DataFrame:
    return generate.generate_products(shop.ids("part", "p_partkey"), shop.params.run_ts)


@query("gen_order_items", oracle.view("gen_order_items"))
def gen_order_items(shop: Shop) -> DataFrame:
    return generate.generate_order_items(shop.ids("orders", "o_orderkey"), gen_products(shop), shop.scratch)


@query("gen_orders", oracle.view("gen_orders"))
def gen_orders(shop: Shop) -> DataFrame:
    ids = shop.ids("orders", "o_orderkey")
    return generate.generate_orders(ids, gen_users(shop), gen_order_items(shop), shop.params.run_ts, shop.scratch)


@query("gen_events", oracle.view("gen_events"))
def gen_events(shop: Shop) -> DataFrame:
    return generate.generate_events(
        shop.ids("events", "event_id"), gen_users(shop), gen_products(shop), shop.params.run_ts, shop.scratch
    )


@query("gen_crm_contacts", oracle.view("gen_crm_contacts"))
def gen_crm_contacts(shop: Shop) -> DataFrame:
    return generate.generate_crm_contacts(shop.ids("supplier", "s_suppkey"), shop.params.run_ts)
