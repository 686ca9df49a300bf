"""The shop's tables, mapped from the star-schema test tables (customer, part, orders, lineitem ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import MONEY, first_match
from basketry.operators.windows import asc, global_window
from basketry.scratch import Scratch
from basketry.sources.snapshot import read_parquet

# The mapping that FIXTURES.md lays down.
NATION_COUNTRIES = ("FRA", "usa", "DEU", "esp", "GBR", "ita", "CAN", "aus")
SEGMENT_PLANS = {"AUTOMOBILE": "premium", "MACHINERY": "enterprise"}
CONTACT_SOURCES = ("organic", "paid_ads", "referral", "email_campaign")
EVENT_NAMES = {"view": "page_view", "click": "add_to_cart", "signup": "checkout_start"}


def _pick(values, index):
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _span(df: DataFrame, key: str, moment: str) -> DataFrame:
    """First and last moment per key."""
    return df.groupBy(key).agg(F.min(moment).alias("first_seen"), F.max(moment).alias("last_seen"))


def _mail(name: str):
    return F.concat(F.lower(F.replace(F.col(name), F.lit("#"), F.lit("_"))), F.lit("@example.com"))


def _name_part(name: str, part: int):
    return F.split_part(F.col(name), F.lit("#"), F.lit(part))


def _country(nation: str):
    return _pick(NATION_COUNTRIES, F.col(nation) % len(NATION_COUNTRIES))


class SalesTables:
    """Access by table name; nothing is read before a query asks for it."""

    names = ("users", "products", "orders", "order_items", "crm_contacts", "events")

    def __init__(self, spark: SparkSession, folder: str, scratch: Scratch):
        self.spark, self.folder, self.scratch = spark, folder, scratch
        self._made: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        return read_parquet(self.spark, self.folder, name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = getattr(self, f"_{name}")()
        return self._made[name]

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in self.names}

    def _users(self) -> DataFrame:
        spans = _span(self.read("orders"), "o_custkey", "o_orderdate")
        key = F.col("c_custkey")
        plan = first_match(
            [(F.col("c_mktsegment") == s, p) for s, p in SEGMENT_PLANS.items()], "freemium"
        )
        return (
            self.read("customer")
            .join(spans, key == F.col("o_custkey"), "left")
            .select(
                key.alias("id"),
                _mail("c_name").alias("email"),
                _name_part("c_name", 1).alias("first_name"),
                _name_part("c_name", 2).alias("last_name"),
                _country("c_nationkey").alias("country"),
                F.when(key % 50 != 7, plan).alias("plan_type"),
                F.col("first_seen").alias("created_at"),
                F.when(key % 10 >= 3, F.col("last_seen")).alias("last_login"),
                (F.col("c_acctbal") >= 0).alias("is_active"),
            )
        )

    def _products(self) -> DataFrame:
        spans = _span(self.read("lineitem"), "l_partkey", "l_shipdate")
        key = F.col("p_partkey")
        return (
            self.read("part")
            .join(spans, key == F.col("l_partkey"), "left")
            .select(
                key.alias("id"),
                (key % 100 + 1).cast("int").alias("merchant_id"),
                F.col("p_name").alias("name"),
                F.concat("p_brand", F.lit(" "), "p_type").alias("description"),
                F.col("p_type").alias("category"),
                F.col("p_retailprice").cast(MONEY).alias("price"),
                F.col("p_size").alias("stock_quantity"),
                F.col("first_seen").alias("created_at"),
                F.col("last_seen").alias("updated_at"),
            )
        )

    def _orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        status = first_match(
            [
                (key % 20 == 0, "cancelled"),
                (F.col("o_orderstatus") == "F", "delivered"),
                (F.col("o_orderstatus") == "P", "pending"),
                (key % 2 == 0, "shipped"),
            ],
            "paid",
        )
        priority = F.substring("o_orderpriority", 1, 1)
        homes = self.read("customer").select("c_custkey", _country("c_nationkey").alias("country"))
        return (
            self.read("orders")
            .join(homes, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(
                key.alias("id"),
                F.col("o_custkey").alias("user_id"),
                F.col("o_orderdate").alias("created_at"),
                F.when(key % 97 == 0, F.lit(0)).otherwise(F.col("o_totalprice")).cast(MONEY).alias("total_amount"),
                status.alias("status"),
                "country",
                first_match([(priority == "1", "Stripe"), (priority == "2", "PayPal")], "credit_card").alias(
                    "payment_method"
                ),
            )
        )

    def _order_lines(self) -> DataFrame:
        """Order items for models that do not read the line key, which is null here."""
        return self._lines(self.read("lineitem").withColumn("line_key", F.lit(None)))

    def _order_items(self) -> DataFrame:
        """The test lines have no key: all lines are numbered in the order of their orders.

        The order of the columns below is total but for equal rows, which may swap their numbers.
        """
        names = ("orderkey", "linenumber", "partkey", "suppkey", "extendedprice", "shipdate", "quantity")
        order = [asc(f"l_{n}") for n in names]
        lines = self.read("lineitem").select(*[b.column for b in order])
        kept = ("l_orderkey", "l_partkey", "l_quantity")
        return self._lines(global_window(lines, order, self.scratch, rank="line_key", columns=kept))

    def _lines(self, lineitem: DataFrame) -> DataFrame:
        quantity, price = F.col("l_quantity").cast("int"), F.col("price")
        prices = self.read("part").select("p_partkey", F.col("p_retailprice").cast(MONEY).alias("price"))
        return lineitem.join(prices, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("line_key").cast("long").alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            price.alias("unit_price"),
            (price * quantity).cast(MONEY).alias("line_total"),
        )

    def _events(self) -> DataFrame:
        kind = F.col("event_type")
        return self.read("events").select(
            F.col("event_id").alias("id"),
            F.when(F.col("event_id") % 10 != 0, F.col("user_id")).alias("user_id"),
            F.coalesce(
                *[F.when(kind == old, new) for old, new in EVENT_NAMES.items()], kind
            ).alias("event_type"),
            F.col("ts").alias("event_ts"),
            F.col("props").alias("metadata"),
        )

    def _crm_contacts(self) -> DataFrame:
        spans = _span(self.read("lineitem"), "l_suppkey", "l_shipdate")
        key = F.col("s_suppkey")
        converted = key % 5 < 2
        return (
            self.read("supplier")
            .join(spans, key == F.col("l_suppkey"), "left")
            .select(
                key.alias("id"),
                _mail("s_name").alias("email"),
                _name_part("s_name", 1).alias("first_name"),
                _name_part("s_name", 2).alias("last_name"),
                _pick(CONTACT_SOURCES, key % 4).alias("source"),
                F.concat(F.lit("CAMP_"), (1000 + key % 9000).cast("string")).alias("campaign_id"),
                F.col("first_seen").alias("created_at"),
                converted.alias("converted"),
                F.when(converted, F.col("last_seen")).alias("converted_at"),
            )
        )
