"""Synthetic shop tables of any size.

Every value comes from a hash of the row's id: a table can be made in parallel, made again with the
same content, and written down in any SQL dialect. A generator takes the ids to fill, from
``id_range`` or from a table.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions.columns import first_match, ntz
from basketry.operators.windows import asc, global_window
from basketry.scratch import Scratch

# Sizes of the default tables.
DEFAULT_ROWS = {"users": 1000, "products": 200, "orders": 5000, "events": 10000, "crm_contacts": 500}

# Shares and ranges of the drawn columns.
FORCED_FREEMIUM_PERCENT = 70
NO_LOGIN_PERCENT = 30
ACTIVE_PERCENT = 95
MERCHANTS = 100
PRICE_CENTS = (500, 50000)
STOCK_MAX = 1000
ITEMS_MAX = 5
QUANTITY_MAX = 3
ANONYMOUS_PERCENT = 10
CAMPAIGNS = (1000, 9999)
CONVERTED_PERCENT = 40

DAY = 86400
TWO_YEARS, YEAR, HALF_YEAR, QUARTER, MONTH = 730 * DAY, 365 * DAY, 180 * DAY, 90 * DAY, 30 * DAY

# Hex digits of the hash that a drawn number is taken from: 60 bits.
HASH_DIGITS = 15


def id_range(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n)


def draw(n: Column | int, key: Column, stream: int) -> Column:
    """A number in [0, n) that depends on the key; streams of one key are independent, and so are keys."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{stream}")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long") % n


def choice(values, key: Column, stream: int) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), draw(len(values), key, stream).cast("int"))


def before(run_ts: datetime, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", (-seconds).cast("int"), ntz(run_ts))


def percent(limit: int, key: Column, stream: int) -> Column:
    return draw(100, key, stream) < limit


def _mail(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"), F.lit("@example.com"))


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def generate_users(ids: DataFrame, run_ts: datetime) -> DataFrame:
    k = F.col("id")
    return ids.select(
        k,
        _mail("user_", k).alias("email"),
        _text("first_", k % 1000).alias("first_name"),
        _text("last_", k).alias("last_name"),
        choice(schemas.COUNTRIES, k, 0).alias("country"),
        F.when(percent(FORCED_FREEMIUM_PERCENT, k, 1), schemas.PLAN_TYPES[0])
        .otherwise(choice(schemas.PLAN_TYPES, k, 2))
        .alias("plan_type"),
        before(run_ts, draw(TWO_YEARS, k, 3)).alias("created_at"),
        F.when(~percent(NO_LOGIN_PERCENT, k, 4), before(run_ts, draw(MONTH, k, 5))).alias("last_login"),
        percent(ACTIVE_PERCENT, k, 6).alias("is_active"),
    )


def generate_products(ids: DataFrame, run_ts: datetime) -> DataFrame:
    k = F.col("id")
    low, high = PRICE_CENTS
    cents = draw(high - low + 1, k, 2) + low
    return ids.select(
        k,
        (draw(MERCHANTS, k, 0) + 1).cast("int").alias("merchant_id"),
        _text("product_", k).alias("name"),
        _text("description of product ", k).alias("description"),
        choice(schemas.CATEGORIES, k, 1).alias("category"),
        (cents.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast("decimal(12,2)").alias("price"),
        draw(STOCK_MAX + 1, k, 3).cast("int").alias("stock_quantity"),
        before(run_ts, draw(YEAR, k, 4)).alias("created_at"),
        ntz(run_ts).alias("updated_at"),
    )


def numbered(df: DataFrame, key: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """Rows with a dense ``position`` from 0 in key order, so that any number below the count picks one."""
    kept = scratch.keep(df, "numbered")
    positions = global_window(kept, [asc(key)], scratch, rank="position")
    return positions.withColumn("position", F.col("position") - 1), kept.count()


def generate_order_items(ids: DataFrame, products: DataFrame, scratch: Scratch) -> DataFrame:
    """1 to 5 lines per order, each of another product.

    An order's products are its first pick and equal steps from there. The step is short enough for
    the walk not to come round, so the products differ.
    """
    goods, n = numbered(products.select("id", "price"), "id", scratch)
    if n == 0:
        return _no_lines(ids)
    k, line = F.col("order_id"), F.col("line")
    lines = F.least(draw(ITEMS_MAX, k, 0) + 1, F.lit(n))
    step = draw(max(1, (n - 1) // ITEMS_MAX), k, 2) + 1
    item = k * ITEMS_MAX + line
    walked = (
        ids.select(F.col("id").alias("order_id"))
        .withColumn("line", F.explode(F.sequence(F.lit(0), (lines - 1).cast("int"))))
        .select("order_id", "line", ((draw(n, k, 1) + line * step) % n).alias("position"))
    )
    quantity = (draw(QUANTITY_MAX, item, 3) + 1).cast("int")
    priced = goods.select("position", F.col("id").alias("product_id"), F.col("price").alias("unit_price"))
    return walked.join(priced, "position").select(
        (item + 1).alias("id"),
        "order_id",
        "product_id",
        quantity.alias("quantity"),
        "unit_price",
        (F.col("unit_price") * quantity).cast("decimal(12,2)").alias("line_total"),
    )


def _no_lines(ids: DataFrame) -> DataFrame:
    """No products, no lines."""
    return ids.sparkSession.createDataFrame([], schemas.ORDER_ITEMS.schema)


def generate_orders(
    ids: DataFrame, users: DataFrame, order_items: DataFrame, run_ts: datetime, scratch: Scratch
) -> DataFrame:
    """Orders of active users; the amount is the sum of the order's lines.

    Orders without lines, which only a shop without products has, do not arise.
    """
    active, n = numbered(users.where("is_active").select("id", "country"), "id", scratch)
    buyers = active.select("position", F.col("id").alias("user_id"), "country")
    k = F.col("id")
    bounds, total = [], 0
    for status, weight in zip(schemas.ORDER_STATUSES, schemas.ORDER_STATUS_WEIGHTS):
        total += weight
        bounds.append((draw(100, k, 5) < total, status))
    amounts = order_items.groupBy(F.col("order_id").alias("id")).agg(
        F.sum("line_total").cast("decimal(12,2)").alias("total_amount")
    )
    return (
        ids.withColumn("position", draw(max(n, 1), k, 4))
        .join(buyers, "position")
        .join(amounts, "id")
        .select(
            "id",
            "user_id",
            before(run_ts, draw(HALF_YEAR, k, 3)).alias("created_at"),
            "total_amount",
            first_match(bounds, schemas.ORDER_STATUSES[-1]).alias("status"),
            "country",
            choice(schemas.PAYMENT_METHODS, k, 6).alias("payment_method"),
        )
    )


def _first(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.orderBy("id").limit(limit)


def generate_events(
    ids: DataFrame,
    users: DataFrame,
    products: DataFrame,
    run_ts: datetime,
    scratch: Scratch,
    first_users: int | None = None,
    first_products: int | None = None,
) -> DataFrame:
    """Events of the users, some anonymous; the metadata's shape depends on the type.

    Users and the products in carts are drawn from all of their tables, or from the first ones by id
    if ``first_users`` or ``first_products`` says how many. Without products a cart names none.
    """
    visitors, n = numbered(_first(users.select("id"), first_users), "id", scratch)
    goods, m = numbered(_first(products.select("id"), first_products), "id", scratch)
    k, kind = F.col("id"), F.col("event_type")
    page = F.struct(
        _text("/page/", draw(1000, k, 3)).alias("page_url"), choice(schemas.DEVICES, k, 4).alias("device")
    )
    cart = F.struct(F.col("product_id"), (draw(QUANTITY_MAX, k, 6) + 1).alias("quantity"))
    picks = visitors.select("position", F.col("id").alias("user_id"))
    carts = goods.select(F.col("position").alias("cart_position"), F.col("id").alias("product_id"))
    anonymous = percent(ANONYMOUS_PERCENT, k, 0)
    drawn = (
        ids.withColumn("position", F.when(~anonymous, draw(max(n, 1), k, 1)))
        .withColumn("event_type", choice(schemas.EVENT_TYPES, k, 2))
        .withColumn("cart_position", F.when(kind == "add_to_cart", draw(max(m, 1), k, 5)))
    )
    return _picked(_picked(drawn, picks, "position"), carts, "cart_position").select(
        "id",
        "user_id",
        "event_type",
        before(run_ts, draw(QUARTER, k, 7)).alias("event_ts"),
        F.when(kind == "page_view", F.to_json(page))
        .when(kind == "add_to_cart", F.to_json(cart))
        .otherwise("{}")
        .alias("metadata"),
    )


def _picked(df: DataFrame, choices: DataFrame, position: str) -> DataFrame:
    """Rows with what stands at their position. Most have none: these take no part in the join, where all of them would
    meet in one task."""
    given = F.col(position).isNotNull()
    return df.where(given).join(choices, position, "left").unionByName(df.where(~given), allowMissingColumns=True)


def generate_crm_contacts(ids: DataFrame, run_ts: datetime) -> DataFrame:
    """Campaign contacts; a conversion lies between creation and the run."""
    k = F.col("id")
    low, high = CAMPAIGNS
    age = draw(YEAR, k, 2)
    converted = percent(CONVERTED_PERCENT, k, 3)
    return ids.select(
        k,
        _mail("contact_", k).alias("email"),
        _text("first_", k % 1000).alias("first_name"),
        _text("last_", k).alias("last_name"),
        choice(schemas.CONTACT_SOURCES, k, 0).alias("source"),
        _text("CAMP_", draw(high - low + 1, k, 1) + low).alias("campaign_id"),
        before(run_ts, age).alias("created_at"),
        converted.alias("converted"),
        F.when(converted, before(run_ts, draw(age + 1, k, 4))).alias("converted_at"),
    )
