"""Small hand-made tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from basketry import schemas
from basketry.params import Params

AS_OF = date(2024, 6, 30)
RUN_TS = datetime(2024, 6, 30, 2, 0)
PARAMS = Params(as_of=AS_OF, run_ts=RUN_TS)
EARLY = datetime(2023, 1, 1)


def money(v):
    return None if v is None else Decimal(str(v))


def days_ago(n, hour=12):
    return datetime(AS_OF.year, AS_OF.month, AS_OF.day, hour) - timedelta(days=n)


def users(spark, *rows):
    """(id, country, plan) or (id, country, plan, first name)."""
    full = [
        (r[0], f"u{r[0]}@x", r[3] if len(r) > 3 else "Ann", f"L{r[0]}", r[1], r[2], EARLY, None, True) for r in rows
    ]
    return spark.createDataFrame(full, schemas.USERS.schema)


def products(spark, *rows):
    """(id, name, category)."""
    full = [(r[0], 1, r[1], None, r[2], money(1), 5, EARLY, EARLY) for r in rows]
    return spark.createDataFrame(full, schemas.PRODUCTS.schema)


def orders(spark, *rows):
    """(id, user, time, amount, status)."""
    full = [(r[0], r[1], r[2], money(r[3]), r[4], "fra", "PayPal") for r in rows]
    return spark.createDataFrame(full, schemas.ORDERS.schema)


def items(spark, *rows):
    """(id, order, product, quantity, price)."""
    full = [(*r[:4], money(r[4]), money(r[4]) * r[3]) for r in rows]
    return spark.createDataFrame(full, schemas.ORDER_ITEMS.schema)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, user_id long, event_type string, event_ts timestamp_ntz, metadata string")


def contacts(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.CRM_CONTACTS.schema)
