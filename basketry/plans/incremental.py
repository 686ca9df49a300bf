"""From one day's staged tables to the next: which months of the fact have changed, and these alone built again."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.params import Params
from basketry.plans import core, daily
from basketry.sources.staging import content_hash
from basketry.warehouse import Change

Tables = Mapping[str, DataFrame]
# What the fact is made of.
READS = ("orders", "order_items")
# Columns that say when a row was loaded, not what it says.
STAMPS = ("_loaded_at",)


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys (column ``key``) whose rows are not the same in both snapshots. Only keys and hashes are shuffled."""

    def tally(df: DataFrame, sign: int) -> DataFrame:
        plain = df.drop(*STAMPS)
        return plain.select(F.col(key).alias("key"), content_hash(plain).alias("hash"), F.lit(sign).alias("sign"))

    both = tally(before, -1).unionByName(tally(after, 1))
    moved = both.groupBy("key", "hash").agg(F.sum("sign").alias("more")).where("more <> 0")
    return moved.select(F.col("key").alias(key)).distinct()


def changed_months(before: Tables, after: Tables, params: Params) -> list[str]:
    """First days, as text, of the months with an order that is new, gone or changed, itself or in its lines."""
    orders = changed_keys(before["orders"], after["orders"], "id")
    lines = changed_keys(before["order_items"], after["order_items"], "order_id")
    touched = orders.unionByName(lines.select(F.col("order_id").alias("id"))).distinct()
    dated = [t["orders"].select("id", F.trunc("created_at", "month").alias("month")) for t in (before, after)]
    months = dated[0].unionByName(dated[1]).distinct().join(touched, "id", "left_semi").select("month").distinct()
    first = params.start_date.replace(day=1)
    return sorted(r.month.isoformat() for r in months.where(F.col("month") >= F.lit(first)).collect())


def refresh_fact(change: Change, before: Tables, after: Tables, params: Params) -> list[str]:
    """Bring the stored fact from one day's tables to the next one's; returns the months that were built again.

    Orders of other months are not read: the months reach the scan as a range of their times.
    """
    months = changed_months(before, after, params)
    if not months:
        return []
    moment = F.col("created_at")
    month = F.trunc(moment, "month")
    end = F.add_months(F.lit(months[-1]).cast("date"), 1).cast("timestamp_ntz")
    span = (moment >= F.lit(months[0]).cast("timestamp_ntz")) & (moment < end)
    orders = after["orders"].where(span & month.isin([F.lit(m).cast("date") for m in months]))
    fact = core.fact_by_month(after["order_items"], orders, params)
    change.write("fact_orders", fact, "core", by=core.ORDER_MONTH, gather=False, only=months)
    return months


def refresh_sales(
    change: Change, before: Tables, after: Tables, dim_products: DataFrame, dim_customers: DataFrame, params: Params
) -> list[str]:
    """The fact and the marts' daily states, each rebuilt in the changed months only."""
    months = refresh_fact(change, before, after, params)
    if months:
        daily.refresh(change, change.warehouse.open(change.tables["fact_orders"]), dim_products, dim_customers, months)
    return months


def built_from(params: Params, day: str, digests: Mapping[str, str]) -> str:
    """What decides about a stored fact: the rules it was built by, the day, and the staged files of that day."""
    rules = (params.start_date, params.completed_statuses, params.margin_rate, params.use_clean_orders)
    return json.dumps({"rules": str(rules), "day": day, "staged": {n: digests[n] for n in READS}})
