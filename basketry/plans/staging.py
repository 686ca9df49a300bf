"""The cleaned view of staged orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_orders(orders: DataFrame) -> DataFrame:
    """Orders worth something, renamed, with case folded. Null amounts go too."""
    return orders.where(F.col("total_amount") > 0).select(
        F.col("id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("created_at").alias("order_date"),
        F.col("total_amount").alias("order_amount"),
        F.upper("status").alias("order_status"),
        F.upper("country").alias("country_code"),
        F.lower("payment_method").alias("payment_method"),
        "_loaded_at",
    )


def clean_orders(orders: DataFrame) -> DataFrame:
    """Source-shaped orders after the same filter, for facts built from clean orders only."""
    return orders.where(F.col("total_amount") > 0)


# Metadata fields of the event types, with their types.
EVENT_FIELDS = {"page_url": "string", "device": "string", "product_id": "bigint", "quantity": "int"}


def event_metadata(events: DataFrame, fields: dict[str, str] = EVENT_FIELDS) -> DataFrame:
    """Events with metadata fields as columns; null where an event lacks a field, its type differs, or
    the text is no JSON."""
    value = F.try_parse_json("metadata") if dict(events.dtypes)["metadata"] == "string" else F.col("metadata")
    return events.withColumn("_value", value).select(
        "id",
        "user_id",
        "event_type",
        "event_ts",
        *[F.try_variant_get("_value", f"$.{name}", kind).alias(name) for name, kind in fields.items()],
    )
