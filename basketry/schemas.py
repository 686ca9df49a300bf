"""Tables of the shop: columns, keys, references, defaults and value domains."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "text": T.StringType(),
    "money": T.DecimalType(12, 2),
    "flag": T.BooleanType(),
    "time": T.TimestampNTZType(),
    "variant": T.VariantType(),
}


@dataclass(frozen=True)
class Table:
    """One operational table.

    ``required`` holds the columns that must not be null, ``lengths`` how long a text may be.
    """

    name: str
    columns: dict[str, str]
    unique: tuple[str, ...]
    required: tuple[str, ...]
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    raw_format: str = "csv"
    lengths: dict[str, int] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, _TYPES[t]) for c, t in self.columns.items()])

    @property
    def text_schema(self) -> T.StructType:
        """The same columns as raw text; a semi-structured column keeps its shape."""
        keep = T.VariantType()
        return T.StructType(
            [T.StructField(c, keep if t == "variant" else T.StringType()) for c, t in self.columns.items()]
        )


# Stands for the load time in a default.
NOW = object()

# Column names, keys, references, defaults and text lengths of the source tables.
USERS = Table(
    "users",
    {
        "id": "long", "email": "text", "first_name": "text", "last_name": "text", "country": "text",
        "plan_type": "text", "created_at": "time", "last_login": "time", "is_active": "flag",
    },
    unique=("id", "email"),
    required=("id", "email"),
    defaults={"plan_type": "freemium", "created_at": NOW, "is_active": True},
    lengths={"email": 255, "first_name": 100, "last_name": 100, "country": 3, "plan_type": 20},
)
PRODUCTS = Table(
    "products",
    {
        "id": "long", "merchant_id": "int", "name": "text", "description": "text", "category": "text",
        "price": "money", "stock_quantity": "int", "created_at": "time", "updated_at": "time",
    },
    unique=("id",),
    required=("id", "merchant_id", "name", "price"),
    defaults={"stock_quantity": 0, "created_at": NOW, "updated_at": NOW},
    lengths={"name": 255, "category": 100},
)
ORDERS = Table(
    "orders",
    {
        "id": "long", "user_id": "long", "created_at": "time", "total_amount": "money",
        "status": "text", "country": "text", "payment_method": "text",
    },
    unique=("id",),
    required=("id", "user_id", "total_amount"),
    references={"user_id": ("users", "id")},
    defaults={"created_at": NOW, "status": "pending"},
    lengths={"status": 20, "country": 3, "payment_method": 50},
)
ORDER_ITEMS = Table(
    "order_items",
    {
        "id": "long", "order_id": "long", "product_id": "long", "quantity": "int",
        "unit_price": "money", "line_total": "money",
    },
    unique=("id",),
    required=("id", "order_id", "product_id", "quantity", "unit_price", "line_total"),
    references={"order_id": ("orders", "id"), "product_id": ("products", "id")},
)
EVENTS = Table(
    "events",
    {"id": "long", "user_id": "long", "event_type": "text", "event_ts": "time", "metadata": "variant"},
    unique=("id",),
    required=("id", "event_type"),
    references={"user_id": ("users", "id")},
    defaults={"event_ts": NOW},
    raw_format="json",
    lengths={"event_type": 50},
)
CRM_CONTACTS = Table(
    "crm_contacts",
    {
        "id": "long", "email": "text", "first_name": "text", "last_name": "text", "source": "text",
        "campaign_id": "text", "created_at": "time", "converted": "flag", "converted_at": "time",
    },
    unique=("id", "email"),
    required=("id", "email"),
    defaults={"created_at": NOW, "converted": False},
    lengths={"email": 255, "first_name": 100, "last_name": 100, "source": 100, "campaign_id": 100},
)

TABLES = {t.name: t for t in (USERS, PRODUCTS, ORDERS, ORDER_ITEMS, CRM_CONTACTS, EVENTS)}

# Domains the generated tables draw from.
COUNTRIES = ("FRA", "USA", "DEU", "ESP", "GBR", "ITA", "CAN", "AUS")
PLAN_TYPES = ("freemium", "premium", "enterprise")
CATEGORIES = ("Electronics", "Fashion", "Home", "Books", "Sports", "Beauty", "Toys")
ORDER_STATUSES = ("pending", "paid", "shipped", "delivered", "cancelled")
ORDER_STATUS_WEIGHTS = (5, 40, 25, 25, 5)
EVENT_TYPES = ("page_view", "add_to_cart", "checkout_start", "purchase", "error")
PAYMENT_METHODS = ("stripe", "paypal", "credit_card")
CONTACT_SOURCES = ("organic", "paid_ads", "referral", "email_campaign")
DEVICES = ("mobile", "desktop", "tablet")
