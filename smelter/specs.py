"""Table contracts, declared once.

A spec carries the typed source columns; the all-string change schema, the
CDC deduplication key, the quality checks and the CSV loader all derive from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: dict[str, str]
    keys: tuple[str, ...] = ()
    # child column -> (parent table, parent column)
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    # quoted CSV fields of this table may hold line breaks
    multiline_text: bool = False

    @property
    def source_schema(self) -> T.StructType:
        """Typed schema of the relational source."""
        ddl = ", ".join(f"{name} {dtype}" for name, dtype in self.columns.items())
        return T.StructType.fromDDL(ddl)

    @property
    def change_schema(self) -> T.StructType:
        """Row images in a change message: every column arrives as text."""
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns])


_MONEY = "decimal(10,2)"
_COORDINATE = "decimal(9,6)"

CUSTOMERS = TableSpec(
    "customers",
    {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "string",
        "customer_city": "string",
        "customer_state": "string",
    },
    keys=("customer_id",),
)

SELLERS = TableSpec(
    "sellers",
    {
        "seller_id": "string",
        "seller_zip_code_prefix": "string",
        "seller_city": "string",
        "seller_state": "string",
    },
    keys=("seller_id",),
)

PRODUCTS = TableSpec(
    "products",
    {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_length": "int",
        "product_description_length": "int",
        "product_photos_qty": "int",
        "product_weight_g": "int",
        "product_length_cm": "int",
        "product_height_cm": "int",
        "product_width_cm": "int",
    },
    keys=("product_id",),
)

CATEGORY_TRANSLATION = TableSpec(
    "category_translation",
    {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
    keys=("product_category_name",),
)

ORDERS = TableSpec(
    "orders",
    {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    keys=("order_id",),
    foreign_keys={"customer_id": ("customers", "customer_id")},
)

ORDER_ITEMS = TableSpec(
    "order_items",
    {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": _MONEY,
        "freight_value": _MONEY,
    },
    keys=("order_id", "order_item_id"),
    foreign_keys={
        "order_id": ("orders", "order_id"),
        "product_id": ("products", "product_id"),
        "seller_id": ("sellers", "seller_id"),
    },
)

GEOLOCATION = TableSpec(
    "geolocation",
    {
        "geolocation_zip_code_prefix": "string",
        "geolocation_lat": _COORDINATE,
        "geolocation_lng": _COORDINATE,
        "geolocation_city": "string",
        "geolocation_state": "string",
    },
)

ORDER_PAYMENTS = TableSpec(
    "order_payments",
    {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": _MONEY,
    },
    keys=("order_id", "payment_sequential"),
    foreign_keys={"order_id": ("orders", "order_id")},
)

ORDER_REVIEWS = TableSpec(
    "order_reviews",
    {
        "review_id": "string",
        "order_id": "string",
        "review_score": "int",
        "review_comment_title": "string",
        "review_comment_message": "string",
        "review_creation_date": "timestamp_ntz",
        "review_answer_timestamp": "timestamp_ntz",
    },
    # One review may cover several orders, so the pair is the grain.
    keys=("review_id", "order_id"),
    foreign_keys={"order_id": ("orders", "order_id")},
    multiline_text=True,
)

# In dependency order: parents before children.
SOURCE_TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        CUSTOMERS,
        GEOLOCATION,
        SELLERS,
        CATEGORY_TRANSLATION,
        PRODUCTS,
        ORDERS,
        ORDER_ITEMS,
        ORDER_PAYMENTS,
        ORDER_REVIEWS,
    )
}


def topics(prefix: str = "") -> dict[str, TableSpec]:
    """Topic name -> spec for every source table, as ``prefix`` + table name."""
    return {f"{prefix}{name}": spec for name, spec in SOURCE_TABLES.items()}
