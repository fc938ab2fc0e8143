"""Quality rules of the silver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from smelter.operators.quality import orphan_check, validate
from smelter.specs import SOURCE_TABLES

# Silver geolocation is grouped, so its grain is not that of its source.
SILVER_KEYS = {name: spec.keys for name, spec in SOURCE_TABLES.items()} | {
    "geolocation": ("zip_code_prefix", "city", "state")
}

# Table -> rule name -> condition a sound row meets.
RULES: dict[str, dict[str, str]] = {
    "customers": {
        "Valid State Code": "customer_state RLIKE '^[A-Z]{2}$'",
        "Valid Zip Code": "customer_zip_code_prefix RLIKE '^[0-9]{5}$'",
    },
    "geolocation": {
        "Valid Latitude": "avg_latitude BETWEEN -90 AND 90",
        "Valid Longitude": "avg_longitude BETWEEN -180 AND 180",
    },
    "sellers": {"Valid State Code": "seller_state RLIKE '^[A-Z]{2}$'"},
    "category_translation": {},
    "products": {
        "Positive Weight": "product_weight_g IS NULL OR product_weight_g > 0",
        "Positive Volume": "product_volume_cm3 IS NULL OR product_volume_cm3 > 0",
    },
    "orders": {
        "Valid Status": "order_status IN ('DELIVERED', 'SHIPPED', 'CANCELED', 'UNAVAILABLE', "
        "'INVOICED', 'PROCESSING', 'CREATED', 'APPROVED')",
        "Purchase Before Delivery": "order_delivered_customer_date IS NULL "
        "OR order_purchase_timestamp <= order_delivered_customer_date",
    },
    "order_items": {
        "Positive Price": "price >= 0",
        "Positive Freight": "freight_value >= 0",
        "Valid Total": "total_item_value >= 0",
    },
    "order_payments": {
        "Valid Payment Type": "payment_type IN ('CREDIT_CARD', 'BOLETO', 'VOUCHER', 'DEBIT_CARD')",
        "Positive Amount": "payment_value > 0",
        "Valid Installments": "payment_installments >= 1",
    },
    "order_reviews": {
        "Valid Score": "review_score BETWEEN 1 AND 5",
        "Valid Rating": "review_rating IN ('POSITIVE', 'NEUTRAL', 'NEGATIVE', 'UNKNOWN')",
    },
}


def validate_silver(table: str, df: DataFrame) -> DataFrame:
    return validate(df, table, SILVER_KEYS[table], RULES[table])


def validate_layer(tables: Callable[[str], DataFrame]) -> DataFrame:
    """Every check of every silver table, foreign keys among them."""
    reports = [validate_silver(t, tables(t)) for t in SOURCE_TABLES]
    reports += [orphans for t in SOURCE_TABLES for orphans in silver_orphans(t, tables)]
    return reduce(DataFrame.unionByName, reports)


def silver_orphans(table: str, tables: Callable[[str], DataFrame]) -> list[DataFrame]:
    """One report per foreign key of the table."""
    return [
        orphan_check(tables(table), table, column, tables(parent), parent_column)
        for column, (parent, parent_column) in SOURCE_TABLES[table].foreign_keys.items()
    ]
