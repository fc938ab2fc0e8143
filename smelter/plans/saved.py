"""Saved queries over the star schema, with filters applied before aggregation.

A query is a relation, whose columns may be filtered, and a summary of it.
``tables`` is anything that maps a gold table name to its DataFrame by calling
it, such as ``Layer.read``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.functions import columns as C
from smelter.operators.keys import known_members
from smelter.operators.predicates import apply_filters
from smelter.plans.gold import MONTH

Tables = Callable[[str], DataFrame]

TOP = 5


def dated(fact: DataFrame, date_key: str, dim_date: DataFrame) -> DataFrame:
    """Fact rows with their calendar day; rows without a date have the unknown one.

    The month condition lets a date filter prune the fact's partitions.
    """
    days = dim_date.drop("etl_loaded_at").withColumnRenamed("date_sk", date_key)
    on = [date_key]
    if MONTH in fact.columns:
        days = days.withColumn(MONTH, C.month_of(date_key))
        on.append(MONTH)
    return fact.drop("etl_loaded_at").join(days, on)


def revenue_relation(tables: Tables) -> DataFrame:
    places = tables("dim_geography").drop("etl_loaded_at")
    items = dated(tables("fact_order_items"), "date_sk", tables("dim_date"))
    return items.join(
        places.withColumnRenamed("geography_sk", "customer_geography_sk"), "customer_geography_sk"
    )


def revenue_by_region(relation: DataFrame, k: int = TOP) -> DataFrame:
    """Revenue, orders and freight per region and state; the best ``k`` by revenue."""
    return (
        relation.groupBy("region", "state")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.sum("total_item_value").alias("total_revenue"),
            F.avg("total_item_value").alias("avg_order_value"),
            F.sum("freight_value").alias("total_shipping_cost"),
        )
        .orderBy(F.desc("total_revenue"), "region", "state")
        .limit(k)
    )


def _products(tables: Tables) -> DataFrame:
    return (
        tables("dim_product")
        .drop("etl_loaded_at")
        .withColumn("category", F.col("product_category_name_english"))
    )


def sales_relation(tables: Tables) -> DataFrame:
    items = dated(tables("fact_order_items"), "date_sk", tables("dim_date"))
    return items.join(_products(tables), "product_sk")


def top_products_by_category(relation: DataFrame, k: int = TOP) -> DataFrame:
    """Items, orders and sales per category; the best ``k`` by sales."""
    return (
        relation.groupBy("category")
        .agg(
            F.count("*").alias("items_sold"),
            F.countDistinct("order_id").alias("order_count"),
            F.sum("unit_price").alias("total_sales"),
            C.exact_ratio(F.sum("unit_price"), F.count("unit_price"), 2).alias("avg_price"),
        )
        .orderBy(F.desc("total_sales"), "category")
        .limit(k)
    )


def review_relation(tables: Tables) -> DataFrame:
    reviews = dated(tables("fact_reviews"), "review_date_sk", tables("dim_date"))
    return reviews.join(_products(tables), "product_sk")


def review_analysis(relation: DataFrame, k: int = TOP) -> DataFrame:
    """Scores and sentiment per category; the ``k`` with most reviews."""
    positive = F.sum("is_positive")
    return (
        relation.groupBy("category")
        .agg(
            F.count("*").alias("total_reviews"),
            C.exact_ratio(F.sum("review_score"), F.count("review_score"), 2).alias("avg_score"),
            positive.alias("positive_reviews"),
            F.sum("is_negative").alias("negative_reviews"),
            F.sum("is_neutral").alias("neutral_reviews"),
            C.exact_ratio(positive * 100, F.count("*"), 2).alias("positive_rate_pct"),
        )
        .orderBy(F.desc("total_reviews"), "category")
        .limit(k)
    )


def customer_count(relation: DataFrame, k: int | None = None) -> DataFrame:
    return relation.agg(F.count("*").alias("customer_count"))


def product_count(relation: DataFrame, k: int | None = None) -> DataFrame:
    return relation.agg(F.countDistinct("product_id").alias("product_count"))


@dataclass(frozen=True)
class SavedQuery:
    relation: Callable[[Tables], DataFrame]
    summary: Callable[[DataFrame, int], DataFrame]


SAVED: dict[str, SavedQuery] = {
    "cus_cnt": SavedQuery(
        lambda t: known_members(t("dim_customer"), "customer_sk"), customer_count
    ),
    "prd_cnt": SavedQuery(lambda t: known_members(t("dim_product"), "product_sk"), product_count),
    "revenue_by_region": SavedQuery(revenue_relation, revenue_by_region),
    "top_products_by_category": SavedQuery(sales_relation, top_products_by_category),
    "review_analysis": SavedQuery(review_relation, review_analysis),
}


def names() -> list[str]:
    return sorted(SAVED)


def load(name: str) -> SavedQuery:
    try:
        return SAVED[name]
    except KeyError:
        raise KeyError(f"no saved query {name!r}; there are {', '.join(names())}") from None


def limited(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The first rows, or all of them."""
    if limit is None:
        return df
    if limit < 1:
        raise ValueError("limit must be at least 1")
    return df.limit(limit)


def run(
    tables: Tables,
    name: str,
    filters: Mapping[str, Any] | None = None,
    limit: int | None = None,
    k: int = TOP,
    wildcards: bool = False,
) -> DataFrame:
    """Run a saved query over the rows of its relation that meet the filters.

    With ``wildcards``, ``%`` and ``_`` in the value of a ``_like`` filter stand for any text and any character.
    """
    query = load(name)
    rows = apply_filters(query.relation(tables), filters, wildcards)
    return limited(query.summary(rows, k), limit)


def filterable(tables: Tables, name: str) -> dict[str, str]:
    """The columns a saved query can be filtered by, with their types: those of its relation."""
    return dict(load(name).relation(tables).dtypes)


def customer_count_with_unknown(tables: Tables) -> DataFrame:
    """The customer count including the unknown member."""
    return customer_count(tables("dim_customer"))


def describe(tables: Tables, name: str) -> DataFrame:
    """``(position, name, type, example)`` per result column; columns also of empty results."""
    result = run(tables, name)
    fields = result.schema.fields
    spark = result.sparkSession
    columns = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)],
        "position int, name string, type string",
    )
    # A left join keeps the columns when there is no row to take examples from.
    first = result.limit(1).select(
        F.posexplode(F.array(*[F.col(f.name).cast("string") for f in fields])).alias(
            "position", "example"
        )
    )
    return columns.join(first, "position", "left")


def customers_by_state(customers: DataFrame, k: int = 10) -> DataFrame:
    return _largest_groups(customers, ["customer_state"], k)


def customers_by_city(customers: DataFrame, k: int = 10) -> DataFrame:
    return _largest_groups(customers, ["customer_city", "customer_state"], k)


def _largest_groups(df: DataFrame, by: list[str], k: int) -> DataFrame:
    return df.groupBy(*by).count().orderBy(F.desc("count"), *by).limit(k)


def customers_of_state(customers: DataFrame, state: str, n: int = 10) -> DataFrame:
    return (
        customers.filter(F.col("customer_state") == state)
        .select("customer_id", "customer_city", "customer_zip_code_prefix")
        .orderBy("customer_id")
        .limit(n)
    )
