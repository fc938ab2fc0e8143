"""Gold star schema: six dimensions, two facts.

Dimension keys are dense on a first build; later builds keep them and number new members
after the largest. A dimension is written before a fact looks anything up in it. Business keys are
resolved where they are fewest: places at customer and seller grain, customers
at order grain, and only orders, sellers and products at item grain.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions import columns as C
from smelter.operators.joins import ROWS_PER_TASK, heavy_keys, look_up, spread_join
from smelter.operators.keys import (
    UNKNOWN_KEY,
    assign_stable_key,
    known_members,
    or_unknown,
    with_unknown_member,
)
from smelter.operators.merge import first_per_key
from smelter.scratch import written

AUDIT = "etl_loaded_at"

# Brazilian states by region; any other state is OUTROS.
REGIONS = {
    "SUDESTE": ("SP", "RJ", "MG", "ES"),
    "SUL": ("PR", "SC", "RS"),
    "CENTRO-OESTE": ("MT", "MS", "GO", "DF"),
    "NORDESTE": ("BA", "SE", "AL", "PE", "PB", "RN", "CE", "PI", "MA"),
    "NORTE": ("AM", "PA", "AC", "RO", "RR", "AP", "TO"),
}

# Order status -> (description, category, terminal, pipeline position).
ORDER_STATUSES = {
    "CREATED": ("Order created", "PENDING", False, 1),
    "APPROVED": ("Payment approved", "IN_PROGRESS", False, 2),
    "PROCESSING": ("Order is being processed", "IN_PROGRESS", False, 3),
    "INVOICED": ("Invoice generated", "IN_PROGRESS", False, 4),
    "SHIPPED": ("Order shipped and in transit", "IN_PROGRESS", False, 5),
    "DELIVERED": ("Order successfully delivered to customer", "COMPLETED", True, 6),
    "UNAVAILABLE": ("Product unavailable", "FAILED", True, 98),
    "CANCELED": ("Order was canceled", "FAILED", True, 99),
}
OTHER_STATUS = ("Unknown status", "OTHER", False, 0)

# Exclusive upper limits of the product bands.
VOLUME_BANDS = ((1000, "SMALL"), (10000, "MEDIUM"), (50000, "LARGE"))
WEIGHT_BANDS = ((500, "LIGHT"), (2000, "MEDIUM"), (10000, "HEAVY"))

# Calendar when no order has a purchase time.
DEFAULT_YEARS = (2016, 2020)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(AUDIT, F.current_timestamp())


# The last refresh of a dimension, or what gives members, business key and key column their keys.
Previous = DataFrame | Callable[[DataFrame, str, str], DataFrame] | None


def _dimension(
    df: DataFrame, business_key: str, key: str, unknown: dict, previous: Previous
) -> DataFrame:
    members = df.filter(F.col(business_key).isNotNull())
    if callable(previous):
        keyed = previous(members, business_key, key)
    else:
        keyed = assign_stable_key(members, business_key, key, previous)
    return _stamped(with_unknown_member(keyed, key, unknown))


def dim_geography(geolocation: DataFrame, previous: Previous = None) -> DataFrame:
    """One place per zip code: the one furthest south."""
    places = geolocation.select("zip_code_prefix", "city", "state", "avg_latitude", "avg_longitude")
    southmost = first_per_key(
        places, ["zip_code_prefix"], ["avg_latitude", "avg_longitude", "city", "state"]
    )
    located = southmost.select(
        "zip_code_prefix",
        "city",
        "state",
        C.first_match(F.col("state"), REGIONS, default="OUTROS").alias("region"),
        F.col("avg_latitude").alias("latitude"),
        F.col("avg_longitude").alias("longitude"),
    )
    unknown = {
        "zip_code_prefix": "00000",
        "city": "UNKNOWN",
        "state": "UNKNOWN",
        "region": "UNKNOWN",
    }
    return _dimension(located, "zip_code_prefix", "geography_sk", unknown, previous)


def dim_date(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every day of every year from the first purchase or review to the last, and an unknown day.

    Years outside 1 to 9999 are not in the calendar; facts of such days refer to the unknown member.
    """
    years = orders.select(F.year("order_purchase_timestamp").alias("y")).unionByName(
        reviews.select(F.year("review_creation_date").alias("y"))
    )
    first, last = (
        F.coalesce(bound("y"), F.lit(default)) for bound, default in zip((F.min, F.max), DEFAULT_YEARS)
    )
    # One row in, one row per day out: at most 9,999 years.
    days = years.filter(F.col("y").between(1, 9999)).agg(first.alias("first"), last.alias("last")).select(
        F.explode(
            F.sequence(
                F.make_date("first", F.lit(1), F.lit(1)),
                F.make_date("last", F.lit(12), F.lit(31)),
            )
        ).alias("full_date")
    )
    day = F.col("full_date")
    described = (
        days.select(
            C.date_key(day).alias("date_sk"),
            day,
            F.dayofmonth(day).alias("day_of_month"),
            F.dayofweek(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.weekofyear(day).alias("week_of_year"),
            F.month(day).alias("month_number"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.quarter(day).alias("quarter"),
            F.year(day).alias("year"),
            F.dayofweek(day).isin(1, 7).alias("is_weekend"),
            F.date_format(day, "yyyy-MM").alias("year_month"),
            F.concat_ws("-Q", F.year(day), F.quarter(day)).alias("year_quarter"),
        )
    )
    unknown = dict.fromkeys(("day_name", "month_name", "year_month", "year_quarter"), "UNKNOWN")
    return _stamped(with_unknown_member(described, "date_sk", unknown))


def _day(timestamp: str) -> Column:
    """The key of a time's day; times that the calendar cannot hold are unknown."""
    key = C.date_key(F.col(timestamp))
    return F.when(F.year(timestamp).between(1, 9999), key).otherwise(F.lit(UNKNOWN_KEY)).cast("int")


def dim_customer(customers: DataFrame, previous: Previous = None) -> DataFrame:
    """One row per person: the details under the least customer id."""
    columns = [
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ]
    people = first_per_key(
        customers.select(*columns, "customer_id"), ["customer_unique_id"], ["customer_id"]
    )
    unknown = dict(zip(columns, ("UNKNOWN", "00000", "UNKNOWN", "UNKNOWN")))
    return _dimension(people.select(*columns), "customer_unique_id", "customer_sk", unknown, previous)


def dim_seller(sellers: DataFrame, previous: Previous = None) -> DataFrame:
    columns = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
    unknown = dict(zip(columns, ("UNKNOWN", "00000", "UNKNOWN", "UNKNOWN")))
    return _dimension(sellers.select(*columns), "seller_id", "seller_sk", unknown, previous)


def dim_product(
    products: DataFrame,
    translation: DataFrame,
    previous: Previous = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Products with their English category, or the native name where none is known."""
    category = "product_category_name"
    heavy = heavy_keys(products, [category], rows_per_task)[category]
    english = translation.select(category, "product_category_name_english")
    named = spread_join(products, english, category, "left", heavy_left=heavy)
    described = named.select(
        "product_id",
        category,
        F.coalesce("product_category_name_english", category).alias("product_category_name_english"),
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_volume_cm3",
        C.banded(
            F.col("product_volume_cm3"), VOLUME_BANDS, above="EXTRA_LARGE", missing="UNKNOWN"
        ).alias("size_category"),
        C.banded(
            F.col("product_weight_g"), WEIGHT_BANDS, above="VERY_HEAVY", missing="UNKNOWN"
        ).alias("weight_category"),
    )
    unknown = dict.fromkeys(
        (
            "product_id",
            category,
            "product_category_name_english",
            "size_category",
            "weight_category",
        ),
        "UNKNOWN",
    )
    return _dimension(described, "product_id", "product_sk", unknown, previous)


def dim_order_status(orders: DataFrame, previous: Previous = None) -> DataFrame:
    """The statuses that occur, with their meaning."""
    status = F.col("order_status")

    def attribute(position: int):
        pairs = [F.lit(x) for s, row in ORDER_STATUSES.items() for x in (s, row[position])]
        known = F.try_element_at(F.create_map(*pairs), status)
        return F.coalesce(known, F.lit(OTHER_STATUS[position]))

    described = orders.select("order_status").distinct().select(
        "order_status",
        attribute(0).alias("status_description"),
        attribute(1).alias("status_category"),
        attribute(2).alias("is_terminal_state"),
        (status == "DELIVERED").alias("is_successful"),
        attribute(3).alias("pipeline_order"),
    )
    unknown = {
        "order_status": "UNKNOWN",
        "status_description": "Unknown order status",
        "status_category": "OTHER",
        "is_terminal_state": False,
        "is_successful": False,
        "pipeline_order": 0,
    }
    return _dimension(described, "order_status", "order_status_sk", unknown, previous)


def customer_keys(
    customers: DataFrame,
    dim_customer: DataFrame,
    dim_geography: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Customer id -> person and place keys; the place is the one given with that id."""
    person, zip_code = "customer_unique_id", "customer_zip_code_prefix"
    heavy = heavy_keys(customers, [person, zip_code], rows_per_task)
    rows = customers.select("customer_id", person, zip_code)
    rows = look_up(rows, dim_customer, person, person, "customer_sk", heavy=heavy[person])
    rows = look_up(
        rows,
        dim_geography,
        zip_code,
        "zip_code_prefix",
        "geography_sk",
        alias="customer_geography_sk",
        heavy=heavy[zip_code],
    )
    return rows.select("customer_id", "customer_sk", "customer_geography_sk")


def seller_keys(
    dim_seller: DataFrame, dim_geography: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Seller id -> seller and place keys; stored.

    A join is taken for larger than it is, and so the items would be shuffled to meet it; of a stored table Spark knows the size.
    """
    zip_code = "seller_zip_code_prefix"
    sellers = known_members(dim_seller, "seller_sk").select("seller_id", "seller_sk", zip_code)
    heavy = heavy_keys(sellers, [zip_code], rows_per_task)[zip_code]
    rows = look_up(
        sellers,
        dim_geography,
        zip_code,
        "zip_code_prefix",
        "geography_sk",
        alias="seller_geography_sk",
        heavy=heavy,
    )
    return written(rows.select("seller_id", "seller_sk", "seller_geography_sk"), "seller-keys")


def _join_keys(rows: DataFrame, keys: DataFrame, on: str, heavy) -> DataFrame:
    """Left join a key table; keys not found become the unknown member."""
    names = [c for c in keys.columns if c != on]
    joined = spread_join(rows, keys, on, "left", heavy_left=heavy)
    return joined.withColumns({c: or_unknown(F.col(c)) for c in names})


def fact_order_items(
    order_items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    dim_customer: DataFrame,
    dim_seller: DataFrame,
    dim_product: DataFrame,
    dim_order_status: DataFrame,
    dim_geography: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per order item whose order exists; ``unique_key`` is added when stored."""
    order_heavy = heavy_keys(orders, ["customer_id", "order_status"], rows_per_task)
    item_heavy = heavy_keys(order_items, ["order_id", "seller_id", "product_id"], rows_per_task)

    order_rows = orders.select(
        "order_id",
        "customer_id",
        "order_status",
        _day("order_purchase_timestamp").alias("date_sk"),
        "actual_delivery_days",
        "delivery_delay_days",
        "is_delivered",
        "is_delivered_late",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_customer_date",
    )
    order_rows = _join_keys(
        order_rows,
        customer_keys(customers, dim_customer, dim_geography, rows_per_task),
        "customer_id",
        order_heavy["customer_id"],
    )
    order_rows = look_up(
        order_rows,
        dim_order_status,
        "order_status",
        "order_status",
        "order_status_sk",
        heavy=order_heavy["order_status"],
    ).drop("customer_id", "order_status")

    item_rows = order_items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        F.col("price").alias("unit_price"),
        "freight_value",
        "total_item_value",
        "shipping_limit_date",
    )
    item_rows = look_up(
        item_rows, dim_product, "product_id", "product_id", "product_sk", heavy=item_heavy["product_id"]
    ).drop("product_id")
    item_rows = _join_keys(
        item_rows,
        seller_keys(dim_seller, dim_geography, rows_per_task),
        "seller_id",
        item_heavy["seller_id"],
    ).drop("seller_id")

    joined = spread_join(item_rows, order_rows, "order_id", heavy_left=item_heavy["order_id"])
    return _stamped(
        joined.select(
            "order_id",
            "order_item_id",
            "date_sk",
            "customer_sk",
            "product_sk",
            "seller_sk",
            "order_status_sk",
            "customer_geography_sk",
            "seller_geography_sk",
            "unit_price",
            "freight_value",
            "total_item_value",
            "actual_delivery_days",
            "delivery_delay_days",
            "is_delivered",
            "is_delivered_late",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_customer_date",
            "shipping_limit_date",
        )
    )


def fact_reviews(
    order_reviews: DataFrame, order_item_facts: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """One row per review and item of the reviewed order.

    The item fact already holds every key of the order and the product, so one
    join replaces the lookups. A review of an order without items has no row.
    """
    items = order_item_facts.select(
        "order_id",
        F.col("date_sk").alias("order_date_sk"),
        "customer_sk",
        "product_sk",
        "customer_geography_sk",
    )
    joined = spread_join(
        items,
        order_reviews,
        "order_id",
        heavy_left=heavy_keys(items, ["order_id"], rows_per_task)["order_id"],
        heavy_right=heavy_keys(order_reviews, ["order_id"], rows_per_task)["order_id"],
    )
    score = F.col("review_score")

    def flag(condition):
        return F.when(condition, 1).otherwise(0)

    return _stamped(
        joined.select(
            "review_id",
            "order_id",
            _day("review_creation_date").alias("review_date_sk"),
            "order_date_sk",
            "customer_sk",
            "product_sk",
            "customer_geography_sk",
            "review_score",
            "review_rating",
            "has_comment",
            "review_comment_title",
            "review_comment_message",
            "review_response_time_hours",
            flag(score >= 4).alias("is_positive"),
            flag(score == 3).alias("is_neutral"),
            flag(score <= 2).alias("is_negative"),
            flag(F.col("has_comment")).alias("has_comment_flag"),
            "review_creation_date",
            "review_answer_timestamp",
        )
    )


# The date key each fact is partitioned by month of.
FACT_DATES = {"fact_order_items": "date_sk", "fact_reviews": "review_date_sk"}
FACT_KEYS = {"fact_order_items": "order_item_sk", "fact_reviews": "review_sk"}
MONTH = "date_month"


def _by_month(table: str, fact: DataFrame) -> dict:
    with_month = fact.withColumn(MONTH, C.month_of(FACT_DATES[table]))
    return {"table": table, "df": with_month, "partition_by": MONTH, "unique": FACT_KEYS[table]}


def store_fact(layer, table: str, fact: DataFrame) -> DataFrame:
    """Write a fact with its key, partitioned by month."""
    return layer.replace(**_by_month(table, fact))


def stage_fact(layer, table: str, fact: DataFrame, after: int = 0) -> str:
    """The same without publishing it, keys from ``after`` + 1 on: the folder it is in."""
    return layer.stage(**_by_month(table, fact), after=after)


class ChangedMonths:
    """The facts of the months that a change of silver tables touches.

    A fact row changes if its order, its item or review, or a key it looks up has changed: the person or place of its customer, its
    seller or the seller's place, its product. Such orders are found from the changed keys; their months, before
    and after, are rebuilt as a whole from the new tables, all others are left alone. Keys of people and statuses change only
    with customers and orders that have changed themselves.

    ``changed`` holds the changed keys per silver table as text; readers give the tables of the last build and of this one.
    """

    def __init__(self, changed, old_silver, new_silver, old_gold, new_gold):
        self.changed, self.old, self.new = changed, old_silver, new_silver
        self.old_gold, self.new_gold = old_gold, new_gold

    def _moved(self, table: str, business_key: str, key: str, members: DataFrame | None = None) -> DataFrame:
        """Members of a dimension, of the given ones if any, whose key came, went or changed."""

        def side(dim: DataFrame, name: str) -> DataFrame:
            known = known_members(dim, key).select(F.col(business_key), F.col(key).alias(name))
            return known if members is None else known.join(members, business_key, "left_semi")

        both = side(self.old_gold(table), "_old").join(side(self.new_gold(table), "_new"), business_key, "full_outer")
        return both.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(business_key)

    def orders(self) -> DataFrame:
        """The orders whose item facts may differ, each once; stored."""
        zips = self._moved("dim_geography", "zip_code_prefix", "geography_sk")
        customers, sellers = self.new("customers"), self.new("sellers")
        people = self.changed["customers"].select("customer_id").unionByName(
            customers.join(zips, customers["customer_zip_code_prefix"] == zips["zip_code_prefix"], "left_semi").select("customer_id")
        )
        shops = self.changed["sellers"].select("seller_id").unionByName(
            sellers.join(zips, sellers["seller_zip_code_prefix"] == zips["zip_code_prefix"], "left_semi").select("seller_id")
        )
        products = self._moved("dim_product", "product_id", "product_sk", self.changed["products"].select("product_id"))
        orders, items = self.new("orders"), self.new("order_items")
        found = [
            self.changed["orders"].select("order_id"),
            self.changed["order_items"].select("order_id"),
            orders.join(people, "customer_id", "left_semi").select("order_id"),
            items.join(shops, "seller_id", "left_semi").select("order_id"),
            items.join(products, "product_id", "left_semi").select("order_id"),
        ]
        return written(reduce(DataFrame.unionByName, found).distinct(), "changed-orders")

    @staticmethod
    def _months(rows: DataFrame, timestamp: str) -> DataFrame:
        return rows.select(_day(timestamp).alias("_day")).select(C.month_of("_day").alias("month")).distinct()

    def _touched(self, table: str, keys: list[str], timestamp: str, changed: DataFrame) -> set[int]:
        """Months, before and after, of the changed rows: at most one per month of the calendar reaches the driver."""
        sides = [self._months(read(table).join(changed, keys, "left_semi"), timestamp) for read in (self.old, self.new)]
        return {row.month for row in sides[0].unionByName(sides[1]).distinct().collect()}

    def _of_months(self, table: str, timestamp: str, months: set[int]) -> DataFrame:
        rows = self.new(table).withColumn("_day", _day(timestamp)).withColumn("_month", C.month_of("_day"))
        return rows.filter(F.col("_month").isin(*months)).drop("_day", "_month")

    def items(self, dimension) -> tuple[set[int], DataFrame]:
        """(months, the item facts of these months)."""
        self.changed_orders = self.orders()
        months = self._touched("orders", ["order_id"], "order_purchase_timestamp", self.changed_orders)
        orders = written(self._of_months("orders", "order_purchase_timestamp", months), "orders-of-months")
        dims = ("dim_customer", "dim_seller", "dim_product", "dim_order_status", "dim_geography")
        items = self.new("order_items").join(orders.select("order_id"), "order_id", "left_semi")
        customers = self.new("customers").join(orders.select("customer_id"), "customer_id", "left_semi")
        return months, fact_order_items(items, orders, customers, *map(dimension, dims))

    def reviews(self, item_facts: DataFrame) -> tuple[set[int], DataFrame]:
        """(months, the review facts of these months); after ``items``."""
        keys = ["review_id", "order_id"]
        of_orders = [
            read("order_reviews").join(self.changed_orders, "order_id", "left_semi").select(*keys) for read in (self.old, self.new)
        ]
        changed = reduce(DataFrame.unionByName, [self.changed["order_reviews"].select(*keys), *of_orders]).distinct()
        months = self._touched("order_reviews", keys, "review_creation_date", written(changed, "changed-reviews"))
        reviews = self._of_months("order_reviews", "review_creation_date", months)
        facts = item_facts.join(reviews.select("order_id"), "order_id", "left_semi")
        return months, fact_reviews(reviews, facts)
