"""Silver tables: row images -> cleaned, typed rows with derived measures.

Every function takes the source columns as text or typed and needs no shuffle,
except geolocation, which averages per place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.functions import columns as C
from smelter.operators.cdc import current_images, latest_by_key
from smelter.specs import SOURCE_TABLES

AUDIT = "processed_at"
SUMS = "decimal(37,12)"  # of coordinates; two add up without rounding

PRODUCT_NUMBERS = (
    "product_name_length",
    "product_description_length",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)
ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(AUDIT, F.current_timestamp())


def _required(*names: str):
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return condition


def customers(rows: DataFrame) -> DataFrame:
    cleaned = rows.select(
        *[
            C.clean_text(F.col(c)).alias(c)
            for c in ("customer_id", "customer_unique_id", "customer_zip_code_prefix")
        ],
        *[C.standard_code(F.col(c)).alias(c) for c in ("customer_city", "customer_state")],
    )
    return _stamped(cleaned.filter(C.not_blank(F.col("customer_id"))))


def located(rows: DataFrame, *others: str) -> DataFrame:
    """Place, valid coordinates and ``others`` of every geolocation row that has them."""
    return rows.select(
        C.clean_text(F.col("geolocation_zip_code_prefix")).alias("zip_code_prefix"),
        C.standard_code(F.col("geolocation_city")).alias("city"),
        C.standard_code(F.col("geolocation_state")).alias("state"),
        C.to_coordinate(F.col("geolocation_lat")).alias("latitude"),
        C.to_coordinate(F.col("geolocation_lng")).alias("longitude"),
        *others,
    ).filter(
        F.col("zip_code_prefix").isNotNull()
        & F.col("latitude").between(-90, 90)
        & F.col("longitude").between(-180, 180)
    )


def geolocation(rows: DataFrame) -> DataFrame:
    """Mean coordinates per (zip, city, state) over rows with valid coordinates.

    Decimal sums make the means independent of the order rows are added in.
    """
    means = located(rows).groupBy("zip_code_prefix", "city", "state").agg(
        F.round(F.avg("latitude"), 6).cast("double").alias("avg_latitude"),
        F.round(F.avg("longitude"), 6).cast("double").alias("avg_longitude"),
    )
    return _stamped(means)


def place_sums(rows: DataFrame, times: str) -> DataFrame:
    """``(zip, city, state, latitude, longitude, n)``: exact sums over rows that count ``times`` each, less than 0 to take away."""
    n = F.col(times)
    weighed = [F.sum(F.col(c) * n.cast("decimal(19,0)")).cast(SUMS).alias(c) for c in ("latitude", "longitude")]
    return located(rows, times).groupBy("zip_code_prefix", "city", "state").agg(*weighed, F.sum(n).alias("n"))


def places_from_sums(sums: DataFrame) -> DataFrame:
    """The geolocation table from exact sums: the same means as from the rows."""

    def mean(column: str):
        exact = F.try_divide(F.col(column).cast("decimal(28,12)"), F.col("n").cast("decimal(20,0)")).cast("decimal(22,16)")
        return F.round(exact, 6).cast("double").alias(f"avg_{column}")

    left = sums.filter(F.col("n") > 0)
    return _stamped(left.select("zip_code_prefix", "city", "state", mean("latitude"), mean("longitude")))


def sellers(rows: DataFrame) -> DataFrame:
    cleaned = rows.select(
        *[C.clean_text(F.col(c)).alias(c) for c in ("seller_id", "seller_zip_code_prefix")],
        *[C.standard_code(F.col(c)).alias(c) for c in ("seller_city", "seller_state")],
    )
    return _stamped(cleaned.filter(_required("seller_id")))


def category_translation(rows: DataFrame) -> DataFrame:
    names = ("product_category_name", "product_category_name_english")
    cleaned = rows.select(*[C.clean_text(F.col(c)).alias(c) for c in names])
    return _stamped(cleaned.filter(_required("product_category_name")))


def products(rows: DataFrame) -> DataFrame:
    typed = rows.select(
        *[C.clean_text(F.col(c)).alias(c) for c in ("product_id", "product_category_name")],
        *[C.to_int(F.col(c)).alias(c) for c in PRODUCT_NUMBERS],
    ).filter(_required("product_id"))
    length, height, width = (
        F.col(f"product_{side}_cm").cast("bigint") for side in ("length", "height", "width")
    )
    # NULL where a side is unknown or the product leaves the bigint range.
    volume = F.try_multiply(F.try_multiply(length, height), width)
    return _stamped(typed.withColumn("product_volume_cm3", volume))


def orders(rows: DataFrame) -> DataFrame:
    typed = rows.select(
        *[C.clean_text(F.col(c)).alias(c) for c in ("order_id", "customer_id")],
        C.standard_code(F.col("order_status")).alias("order_status"),
        *[C.to_wall_clock(F.col(c)).alias(c) for c in ORDER_TIMES],
    ).filter(_required("order_id"))
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    measured = typed.withColumns(
        {
            "order_year": F.year(purchased),
            "order_month": F.month(purchased),
            "order_day": F.dayofmonth(purchased),
            "order_hour": F.hour(purchased),
            "approval_delay_days": C.days_between(F.col("order_approved_at"), purchased),
            "actual_delivery_days": C.days_between(delivered, purchased),
            "estimated_delivery_days": C.days_between(estimated, purchased),
            "delivery_delay_days": C.days_between(delivered, estimated),
        }
    )
    return _stamped(
        measured.withColumns(
            {
                "is_delivered_late": F.col("delivery_delay_days") > 0,
                "is_delivered": F.col("order_status") == "DELIVERED",
            }
        )
    )


def order_items(rows: DataFrame) -> DataFrame:
    typed = rows.select(
        C.clean_text(F.col("order_id")).alias("order_id"),
        C.to_int(F.col("order_item_id")).alias("order_item_id"),
        *[C.clean_text(F.col(c)).alias(c) for c in ("product_id", "seller_id")],
        C.to_wall_clock(F.col("shipping_limit_date")).alias("shipping_limit_date"),
        *[C.to_money(F.col(c)).alias(c) for c in ("price", "freight_value")],
    ).filter(_required("order_id", "order_item_id"))
    price, freight = F.col("price"), F.col("freight_value")
    return _stamped(
        typed.withColumns(
            {
                "total_item_value": price + freight,
                "freight_ratio": F.when(
                    price > 0, F.round(F.try_divide(freight, price), 4).cast("double")
                ),
            }
        )
    )


def order_payments(rows: DataFrame) -> DataFrame:
    typed = rows.select(
        C.clean_text(F.col("order_id")).alias("order_id"),
        C.to_int(F.col("payment_sequential")).alias("payment_sequential"),
        C.standard_code(F.col("payment_type")).alias("payment_type"),
        C.to_int(F.col("payment_installments")).alias("payment_installments"),
        C.to_money(F.col("payment_value")).alias("payment_value"),
    ).filter(C.not_blank(F.col("order_id")))
    count, value = F.col("payment_installments"), F.col("payment_value")
    share = F.round(F.try_divide(value, count.cast("decimal(10,0)")), 2)
    return _stamped(
        typed.withColumns(
            {
                "installment_value": F.when(count > 0, share).otherwise(value).cast(C.MONEY),
                "is_installment_payment": F.coalesce(count > 1, F.lit(False)),
            }
        )
    )


def order_reviews(rows: DataFrame) -> DataFrame:
    typed = rows.select(
        *[C.clean_text(F.col(c)).alias(c) for c in ("review_id", "order_id")],
        C.to_int(F.col("review_score")).alias("review_score"),
        *[
            C.clean_text(F.col(c)).alias(c)
            for c in ("review_comment_title", "review_comment_message")
        ],
        *[
            C.to_wall_clock(F.col(c)).alias(c)
            for c in ("review_creation_date", "review_answer_timestamp")
        ],
    ).filter(_required("review_id", "order_id"))
    score = F.col("review_score")
    return _stamped(
        typed.withColumns(
            {
                "review_rating": C.banded(
                    score, ((3, "NEGATIVE"), (4, "NEUTRAL")), above="POSITIVE", missing="UNKNOWN"
                ),
                "has_comment": C.not_blank(F.col("review_comment_title"))
                | C.not_blank(F.col("review_comment_message")),
                "review_response_time_hours": C.hours_between(
                    F.col("review_answer_timestamp"), F.col("review_creation_date")
                ),
            }
        )
    )


CLEAN: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": customers,
    "geolocation": geolocation,
    "sellers": sellers,
    "category_translation": category_translation,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
}


def from_changes(table: str, changes: DataFrame, deletes: str = "apply") -> DataFrame:
    """Bronze change log -> silver table: fold to current rows, then clean."""
    keys = SOURCE_TABLES[table].keys
    rows = latest_by_key(changes, keys, deletes=deletes) if keys else current_images(changes, deletes)
    return CLEAN[table](rows)
