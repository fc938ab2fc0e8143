import datetime as dt
from decimal import Decimal

import pytest

from smelter.plans import silver
from smelter.specs import SOURCE_TABLES
from tests.helpers import one, rows


def text_rows(spark, table, *records):
    """Row images as bronze holds them: text, absent columns NULL."""
    spec = SOURCE_TABLES[table]
    return spark.createDataFrame(
        [tuple(r.get(c) for c in spec.columns) for r in records], spec.change_schema
    )


def clean(spark, table, *records):
    return silver.CLEAN[table](text_rows(spark, table, *records))


def test_customers(spark):
    result = clean(
        spark,
        "customers",
        {"customer_id": " a ", "customer_city": " são paulo ", "customer_state": "sp"},
        {"customer_id": "  "},
        {"customer_id": None},
    )
    row = one(result)
    assert (row.customer_id, row.customer_city, row.customer_state) == ("a", "SÃO PAULO", "SP")
    assert row.processed_at is not None


def test_sellers_keep_an_empty_id(spark):
    assert clean(spark, "sellers", {"seller_id": ""}, {"seller_id": None}).count() == 1


def test_category_translation(spark):
    result = clean(
        spark,
        "category_translation",
        {"product_category_name": " a ", "product_category_name_english": " A "},
        {"product_category_name": None, "product_category_name_english": "x"},
    )
    assert rows(result.drop("processed_at")) == [("a", "A")]


def test_geolocation_bounds_and_means(spark):
    def place(zip_code, lat, lng):
        return {
            "geolocation_zip_code_prefix": zip_code,
            "geolocation_lat": lat,
            "geolocation_lng": lng,
            "geolocation_city": " city ",
            "geolocation_state": "sp",
        }

    result = clean(
        spark,
        "geolocation",
        place("1", "90", "-180"),
        place("1", "-90", "180"),
        place("1", "90.1", "0"),
        place("1", "0", "180.1"),
        place("1", None, "0"),
        place("1", "north", "0"),
        place(None, "0", "0"),
        place(" ", "1.0000004", "-1.0000005"),
    )
    assert sorted(rows(result.drop("processed_at"))) == [
        ("", "CITY", "SP", 1.0, -1.000001),
        ("1", "CITY", "SP", 0.0, 0.0),
    ]


def test_product_volume(spark):
    def product(length, height, width):
        sides = {"product_length_cm": length, "product_height_cm": height, "product_width_cm": width}
        return {"product_id": f"{length}", **sides}

    result = clean(
        spark,
        "products",
        product("2", "3", "4"),
        product("3", None, "4"),
        product("4", "x", "4"),
        product("2000", "2000", "2000"),
        product("2147483647", "2147483647", "2147483647"),
    )
    assert dict(rows(result.select("product_id", "product_volume_cm3"))) == {
        "2": 24,
        "3": None,
        "4": None,
        "2000": 8_000_000_000,  # beyond 32 bits
        "2147483647": None,  # beyond 64 bits
    }


@pytest.mark.parametrize(
    "delivered, late", [("2017-10-11", True), ("2017-10-10", False), ("2017-10-09", False), (None, None)]
)
def test_order_delays(spark, delivered, late):
    row = one(
        clean(
            spark,
            "orders",
            {
                "order_id": "o",
                "order_status": " delivered ",
                "order_purchase_timestamp": "1506941792123",
                "order_approved_at": "2017-10-03 00:01:00",
                "order_delivered_customer_date": delivered and f"{delivered} 01:00:00",
                "order_estimated_delivery_date": "2017-10-10 00:00:00",
            },
        )
    )
    assert row.order_purchase_timestamp == dt.datetime(2017, 10, 2, 10, 56, 32, 123000)
    assert (row.order_year, row.order_month, row.order_day, row.order_hour) == (2017, 10, 2, 10)
    assert (row.approval_delay_days, row.estimated_delivery_days) == (1, 8)
    assert row.is_delivered_late is late
    assert row.is_delivered is True
    if delivered is None:
        assert row.actual_delivery_days is None and row.delivery_delay_days is None


def test_order_without_status_or_times(spark):
    row = one(clean(spark, "orders", {"order_id": "o"}, {"order_id": None}))
    assert row.is_delivered is None and row.is_delivered_late is None and row.order_year is None


def test_order_items(spark):
    def item(number, price, freight):
        return {"order_id": "o", "order_item_id": number, "price": price, "freight_value": freight}

    result = clean(
        spark,
        "order_items",
        item("1", "3", "1"),
        item("2", "0", "1"),
        item("3", "3", None),
        item("4", None, "1"),
        item("x", "3", "1"),
        {"order_item_id": "9"},
    )
    selected = result.select("order_item_id", "total_item_value", "freight_ratio")
    assert {r[0]: r[1:] for r in rows(selected)} == {
        1: (Decimal("4.00"), 0.3333),
        2: (Decimal("1.00"), None),
        3: (None, None),
        4: (None, None),
    }


def test_payments(spark):
    def payment(value, count):
        return {"order_id": "o", "payment_value": value, "payment_installments": count}

    cases = {
        ("100", "3"): (Decimal("33.33"), True),
        ("100", "1"): (Decimal("100.00"), False),
        ("100", "0"): (Decimal("100.00"), False),
        ("100", None): (Decimal("100.00"), False),
        (None, "3"): (None, True),
        ("0.05", "2"): (Decimal("0.03"), True),
    }
    for (value, count), expected in cases.items():
        row = one(clean(spark, "order_payments", payment(value, count), {"order_id": " "}))
        assert (row.installment_value, row.is_installment_payment) == expected, (value, count)


def test_review_ratings(spark):
    expected = {
        "5": "POSITIVE",
        "4": "POSITIVE",
        "3": "NEUTRAL",
        "2": "NEGATIVE",
        "1": "NEGATIVE",
        None: "UNKNOWN",
    }
    records = [{"review_id": f"r{s}", "order_id": "o", "review_score": s} for s in expected]
    result = clean(spark, "order_reviews", *records, {"review_id": "r"}, {"order_id": "o"})
    assert dict(rows(result.select("review_id", "review_rating"))) == {
        f"r{s}": rating for s, rating in expected.items()
    }


@pytest.mark.parametrize(
    "title, message, expected",
    [("  ", None, False), (None, "x", True), ("x", "", True), (None, None, False)],
)
def test_review_comments(spark, title, message, expected):
    record = {"review_id": "r", "order_id": "o"}
    record |= {"review_comment_title": title, "review_comment_message": message}
    assert one(clean(spark, "order_reviews", record)).has_comment is expected


def test_review_response_time(spark):
    def hours(created, answered):
        record = {"review_id": "r", "order_id": "o"}
        record |= {"review_creation_date": created, "review_answer_timestamp": answered}
        return one(clean(spark, "order_reviews", record)).review_response_time_hours

    assert hours("2018-01-18 00:00:00", "2018-01-18 21:46:59") == 21.78
    assert hours("1516233600000", "1516233599000") == 0.0
    assert hours(None, "2018-01-18 21:46:59") is None


def test_typed_rows_clean_like_text(spark, sf_dir):
    """Rows loaded in their source types give the same table as a change log."""
    from verification.derive import source

    typed = source(spark, sf_dir, "orders").drop("_n")
    as_text = typed.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in typed.columns])
    one_way = silver.orders(typed).drop("processed_at")
    other_way = silver.orders(as_text).drop("processed_at")
    assert one_way.exceptAll(other_way).isEmpty() and other_way.exceptAll(one_way).isEmpty()
