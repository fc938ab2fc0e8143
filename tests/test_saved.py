import pytest

from smelter.operators.predicates import FilterError
from smelter.plans import saved
from tests.helpers import bag, one, plan, rows


def test_registry():
    assert saved.names() == [
        "cus_cnt",
        "prd_cnt",
        "revenue_by_region",
        "review_analysis",
        "top_products_by_category",
    ]
    with pytest.raises(KeyError, match="no saved query 'x'"):
        saved.load("x")


def test_counts_leave_out_the_unknown_member(stored):
    known = one(saved.run(stored.gold, "cus_cnt"))[0]
    assert one(saved.customer_count_with_unknown(stored.gold))[0] == known + 1
    assert one(saved.run(stored.gold, "prd_cnt"))[0] == stored.silver("products").count()


def test_filters_apply_before_the_summary(stored):
    everything = saved.run(stored.gold, "revenue_by_region", k=100)
    part = saved.run(stored.gold, "revenue_by_region", {"region": "SUL"}, k=100)
    assert bag(part) == bag(everything.filter("region = 'SUL'"))
    by_category = saved.run(stored.gold, "review_analysis", {"category_like": "large"})
    assert [r.category for r in by_category.collect()] == ["large"]


def test_unknown_places_stay_in_the_report(stored):
    regions = {r.region for r in saved.run(stored.gold, "revenue_by_region", k=100).collect()}
    assert "UNKNOWN" in regions


def test_top_and_limit(stored):
    assert saved.run(stored.gold, "revenue_by_region").count() == 5
    assert saved.run(stored.gold, "revenue_by_region", limit=2).count() == 2
    with pytest.raises(ValueError):
        saved.run(stored.gold, "cus_cnt", limit=0)
    with pytest.raises(FilterError):
        saved.run(stored.gold, "cus_cnt", {"nothing": 1})


def test_every_group_comes_back(spark, stored):
    """More groups than any default of a request: none is cut."""
    places = stored.gold("dim_geography")
    by_place = places.withColumn("region", places.zip_code_prefix).withColumn("state", places.geography_sk.cast("string"))
    tables = lambda name: by_place if name == "dim_geography" else stored.gold(name)
    groups = saved.revenue_relation(tables).select("region", "state").distinct().count()
    assert saved.run(tables, "revenue_by_region", k=1000).count() == groups > 5
    wide = spark.range(70).selectExpr("id AS customer_sk")
    assert saved.limited(wide).count() == 70


def test_filterable_columns(stored):
    columns = saved.filterable(stored.gold, "revenue_by_region")
    assert columns["full_date"] == "date" and columns["order_purchase_timestamp"] == "timestamp_ntz"
    assert saved.run(stored.gold, "revenue_by_region", {"seller_sk_gte": 1}).count() == 5


def test_describe(stored):
    described = saved.describe(stored.gold, "top_products_by_category")
    assert [r.name for r in described.orderBy("position").collect()] == [
        "category",
        "items_sold",
        "order_count",
        "total_sales",
        "avg_price",
    ]
    assert all(r.example for r in described.collect())


def test_describe_an_empty_result(spark, stored):
    def empty(name):
        table = stored.gold(name)
        return table.limit(0) if name.startswith("fact_") else table

    described = saved.describe(empty, "review_analysis")
    assert described.count() == 7
    assert {r.example for r in described.collect()} == {None}


def test_top_k_is_not_a_full_sort(stored):
    assert "TakeOrderedAndProject" in plan(saved.run(stored.gold, "revenue_by_region"))


def test_date_filters_prune_partitions_and_columns(stored):
    text = plan(saved.run(stored.gold, "revenue_by_region", {"full_date_lt": "1997-01-01"}))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "fact_order_items__" in line)
    assert "dynamicpruning" in text and "date_month" in scan
    assert "order_approved_at" not in scan


def test_fact_filters_reach_the_scan(stored):
    text = plan(saved.run(stored.gold, "revenue_by_region", {"unit_price_gt": 100}))
    assert "GreaterThan(unit_price,100.00)" in text


def test_reports(stored):
    customers = stored.silver("customers")
    by_state = rows(saved.customers_by_state(customers))
    assert by_state == sorted(by_state, key=lambda r: (-r[1], r[0]))
    assert saved.customers_by_city(customers).count() == 10
    one_state = saved.customers_of_state(customers, "SP", n=3)
    assert one_state.columns == ["customer_id", "customer_city", "customer_zip_code_prefix"]
    assert one_state.count() == 3
