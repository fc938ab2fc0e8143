import datetime as dt
from decimal import Decimal

import pytest

from smelter.operators.predicates import FilterError, apply_filters
from tests.helpers import plan, rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [
            (1, "south", Decimal("10.50"), dt.date(2017, 1, 1), True, dt.datetime(2017, 1, 1, 5), "x"),
            (2, "north%", Decimal("20.00"), dt.date(2017, 6, 1), False, dt.datetime(2017, 6, 1, 5), "y"),
            (3, "it's", None, dt.date(2018, 1, 1), None, dt.datetime(2018, 1, 1, 5), "z"),
        ],
        "n int, name string, price decimal(18,2), day date, ok boolean, at timestamp_ntz, valid_to string",
    )


@pytest.mark.parametrize(
    "filters, expected",
    [
        ({}, [1, 2, 3]),
        (None, [1, 2, 3]),
        ({"n": "2"}, [2]),
        ({"name": "it's"}, [3]),
        ({"n": "", "name": None}, [1, 2, 3]),
        ({"n_gte": 2}, [2, 3]),
        ({"day_from": "2017-06-01"}, [2, 3]),
        ({"day_to": "2017-06-01"}, [1, 2]),
        ({"n_lte": "1"}, [1]),
        ({"price_gt": "10.5"}, [2]),
        ({"price_gt": "10.499"}, [1, 2]),
        ({"price_lt": "20"}, [1]),
        ({"at_lt": "2017-06-01 05:00:00"}, [1]),
        ({"name_like": "o"}, [1, 2]),
        ({"name_like": "%"}, [2]),
        ({"n_like": "2"}, [2]),
        ({"n_in": "1,3"}, [1, 3]),
        ({"n_in": [1, 2]}, [1, 2]),
        ({"ok": "true"}, [1]),
        ({"ok": False}, [2]),
        # A column of that exact name wins over the suffix.
        ({"valid_to": "y"}, [2]),
        ({"valid_to_like": "z"}, [3]),
        ({"n_gte": 2, "day_lt": "2018-01-01"}, [2]),
    ],
)
def test_filters(df, filters, expected):
    assert [r[0] for r in rows(apply_filters(df, filters).orderBy("n"))] == expected


@pytest.mark.parametrize(
    "filters",
    [
        {"missing": "1"},
        {"missing_gte": "1"},
        {"n": "1 OR 1=1"},
        {"day_from": "yesterday"},
        {"price_lt": "cheap"},
        {"ok": "perhaps"},
    ],
)
def test_bad_filters_are_errors(df, filters):
    with pytest.raises(FilterError):
        apply_filters(df, filters)


def test_wildcards_on_request(df):
    assert [r.n for r in apply_filters(df, {"name_like": "_o%"}, wildcards=True).orderBy("n").collect()] == [1, 2]
    assert apply_filters(df, {"name_like": "_o%"}).count() == 0


@pytest.mark.parametrize("number", ["2147483648", "-2147483649"])
def test_integers_beyond_the_column_are_errors(df, number):
    with pytest.raises(FilterError):
        apply_filters(df, {"n_lt": number})


def test_the_zone_of_the_driver_does_not_move_times(df, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "Asia/Tokyo")
    time.tzset()
    try:
        assert [r.n for r in apply_filters(df, {"at_gte": "2017-06-01T05:00"}).orderBy("n").collect()] == [2, 3]
        assert apply_filters(df, {"at": "2017-01-01 05:00:00"}).count() == 1
    finally:
        monkeypatch.undo()
        time.tzset()


def test_filters_reach_the_scan(spark, folder, df):
    df.write.parquet(f"{folder}/t")
    text = plan(apply_filters(spark.read.parquet(f"{folder}/t"), {"n_gte": 2, "name": "x"}))
    assert "GreaterThanOrEqual(n,2)" in text and "EqualTo(name,x)" in text
