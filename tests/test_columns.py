import datetime as dt

import pytest
from pyspark.sql import functions as F

from smelter.functions import columns as C
from smelter.plans.gold import REGIONS, VOLUME_BANDS, WEIGHT_BANDS
from tests.helpers import rows

WALL_CLOCK = {
    "1506941792123": dt.datetime(2017, 10, 2, 10, 56, 32, 123000),
    "2017-10-02 10:56:33": dt.datetime(2017, 10, 2, 10, 56, 33),
    "2017-10-02T10:56:33": dt.datetime(2017, 10, 2, 10, 56, 33),
    # An hour New York skips: a wall clock without zone keeps it.
    "1489285800000": dt.datetime(2017, 3, 12, 2, 30),
    "2017": dt.datetime(2017, 1, 1),
    "-1000": dt.datetime(1969, 12, 31, 23, 59, 59),
    "0": dt.datetime(1970, 1, 1),
    " 1000 ": dt.datetime(1000, 1, 1),
    "99999999999999999999": None,
    "": None,
    "abc": None,
    None: None,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_wall_clock(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(x,) for x in WALL_CLOCK], "x string")
        assert dict(rows(df.select("x", C.to_wall_clock(F.col("x"))))) == WALL_CLOCK
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_wall_clock_of_typed_columns(spark):
    df = spark.sql("SELECT timestamp_ntz'2017-03-12 02:30:00.5' AS a, 1506941792123L AS b")
    assert rows(df.select(C.to_wall_clock(F.col("a")), C.to_wall_clock(F.col("b")))) == [
        (dt.datetime(2017, 3, 12, 2, 30, 0, 500000), WALL_CLOCK["1506941792123"])
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers_from_text(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("12",), ("12.5",), ("x",), ("",), (None,)], "x string")
        assert rows(
            df.select(
                C.to_int(F.col("x")),
                C.to_money(F.col("x")).cast("double"),
                C.to_coordinate(F.col("x")).cast("double"),
            )
        ) == [(12, 12.0, 12.0), (None, 12.5, 12.5)] + [(None, None, None)] * 3
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_days_count_midnights(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2017-01-02 00:01:00' AS a, timestamp_ntz'2017-01-01 23:59:00' AS b"
    )
    assert rows(df.select(C.days_between(F.col("a"), F.col("b")))) == [(1,)]


def test_hours_ignore_daylight_saving(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2017-03-12 06:00:00' AS a, timestamp_ntz'2017-03-11 23:10:30' AS b"
    )
    assert rows(df.select(C.hours_between(F.col("a"), F.col("b")))) == [(6.83,)]


def test_date_key_and_month(spark):
    df = spark.sql("SELECT timestamp_ntz'2017-03-12 23:59:59' AS t").select(
        C.date_key(F.col("t")).alias("k")
    )
    assert rows(df.select("k", C.month_of("k"))) == [(20170312, 201703)]


def test_not_blank_is_never_null(spark):
    df = spark.createDataFrame([("x",), ("  ",), (None,)], "x string")
    assert rows(df.select(C.not_blank(F.col("x")))) == [(True,), (False,), (False,)]


def test_exact_ratio_rounds_half_up(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 8), (-1, 8), (2, 3), (1, 0) t(a, b)")
    assert rows(df.select(C.exact_ratio(F.col("a"), F.col("b"), 2))) == [
        (0.13,),
        (-0.13,),
        (0.67,),
        (None,),
    ]


@pytest.mark.parametrize(
    "bands, above, expected",
    [
        (
            VOLUME_BANDS,
            "EXTRA_LARGE",
            {
                999: "SMALL",
                1000: "MEDIUM",
                9999: "MEDIUM",
                10000: "LARGE",
                49999: "LARGE",
                50000: "EXTRA_LARGE",
                None: "UNKNOWN",
            },
        ),
        (
            WEIGHT_BANDS,
            "VERY_HEAVY",
            {
                499: "LIGHT",
                500: "MEDIUM",
                1999: "MEDIUM",
                2000: "HEAVY",
                9999: "HEAVY",
                10000: "VERY_HEAVY",
                None: "UNKNOWN",
            },
        ),
    ],
)
def test_bands(spark, bands, above, expected):
    df = spark.createDataFrame([(x,) for x in expected], "x bigint")
    banded = C.banded(F.col("x"), bands, above=above, missing="UNKNOWN")
    assert dict(rows(df.select("x", banded))) == expected


def test_regions(spark):
    expected = {"SP": "SUDESTE", "RS": "SUL", "DF": "CENTRO-OESTE", "MA": "NORDESTE", "TO": "NORTE"}
    expected |= {"XX": "OUTROS", None: "OUTROS"}
    df = spark.createDataFrame([(x,) for x in expected], "x string")
    region = C.first_match(F.col("x"), REGIONS, default="OUTROS")
    assert dict(rows(df.select("x", region))) == expected
    assert sum(len(states) for states in REGIONS.values()) == 27
