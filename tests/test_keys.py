import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from smelter.operators import keys
from tests.helpers import bag, plan, rows


@pytest.fixture(scope="module")
def hashed(spark):
    """Distinct hash-like business keys in no order."""
    return spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("bk"), "id")


@pytest.mark.parametrize("partitions", [1, 4, 50])
def test_dense_key_equals_row_number(spark, hashed, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        keyed = keys.assign_dense_key(hashed.repartition(partitions), ["bk"], "sk")
        expected = hashed.select(
            F.row_number().over(Window.orderBy("bk")).cast("long").alias("sk"), "bk", "id"
        )
        assert keyed.columns == ["sk", "bk", "id"]
        assert bag(keyed) == bag(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_dense_key_of_nothing(spark, hashed):
    assert keys.assign_dense_key(hashed.limit(0), ["bk"], "sk").count() == 0


def test_dense_key_numbers_only_partitions_in_one_task(spark, hashed):
    """The one window without partitions adds up partition sizes, never rows of the table."""
    text = plan(keys.assign_dense_key(hashed, ["bk"], "sk"))
    (window,) = [line for line in text.splitlines() if "+- Window [" in line or ": Window [" in line]
    assert "_size" in window and "bk" not in window


def test_unique_key(spark):
    df = spark.range(0, 1000, 1, 7).select(keys.unique_key().alias("sk"))
    low, distinct = df.agg(F.min("sk"), F.countDistinct("sk")).first()
    assert low == 1 and distinct == 1000


def test_unknown_member(spark):
    df = spark.createDataFrame([(1, "a", 5)], "sk bigint, bk string, n int")
    with_unknown = keys.with_unknown_member(df, "sk", {"bk": "UNKNOWN"})
    assert bag(with_unknown) == {(1, "a", 5): 1, (-1, "UNKNOWN", None): 1}
    assert with_unknown.schema.simpleString() == df.schema.simpleString()
    assert bag(keys.known_members(with_unknown, "sk")) == {(1, "a", 5): 1}


def test_or_unknown(spark):
    df = spark.createDataFrame([(3,), (None,)], "sk int")
    assert rows(df.select(keys.or_unknown(F.col("sk")))) == [(3,), (-1,)]
