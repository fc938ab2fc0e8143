import pytest
from pyspark.sql import functions as F

from smelter.operators import joins
from smelter.operators.joins import Heavy, heavy_keys, look_up, spread_join
from tests.helpers import bag, plan, rows


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: a third under one key, a tenth under NULL, many exact copies."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("key"),
        (F.col("id") % 4).alias("n"),
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.sql(
        "SELECT * FROM VALUES ('hot', 1), ('k1', 2), ('k2', 3), ('none', 4) t(key, label)"
    )


def splits(heavy):
    return dict(rows(heavy.table))


def test_heavy_keys_are_found_with_their_splits(spark, skewed):
    found = heavy_keys(skewed, ["key", "n"], rows_per_task=150)
    assert splits(found["key"]) == {"hot": 7, None: 2}
    assert splits(found["n"]) == {0: 5, 1: 5, 2: 5, 3: 5}
    assert not heavy_keys(skewed, ["key"], rows_per_task=10_000)["key"]


def test_every_heavy_key_is_found(spark):
    many = spark.range(20_000).selectExpr("id % 1000 AS key")
    assert splits(heavy_keys(many, ["key"], rows_per_task=19)["key"]) == {i: 2 for i in range(1000)}
    # Twenty keys just over the bound among eight million rows of other keys.
    few = spark.range(8_000_000).selectExpr("CASE WHEN id < 40000 THEN id % 20 ELSE id END AS key")
    assert set(splits(heavy_keys(few, ["key"], rows_per_task=1000)["key"])) == set(range(20))


def test_heavy_keys_of_nothing(spark, skewed):
    assert not heavy_keys(skewed.limit(0), ["key"])["key"]


@pytest.fixture(scope="module")
def heavy(spark):
    return lambda **keys: Heavy(
        spark.createDataFrame([(None if k == "null" else k, n) for k, n in keys.items()], "_key string, _splits int")
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spreading_the_left_changes_no_row(spark, skewed, dim, how, heavy):
    expected = skewed.join(dim, "key", how)
    result = spread_join(skewed, dim, "key", how, heavy_left=heavy(hot=7, k1=3, null=4))
    assert result.columns == expected.columns
    assert bag(result) == bag(expected)


@pytest.mark.parametrize("left, right", [("hot", "hot"), ("", "hot"), ("hot", "k2")])
def test_spreading_both_sides_keeps_every_pair_once(spark, skewed, dim, left, right, heavy):
    left, right = (heavy(**{k: 5, "k1": 3, "null": 4}) if k else Heavy() for k in (left, right))
    many = dim.crossJoin(spark.range(5).withColumnRenamed("id", "copy"))
    expected = skewed.join(many, "key")
    result = spread_join(skewed, many, "key", heavy_left=left, heavy_right=right)
    assert bag(result) == bag(expected)


def test_numeric_keys_spread_too(spark):
    left = spark.range(100).selectExpr("id % 3 AS key", "id")
    right = spark.range(3).selectExpr("id AS key", "id * 10 AS label")
    heavy = heavy_keys(left, ["key"], rows_per_task=10)["key"]
    assert set(splits(heavy)) == {0, 1, 2}
    assert bag(spread_join(left, right, "key", heavy_left=heavy)) == bag(left.join(right, "key"))


def test_heavy_rows_land_in_several_partitions(spark, skewed, dim, heavy):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(skewed, dim, "key", "left", heavy_left=heavy(hot=64, null=64))
        spread = joined.withColumn("at", F.spark_partition_id())
        assert spread.filter("key = 'hot'").select("at").distinct().count() > 2
        assert spread.filter("key IS NULL").select("at").distinct().count() > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_heavy_key_means_a_plain_join(spark, skewed, dim):
    assert "_salt" not in plan(spread_join(skewed, dim, "key", "left"))


def test_unsupported_joins(spark, skewed, dim, heavy):
    with pytest.raises(ValueError):
        spread_join(skewed, dim, "key", "full")
    with pytest.raises(ValueError):
        spread_join(skewed, dim, "key", "left", heavy_right=heavy(hot=2))


def test_look_up_gives_the_key_or_unknown(spark):
    dim = spark.createDataFrame(
        [(1, "a"), (2, "UNKNOWN"), (-1, "UNKNOWN")], "sk bigint, code string"
    )
    facts = spark.createDataFrame([("a",), ("UNKNOWN",), ("zz",), (None,)], "ref string")
    found = look_up(facts, dim, "ref", "code", "sk", alias="ref_sk")
    # A code that reads UNKNOWN meets its own row and not the unknown member.
    assert bag(found) == {("a", 1): 1, ("UNKNOWN", 2): 1, ("zz", -1): 1, (None, -1): 1}
    assert dict(found.dtypes)["ref_sk"] == "bigint"


def test_size_decides_the_strategy(spark, skewed, dim):
    """Without a hint Spark broadcasts under its threshold and shuffles above it."""
    small = spread_join(skewed, dim, "key", "left")
    assert "BroadcastHashJoin" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "SortMergeJoin" in plan(spread_join(skewed, dim, "key", "left"))
        assert rows(small.groupBy().count()) == [(3000,)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_keys_of_crowded_places_are_counted(spark, monkeypatch):
    plans, written = [], joins.written

    def noted(df, label):
        plans.append((label, df._jdf.queryExecution().optimizedPlan().toString()))
        return written(df, label)

    monkeypatch.setattr(joins, "written", noted)
    unique = spark.range(1000).selectExpr("CAST(id AS STRING) AS k", "id AS other")
    assert not any(joins.heavy_keys(unique, ["k", "other"], 100).values())
    assert [label for label, _ in plans] == ["crowded", "crowded"]  # no count by key
    plans.clear()
    hot = spark.range(450).selectExpr("CASE WHEN id < 250 THEN 'hot' END AS k", "id AS other")
    found = joins.heavy_keys(unique.unionByName(hot), ["k"], 100)["k"]
    assert bag(found.table) == {("hot", 3): 1, (None, 2): 1}
    (plan,) = [plan for label, plan in plans if label == "heavy"]
    assert "LeftSemi" in plan
