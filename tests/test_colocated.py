"""Look-ups into dimensions that are stored bucketed by business key."""

import random

import pytest
from pyspark.sql import functions as F

from smelter.operators.joins import heavy_keys, look_up
from smelter.operators.keys import UNKNOWN_KEY
from smelter.plans import build
from smelter.sources.tables import Layer
from tests.helpers import bag, plan

SETTINGS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def below_join(text, scan):
    """What is done to a scan before it is joined, per place it is read."""
    lines = text.split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if scan in line and "Scan" in line:
            above, at = [], depth[i]
            for j in reversed(range(i)):
                if depth[j] < at:
                    at = depth[j]
                    if "Join" in lines[j]:
                        break
                    above.append(lines[j])
            found.append("\n".join([*reversed(above), line]))
    return found


@pytest.fixture
def large(spark):
    """Tables are too large to broadcast."""
    before = {name: spark.conf.get(name, None) for name in [*SETTINGS, "spark.sql.shuffle.partitions"]}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def products(spark, folder):
    """A stored dimension of 40 members and the unknown one, in 4 buckets."""
    layer = Layer(spark, f"colocated_{abs(hash(folder))}", f"{folder}/gold")
    rows = [(UNKNOWN_KEY, "UNKNOWN"), (0, "\x001"), *[(i, f"p{i}") for i in range(1, 40)]]
    dim = spark.createDataFrame(rows, "product_sk long, product_id string")
    return layer.load_bucketed(layer.stage_bucketed("dim_product", dim, 4, ["product_id"]))


def items(spark, seed=1, number=600):
    rng = random.Random(seed)
    kinds = ["p7", "p7", "p8", None, "UNKNOWN", "gone", *[f"p{i}" for i in range(40)]]
    rows = [(i // 3, rng.choice(kinds)) for i in range(number)]
    return rows, spark.createDataFrame(rows, "order_id int, product_id string")


@pytest.mark.parametrize("partitions", ["2", "4", "16"])
@pytest.mark.parametrize("rows_per_task", [15, 1_000_000])
def test_only_the_rows_are_shuffled(spark, large, products, partitions, rows_per_task):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    _, df = items(spark)
    heavy = heavy_keys(df, ["product_id"], rows_per_task)["product_id"]
    assert bool(heavy) == (rows_per_task == 15)
    found = look_up(df, products, "product_id", "product_id", "product_sk", heavy=heavy)
    places = below_join(plan(found), "dim_product__")
    # With heavy keys their few members are read a second time, for a broadcast.
    assert places and all("Exchange hash" not in p and "Exchange range" not in p for p in places)
    assert any("Bucketed: true" in p and "BroadcastExchange" not in p for p in places)


@pytest.mark.parametrize("rows_per_task", [15, 60, 1_000_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_heavy_and_unknown_keys_change_no_row(spark, products, rows_per_task, seed):
    rows, df = items(spark, seed)
    rows += [(900, "\x001")]
    df = df.unionByName(spark.createDataFrame(rows[-1:], df.schema))
    heavy = heavy_keys(df, ["product_id"], rows_per_task)["product_id"]
    found = look_up(df, products, "product_id", "product_id", "product_sk", alias="sk", heavy=heavy)
    known = {f"p{i}": i for i in range(1, 40)} | {"\x001": 0}
    assert bag(found.select("order_id", "product_id", "sk")) == bag(df.rdd.map(lambda r: (*r, known.get(r[1], UNKNOWN_KEY))))


def test_no_rows_and_no_members(spark, products):
    _, df = items(spark)
    heavy = heavy_keys(df, ["product_id"], 15)["product_id"]
    assert look_up(df.limit(0), products, "product_id", "product_id", "product_sk", heavy=heavy).count() == 0
    none = look_up(df, products.limit(0), "product_id", "product_id", "product_sk", heavy=heavy)
    assert {r.product_sk for r in none.collect()} == {UNKNOWN_KEY} and none.count() == df.count()


def test_a_heavy_key_is_spread_over_tasks(spark, large, products):
    """Half of all rows have one key; no task of the look-up gets more than its share."""
    df = spark.range(40_000).selectExpr("CAST(id AS int) AS order_id", "IF(id % 2 = 0, 'p7', concat('p', id % 40)) AS product_id")
    heavy = heavy_keys(df, ["product_id"], 1000)["product_id"]
    found = look_up(df.repartition(8), products, "product_id", "product_id", "product_sk", heavy=heavy)
    sizes = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes) < 20_000 and sum(sizes) == 40_000
    assert found.filter("product_id = 'p7' AND product_sk != 7").isEmpty()


def test_facts_read_the_built_dimensions_where_they_are(spark, stored, folder, large):
    tag = abs(hash(folder))
    for table in build.SOURCE_TABLES:
        stored.silver(table)
    # The stored layer has views only for what was asked for so far; all are there now.
    gold = Layer(spark, f"cogold_{tag}", f"{folder}/gold")
    build.build_gold(stored.silver_layer, gold, buckets=4)
    at = gold.snapshot()
    for partitions in ("2", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        text = plan(build.fact("fact_order_items", stored.silver, at.read))
        for table in ("dim_product", "dim_customer"):
            places = below_join(text, f"{table}__")
            assert places and all("Exchange" not in p and "Bucketed: true" in p for p in places), places
    for table, key in build.LOOKED_UP.items():
        dim = at.read(table)
        members = dim.filter(F.col(dim.columns[0]) != UNKNOWN_KEY)  # a member may be called like the unknown one
        assert members.groupBy(key).count().filter("count > 1").isEmpty()
        assert bag(dim.select(key)) == bag(stored.gold(table).select(key))
