from pyspark.sql import functions as F

from tests.helpers import bag, plan
from verification import derive

SPREAD = "RoundRobinPartitioning"


def lines(spark, n=200):
    number = F.col("id").cast("int")
    return spark.range(n).select(
        F.col("id").alias("l_orderkey"),
        (F.col("id") % 7).alias("l_partkey"),
        (F.col("id") % 3).alias("l_suppkey"),
        number.alias("l_linenumber"),
        F.lit(1.5).alias("l_quantity"),
        F.lit(2.5).alias("l_extendedprice"),
        F.lit("1996-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )


def test_a_table_in_a_part_per_core_is_not_shuffled(spark, folder):
    """A small file is dealt over the cores; one that all cores read already is left as it is, with the same rows."""
    cores = spark.sparkContext.defaultParallelism
    small, large = f"{folder}/small", f"{folder}/large"
    lines(spark).coalesce(1).write.parquet(f"{small}/lineitem.parquet")
    lines(spark).repartition(4 * cores).write.parquet(f"{large}/lineitem.parquet")
    for place in (small, large):  # not read for the lines, although their columns are named like it
        spark.range(1).coalesce(1).write.parquet(f"{place}/part.parquet")
    logs = [derive.messages(spark, place, "order_items") for place in (small, large)]
    assert [SPREAD in plan(log) for log in logs] == [cores > 1, False]
    assert bag(logs[0]) == bag(logs[1]) and logs[0].count() == 200


def test_events_in_a_part_per_core_are_not_shuffled(spark, folder):
    cores = spark.sparkContext.defaultParallelism
    spark.range(100).repartition(4 * cores).write.parquet(f"{folder}/events.parquet")
    assert SPREAD not in plan(derive.spread_out(derive.given(spark, folder, "events")))
