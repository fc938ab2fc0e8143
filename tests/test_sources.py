import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from smelter.sources.csv import read_csv
from smelter.sources.messages import from_kafka_records, kafka_stream
from smelter.sources.tables import Layer, summary
from smelter.specs import ORDER_ITEMS, ORDER_REVIEWS, SOURCE_TABLES, topics
from tests.helpers import bag, rows


def test_csv_types_and_malformed_rows(spark, folder):
    Path(folder, "items.csv").write_text(
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2017-09-19 09:45:35,58.90,13.29\n"
        "o2,2,p2,s2,,,\n"
        "o3,x,p3,s3,2017-09-19 09:45:35,1.00,1.00\n"
        "o4,4,p4\n"
        "o5,5,p5,s5,2017-09-19 09:45:35,1.00,1.00,extra\n"
    )
    good, bad = read_csv(spark, folder, ORDER_ITEMS)
    assert bag(good) == {
        ("o1", 1, "p1", "s1", dt.datetime(2017, 9, 19, 9, 45, 35), Decimal("58.90"), Decimal("13.29")): 1,
        ("o2", 2, "p2", "s2", None, None, None): 1,
    }
    # Counting uses no column, and still sees the same rows.
    assert good.count() == 2 and bad.count() == 3
    assert good.select("order_id").count() == 2
    assert sorted(r[0] for r in rows(bad))[0].startswith("o3,x,p3")


def test_csv_text_with_line_breaks_and_quotes(spark, folder):
    Path(folder, "reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,"say ""hi""","two\nlines, one field",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
        "r2,o2,4,,,2018-01-18 00:00:00,2018-01-18 21:46:59\n"
    )
    good, bad = read_csv(spark, folder, ORDER_REVIEWS)
    assert rows(good.select("review_id", "review_comment_title", "review_comment_message").orderBy("review_id")) == [
        ("r1", 'say "hi"', "two\nlines, one field"),
        ("r2", None, None),
    ]
    assert bad.count() == 0


def test_kafka_columns(spark):
    records = spark.sql(
        "SELECT 't' AS topic, 3 AS partition, 7L AS offset, CAST('{}' AS BINARY) AS value"
    )
    assert rows(from_kafka_records(records)) == [("t", 3, 7, "{}")]
    with pytest.raises(ValueError, match="topic or a pattern"):
        kafka_stream(spark, "host:9092")
    with pytest.raises(ValueError, match="max_offsets_per_trigger"):
        kafka_stream(spark, "host:9092", topic="t")


def test_topics_carry_a_prefix():
    assert set(topics("shop.public.")) == {f"shop.public.{t}" for t in SOURCE_TABLES}


@pytest.fixture
def layer(spark, folder):
    made = Layer(spark, f"layer_{abs(hash(folder))}", f"{folder}/layer")
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS {made.database} CASCADE")


def test_replace_changes_schema_and_keeps_open_readers(spark, layer):
    first = layer.replace("t", spark.range(3))
    layer.replace("t", spark.range(5).selectExpr("id", "id * 2 AS twice"))
    assert first.count() == 3  # a reader of the old version is undisturbed
    assert layer.read("t").count() == 5
    assert layer.read("t").columns == ["id", "twice"]


def test_replace_from_itself(spark, layer):
    layer.replace("t", spark.range(3))
    layer.replace("t", layer.read("t").union(layer.read("t")))
    assert layer.read("t").count() == 6


def test_failed_write_leaves_the_table(spark, layer):
    layer.replace("t", spark.range(3))
    broken = spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        layer.replace("t", broken)
    assert layer.read("t").count() == 3


def test_partitioned_replace_with_key(spark, layer):
    df = spark.range(100).selectExpr("id", "CAST(id % 3 AS INT) AS month")
    stored = layer.replace("t", df, partition_by="month", unique="sk")
    assert stored.filter("month = 1").count() == 33
    low, distinct = stored.agg(F.min("sk"), F.countDistinct("sk")).first()
    assert low == 1 and distinct == 100


def test_append_creates_then_adds_and_never_overwrites(spark, layer):
    layer.append("t", spark.range(3))
    layer.append("t", spark.range(2))
    assert layer.read("t").count() == 5
    with pytest.raises(Exception):
        layer.append("t", spark.range(2).select(F.raise_error(F.lit("no")).alias("id")))
    assert layer.read("t").count() == 5


def test_append_follows_a_replace(spark, layer):
    layer.replace("t", spark.range(3))
    layer.append("t", spark.range(2))
    assert layer.read("t").count() == 5
    layer.replace("p", spark.range(6).selectExpr("id", "id % 2 AS part"), partition_by="part")
    layer.append("p", spark.range(2).selectExpr("id", "7 + id AS part"))
    assert layer.read("p").count() == 8 and layer.read("p").filter("part = 8").count() == 1


def test_a_failed_entry_keeps_the_old_one(spark, layer, folder):
    layer.replace("t", spark.range(3))
    with pytest.raises(Exception):
        layer.register("t", f"{folder}/nowhere")
    assert layer.read("t").count() == 3 and layer.tables() == ["t"]


def test_old_versions_expire_on_request(spark, layer):
    for n in (1, 2, 3):
        layer.replace("t", spark.range(n))
    assert layer.expire("t") == 2
    assert layer.expire("t") == 0
    assert layer.read("t").count() == 3


def test_layer_summary_marks_missing_tables(spark, layer):
    layer.replace("t", spark.range(3))
    assert bag(layer.summary(["t", "u"])) == {("t", 3, "OK"): 1, ("u", None, "ERROR"): 1, ("TOTAL", 3, "OK"): 1}


def test_register_goes_on_after_a_failure(spark, layer, folder):
    spark.range(4).write.parquet(f"{folder}/good")
    registered, failed = layer.register_all({"good": f"{folder}/good", "gone": f"{folder}/gone"})
    assert registered == ["good"] and set(failed) == {"gone"}
    assert layer.tables() == ["good"]
    assert layer.read("good").count() == 4


def test_summary(spark):
    counted = summary({"a": spark.range(3), "b": None, "c": spark.range(0), "TOTAL?": spark.range(1)})
    assert bag(counted) == {
        ("a", 3, "OK"): 1,
        ("b", None, "ERROR"): 1,
        ("c", 0, "OK"): 1,
        ("TOTAL?", 1, "OK"): 1,
        ("TOTAL", 4, "OK"): 1,
    }
