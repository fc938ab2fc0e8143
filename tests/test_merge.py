from smelter.operators.merge import absent_rows, first_per_key, insert_if_absent
from tests.helpers import bag

COLUMNS = "id string, at int, text string"


def test_first_row_wins_and_existing_rows_stay(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("d", 1, "x"), ("d", 2, "y")], COLUMNS)
    incoming = spark.createDataFrame(
        [("a", 5, "new"), ("b", 7, "second"), ("b", 6, "first"), ("c", 1, "c")], COLUMNS
    )
    assert bag(absent_rows(target, incoming, ["id"], ["at"])) == {
        ("b", 6, "first"): 1,
        ("c", 1, "c"): 1,
    }
    merged = insert_if_absent(target, incoming, ["id"], ["at"])
    assert merged.count() == 5
    again = insert_if_absent(merged, incoming, ["id"], ["at"])
    assert bag(again) == bag(merged)


def test_null_keys_conflict_with_nothing(spark):
    target = spark.createDataFrame([(None, 1, "x")], COLUMNS)
    incoming = spark.createDataFrame([(None, 2, "y"), (None, 3, "z")], COLUMNS)
    assert insert_if_absent(target, incoming, ["id"], ["at"]).count() == 3


def test_first_per_key_keeps_column_order(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early")], COLUMNS)
    first = first_per_key(df.select("text", "at", "id"), ["id"], ["at"])
    assert bag(first) == {("early", 1, "a"): 1}
