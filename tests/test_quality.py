from smelter.operators import quality
from smelter.plans.rules import RULES, SILVER_KEYS, validate_silver
from smelter.specs import SOURCE_TABLES
from tests.helpers import plan, rows

SELECT = ("check_name", "checked", "violations", "unknown", "violation_pct", "passed")


def report(df, kind):
    found = df.filter(f"check_kind = '{kind}'").select(*SELECT)
    return {r[0]: r[1:] for r in rows(found)}


def test_one_table(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.5), ("a", 1, float("nan")), (None, 2, -1.0), (None, 2, None), ("b", 3, 0.0)],
        "k string, part int, x double",
    )
    result = quality.validate(df, "t", ["k", "part"], {"x isn't negative": "x >= 0"})
    assert report(result, "rows") == {"has rows": (5, 0, 0, 0.0, True)}
    assert report(result, "null_key") == {
        "k": (5, 2, 0, 40.0, False),
        "part": (5, 0, 0, 0.0, True),
    }
    assert report(result, "null_profile")["x"] == (5, 2, 0, 40.0, False)
    # NULL key parts compare as equal; a NULL condition is unknown, not violated.
    assert report(result, "duplicate") == {"k, part": (5, 2, 0, 40.0, False)}
    assert report(result, "rule") == {"x isn't negative": (5, 1, 1, 20.0, False)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string")
    result = quality.validate(df, "t", ["k"], {"rule": "k = 'a'"})
    assert {r[1:] for r in rows(result.select(*SELECT))} == {(0, 0, 0, None, False)}


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("a",), ("x",), ("x",), (None,)], "ref string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    result = quality.orphan_check(child, "child", "ref", parent, "id")
    assert rows(result.select(*SELECT)) == [("ref", 5, 2, 1, 40.0, False)]


def test_column_checks_shuffle_one_row_per_task(spark):
    df = spark.range(10).selectExpr("id", "id % 3 AS k")
    text = plan(quality.column_checks(df, "t", ["id"], {"r": "k > 0"}))
    assert text.count("Exchange") == 1 and "SinglePartition" in text


def test_every_table_has_rules_and_keys(stored):
    assert set(RULES) == set(SILVER_KEYS) == set(SOURCE_TABLES)
    for table in SOURCE_TABLES:
        checked = validate_silver(table, stored.silver(table))
        assert checked.filter("check_kind = 'duplicate' AND NOT passed").count() == 0
        assert checked.filter("check_kind = 'null_key' AND NOT passed").count() == 0


def test_sample(spark):
    assert quality.sample_rows(spark.range(100)).count() == 5
