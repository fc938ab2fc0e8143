import pytest

from smelter.llm import queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def prepared(spark):
    queries.prepare(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns that clash with results."""

    def make(rows, parts=3):
        full = [(*r[:2], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(parts)
        return df.selectExpr(
            "*", "1 AS size", "'x' AS digest", "2 AS kept", "3 AS chunk", "4 AS shard", "5 AS target", "6 AS score", "7 AS n_tokens"
        )

    return make


LONG = " ".join(f"w{i % 977}" for i in range(40_000))

NASTY = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b "),
    (None, "some text without an id"),
    (4, LONG),
    (5, "a row that comes twice"),
    (5, "a row that comes twice"),
    (6, "a row  that\tcomes twice"),
    (7, "non breaking\xa0space and 💡 signs"),
    (8, "one"),
]
