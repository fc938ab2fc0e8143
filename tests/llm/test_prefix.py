import random

from smelter.llm.prefix import prefix_sums


def test_sums_of_earlier_rows_of_a_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "hot", "hot", "hot"]), i, rng.randrange(9)) for i in range(700)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int, n long")
    got = {(r.g, r.i): r.before for r in prefix_sums(df, ["g"], ["i"], {"before": "n"}).collect()}
    sums = {}
    for g, i, n in sorted(rows, key=lambda r: r[1]):
        assert got[g, i] == sums.get(g, 0)
        sums[g] = sums.get(g, 0) + n


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, i int, n long")
    assert prefix_sums(df, [], ["i"], {"before": "n"}).count() == 0
