import numpy as np
import pytest

from smelter.llm import hard_negatives as hn
from pyspark.sql import functions as F


def brute(rows, is_anchor, mining=hn.Mining()):
    def fits(i, label, v):
        return i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)

    kept = [(i, y, [int(np.floor(mining.units * float(x))) for x in v]) for i, y, v in rows if fits(i, y, v)]
    out = []
    for a, y, v in [r for r in kept if is_anchor(r[0])]:
        scored = [(-sum(map(int.__mul__, v, w)), i, z) for i, z, w in kept if len(w) == len(v)]
        positives = sorted((s, i) for s, i, z in scored if z == y and i != a)[: mining.positives]
        for p, pid in positives:
            hard = sorted(
                (s, i)
                for s, i, z in scored
                if z != y and mining.least[0] * -p <= mining.least[1] * -s and mining.most[1] * -s <= mining.most[0] * -p
            )
            out += [(a, pid, r, i, -p, -s) for r, (s, i) in enumerate(hard[: mining.negatives], 1)]
    return sorted(out)


def frame(spark, rows):
    made = spark.createDataFrame(rows, "vec_id long, label int, vector array<float>").repartition(3)
    return made.selectExpr("*", "1 AS row", "2 AS lane", "3 AS score", "4 AS rank", "5 AS dim")


def mined(spark, rows, mining=hn.Mining()):
    return sorted(tuple(r) for r in hn.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, mining).collect())


def tenth(i):
    return i % 10 == 0


def clustered(n, labels, seed, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    return [(i, i % labels, (centres[(i * 7) % labels] + rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_over_many_lanes_and_slabs(spark, seed):
    rows = clustered(900, 4, seed)
    small = hn.Mining(lane_rows=200, slab_rows=20, clusters=5)
    assert mined(spark, rows, small) == brute(rows, tenth, small)


def test_odd_rows_ties_and_dimensions(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, i % 3, [1.0, float(i % 2), -0.5]) for i in range(60)]  # many equal scores
    rows += [(100, 0, None), (110, None, [1.0, 1.0, 1.0]), (None, 0, [1.0, 1.0, 1.0]), (120, 0, [nan, 1.0, 1.0])]
    rows += [(130, 1, [inf, 0.0, 0.0]), (140, 1, [None, 1.0, 1.0]), (150, 2, [0.0, 0.0, 0.0]), (151, 1, [0.0, 0.0, 0.0])]
    rows += [(160, 1, [1.0, 1.0]), (161, 1, [1.0, 0.9]), (162, 2, [0.9, 0.95]), (170, 1, []), (171, 1, []), (172, 0, [])]
    rows += [(180, 5, [2.0, 2.0, 2.0]), (31, 1, [1.0, 1.0, -0.5])]  # an only row of its label; a row that comes twice
    assert mined(spark, rows) == brute(rows, tenth)


def test_negative_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 2, (-np.abs(rng.normal(size=4)) if i % 10 else np.abs(rng.normal(size=4))).tolist()) for i in range(80)]
    assert mined(spark, rows) == brute(rows, tenth)


def test_large_whole_numbers_are_exact_and_overflow_is_an_error(spark):
    rows = [(i, i % 2, [3e5 + i, 1.0 + i]) for i in range(30)]
    assert mined(spark, rows) == brute(rows, tenth)
    with pytest.raises(Exception, match="OverflowError|too large"):
        mined(spark, [(i, i % 2, [1e30, 1.0]) for i in range(30)])


def test_no_rows(spark):
    assert mined(spark, clustered(5, 2, 1)[1:]) == []
    assert hn.mine(frame(spark, clustered(5, 2, 1)).limit(0), F.lit(True)).count() == 0


def test_lists_end_early():
    """Members of a tight cluster stop once the bound certifies their result."""
    rng = np.random.default_rng(4)
    vectors = np.floor(256 * rng.normal(size=(20_000, 8)))
    anchors = np.floor(256 * (np.ones((5, 8)) + 0.01 * rng.normal(size=(5, 8))))
    calls = []
    plain = hn.inner_products

    def counted(a, c):
        calls.append(len(c))
        return plain(a, c)

    hn.inner_products = counted
    try:
        low, high = np.full((5, 1), hn.LEAST), np.full((5, 1), hn.MOST)
        allowed = np.ones((5, 20_000), bool)
        centre = np.ones(8) / 8**0.5
        (found,) = hn.walk(anchors, vectors, allowed, low, high, 5, centre, np.arange(20_000))
    finally:
        hn.inner_products = plain
    best = np.sort(plain(anchors, vectors), axis=1)[:, ::-1][:, :5]
    assert found[3].reshape(5, 5).tolist() == best.tolist()
    assert sum(calls) < 5_000
