import numpy as np

from smelter.llm import ann


def brute(vectors, queries, k):
    usable = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    rows = [(i, np.array(v, float)) for i, v in vectors if i is not None and usable(v)]
    out = []
    for q, v in [(i, np.array(v, float)) for i, v in queries if i is not None and usable(v)]:
        near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out += [(q, r, i, round(s, 9)) for r, (s, i) in enumerate(near, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, vector array<float>").repartition(3)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect())


def test_recall_and_order_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 32))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=32)).astype(np.float32).tolist()) for i in range(3000)]
    asked = [r for r in rows if r[0] % 50 == 0]
    got = found(ann.search_all(frame(spark, rows), frame(spark, asked), ann.Search(block=500, query_block=16)))
    want = brute(rows, asked, 10)
    assert len(got) == len(want)
    recall = len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) / len(want)
    assert recall >= 0.99


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, float(i % 3)]) for i in range(40)]
    rows += [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [nan, 1.0, 1.0]), (104, [inf, 1.0, 1.0])]
    rows += [(105, [None, 1.0, 1.0]), (None, [1.0, 2.0, 0.0]), (106, [1.0, 2.0]), (107, [3.0, 2.0]), (7, [1.0, 2.0, 1.0])]
    asked = [rows[0], rows[7], *rows[40:47], (106, [1.0, 2.0])]
    assert found(ann.search_all(frame(spark, rows), frame(spark, asked))) == brute(rows, asked, 10)


def test_fewer_candidates_and_no_rows(spark):
    two = [(1, [1.0, 0.0]), (2, [0.0, 1.0])]
    assert found(ann.search_all(frame(spark, two), frame(spark, two[:1]))) == [(1, 1, 2, round(2**0.5, 9))]
    none = frame(spark, two).limit(0)
    assert ann.search_all(none, none).count() == 0
    assert ann.search_all(frame(spark, two), none).count() == 0


def test_vectors_whose_squares_exceed_single_precision(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rng.normal(size=(60, 8)))]
    rows += [(100 + i, (3e38 * v).astype(np.float32).tolist()) for i, v in enumerate(rng.uniform(-1, 1, size=(20, 8)))]
    rows += [(200, [3e38] * 8)]
    asked = [*rows[:5], *rows[60:65], rows[-1]]
    places = lambda out: [x[:3] for x in out]
    assert places(found(ann.search_all(frame(spark, rows), frame(spark, asked)))) == places(brute(rows, asked, 10))
