import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from smelter.llm import queries, toxicity
from tests.llm.conftest import NASTY


def corpus(n=400):
    """Texts with and without bad words, some of them known by their beginning only."""
    rng = random.Random(4)
    syllables = "ka lo mi tu re sa ni po".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    bad = lambda: rng.choice(["villain", "Rascal!", "gruzzel" + word()])
    docs, labels = [], []
    for i in range(n):
        words, toxic = [word() + rng.choice(["", "", "."]) for _ in range(rng.randint(3, 60))], rng.random() < 0.3
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words)), bad())
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    queries.prepare(spark)
    docs, labels = corpus()
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    train = spark.createDataFrame([x for x, h in zip(labels, held) if not h] + [(None, 1), (3, None)], "doc_id long, toxic int")
    return docs, labels, held, toxicity.learn(df, train)


def test_held_out_documents(spark, fitted):
    docs, labels, held, field = fitted
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r.doc_id: r for r in toxicity.score(df, field).collect()}
    right = [(rows[i].score >= 0.5) == bool(y) for (i, y), h in zip(labels, held) if h]
    assert len(right) > 50 and np.mean(right) > 0.95
    texts = dict(docs)
    found = {texts[i][s.start : s.end].lower()[:6] for i, r in rows.items() for s in r.spans}
    assert found and found <= {"villai", "rascal", "gruzze"}


def test_odd_rows_and_equal_texts(documents, fitted):
    field = fitted[3]
    rows = toxicity.score(documents([*NASTY, (20, "a villain"), (21, "a villain")]), field).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(NASTY) + 2 and all(0 <= r.score <= 1 for r in rows)
    assert by_id[1].score == by_id[2].score == by_id[3].score and by_id[1].spans == []
    assert by_id[20].score == by_id[21].score >= 0.5
    assert toxicity.score(documents(NASTY).limit(0), field).count() == 0
    clean = toxicity.clean(documents([*NASTY, (20, "a villain")]), field)
    assert clean.columns == documents(NASTY).columns and clean.count() == len(NASTY)


@pytest.mark.parametrize("labels", [[], [(5, 0)], [(5, 1)]])
def test_too_few_labels(spark, documents, labels):
    field = toxicity.learn(documents(NASTY), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert all(0 <= r.score <= 1 and r.spans == [] for r in toxicity.score(documents(NASTY), field).collect())


@pytest.mark.parametrize("piece", [1, 2, 3, toxicity.PIECE])
def test_marginals_against_all_paths(piece):
    rng = np.random.default_rng(2)
    step, score = rng.normal(size=(2, 2)), rng.normal(size=7)
    begins = np.array([True, False, False, False, True, False, True])
    _, _, got = toxicity.marginals(np.exp(score), begins, step, piece)
    for chain in ([0, 1, 2, 3], [4, 5], [6]):
        total, ones = 0.0, np.zeros(len(chain))
        for path in np.ndindex(*[2] * len(chain)):
            weight = np.exp(sum(score[i] * s for i, s in zip(chain, path)) + sum(step[a, b] for a, b in zip(path, path[1:])))
            total, ones = total + weight, ones + weight * np.array(path)
        assert np.allclose(got[chain], ones / total)


def test_query_ignores_held_out_labels(spark, sf_dir):
    rows = queries.QUERIES["op3_toxicity"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == (r.score >= 0.5)
    kept = queries.toxic_labels(spark, sf_dir).select("doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in kept)


def test_pieces_of_a_chain_are_the_whole_chain():
    rng = np.random.default_rng(5)
    odds, begins = np.exp(rng.normal(-2, 4, 3000)), rng.random(3000) < 0.004
    begins[0] = True
    step = np.array([[2.0, -3.0], [-1.5, 1.0]])
    whole = toxicity.marginals(odds, begins, step, 10_000)
    for piece in (1, 7, 64, toxicity.PIECE):
        for got, expected in zip(toxicity.marginals(odds, begins, step, piece), whole):
            assert np.allclose(got, expected, rtol=1e-9)


def test_words_far_into_an_unpunctuated_text_are_one_chain():
    t = toxicity.tokens(pa.array(["w " * 1000 + "end. next", None, ""]))
    assert np.flatnonzero(t.begins).tolist() == [0, 1001] and t.counts.tolist() == [1002, 0, 0]
    assert np.flatnonzero(toxicity.cut(t.begins, 400)).tolist() == [0, 400, 800, 1001]


def test_the_fit_is_the_same_in_a_task_and_here(spark, fitted):
    docs, labels, held, field = fitted
    kept = [(d, y) for d, (_, y), h in zip(docs, labels, held) if not h and d[0] != 3]
    again = toxicity.learn(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
        spark.createDataFrame([(d[0], y) for d, y in kept] + [(3, labels[3][1])] * (not held[3]), "doc_id long, toxic int"),
    )
    assert np.array_equal(field.weights, again.weights) and np.array_equal(field.document, again.document)
    here = toxicity.fitted(pa.array([d[1] for d, _ in kept]), np.array([y == 1 for _, y in kept]), toxicity.Fit())
    assert np.allclose(here.step, field.step, atol=0.2) and len(here.weights) == len(field.weights)
