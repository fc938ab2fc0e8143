import math
import random
from collections import Counter

import numpy as np
import pytest

from smelter.llm import minhash
from tests.llm.conftest import NASTY
from tests.llm.test_debruijn import split


def vectors(rows):
    out = []
    for _, t in rows:
        w = split(t)
        out.append(Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else []))
    df = Counter(k for s in out for k in s)
    rare = {k: round(255 * (1 - math.log(n) / math.log(max(len(rows), 2)))) for k, n in df.items()}
    return [{k: c * (1 + rare[k] / 255) for k, c in s.items()} for s in out]


def similarity(a, b):
    common = sum(min(w, b[k]) for k, w in a.items() if k in b)
    return common / (sum(a.values()) + sum(b.values()) - common) if a and b else 0.0


def expected(rows, least=0.8):
    v, parent = vectors(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or similarity(v[i], v[j]) >= least:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    head = {k: min((x for x in g if x is not None), default=None) for k, g in groups.items()}
    return sorted(((rows[i][0], head[find(i)], len(groups[find(i)])) for i in range(len(rows))), key=str)


def actual(df):
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def near_copies():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, passage = [], [word() for _ in range(60)]
    for base in range(12):
        text = [word() for _ in range(rng.randint(40, 300))] + (passage if base % 2 else [])
        for _ in range(30 if base == 0 else rng.randint(1, 5)):
            copy = list(text)
            for _ in range(rng.randint(0, len(copy) // 60)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


def test_classes_against_brute_force(documents, near_copies):
    assert actual(minhash.classes(documents(near_copies))) == expected(near_copies)


def test_large_buckets_meet_their_centres(documents, near_copies):
    near = minhash.Near(all_pairs=1, per_task=3)
    assert actual(minhash.classes(documents(near_copies), near)) == expected(near_copies)


def test_odd_rows(documents):
    docs = documents(NASTY)
    assert actual(minhash.classes(docs)) == expected(NASTY)
    left = minhash.one_of_each(docs)
    assert left.columns == docs.columns
    assert left.count() == len({(r[1], r[2]) for r in expected(NASTY)})
    assert minhash.classes(docs.limit(0)).count() == 0


def test_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 600).astype(np.uint64)
    one, two = keys[:450], keys[150:]
    a, b = rng.integers(1, 4, 450).astype(float), rng.integers(1, 4, 450).astype(float)
    drawn = [minhash.samples(k, w, np.array([0]), 4000)[0] for k, w in ((one, a), (two, b))]
    common = np.minimum(a[150:], b[:300]).sum()
    assert abs((drawn[0] == drawn[1]).mean() - common / (a.sum() + b.sum() - common)) < 0.03


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (3, 30), (30, 31), (4, 40)]
    got = {r.no: r.label for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 30: 1, 31: 1, 5: 5, 6: 5, 7: 5, 8: 5, 9: 5, 4: 4, 40: 4}


def spread(n, words, changed, seed):
    """Texts of one template, each with a passage of its own somewhere: few of them are similar enough."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        text, at = [f"w{j}" for j in range(words)], rng.randrange(words - changed)
        text[at : at + changed] = [f"v{i}x{j}" for j in range(changed)]
        rows.append((i, " ".join(text)))
    return rows


def revisions(n, words, changed):
    """Texts of which each replaces the next words of the one before, so that the first and the last are unlike."""
    text, rows = [f"w{i}" for i in range(words)], []
    for i in range(n):
        rows.append((i, " ".join(text)))
        for j in range(changed):
            text[(i * changed + j) % words] = f"v{i}x{j}"
    return rows


@pytest.mark.parametrize("near", [minhash.Near(), minhash.Near(all_pairs=2, per_task=3, held=1500)])
def test_members_of_large_buckets_that_are_unlike_the_centres(documents, near):
    rows = spread(120, 300, 12, 1)
    assert actual(minhash.classes(documents(rows), near)) == expected(rows)


def test_revisions_are_one_class(documents):
    rows = revisions(60, 200, 4)
    near = minhash.Near(all_pairs=1, per_task=5)
    assert actual(minhash.classes(documents(rows), near)) == expected(rows)
