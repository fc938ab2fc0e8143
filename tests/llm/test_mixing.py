import hashlib
from collections import Counter, defaultdict

import pytest

from smelter.llm import mixing
from tests.llm.conftest import NASTY
from tests.llm.test_debruijn import split


def expected(rows, mix):
    rows = [(i, len(split(t)), s) for i, t, s in rows]
    size = Counter()
    for _, n, s in rows:
        size[s] += n
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(names)}
    total, open_, target = mix.share * sum(size.values()), set(names), {}
    while open_:
        level = total / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= mix.epochs * size[s]}
        for s in full or open_:
            target[s] = min(mix.epochs * size[s], weight[s] * level)
            total -= target[s]
        open_ -= full or open_
    key = lambda r: (hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest(), r[1])
    out, before = [], defaultdict(int)
    for i, n, s in sorted(rows, key=key):
        whole = int(target[s] // size[s]) if size[s] else 0
        taken = whole + (2 * before[s] + n <= 2 * (target[s] - whole * size[s]) + 1e-9)
        out.append((i, n, size[s], round(target[s], 6), n * min(taken, mix.epochs)))
        before[s] += n
    return sorted(out, key=str)


def actual(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


SOURCES = [(i, "w " * (i % 17 + 1), f"src{i % 7 if i % 2 else 0}") for i in range(300)] + [(900, "a b c", None), (901, "d", "\U0001f600"), (902, "e", "￿")]


@pytest.mark.parametrize("mix", [mixing.Mix(), mixing.Mix((5, 1), 0.4, 1), mixing.Mix((1, 2, 3, 4), 2.9, 3)])
def test_plan_against_brute_force(documents, mix):
    assert actual(mixing.plan(documents(SOURCES), mix)) == expected(SOURCES, mix)


def test_sources_come_near_their_targets_and_reruns_agree(documents):
    rows = mixing.plan(documents(SOURCES)).collect()
    taken, largest, target = Counter(), Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - t) <= largest[s] / 2 for s, t in target.items())
    assert actual(mixing.plan(documents(SOURCES, parts=7))) == actual(mixing.plan(documents(SOURCES)))


def test_the_mix_repeats_documents(documents):
    docs = documents(SOURCES)
    want = {r.doc_id: r.copies for r in mixing.plan(docs).collect() if r.copies}
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    assert Counter(r.doc_id for r in mix.collect()) == want


def test_odd_rows(documents):
    rows = [(*r, s) for r, s in zip(NASTY, ["a", "a", None, "b", "b", "a", "a", None, "c", "c"])]
    assert actual(mixing.plan(documents(rows))) == expected(rows, mixing.Mix())
    empty = [(1, None, "a"), (2, "", None)]
    assert actual(mixing.plan(documents(empty))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.plan(documents(rows).limit(0)).count() == 0
    assert mixing.mixed(documents(rows).limit(0)).count() == 0
