import random

import pytest

from smelter.llm import debruijn
from tests.llm.conftest import NASTY

WORDS = " \t\n\x0b\x0c\r"


def split(text):
    return [w for w in "".join(" " if c in WORDS else c for c in text or "").split(" ") if w]


def expected(rows, k):
    last = float("inf")
    order = lambda i: last if i is None else i
    docs = [(i, split(t)) for i, t in rows]
    first = {}
    for i, w in docs:
        for s in range(len(w) - k + 1):
            key = tuple(w[s : s + k])
            first[key] = min(first.get(key, last), order(i))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for s in range(len(w) - k + 1):
            if first[tuple(w[s : s + k])] < order(i):
                gone[s : s + k] = [True] * k
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def actual(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("k", [1, 2, 5, 13])
def test_against_brute_force(documents, k):
    rng = random.Random(k)
    text = lambda n: " ".join(rng.choice(["a", "b", "c\td", "é", "long"]) + str(rng.randrange(9)) for _ in range(n))
    passages = [text(k), text(k + 20), text(max(k - 1, 1)), "x " * (3 * k)]
    rows = [(rng.randrange(25), f"{text(rng.randint(0, 20))} {rng.choice(passages)}\n{text(rng.randint(0, 20))}") for _ in range(40)]
    rows += [(30, rows[0][1]), (None, rows[1][1]), (None, rows[1][1])]
    assert actual(debruijn.dedup(documents(rows), k)) == expected(rows, k)


def test_odd_rows(documents):
    assert actual(debruijn.dedup(documents(NASTY), 4)) == expected(NASTY, 4)
    assert debruijn.dedup(documents(NASTY).limit(0)).count() == 0


def test_paths_end_at_branches(documents):
    trunk = [f"t{i}" for i in range(30)]
    rows = [(1, " ".join(trunk)), (2, " ".join([*trunk[:20], "left", *trunk[:20]])), (3, " ".join([*trunk[:20], "right"]))]
    got = {r.doc_id: [tuple(p) for p in r.paths] for r in debruijn.dedup(documents(rows, 1), 4).collect()}
    # Windows 0 to 16 occur in all three; what follows the last differs, and only document 2 repeats them itself.
    assert got[1] == [(0, 20)] and got[3] == [(0, 20)]
    assert got[2] == [(0, 20), (21, 41)]
