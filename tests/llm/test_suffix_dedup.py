import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from smelter.llm import byte_dedup, queries, suffixes
from tests.llm.conftest import NASTY


def naive_windows(strings, width):
    seen = Counter(s[i : i + width] for s in strings for i in range(len(s) - width + 1))
    return [[seen[s[i : i + width]] > 1 for i in range(len(s) - width + 1)] for s in strings]


@pytest.mark.parametrize("held", [suffixes.HELD, 10])
def test_windows_against_brute_force(held, monkeypatch):
    monkeypatch.setattr(suffixes, "HELD", held)  # 10: queues go to disk
    rng = random.Random(held)
    for _ in range(150):
        letters, width, strings = rng.choice([1, 2, 3, 26, 256]), rng.choice([1, 2, 3, 5, 17]), []
        for _ in range(rng.randint(1, 6)):
            s = bytes(rng.randrange(letters) for _ in range(rng.randint(0, 60)))
            if strings and rng.random() < 0.5:
                other = rng.choice(strings)
                s = s[:20] + other[rng.randint(0, len(other)) :] + s[20:]
            strings.append(s)
        got = suffixes.repeated_windows(b"".join(strings), np.array([len(s) for s in strings]), width)
        assert [g.tolist() for g in got] == naive_windows(strings, width)


def expected(rows, width):
    bodies = [(i, (t or "").encode()) for i, t in rows]
    out = []
    for (i, body), found in zip(bodies, naive_windows([b for _, b in bodies], width)):
        gone = np.zeros(len(body), bool)
        for at in np.flatnonzero(found):
            gone[at : at + width] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        spans = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        out.append((i, len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def actual(df):
    return sorted(
        (
            (r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], hashlib.sha256(bytes(r.kept)).hexdigest())
            for r in df.collect()
        ),
        key=str,
    )


@pytest.mark.parametrize("width, most", [(20, 2000), (20, 1), (100, 3), (400, 2000), (400, 1)])
def test_dedup_against_brute_force(documents, width, most):
    rng = random.Random(width)
    text = lambda n: "".join(rng.choice("ab é") for _ in range(n))
    passages = [text(width + 300), text(width), text(width - 1), "z" * (2 * width)]
    rows = [(i, text(rng.randint(0, 200)) + rng.choice(passages) + text(rng.randint(0, 200))) for i in range(40)]
    rows += [(100 + i, rows[3][1]) for i in range(3)] + [(200, None), (201, ""), (None, rows[5][1])]
    assert actual(byte_dedup.dedup(documents(rows), width, most)) == expected(rows, width)


def test_odd_rows(documents, spark):
    rows = [(i, t if t is None or len(t) < 9000 else t[:9000]) for i, t in NASTY]
    assert actual(byte_dedup.dedup(documents(rows), 10)) == expected(rows, 10)
    assert byte_dedup.dedup(documents([]).limit(0)).count() == 0


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in queries.QUERIES["op1_suffix_dedup"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    for i, n_bytes, n_removed, spans, kept in expected([tuple(r) for r in docs], 400):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n_bytes, n_removed, len(spans), kept)
