import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from smelter.llm import chunks, kneser_ney, queries
from smelter.llm.words import remainder
from tests.llm.conftest import NASTY
from tests.llm.test_debruijn import split

BEGIN, END = "<begin>", "<end>"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def fold(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 7


class Plain:
    """The same model from dictionaries of words."""

    def __init__(self, texts):
        self.pairs, self.words = Counter(), Counter()
        for t in texts:
            tokens = [*split(lower(t)), END]
            self.words.update(tokens)
            self.pairs.update(zip([BEGIN, *tokens], tokens))
        self.after, self.before, self.context = defaultdict(Counter), Counter(), Counter()
        for (v, w), c in self.pairs.items():
            self.after[v][min(c, 3)] += 1
            self.before[w] += 1
            self.context[v] += c
        self.d = self.discounts(Counter(self.pairs.values()))
        self.e = self.discounts(Counter(self.before.values()))
        self.n, self.v = sum(self.words.values()), len(self.words)
        kinds = Counter(min(a, 3) for a in self.before.values())
        self.rest = sum(self.e[i] * kinds[i] for i in (1, 2, 3)) / max(len(self.pairs), 1)

    @staticmethod
    def discounts(n):
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        raw = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.75 * i for i in (1, 2, 3)]
        return [0, *(min(max(d, 0.1), i - 0.05) for i, d in enumerate(raw, 1))]

    def word(self, w):
        pairs = len(self.pairs)
        if not pairs:
            return 1 / (self.v + 1)
        return max(self.before[w] - self.e[min(self.before[w], 3)], 0) / pairs + self.rest / (self.v + 1)

    def pair(self, v, w):
        total = self.context[v]
        if not total:
            return self.word(w)
        c = self.pairs[v, w]
        free = sum(self.d[i] * self.after[v][i] for i in (1, 2, 3)) / total
        return max(c - self.d[min(c, 3)], 0) / total + free * self.word(w)

    def score(self, text):
        tokens = [*split(lower(text)), END]
        base = sum(math.log10((self.words[w] + 1) / (self.n + self.v + 1)) for w in tokens)
        known = sum(self.words[w] > 0 for w in tokens)
        return len(tokens), known, self.n, base, sum(math.log10(self.pair(v, w)) for v, w in zip([BEGIN, *tokens], tokens))


def check(rows, got):
    plain = Plain([t for i, t in rows if fold(i) != 2])
    want = sorted(((i, *plain.score(t)) for i, t in rows), key=str)
    have = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=str)
    assert [h[:4] for h in have] == [w[:4] for w in want]
    for h, w in zip(have, want):
        assert h[4:] == pytest.approx(w[4:], rel=1e-9, abs=1e-9)
    return plain


def learnt(docs):
    staged = chunks.stage(docs, remainder(F.col("doc_id"), 7) != 2, chunk_bytes=2000)
    model, counts = kneser_ney.learn(staged)
    return staged, model, counts


def random_rows(seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "The", "a", "é", "of"]) if rng.random() < 0.5 else f"w{int(rng.expovariate(0.02))}"
    return [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(150)]


def test_scores_against_a_plain_model(documents):
    rows = random_rows() + NASTY
    staged, model, counts = learnt(documents(rows))
    plain = check(rows, kneser_ney.score(staged, model, counts).collect())
    # Looking the pairs up in the stored arrays gives the same.
    check(rows, kneser_ney.score(staged, model).collect())
    for v in ("the", "w3", BEGIN, "never seen"):
        everything = sum(plain.pair(v, w) for w in plain.words) + plain.pair(v, "unknown")
        assert everything == pytest.approx(1)


def test_texts_the_model_has_not_seen(documents):
    _, model, _ = learnt(documents(random_rows()))
    plain = Plain([t for i, t in random_rows() if fold(i) != 2])
    fresh = [(1, "the of strange words"), (2, None), (3, "a")]
    rows = kneser_ney.score(chunks.stage(documents(fresh)), model).collect()
    for r in rows:
        assert (r.base_score, r.score) == pytest.approx(plain.score(dict(fresh)[r.doc_id])[3:])


def test_no_training_documents_and_no_rows(documents):
    rows = [(i, "a b") for i in range(200) if fold(i) == 2][:3]
    staged, model, counts = learnt(documents(rows))
    check(rows, kneser_ney.score(staged, model, counts).collect())
    staged, model, counts = learnt(documents(rows).limit(0))
    assert kneser_ney.score(staged, model, counts).count() == 0


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op9_language_model"](spark, sf_dir).collect()
    check([tuple(r) for r in rows], got)
    assert all(r.held_out == (fold(r.doc_id) == 2) for r in got)
