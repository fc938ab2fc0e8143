import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer as Reference

from smelter.llm import bpe, queries
from tests.llm.conftest import NASTY


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(queries.TOKENIZER)


@pytest.fixture(scope="module")
def reference():
    return Reference.from_file(queries.TOKENIZER)


def texts(seed, n):
    rng = random.Random(seed)
    letters = "aàéßÉΣσςİıIñ'sтtеЖ中文12٣½ \t\n\x85\xa0 ​.,!?-_<>|/w\x1c\x00😀é̈ﬁǅ"
    words = ["the", "Hello", "<|endoftext|>", "<|startoftext|>", "don't", "I'LL", "international", "zzzzzzzz", "aaaaaaa"]
    pick = lambda: rng.choice(letters) if rng.random() < 0.6 else rng.choice(words)
    mixed = ["".join(pick() for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return mixed + ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 30))) for _ in range(n)]


def test_ids_and_text_equal_the_library(own, reference):
    cases = texts(1, 4000) + ["", "a" * 5000, "ab" * 3000, "Σ" * 9]
    for text, ids, want in zip(cases, own.encode(cases), reference.encode_batch(cases, add_special_tokens=False)):
        assert ids.tolist() == want.ids, text
        assert own.decode(ids) == reference.decode(want.ids, skip_special_tokens=False)


def test_a_full_cache_starts_anew(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    small = bpe.Tokenizer(queries.TOKENIZER)
    cases = texts(2, 300)
    for at in range(0, len(cases), 7):
        got = small.encode(cases[at : at + 7])
        want = reference.encode_batch(cases[at : at + 7], add_special_tokens=False)
        assert [g.tolist() for g in got] == [w.ids for w in want]


def test_compatible_pairs_are_those_that_stay(own):
    rng = np.random.default_rng(0)
    tokens = [t for t in own.vocab if not t.startswith("<|")]
    first = [t for t in rng.choice(tokens, 6000) if not t.endswith(bpe.WORD_END)]
    second = [t for t in rng.choice(tokens, 9000) if t.endswith(bpe.WORD_END)]
    pairs = list(zip(first, second))
    got = own.compatible(*(np.array([own.vocab[p[i]] for p in pairs]) for i in (0, 1)))
    flat, sizes = own.merge([a + b.removesuffix(bpe.WORD_END) for a, b in pairs])
    ends = np.cumsum(sizes)
    for (a, b), good, end, size in zip(pairs, got, ends, sizes):
        assert good == (flat[end - size : end].tolist() == [own.vocab[a], own.vocab[b]])
    assert 0 < got.sum() < len(got)


def test_documents(documents, reference):
    rows = [r for r in bpe.decode(bpe.encode(documents(NASTY), queries.TOKENIZER), queries.TOKENIZER).collect()]
    have = sorted((r.doc_id or 0, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in rows)
    want = []
    for i, text in NASTY:
        ids = reference.encode(text or "", add_special_tokens=False).ids
        want.append((i or 0, len(ids), ids, reference.decode(ids, skip_special_tokens=False)))
    assert have == sorted(want)
    assert bpe.encode(documents(NASTY).limit(0), queries.TOKENIZER).count() == 0


def test_query(spark, sf_dir, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.QUERIES["op2_bpe"](spark, sf_dir).collect():
        ids = reference.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        text = reference.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
