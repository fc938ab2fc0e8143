from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from smelter.llm import packing, queries
from smelter.llm.words import table
from tests.llm.conftest import NASTY

PATH = queries.BYTE_TOKENIZER


def check(pieces, docs, window=1024):
    """Every id in one piece, sequences gapless and within the window; returns the lengths of the sequences."""
    library = Tokenizer.from_file(PATH)
    want = sorted(
        [(i is None, i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 0])) for i, t in docs], key=repr
    )
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        by_doc[p.doc_id].append((p.start, tuple(ids), p.doc_tokens))
        sequences[p.sequence_id].append((p.offset, p.length))
    got = []
    for i, parts in by_doc.items():
        copies = sum(start == 0 for start, _, _ in parts)
        whole, at = [], 0
        for start, ids, total in sorted(parts)[::copies]:
            assert start == at
            whole += ids
            at += len(ids)
        assert all(total == at for _, _, total in parts)
        got += [(i is None, i, tuple(whole))] * copies
    assert sorted(got, key=repr) == want
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        lengths.append(at)
    return np.array(lengths)


def padding(lengths, window=1024):
    return np.where(lengths & (lengths - 1), window - lengths, 0).sum() / lengths.sum()


def test_odd_documents(documents):
    special = [(20, "a <|endoftext|> b"), (21, "it's 12 o'clock\r\n\t x　y \u0085é𝒜"), (22, "ab" * 3000)]
    rows = [*NASTY, *special]
    check(packing.pack(documents(rows), PATH).collect(), rows)


def test_all_documents_with_little_padding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lengths = check(packing.pack(docs.coalesce(1), PATH).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert padding(lengths) < 0.02


def test_small_windows_and_groups(documents):
    rows = [(i, "lorem ipsum dolor " * (i % 37)) for i in range(300)]
    small = packing.Packing(window=64, group=50, fine=3)
    lengths = check(packing.pack(documents(rows), PATH, small).collect(), rows, 64)
    assert padding(lengths, 64) < 0.05


def test_no_documents(documents):
    assert packing.pack(documents(NASTY).limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_differencing_gives_near_equal_windows(seed):
    sizes = np.random.default_rng(seed).integers(1, 200, 400)
    window = packing.differencing(sizes, 20)
    sums = np.bincount(window, sizes, minlength=20)
    assert len(sums) == 20 and sums.max() - sums.min() <= 2


def plain_differencing(sizes, windows):
    """The greatest window by the textbook: whole tuples, every step."""
    parts = [sorted([int(s)] + [0] * (windows - 1)) for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[-1] - p[0])
        a, b = parts.pop(), parts.pop()
        parts.append(sorted(x + y for x, y in zip(a, reversed(b))))
    return parts[0][-1] - parts[0][0]


@pytest.mark.parametrize("windows", [1, 2, 3, 7, 30])
def test_spread_is_that_of_the_plain_method(windows):
    sizes = np.random.default_rng(windows).permutation(np.arange(3, 3 + 7 * 40, 7)) ** 2  # no ties between spreads
    window = packing.differencing(sizes, windows)
    sums = np.bincount(window, sizes, minlength=windows)
    assert sums.max() - sums.min() == plain_differencing(sizes, windows)


def test_more_windows_when_one_is_too_full():
    sizes = np.array([700] * 9)  # the sum asks for 7 windows of 1,024, the items for 9
    window = packing.pack_sizes(sizes, 1024)
    assert np.bincount(window, sizes).max() == 700 and window.max() == 8


def test_one_item_and_equal_items():
    assert packing.pack_sizes(np.array([5]), 1024).tolist() == [0]
    window = packing.pack_sizes(np.array([256] * 8), 1024)
    assert np.bincount(window).tolist() == [4, 4]
