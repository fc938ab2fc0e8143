import re
from collections import Counter, defaultdict

import pytest

from smelter.llm import divergence
from tests.llm.conftest import LONG

FEW = divergence.Audit(least_docs=2)
ROW = "text string, lang string, source string"


def brute(rows, audit):
    rows = [tuple(x or "" for x in r) for r in rows]
    found = [
        (lang, source, Counter("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in re.findall(divergence.TERM, text)))
        for text, lang, source in rows
    ]
    groups = sorted({(lang, source) for lang, source, _ in found})
    docs, n = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in found:
        docs[lang].update(terms.keys())
        n[lang, source] += terms
        n[lang] += terms
    out = []
    for lang, source in groups:
        kept = [t for t, c in docs[lang].items() if c >= audit.least_docs]

        def share(key):
            total = sum(n[key][t] for t in kept)
            return {t: 1 + audit.scale * (n[key][t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = share((lang, source)), share(lang)
        pairs = []
        for other in [s for g, s in groups if g == lang and s != source]:
            o = share((lang, other))
            pairs.append((-sum((p[t] - o[t]) ** 2 // (p[t] + o[t]) for t in kept), other.encode(), other))
        terms = [
            (-((p[t] - q[t]) ** 2 // (p[t] + q[t])), t.encode(), t) for t in kept if n[lang, source][t] > 0 and p[t] > q[t]
        ]
        out += [(lang, source, "pair", s, -v, r) for r, (v, _, s) in enumerate(sorted(pairs), 1)]
        out += [(lang, source, "term", t, -v, r) for r, (v, _, t) in enumerate(sorted(terms)[: audit.top], 1)]
    return sorted(out)


def audited(spark, rows, audit, parts=3):
    df = spark.createDataFrame(rows, ROW).repartition(parts).selectExpr("*", "1 AS block", "2 AS term", "3 AS n", "4 AS docs")
    return sorted(tuple(r) for r in divergence.audit(df, audit).collect())


ODD = [
    ("Alpha beta, gamma-delta\talpha", "en", "a"),
    ("alpha BETA\x00beta\x7fgamma éÉ ÀÀ", "en", "a"),
    ("beta non\xa0breaking 💡💡 éÉ x", "en", "b"),
    ("beta non\xa0breaking ßß x1y2 @[`{", "en", "b"),
    ("delta", "en", None),
    (None, "en", "none"),
    ("", None, "a"),
    ("lone words", None, None),
    ("only once", "fr", "a"),
    ("nothing kept here", "fr", "b"),
    (LONG, "de", "long"),
    (LONG, "de", "long"),
    ("W1 w", "de", "short"),
    ("same text twice", "es", "a"),
    ("same text twice", "es", "a"),
]


@pytest.mark.parametrize("block", [8_000_000, 40])
def test_against_brute_force(spark, block):
    """With a block per document chunks recur in every block, and a term spans cells."""
    audit = divergence.Audit(least_docs=2, block_bytes=block, cell_terms=3)
    assert audited(spark, ODD, audit) == brute(ODD, audit)


def test_least_documents_counts_documents_not_occurrences(spark):
    rows = [("word word word, Word", "en", "a"), ("other", "en", "b")]
    got = audited(spark, rows, FEW)
    assert got == brute(rows, FEW)
    assert [r for r in got if r[2] == "term"] == []
    assert [r[4] for r in got if r[2] == "pair"] == [0, 0]


def test_a_term_in_two_chunks_of_a_document_is_one_document(spark):
    rows = [("term term, (TERM)", "en", "a"), ("x", "en", "a")]
    assert audited(spark, rows, FEW) == []
    assert audited(spark, rows, divergence.Audit(least_docs=1)) == brute(rows, divergence.Audit(least_docs=1))


def test_empty_table_and_large_counts(spark):
    assert divergence.audit(spark.createDataFrame([], ROW)).count() == 0
    big = spark.createDataFrame([(3 * 10**10, 4 * 10**10, 7)], "n long, total long, terms long")
    share = big.select(divergence._share("n", "total", "terms", 10**9)).first()[0]
    assert share == 1 + 10**9 * (3 * 10**10 + 2) // (4 * 10**10 + 14)
