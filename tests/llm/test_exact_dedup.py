from collections import defaultdict

import pytest

from smelter.llm import exact_dedup, queries
from smelter.scratch import scratch_path
from tests.llm.conftest import NASTY
from tests.llm.test_debruijn import split


@pytest.fixture
def index(spark):
    made = queries.new_index(spark)
    yield made
    spark.sql(f"DROP TABLE {made.table}")


def test_odd_rows(documents, index):
    rows = index.add(documents(NASTY), "one").collect()
    groups = defaultdict(list)
    for i, t in NASTY:
        groups["".join(split(t))].append((-len(t or ""), i is None, i or 0))
    best = {k: min(v) for k, v in groups.items()}
    have = {(r.doc_id, r.keep_id, r.group_size) for r in rows}
    want = {
        (i, None if best[k][1] else best[k][2], len(groups[k])) for i, t in NASTY for k in ["".join(split(t))]
    }
    assert have == want
    assert len(rows) == len(NASTY) and sum(r.kept for r in rows) == len(groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_a_second_batch_meets_the_index(spark, documents, index):
    first = index.new_documents(documents([(1, "a b"), (2, "ab"), (3, "c")]), "one")
    assert sorted(r.doc_id for r in first.collect()) == [1, 3]
    assert first.columns == documents([(1, "a")]).columns
    again = exact_dedup.DigestIndex(spark, index.table + "_again", index.path)
    second = again.add(documents([(4, "a  b  "), (5, "d"), (6, "d")]), "two").collect()
    assert {r.doc_id: (r.keep_id, r.kept) for r in second} == {4: (1, False), 5: (5, True), 6: (5, False)}
    assert sorted(r.keep_id for r in spark.read.parquet(index.path).collect()) == [1, 3, 5]
    spark.sql(f"DROP TABLE {again.table}")


def test_the_index_is_bucketed_and_joined_without_moving_it(spark, documents, index):
    index.add(documents(NASTY), "one")
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {index.table}").collect()}
    assert described["Bucket Columns"] == described["Sort Columns"] == "[`digest`]"


def test_no_rows(documents, index):
    assert index.add(documents(NASTY).limit(0), "none").count() == 0
    assert index.new_documents(documents(NASTY).limit(0), "none").count() == 0
    assert scratch_path(index.spark, "x")
