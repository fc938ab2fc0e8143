import zlib
from collections import Counter, defaultdict

import pytest

from smelter.llm import queries, sharding
from tests.llm.conftest import NASTY


def test_sizes_checksums_and_slots(documents):
    rows = sharding.shard(documents(NASTY), [1.0] * 3).collect()
    bodies = defaultdict(list)
    for i, t in NASTY:
        bodies[i].append((t or "").encode())
    for r in rows:
        assert (r.size, r.text_crc32) in [(len(b) + 16, zlib.crc32(b)) for b in bodies[r.doc_id]]
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append((r.slot, r.doc_id))
    for held in slots.values():
        assert sorted(s for s, _ in held) == list(range(len(held)))
        ids = [i for _, i in sorted(held)]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert len({r.shard for r in rows if r.doc_id == 5}) == 1


def ids(spark, n):
    return spark.range(n).selectExpr("id AS doc_id", "'t' AS text")


def test_a_new_shard_takes_rows_only_into_itself(spark):
    rows = sharding.shard(ids(spark, 4000), [1.0] * 8).collect()
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {8}
    assert 300 < len(moved) < 600  # a ninth
    grown = {r.doc_id: r.shard for r in sharding.shard(ids(spark, 4000), [1.0] * 9).collect()}
    assert grown == {r.doc_id: r.grown_shard for r in rows}
    again = {r.doc_id: r.shard for r in sharding.shard(ids(spark, 4000).repartition(5), [1.0] * 8).collect()}
    assert again == {r.doc_id: r.shard for r in rows}


def test_weights(spark):
    counts = Counter(r.shard for r in sharding.shard(ids(spark, 4000), [1.0, 0.0, 3.0]).collect())
    assert counts[1] == 0 and 2.6 < counts[2] / counts[0] < 3.4
    with pytest.raises(ValueError):
        sharding.shard(ids(spark, 1), [0.0])


def test_no_rows(documents):
    assert sharding.shard(documents(NASTY).limit(0), [1.0]).count() == 0


def test_query(spark, sf_dir):
    rows = queries.QUERIES["op10_sharding"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.shard < 40 and r.grown_shard in (r.shard, 40) and r.law == "key" for r in rows)
