import pytest

from verification.compare import difference
from verification.oracle import ORACLE
from verification.queries import QUERIES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(spark, sf_dir, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
