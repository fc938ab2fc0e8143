import random

import pytest

from smelter.operators.merge import insert_if_absent
from smelter.sources.tables import Layer
from smelter.sources.unique import KeyRegistry, UniqueTable
from smelter.sources.versions import Conflict
from tests.helpers import bag, plan, rows

ROW = "k string, n int, v string"


def only_one_exchange(spark, make):
    """That of what comes in, where the stored side is too large to broadcast, whatever the number of partitions."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for partitions in ("2", "16"):
            for name, value in zip(names, (partitions, "-1")):
                spark.conf.set(name, value)
            text = plan(make())
            assert text.count("Exchange") == 1 and "Bucketed: true" in text
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.fixture
def layer(spark, folder):
    made = Layer(spark, f"unique_{abs(hash(folder))}", f"{folder}/layer")
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS {made.database} CASCADE")


@pytest.fixture
def table(layer):
    return UniqueTable(layer, "t", ["k", "n"], buckets=3)


def test_inserts_equal_the_plain_operator(spark, table):
    rng, target = random.Random(4), spark.createDataFrame([], ROW)
    for step in range(3):
        made = [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None]), f"v{step}-{i}") for i in range(25)]
        incoming = spark.createDataFrame(made, ROW)
        before = target.count()
        target = spark.createDataFrame(rows(insert_if_absent(target, incoming, ["k", "n"], ["v"])), ROW)
        assert table.insert(incoming, ["v"]) == target.count() - before
        assert bag(table.read()) == bag(target)
    assert table.insert(spark.createDataFrame([("a", 1, "again")], ROW), ["v"]) == 0
    assert table.read().columns == ["k", "n", "v"]


def test_first_insert_of_nothing(spark, table):
    assert table.insert(spark.createDataFrame([], ROW), ["v"]) == 0
    assert table.read().count() == 0
    assert table.insert(spark.createDataFrame([("a", 1, "x")], ROW), ["v"]) == 1


def test_stored_rows_are_not_rewritten_and_the_index_is_not_shuffled(spark, layer, table):
    table.insert(spark.createDataFrame([(str(i), i, "x") for i in range(50)], ROW), ["v"])
    files = set(table.read().inputFiles())
    table.insert(spark.createDataFrame([(str(i), i, "y") for i in range(40, 60)], ROW), ["v"])
    assert files < set(table.read().inputFiles())
    incoming = spark.createDataFrame([("1", 1, "z")], ROW)
    only_one_exchange(spark, lambda: table.index.absent(layer.snapshot(), incoming))


def test_the_same_rows_inserted_twice_at_a_time(spark, table, monkeypatch):
    """Both inserts start from the same table: one is stored, the other a conflict, and repeated it adds nothing."""
    incoming = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], ROW)
    real = Layer.publish

    def late(self, *a, **k):
        monkeypatch.setattr(Layer, "publish", real)
        assert table.insert(incoming, ["v"]) == 2
        return real(self, *a, **k)

    monkeypatch.setattr(Layer, "publish", late)
    with pytest.raises(Conflict):
        table.insert(incoming, ["v"])
    assert table.insert(incoming, ["v"]) == 0
    assert bag(table.read()) == {("a", 1, "x"): 1, ("b", 2, "y"): 1}


def test_an_insert_that_dies_adds_nothing(spark, table, monkeypatch):
    table.insert(spark.createDataFrame([("a", 1, "x")], ROW), ["v"])

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Layer, "_release", die)
        with pytest.raises(RuntimeError):
            table.insert(spark.createDataFrame([("b", 1, "y")], ROW), ["v"])
    assert rows(table.read()) == [("a", 1, "x")]
    assert table.insert(spark.createDataFrame([("b", 1, "y")], ROW), ["v"]) == 1


def members(spark, *names):
    return spark.createDataFrame([(n, f"about {n}") for n in names], "name string, note string")


def test_registered_members_keep_their_keys(spark, layer):
    registry = KeyRegistry(layer, "people", "name", "sk", buckets=3)
    first = bag(registry.assign(members(spark, "b", "d", None)))
    assert first == {(1, "b", "about b"): 1, (2, "d", "about d"): 1}
    assert bag(registry.assign(members(spark, "c", "a", "d"))) == {(4, "c", "about c"): 1, (3, "a", "about a"): 1, (2, "d", "about d"): 1}
    assert bag(registry.assign(members(spark, "b", "e"))) == {(1, "b", "about b"): 1, (5, "e", "about e"): 1}  # b came back
    assert registry.assign(members(spark).limit(0)).count() == 0


def test_a_registry_starts_from_a_dimension(spark, layer):
    dim = spark.createDataFrame([(-1, "UNKNOWN"), (7, "x"), (3, "y")], "sk long, name string")
    registry = KeyRegistry(layer, "people", "name", "sk", buckets=3)
    assert {(r.name, r.sk) for r in registry.assign(members(spark, "x", "z"), dim).collect()} == {("x", 7), ("z", 8)}
    assert {(r.name, r.sk) for r in registry.assign(members(spark, "y"), None).collect()} == {("y", 3)}


def test_the_registry_is_read_by_bucket(spark, layer):
    registry = KeyRegistry(layer, "people", "name", "sk", buckets=3)
    registry.assign(members(spark, *map(str, range(30))))
    only_one_exchange(spark, lambda: registry.assign(members(spark, "1", "2")))
