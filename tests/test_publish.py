import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from smelter.sources.tables import Layer, Parts
from smelter.sources.versions import Conflict, Versions
from tests.helpers import rows


@pytest.fixture
def layer(spark, folder):
    made = Layer(spark, f"publish_{abs(hash(folder))}", f"{folder}/layer")
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS {made.database} CASCADE")


def test_versions_follow_each_other_and_conflict(spark, folder):
    versions = Versions(spark, f"{folder}/v")
    assert versions.latest() == (0, {})
    assert versions.follow(0, {"a": 1}) == 1
    assert versions.follow(1, {"a": "é"}) == 2
    assert versions.latest() == (2, {"a": "é"})
    with pytest.raises(Conflict):
        versions.follow(1, {"a": 3})
    assert versions.latest() == (2, {"a": "é"}) and versions.last(5) == [{"a": 1}, {"a": "é"}]
    assert not [p for p in Path(folder, "v").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def stage(spark, layer, build):
    """Two tables that belong together: both carry the number of their build."""
    return {t: layer.stage(t, spark.range(5).select("id", F.lit(build).alias("build"))) for t in ("dim", "fact")}


def test_readers_see_one_build_at_any_moment(spark, layer):
    """A reader beside a writer of twelve releases never meets a missing table or two builds at once."""
    layer.publish(stage(spark, layer, 0))
    staged = [stage(spark, layer, n) for n in range(1, 13)]
    seen, failures, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                at = layer.snapshot()
                found = {t: {r.build for r in at.read(t).select("build").collect()} for t in ("dim", "fact")}
                if len(found["dim"] | found["fact"]) != 1:
                    failures.append(found)
                seen.extend(found["dim"])
                spark.sql(f"SELECT count(*) FROM {layer.qualified('dim')}").collect()  # a name is never missing
            except Exception as error:
                failures.append(error)

    readers = [threading.Thread(target=read) for _ in range(3)]
    for r in readers:
        r.start()
    for paths in staged:
        layer.publish(paths)
    done.set()
    for r in readers:
        r.join()
    assert failures == []
    assert sorted(seen, key=seen.index) == seen or len(set(seen)) > 1
    assert {r.build for r in layer.read("fact").collect()} == {12}


def test_a_snapshot_keeps_its_release(spark, layer):
    layer.publish(stage(spark, layer, 1))
    old = layer.snapshot()
    layer.publish(stage(spark, layer, 2))
    assert {r.build for r in old.read("dim").collect()} == {1}
    assert {r.build for r in layer.snapshot().read("dim").collect()} == {2}
    assert layer.expire("dim", keep=2) == 0
    assert {r.build for r in old.read("dim").collect()} == {1}
    assert layer.expire("dim") == 1


def test_a_table_that_cannot_be_published_stops_the_release(spark, layer, folder):
    layer.publish(stage(spark, layer, 1))
    number = layer.snapshot().number
    with pytest.raises(Exception):
        layer.publish(stage(spark, layer, 2) | {"third": f"{folder}/nowhere"})
    assert layer.snapshot().number == number and layer.tables() == ["dim", "fact"]
    assert {r.build for r in layer.read("dim").collect()} == {1}


def test_two_writers_of_different_tables_keep_each_other(spark, layer):
    mine, other = stage(spark, layer, 1), stage(spark, layer, 2)
    follow, layer_releases = Versions.follow, []

    def late(self, number, document):
        if not layer_releases:
            layer_releases.append(1)
            Layer(spark, layer.database, layer.root).publish({"fact": other["fact"]})
        return follow(self, number, document)

    Versions.follow = late
    try:
        layer.publish({"dim": mine["dim"]})
    finally:
        Versions.follow = follow
    at = layer.snapshot()
    assert {r.build for r in at.read("dim").collect()} == {1} and {r.build for r in at.read("fact").collect()} == {2}


def test_a_table_of_parts_reads_each_partition_from_its_folder(spark, layer):
    first = layer.stage("t", spark.range(30).selectExpr("id", "CAST(id % 3 AS INT) AS month"), "month")
    second = layer.stage("t", spark.range(5).selectExpr("id + 100 AS id", "1 AS month"), "month")
    folders = [({"month": m}, f"{second if m == 1 else first}/month={m}") for m in (0, 1, 2)]
    layer.publish({"t": Parts("id bigint", "month int", folders)})
    stored = layer.read("t")
    assert rows(stored.groupBy("month").count().orderBy("month")) == [(0, 10), (1, 5), (2, 10)]
    pruned = stored.filter("month = 1")
    assert all("month=1" in f for f in pruned.inputFiles()) and pruned.count() == 5
    assert layer.expire("t") == 0  # both folders are in use
    assert layer.snapshot().folders("t") == {str(v["month"]): f for v, f in folders}


def test_many_writers_at_a_time_lose_nothing(spark, layer):
    """Eight threads publish a table each, several times: the last release has all of them."""
    staged = {f"t{i}": [layer.stage(f"t{i}", spark.range(n + 1)) for n in range(3)] for i in range(8)}
    failures = []

    def write(table):
        try:
            for path in staged[table]:
                layer.publish({table: path})
        except Exception as error:
            failures.append(error)

    writers = [threading.Thread(target=write, args=(t,)) for t in staged]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert failures == []
    at = layer.snapshot()
    assert at.number == 24 and {t: at.read(t).count() for t in staged} == dict.fromkeys(staged, 3)
