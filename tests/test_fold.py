import json
import random
from pathlib import Path

import pytest

from smelter.operators.cdc import parse_changes
from smelter.operators import merge
from smelter.operators.merge import merged
from smelter.plans import silver
from smelter.sources.messages import MESSAGE_SCHEMA
from smelter.sources.tables import Layer
from smelter.sources.versions import Conflict
from smelter.specs import GEOLOCATION, ORDER_ITEMS, SELLERS
from smelter.streaming import fold, ingest
from tests.helpers import bag, plan

SPECS = (SELLERS, ORDER_ITEMS, GEOLOCATION)


@pytest.fixture
def place(spark, folder):
    class Place:
        root = f"{folder}/bronze"
        layer = Layer(spark, f"fold_{abs(hash(folder))}", f"{folder}/silver")

        def commit(self, log, batch, stream="s"):
            frame = spark.createDataFrame(log, MESSAGE_SCHEMA)
            ingest.write_batch(frame, {s.name: s for s in SPECS}, self.root, stream, batch)

        def fold(self, spec, **settings):
            return fold.Fold(self.layer, spec, buckets=4, **settings).run(self.root)

        def table(self, spec):
            return bag(self.layer.read(spec.name).drop(silver.AUDIT))

        def whole(self, spec, log, deletes="apply"):
            changes, _ = parse_changes(spark.createDataFrame(log, MESSAGE_SCHEMA), spec)
            return bag(silver.from_changes(spec.name, changes, deletes).drop(silver.AUDIT))

    made = Place()
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS {made.layer.database} CASCADE")


def change(topic, offset, op, ts, before=None, after=None):
    return (topic, 0, offset, json.dumps({"before": before, "after": after, "op": op, "ts_ms": ts}))


def random_log(rng, n):
    """Late, equal-time, deleted, re-created and malformed changes of three tables."""
    log, images = [], []
    for offset in range(n):
        ts, kind = rng.randrange(40), rng.random()
        if kind < 0.35:
            key = {"seller_id": f" {rng.randrange(9)} "}
            row = {**key, "seller_zip_code_prefix": str(rng.randrange(3)), "seller_city": f"c{offset}", "seller_state": "sp"}
            op = rng.choice("cuud")
            log.append(change("sellers", offset, op, ts, key if op == "d" else None, None if op == "d" else row))
        elif kind < 0.6:
            key = {"order_id": str(rng.randrange(4)), "order_item_id": str(rng.randrange(3))}
            op = rng.choice("cud")
            row = {**key, "price": str(offset), "freight_value": "1"}
            log.append(change("order_items", offset, op, ts, key if op == "d" else None, None if op == "d" else row))
        elif kind < 0.95:
            image = {
                "geolocation_zip_code_prefix": str(rng.randrange(2)),
                "geolocation_lat": rng.choice(["1.123456789012", "-33.3", "91", "x"]),
                "geolocation_lng": str(rng.randrange(-5, 5)),
                "geolocation_city": rng.choice(["a", " A", None]),
                "geolocation_state": "sp",
            }
            old = rng.choice(images) if images else None
            op = rng.choice("cccdu") if old else "c"
            log.append(change("geolocation", offset, op, ts, old if op != "c" else None, None if op == "d" else image))
            images.append(image)
        else:
            log.append((rng.choice(["sellers", "geolocation"]), 0, offset, rng.choice(["{broken", None])))
    return log


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches_gives_the_fold_of_the_whole_log(spark, place, seed):
    """Shuffled changes in four batches of two streams, one of them replayed in full, with a fold after each or after two."""
    rng = random.Random(seed)
    log = random_log(rng, 120)
    shuffled = rng.sample(log, len(log))
    parts = [shuffled[:50], shuffled[50:60], shuffled[60:100], shuffled[100:]]
    for number, part in enumerate(parts):
        place.commit(part, number)
        if number == 2:
            place.commit(parts[0], 0, "again")
        if number != 1:
            for spec in SPECS:
                assert place.fold(spec)
            so_far = [m for p in parts[: number + 1] for m in p]
            for spec in SPECS:
                assert place.table(spec) == place.whole(spec, so_far), spec.name
    assert not any(place.fold(spec) for spec in SPECS)  # nothing new


def test_removals_move_means_exactly_and_wait_for_their_rows(spark, place):
    row = {"geolocation_zip_code_prefix": "1", "geolocation_lat": "1.5", "geolocation_lng": "2", "geolocation_city": "a", "geolocation_state": "s"}
    other = row | {"geolocation_lat": "2.5"}
    place.commit([change("geolocation", 1, "c", 1, None, row), change("geolocation", 2, "d", 2, other)], 0)
    place.fold(GEOLOCATION)
    assert list(place.table(GEOLOCATION)) == [("1", "A", "S", 1.5, 2.0)]
    place.commit([change("geolocation", 3, "c", 3, None, other)], 1)  # its removal came first
    place.fold(GEOLOCATION)
    assert list(place.table(GEOLOCATION)) == [("1", "A", "S", 1.5, 2.0)]
    place.commit([change("geolocation", 4, "u", 4, row, other), change("geolocation", 3, "c", 3, None, other)], 2)
    place.fold(GEOLOCATION)
    assert list(place.table(GEOLOCATION)) == [("1", "A", "S", 2.5, 2.0)]
    place.commit([change("geolocation", 5, "d", 5, other)], 3)
    place.fold(GEOLOCATION)
    assert place.table(GEOLOCATION) == {}


def test_ignored_deletes(spark, place):
    log = random_log(random.Random(7), 60)
    place.commit(log[:30], 0)
    place.commit(log[30:], 1)
    for spec in SPECS:
        place.fold(spec, deletes="ignore")
        assert place.table(spec) == place.whole(spec, log, "ignore")
        with pytest.raises(ValueError, match="other settings"):
            place.fold(spec)


def test_compacted_bronze_folds_alike(spark, place):
    log = random_log(random.Random(3), 80)
    for number in range(4):
        place.commit(log[20 * number : 20 * number + 20], number)
        if number in (0, 3):
            place.fold(SELLERS)
        if number == 2:
            ingest.compact(spark, place.root, [s.name for s in SPECS])
            ingest.vacuum(spark, place.root)
    assert place.table(SELLERS) == place.whole(SELLERS, log)


def test_a_run_that_dies_changes_nothing(spark, place, monkeypatch):
    log = random_log(random.Random(5), 60)
    place.commit(log[:30], 0)
    place.fold(SELLERS)
    before = place.table(SELLERS)
    place.commit(log[30:], 1)

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Layer, "_release", die)
        with pytest.raises(RuntimeError):
            place.fold(SELLERS)
    assert place.table(SELLERS) == before
    place.fold(SELLERS)
    assert place.table(SELLERS) == place.whole(SELLERS, log)


def test_two_runs_at_a_time_conflict(spark, place, monkeypatch):
    place.commit(random_log(random.Random(5), 30), 0)
    real = Layer.publish

    def late(self, *a, **k):
        monkeypatch.setattr(Layer, "publish", real)
        place.fold(SELLERS)
        return real(self, *a, **k)

    monkeypatch.setattr(Layer, "publish", late)
    with pytest.raises(Conflict):
        place.fold(SELLERS)


def test_changed_keys_since_a_run(spark, place):
    place.commit([change("sellers", i, "c", i, None, {"seller_id": str(i)}) for i in range(5)], 0)
    place.fold(SELLERS)
    first = fold.last_run(place.layer.snapshot(), SELLERS)
    place.commit([change("sellers", 7, "u", 9, None, {"seller_id": "2"}), change("sellers", 8, "u", 0, None, {"seller_id": "3"})], 1)
    place.fold(SELLERS)
    at = place.layer.snapshot()
    assert bag(fold.changed_since(place.layer, SELLERS, at, first)) == {("2",): 1}
    assert fold.changed_since(place.layer, SELLERS, at, 0).count() == 5
    place.layer.replace("sellers", place.layer.read("sellers"))
    assert fold.changed_since(place.layer, SELLERS, place.layer.snapshot(), first) is None


def test_the_state_is_not_shuffled(spark, place):
    """Only the side of the new batches has an exchange, whatever the number of shuffle partitions."""
    place.commit([change("sellers", i, "c", i, None, {"seller_id": str(i)}) for i in range(50)], 0)
    place.fold(SELLERS)
    state = place.layer.snapshot().read("sellers_versions").drop(fold.NEW)
    fresh = spark.createDataFrame([("1", "u", None, 5, 0, 1)], f"seller_id string, op string, after {SELLERS.change_schema.simpleString()}, ts_ms long, kafka_partition int, kafka_offset long")
    for partitions in ("2", "16"):
        with_setting = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            text = plan(merged(state, fresh, ["seller_id"], 4))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", with_setting)
        assert text.count("Exchange") == 1 and "Bucketed: true" in text


def test_merging_sorts_instead_of_hashing_a_bucket(spark, place):
    """A bucket of a large log need not fit in memory."""
    place.commit([change("sellers", i, "c", i, None, {"seller_id": str(i)}) for i in range(50)], 0)
    place.fold(SELLERS)
    state = place.layer.snapshot().read("sellers_versions").drop(fold.NEW, fold.OLD)
    text = plan(merged(state, state, ["seller_id"], 4))
    assert "SortMergeJoin" in text and "ShuffledHashJoin" not in text


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_states_that_grow_are_dealt_into_more_buckets(place, spec, monkeypatch):
    """No bucket keeps more rows than a task should take, and the rows stay those of the whole log."""
    monkeypatch.setattr(merge, "ROWS_PER_BUCKET", 5)
    rng, log, dealt = random.Random(3), random_log(random.Random(3), 240), []
    for batch, part in enumerate((log[:60], log[60:150], log[150:], log[:30])):
        place.commit(rng.sample(part, len(part)), batch)
        place.fold(spec)
        dealt.append(place.layer.snapshot().notes[spec.name]["dealt"])
        assert place.table(spec) == place.whole(spec, log[: (60, 150, 240, 240)[batch]])
    assert dealt == sorted(dealt) and dealt[-1] > 4
    (part,) = [p for p in ("versions", "seen") if place.layer.exists(f"{spec.name}_{p}")]
    assert place.layer.location(f"{spec.name}_{part}")
    described = place.layer.spark.sql(f"DESCRIBE EXTENDED {place.layer.qualified(place.layer.refresh_of(f'{spec.name}_{part}'))}")
    assert described.filter("col_name = 'Num Buckets'").first().data_type == str(dealt[-1])


def test_a_first_run_stores_no_feed(spark, place):
    """Every row of it is new: the table is its feed. Later runs store theirs."""
    place.commit([change("sellers", i, "c", i, None, {"seller_id": str(i)}) for i in range(5)], 0)
    place.fold(SELLERS)
    at = place.layer.snapshot()
    assert not Path(place.layer.root, "sellers_feed").exists()
    assert fold.feed_since(place.layer, SELLERS, at, 0) is None
    assert fold.feed_since(place.layer, SELLERS, at, fold.last_run(at, SELLERS)).count() == 0
    place.commit([change("sellers", 7, "u", 9, None, {"seller_id": "2", "seller_city": "x"})], 1)
    place.fold(SELLERS)
    feed = fold.feed_since(place.layer, SELLERS, place.layer.snapshot(), 1)
    assert bag(feed.select("seller_id", "seller_city", fold.SIGN)) == {("2", None, -1): 1, ("2", "X", 1): 1}


def test_a_bucket_is_written_without_sorting_it_by_key(spark, place):
    """Spark sorts what it merges whatever the order of the files, so a sort at the write is done for nothing."""
    place.commit([change("sellers", i, "c", i, None, {"seller_id": str(i)}) for i in range(50)], 0)
    place.fold(SELLERS)
    described = spark.sql(f"DESCRIBE EXTENDED {place.layer.qualified(place.layer.refresh_of('sellers_versions'))}")
    found = {r.col_name: r.data_type for r in described.collect()}
    assert found["Num Buckets"] == "4" and found.get("Sort Columns", "[]") == "[]"
