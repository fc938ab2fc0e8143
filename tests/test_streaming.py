import json
from pathlib import Path

import pytest

from smelter.operators.cdc import rejected_messages, valid_changes
from smelter.sources.messages import MESSAGE_SCHEMA, file_stream
from smelter.specs import CUSTOMERS, SELLERS, TableSpec
from smelter.steps import StepsFailed
from smelter.streaming import ingest
from tests.helpers import bag, rows

TOPICS = {"shop.customers": CUSTOMERS, "shop.sellers": SELLERS}


def message(topic, offset, **after):
    body = {"payload": {"before": None, "after": after, "op": "c", "ts_ms": offset}}
    return (topic, 0, offset, json.dumps(body))


@pytest.fixture
def place(spark, folder):
    """Landing folder with a writer, bronze root and checkpoint."""

    class Place:
        landing, root, checkpoint = (f"{folder}/{x}" for x in ("landing", "bronze", "checkpoint"))

        def land(self, *messages):
            spark.createDataFrame(messages, MESSAGE_SCHEMA).write.mode("append").parquet(self.landing)

        def ingest(self, topics=TOPICS, checkpoint=None):
            source = file_stream(spark, self.landing)
            query = ingest.stream_changes(source, topics, self.root, checkpoint or self.checkpoint)
            query.awaitTermination()

        def offsets(self, spec):
            return bag(ingest.read_bronze(spark, self.root, spec).select("kafka_offset"))

    return Place()


def test_routing_restarts_and_rejects(spark, place):
    place.land(
        message("shop.customers", 1, customer_id="a"),
        message("shop.sellers", 2, seller_id="s"),
        message("other", 3, x="y"),
        ("shop.customers", 0, 4, "{broken"),
    )
    place.ingest()
    place.ingest()  # nothing new
    assert place.offsets(CUSTOMERS) == {(1,): 1, (4,): 1}
    assert place.offsets(SELLERS) == {(2,): 1}
    unknown = ingest.read_unknown(spark, place.root)
    assert [(t, o, json.loads(v)["payload"]["after"]) for t, o, v in rows(unknown.select("topic", "kafka_offset", "value"))] == [
        ("other", 3, {"x": "y"})
    ]
    place.land(message("shop.customers", 5, customer_id="b"))
    place.ingest()
    bronze = ingest.read_bronze(spark, place.root, CUSTOMERS)
    assert sorted(rows(valid_changes(bronze).select("kafka_offset"))) == [(1,), (5,)]
    rejected = rejected_messages(bronze)
    assert rows(rejected.select("topic", "kafka_offset", "raw")) == [("shop.customers", 4, "{broken")]


def test_a_batch_repeated_after_a_failure_replaces_itself(spark, place):
    place.land(message("shop.customers", 1, customer_id="a"))
    batch = spark.read.parquet(place.landing)
    for _ in range(3):
        ingest.write_batch(batch, TOPICS, place.root, "s", 0)
    assert place.offsets(CUSTOMERS) == {(1,): 1}


def test_a_batch_is_held_on_disk_alone(spark, place, monkeypatch):
    """Texts of a large batch do not fill the executors' memory while its tables are written."""
    place.land(message("shop.customers", 1, customer_id="a"), message("shop.sellers", 2, seller_id="s"))
    held, run_steps = [], ingest.run_steps

    def look(steps, at_once):
        held.extend((info.memSize(), info.diskSize() > 0) for info in spark.sparkContext._jsc.sc().getRDDStorageInfo())
        return run_steps(steps, at_once)

    spark.catalog.clearCache()
    monkeypatch.setattr(ingest, "run_steps", look)
    ingest.write_batch(spark.read.parquet(place.landing), TOPICS, place.root, "s", 0)
    assert held == [(0, True)]
    assert place.offsets(CUSTOMERS) == {(1,): 1} and place.offsets(SELLERS) == {(2,): 1}


def test_a_lost_commit_is_repeated_without_duplicates(spark, place):
    """The batch wrote its files, but the stream died before committing it."""
    place.land(message("shop.customers", 1, customer_id="a"))
    place.ingest()
    for commit in Path(place.checkpoint, "commits").glob("*0*"):
        commit.unlink()
    place.ingest()
    assert place.offsets(CUSTOMERS) == {(1,): 1}


def test_a_second_stream_adds_beside_the_first(spark, place):
    place.land(message("shop.customers", 1, customer_id="a"))
    place.ingest()
    place.ingest(checkpoint=f"{place.checkpoint}-2")
    assert place.offsets(CUSTOMERS) == {(1,): 2}  # same messages, for the reader to fold


def test_a_new_checkpoint_at_an_old_path_keeps_what_is_stored(spark, place):
    place.land(*[message("shop.customers", i, customer_id=str(i)) for i in range(10)])
    place.ingest()
    Path(place.checkpoint).rename(f"{place.checkpoint}-lost")
    Path(place.landing).rename(f"{place.landing}-old")
    place.land(*[message("shop.customers", i, customer_id=str(i)) for i in range(10, 13)])
    place.ingest()
    assert place.offsets(CUSTOMERS) == {(i,): 1 for i in range(13)}
    place.ingest(checkpoint=place.checkpoint + "/")  # the same checkpoint
    assert place.offsets(CUSTOMERS) == {(i,): 1 for i in range(13)}


def test_catching_up_in_several_batches(spark, place):
    for i in range(4):
        place.land(message("shop.customers", i, customer_id=str(i)))
    source = file_stream(spark, place.landing, files_per_batch=1)
    query = ingest.stream_changes(source, TOPICS, place.root, place.checkpoint)
    query.awaitTermination()
    bronze = ingest.read_bronze(spark, place.root, CUSTOMERS)
    assert bronze.select(ingest.BATCH).distinct().count() >= 4
    assert place.offsets(CUSTOMERS) == {(i,): 1 for i in range(4)}


def test_empty_stream_writes_nothing(spark, place):
    Path(place.landing).mkdir()
    place.ingest()
    assert not Path(place.root).exists()


def test_catch_up_reports_failed_topics_after_the_others_ran(spark, place):
    place.land(message("shop.sellers", 2, seller_id="s"))

    def source(topic):
        if topic == "shop.customers":
            raise RuntimeError("no such topic")
        return file_stream(spark, place.landing)

    with pytest.raises(StepsFailed) as caught:
        ingest.catch_up_topics(source, TOPICS, place.root, place.checkpoint)
    assert caught.value.done == ["shop.sellers"]
    assert set(caught.value.failed) == {"shop.customers"}
    assert place.offsets(SELLERS) == {(2,): 1}


def test_one_topic_by_the_file_sink(spark, place):
    place.land(message("shop.sellers", 2, seller_id="s"))
    for _ in range(2):
        source = file_stream(spark, place.landing)
        ingest.stream_one_topic(source, SELLERS, place.root, place.checkpoint).awaitTermination()
    stored = spark.read.parquet(ingest.table_path(place.root, "sellers"))
    assert rows(stored.select("after.seller_id")) == [("s",)]


def test_awaiting_all_raises_the_first_failure(spark, place, folder):
    place.land(message("shop.sellers", 2, seller_id="s"))

    def query(name, topics):
        source = file_stream(spark, place.landing)
        return ingest.stream_changes(source, topics, f"{folder}/{name}", f"{folder}/{name}-checkpoint")

    good = [query("a", TOPICS), query("b", TOPICS)]
    ingest.await_all(good)
    assert not any(q.isActive for q in good)
    ingest.await_all(good)  # of ended queries: returns at once
    Path(folder, "blocked").write_text("a file where a folder must go")
    with pytest.raises(Exception):
        ingest.await_all([query("blocked", TOPICS)])


def test_batch_and_stream_agree(spark, place):
    from smelter.operators.cdc import latest_by_key, parse_changes

    spec = TableSpec("t", {"k": "string", "v": "string"}, keys=("k",))
    log = [message("t", i, k=str(i % 7), v=str(i)) for i in range(50)]
    place.land(*log[:20])
    place.ingest({"t": spec})
    place.land(*log[20:], *log[:10])
    place.ingest({"t": spec})
    streamed = latest_by_key(ingest.read_bronze(spark, place.root, spec), spec.keys)
    valid, _ = parse_changes(spark.createDataFrame(log, MESSAGE_SCHEMA), spec)
    assert bag(streamed) == bag(latest_by_key(valid, spec.keys))


def compacted(spark, place):
    return ingest.compact(spark, place.root, [s.name for s in TOPICS.values()])


def land_and_ingest(place, offsets):
    place.land(*[message("shop.customers", i, customer_id=str(i)) for i in offsets])
    place.ingest()


def test_compaction_keeps_every_row_once(spark, place):
    for i in range(4):
        land_and_ingest(place, range(10 * i, 10 * i + 5))
    place.land(message("other", 3, x="y"), message("shop.sellers", 2, seller_id="s"))
    place.ingest()
    before = bag(ingest.read_bronze(spark, place.root, CUSTOMERS))
    assert compacted(spark, place) == 5
    assert bag(ingest.read_bronze(spark, place.root, CUSTOMERS)) == before
    assert ingest.read_unknown(spark, place.root).count() == 1 and place.offsets(SELLERS) == {(2,): 1}
    files = ingest.read_bronze(spark, place.root, CUSTOMERS).inputFiles()
    assert len(files) == 1 and "_compacted" in files[0]
    assert compacted(spark, place) == 0  # nothing new
    land_and_ingest(place, range(90, 92))
    assert bag(ingest.read_bronze(spark, place.root, CUSTOMERS).filter("kafka_offset < 90")) == before
    assert compacted(spark, place) == 1
    assert ingest.vacuum(spark, place.root) > 0
    assert ingest.compact(spark, place.root, ["customers", "sellers"], whole=True) == 0
    assert len(ingest.read_bronze(spark, place.root, CUSTOMERS).inputFiles()) == 1
    ingest.vacuum(spark, place.root)
    assert bag(ingest.read_bronze(spark, place.root, CUSTOMERS).filter("kafka_offset < 90")) == before
    assert place.offsets(CUSTOMERS).total() == 22


def test_a_batch_is_seen_once_it_is_committed(spark, place, monkeypatch):
    """A batch that dies between its tables and its commit shows nothing, and all of it after the retry."""
    land_and_ingest(place, [1])
    place.land(message("shop.customers", 2, customer_id="b"), message("shop.sellers", 3, seller_id="s"))

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "_commit", die)
        with pytest.raises(Exception):
            place.ingest()
    assert place.offsets(CUSTOMERS) == {(1,): 1} and place.offsets(SELLERS) == {}
    place.ingest()
    assert place.offsets(CUSTOMERS) == {(1,): 1, (2,): 1} and place.offsets(SELLERS) == {(3,): 1}


@pytest.mark.parametrize("step", ["merge", "publish", "vacuum"])
def test_a_compaction_that_dies_leaves_every_row_once(spark, place, monkeypatch, step):
    for i in range(3):
        land_and_ingest(place, [i])
    before = bag(ingest.read_bronze(spark, place.root, CUSTOMERS))

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "merge":  # one table is merged, another is not
            real = ingest._stored
            m.setattr(ingest, "_stored", lambda s, r, t, *a, **k: die() if t == "sellers" else real(s, r, t, *a, **k))
        if step == "publish":
            m.setattr(ingest.Versions, "follow", die)
        if step == "vacuum":
            compacted(spark, place)
            m.setattr(ingest.Folder, "remove", die)
            with pytest.raises(RuntimeError):
                ingest.vacuum(spark, place.root)
        else:
            with pytest.raises(Exception):
                compacted(spark, place)
    assert bag(ingest.read_bronze(spark, place.root, CUSTOMERS)) == before
    compacted(spark, place)
    ingest.vacuum(spark, place.root)
    assert bag(ingest.read_bronze(spark, place.root, CUSTOMERS)) == before


def test_a_merged_batch_that_the_stream_repeats_is_not_read_twice(spark, place):
    land_and_ingest(place, [1, 2])
    compacted(spark, place)
    ingest.vacuum(spark, place.root)
    for commit in Path(place.checkpoint, "commits").glob("*0*"):
        commit.unlink()
    place.ingest()  # writes the batch's folder again
    assert place.offsets(CUSTOMERS) == {(1,): 1, (2,): 1}
    assert ingest.vacuum(spark, place.root) >= 1


def test_two_compactions_at_a_time_conflict(spark, place, monkeypatch):
    land_and_ingest(place, [1])
    real = ingest.Versions.follow

    def late(self, number, document):
        monkeypatch.setattr(ingest.Versions, "follow", real)
        compacted(spark, place)
        return real(self, number, document)

    monkeypatch.setattr(ingest.Versions, "follow", late)
    with pytest.raises(ingest.Conflict):
        compacted(spark, place)
    assert place.offsets(CUSTOMERS) == {(1,): 1}


def test_readers_after_a_batch_read_only_later_ones(spark, place):
    for i in range(3):
        land_and_ingest(place, [i])
    stream = ingest.stream_id(spark, place.checkpoint)
    assert ingest.committed(spark, place.root).last() == {stream: 2}

    def after(batch):
        return bag(ingest.read_bronze(spark, place.root, CUSTOMERS, after={stream: batch}).select("kafka_offset"))

    assert after(0) == {(1,): 1, (2,): 1}
    compacted(spark, place)
    assert after(0) == {(1,): 1, (2,): 1} and after(2) == {}
    land_and_ingest(place, [7])
    assert after(2) == {(7,): 1}
    assert ingest.read_bronze(spark, place.root, CUSTOMERS, after={stream: 2}).inputFiles()[0].count("_compacted") == 0


def test_the_catalog_has_committed_and_merged_rows_once(spark, place, folder):
    land_and_ingest(place, [1])
    compacted(spark, place)
    land_and_ingest(place, [2])
    from smelter.sources.tables import Layer

    layer = Layer(spark, f"bronze_{abs(hash(folder))}", place.root)
    registered, failed = ingest.register_bronze(layer, [CUSTOMERS, TableSpec("missing", {"k": "string"})])
    assert registered == ["customers"] and set(failed) == {"missing"}
    assert bag(layer.read("customers").select("kafka_offset", "after.customer_id")) == {(1, "1"): 1, (2, "2"): 1}
    spark.sql(f"DROP DATABASE {layer.database} CASCADE")


def test_a_held_batch_is_in_small_blocks(spark, folder, monkeypatch):
    """A hundred blocks of a batch are in the heap of each task that writes or reads it, so blocks are small."""
    count, blocks = 4 * ingest.HELD_ROWS, []
    some = spark.range(0, count, 1, 1).selectExpr(
        "'shop.sellers' AS topic", "0 AS kafka_partition", "id AS kafka_offset",
        """concat('{"op":"c","ts_ms":1,"after":{"seller_id":"', id, '"}}') AS value""",
    )
    setting, run_steps = "spark.sql.inMemoryColumnarStorage.batchSize", ingest.run_steps
    known = set(spark.sparkContext._jsc.getPersistentRDDs().keys())

    def counted(steps, at_once):
        held = spark.sparkContext._jsc.getPersistentRDDs()
        blocks.extend(held[number].count() for number in held.keys() if number not in known)
        assert spark.conf.get(setting) == "7000"
        return run_steps(steps, at_once)

    monkeypatch.setattr(ingest, "run_steps", counted)
    spark.conf.set(setting, 7000)
    try:
        ingest.write_batch(some, TOPICS, folder, "one", 0)
    finally:
        spark.conf.unset(setting)
    assert blocks == [4]
    assert ingest.read_bronze(spark, folder, SELLERS).filter("after.seller_id = kafka_offset").count() == count


def test_compaction_shuffles_no_row(spark, place, monkeypatch):
    for i in range(3):
        land_and_ingest(place, [i])
    before = bag(ingest.read_bronze(spark, place.root, CUSTOMERS))

    def die(*_):
        raise AssertionError("a compaction that shuffles")

    monkeypatch.setattr(type(spark.range(1)), "repartition", die)
    assert compacted(spark, place) == 3
    monkeypatch.undo()
    assert bag(ingest.read_bronze(spark, place.root, CUSTOMERS)) == before
    assert len(ingest.read_bronze(spark, place.root, CUSTOMERS).inputFiles()) == 1
