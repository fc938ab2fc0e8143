import pytest

from smelter.operators.cdc import parse_changes
from smelter.plans import build, saved, silver
from smelter.scratch import scratch_root
from smelter.sources.messages import file_stream
from smelter.sources.tables import Layer
from smelter.specs import ORDERS, SOURCE_TABLES, topics
from smelter.steps import StepsFailed, run_steps
from smelter.streaming.ingest import stream_changes
from tests.helpers import bag, rows
from verification.derive import messages


def test_steps_go_on_after_a_failure():
    seen = []

    def fail():
        raise RuntimeError("broken")

    with pytest.raises(StepsFailed, match="1 of 3 failed: b: broken"):
        run_steps({"a": lambda: seen.append("a"), "b": fail, "c": lambda: seen.append("c")})
    assert seen == ["a", "c"]


@pytest.fixture
def layers(spark, folder):
    made = [Layer(spark, f"run_{n}_{abs(hash(folder))}", f"{folder}/{n}") for n in ("silver", "gold")]
    yield made
    for layer in made:
        spark.sql(f"DROP DATABASE IF EXISTS {layer.database} CASCADE")


def test_the_whole_run(spark, stored, layers):
    for table in SOURCE_TABLES:
        stored.bronze(table)
    report = build.run(stored.bronze_layer, *layers, buckets=4)
    steps = [*SOURCE_TABLES, *build.DIMENSIONS, *build.FACTS]
    assert {r.step: (r.status, r.reason) for r in report.collect()} == {name: ("OK", None) for name in steps}
    counts = {r.step: r.row_count for r in report.collect()}
    for table in (*build.DIMENSIONS, *build.FACTS):
        assert layers[1].read(table).count() == stored.gold(table).count() == counts[table]


def test_a_failed_fact_leaves_the_star_as_it_was(spark, stored, layers, monkeypatch):
    build.build_gold(stored.silver_layer, layers[1], buckets=4)
    before = {t: rows(layers[1].read(t).groupBy().count()) for t in (*build.DIMENSIONS, *build.FACTS)}
    places = {t: layers[1].location(t) for t in before}
    revenue = bag(saved.run(layers[1].read, "revenue_by_region", k=100))

    def broken(*_, **__):
        raise RuntimeError("no fact today")

    monkeypatch.setattr(build, "fact", broken)
    with pytest.raises(build.BuildFailed) as caught:
        build.run(stored.bronze_layer, *layers, buckets=4)
    report = {r.step: r.status for r in caught.value.report.collect()}
    assert {report[d] for d in build.DIMENSIONS} == {"OK"}
    assert [report[f] for f in build.FACTS] == ["FAILED", "SKIPPED"]
    assert {t: layers[1].location(t) for t in before} == places
    assert bag(saved.run(layers[1].read, "revenue_by_region", k=100)) == revenue


def test_from_landed_messages_to_gold(spark, layers, folder, sf_dir):
    """Messages land as files, stream into bronze, and become silver and gold in one call."""
    names = [*SOURCE_TABLES]
    for name in names:
        log = messages(spark, sf_dir, name)
        log.coalesce(1).write.mode("append").parquet(f"{folder}/landing")
    bronze = Layer(spark, f"run_bronze_{abs(hash(folder))}", f"{folder}/bronze")

    def ingest_all():
        source = file_stream(spark, f"{folder}/landing")
        stream_changes(source, topics(), bronze.root, f"{folder}/checkpoint").awaitTermination()
        return ["ingest"]

    report = build.run(bronze, *layers, ingest=ingest_all, buckets=4)
    assert {r[1] for r in rows(report)} == {"OK"} and report.count() == 1 + 9 + 8
    # A later batch is seen by the next run.
    extra = messages(spark, sf_dir, "sellers").limit(1).selectExpr(
        "topic", "kafka_partition", "kafka_offset + 1000000 AS kafka_offset",
        """replace(replace(value, '"seller_id":"', '"seller_id":"new'), '"op":"d"', '"op":"u"') AS value""",
    )
    extra.write.mode("append").parquet(f"{folder}/landing")
    count = layers[0].read("sellers").count()
    build.run(bronze, *layers, ingest=ingest_all, buckets=4)
    assert layers[0].read("sellers").count() == count + 1
    direct = silver.from_changes("orders", parse_changes(messages(spark, sf_dir, "orders"), ORDERS)[0])
    stored = layers[0].read("orders")
    assert bag(stored.drop(silver.AUDIT)) == bag(direct.drop(silver.AUDIT))
    spark.sql(f"DROP DATABASE {bronze.database} CASCADE")


def test_a_failed_layer_stops_the_next(spark, stored, layers, folder):
    bronze = Layer(spark, f"run_bronze_{abs(hash(folder))}", f"{folder}/bronze")
    bronze.replace("sellers", stored.bronze("sellers"))
    with pytest.raises(build.BuildFailed) as caught:
        build.run(bronze, *layers, buckets=4)
    report = {r.step: r.status for r in caught.value.report.collect()}
    assert [s for s, status in report.items() if status == "OK"] == ["sellers"]
    assert {report[t] for t in (*build.DIMENSIONS, *build.FACTS)} == {"SKIPPED"}
    spark.sql(f"DROP DATABASE {bronze.database} CASCADE")


def test_scratch_is_the_folder_the_session_names(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
