import json
import threading
from pathlib import Path

import pytest

from smelter.operators import merge
from smelter.plans import build, gold, rules, silver
from smelter.plans.kept_quality import NOTE, KeptQuality
from smelter.sources.messages import MESSAGE_SCHEMA
from smelter.sources.tables import Layer
from smelter.specs import SOURCE_TABLES, topics
from smelter.streaming import ingest
from tests.helpers import bag

FACTS = build.FACTS


def put(table, offset, ts, op="u", **row):
    body = {"before": row if op == "d" else None, "after": None if op == "d" else row, "op": op, "ts_ms": ts}
    return (table, 0, offset, json.dumps(body))


def start():
    """Two sellers, three orders in three months; the third order has both sellers."""
    log = [put("customers", i, 1, customer_id=f"c{i}", customer_unique_id=f"u{i}", customer_zip_code_prefix=f"1000{i}") for i in range(3)]
    log += [put("sellers", 10 + i, 1, seller_id=f"s{i}", seller_zip_code_prefix=f"2000{i}") for i in range(2)]
    log += [put("products", 20 + i, 1, product_id=f"p{i}", product_category_name="toys") for i in range(2)]
    log += [
        put("geolocation", 30 + i, 1, "c", geolocation_zip_code_prefix=z, geolocation_lat="-1", geolocation_lng="2", geolocation_city="x", geolocation_state="SP")
        for i, z in enumerate(("10000", "10001", "20000"))
    ]
    for i in range(3):
        log.append(put("orders", 40 + i, 1, order_id=f"o{i}", customer_id=f"c{i}", order_status="shipped", order_purchase_timestamp=f"2018-0{i + 1}-05 10:00:00"))
        log.append(put("order_items", 50 + i, 1, order_id=f"o{i}", order_item_id="1", product_id="p0", seller_id=f"s{i % 2}", price="10", freight_value="1"))
        log.append(put("order_reviews", 60 + i, 1, review_id=f"r{i}", order_id=f"o{i}", review_score="5", review_creation_date=f"2018-0{i + 2}-01 00:00:00"))
    log.append(put("order_items", 59, 1, order_id="o2", order_item_id="2", product_id="p1", seller_id="s1", price="20", freight_value="2"))
    return log


@pytest.fixture
def star(spark, folder):
    tag = abs(hash(folder))

    class Star:
        bronze = f"{folder}/bronze"
        silver = Layer(spark, f"rsilver_{tag}", f"{folder}/silver")
        gold = Layer(spark, f"rgold_{tag}", f"{folder}/gold")
        batch = 0

        def commit(self, *log):
            ingest.write_batch(spark.createDataFrame(list(log), MESSAGE_SCHEMA), topics(), self.bronze, "s", self.batch)
            self.batch += 1
            build.refresh_silver(self.bronze, self.silver, buckets=2)

        def refresh(self):
            """Refresh gold; the months rewritten per fact."""
            before = {t: self.gold.snapshot().folders(t) for t in FACTS}
            build.refresh_gold(self.silver, self.gold, buckets=2)
            after = {t: self.gold.snapshot().folders(t) for t in FACTS}
            return tuple(sorted(m for m in before[t].keys() | after[t].keys() if before[t].get(m) != after[t].get(m)) for t in FACTS)

        def compare(self):
            """Facts equal a full build, which starts from the same dimension keys."""
            dims = {d: self.gold.read(d) for d in build.DIMENSIONS}
            for table in FACTS:
                made = build.fact(table, self.silver.read, lambda t: dims[t] if t in dims else self.gold.read(t))
                have = self.gold.read(table)
                assert have.select(gold.FACT_KEYS[table]).distinct().count() == have.count()
                assert bag(have.select(made.columns).drop(gold.AUDIT)) == bag(made.drop(gold.AUDIT)), table

    made = Star()
    made.commit(*start())
    made.refresh()
    yield made
    for layer in (made.silver, made.gold):
        spark.sql(f"DROP DATABASE IF EXISTS {layer.database} CASCADE")


def test_only_months_that_a_change_touches_are_rewritten(star):
    star.compare()
    assert star.refresh() == ([], [])  # nothing new
    # A seller's own details are no part of a fact, but its place is: s0 has items in January and March.
    star.commit(put("sellers", 100, 5, seller_id="s0", seller_zip_code_prefix="10001"))
    assert star.refresh() == (["201801", "201803"], ["201802", "201804"])
    star.compare()
    # A product that was known all along: no fact changes.
    star.commit(put("products", 101, 5, product_id="p0", product_category_name="tools"))
    assert star.refresh() == ([], [])
    # An order moves from February to July: both months.
    star.commit(put("orders", 102, 5, order_id="o1", customer_id="c1", order_status="delivered", order_purchase_timestamp="2018-07-01 00:00:00"))
    assert star.refresh() == (["201802", "201807"], ["201803"])
    star.compare()
    # A review moves, another is deleted.
    star.commit(
        put("order_reviews", 103, 5, review_id="r0", order_id="o0", review_score="1", review_creation_date="2018-09-01 00:00:00"),
        put("order_reviews", 104, 5, "d", review_id="r2", order_id="o2"),
    )
    assert star.refresh() == ([], ["201802", "201804", "201809"])
    star.compare()


def test_new_places_and_gone_members(star):
    # A place that was unknown so far: the customer of the third order, and of seller s1.
    places = [dict(geolocation_zip_code_prefix=z, geolocation_lat="-1", geolocation_lng="2", geolocation_city="x", geolocation_state="SP") for z in ("10002", "20001")]
    star.commit(put("geolocation", 200, 5, "c", **places[0]))
    assert star.refresh()[0] == ["201803"]
    star.compare()
    star.commit(put("geolocation", 201, 6, "c", **places[1]))
    assert star.refresh()[0] == ["201802", "201803"]
    star.compare()
    star.commit(
        put("products", 202, 7, "d", product_id="p1"),
        put("customers", 203, 7, "d", customer_id="c0"),
        put("order_items", 204, 7, "d", order_id="o1", order_item_id="1"),
        put("orders", 205, 7, order_id="o9", customer_id="c2", order_status="new", order_purchase_timestamp=None),
        put("order_items", 206, 7, order_id="o9", order_item_id="1", product_id="p0", seller_id="s0", price="1", freight_value="1"),
    )
    assert star.refresh()[0] == ["0", "201801", "201802", "201803"]
    star.compare()


def test_several_runs_between_two_refreshes(star):
    star.commit(put("sellers", 300, 5, seller_id="s0", seller_zip_code_prefix="10001"))
    star.commit(put("order_items", 301, 5, order_id="o1", order_item_id="5", product_id="p1", seller_id="s0", price="3", freight_value="1"))
    assert star.refresh()[0] == ["201801", "201802", "201803"]
    star.compare()


def test_everything_is_built_where_changes_are_not_known(star):
    star.silver.replace("sellers", star.silver.read("sellers"))
    assert star.refresh()[0] == ["201801", "201802", "201803"]
    star.compare()
    for table in SOURCE_TABLES:
        star.silver.expire(table)
    star.compare()


def test_kept_quality_equals_counting_again(star):
    kept = KeptQuality(star.silver, buckets=2)

    def compare(from_start):
        assert kept.refresh() == from_start
        at = star.silver.snapshot()
        assert bag(kept.report()) == bag(rules.validate_layer(lambda t: at.read(t).drop(silver.AUDIT)))

    compare(9)
    star.commit(
        put("order_items", 400, 5, order_id="o1", order_item_id="01", product_id="p7", seller_id=None, price="-3"),  # a duplicate once cleaned
        put("orders", 401, 5, "d", order_id="o0"),
        put("customers", 402, 5, customer_id="c1", customer_unique_id="u1", customer_state="Sao"),
        put("geolocation", 403, 5, "d", geolocation_zip_code_prefix="10000", geolocation_lat="-1", geolocation_lng="2", geolocation_city="x", geolocation_state="SP"),
    )
    compare(0)
    star.commit(
        put("order_items", 404, 6, "d", order_id="o1", order_item_id="01"),
        put("orders", 405, 6, order_id="o0", customer_id="gone", order_status="odd", order_purchase_timestamp="2018-01-01 00:00:00"),
        put("products", 406, 6, product_id="p7", product_weight_g="-1"),
    )
    star.commit(put("products", 407, 7, "d", product_id="p0"))
    compare(0)
    star.silver.replace("products", star.silver.read("products"))
    compare(1)


def test_kept_quality_is_dealt_into_more_buckets(star, monkeypatch):
    """Counts per key that outgrow their buckets are dealt again, and stay right."""
    kept = KeptQuality(star.silver, buckets=2)
    kept.refresh()
    monkeypatch.setattr(merge, "ROWS_PER_BUCKET", 1)
    star.commit(put("order_items", 400, 5, order_id="o1", order_item_id="01", product_id="p7", seller_id=None, price="-3"))
    assert kept.refresh() == 0
    at = star.silver.snapshot()
    assert at.notes[NOTE]["buckets"]["order_items_grain"] > 2
    assert bag(kept.report()) == bag(rules.validate_layer(lambda t: at.read(t).drop(silver.AUDIT)))


def test_old_tables_are_removed_and_runs_go_on(spark, star):
    """With each run only the latest of every state and table is left, and the next run is as right as before."""
    bronze = Layer(spark, f"{star.silver.database}_bronze", star.bronze)

    def folders(layer, table):
        return [p for p in Path(layer.root, table).iterdir() if not p.name.startswith((".", "_"))]

    kept = KeptQuality(star.silver, buckets=2)
    for batch, city in ((1, "a"), (2, "b")):
        log = [
            put("orders", 500 + batch, 5 + batch, order_id="o1", customer_id="c1", order_status="delivered", order_purchase_timestamp=f"2018-0{batch + 3}-01 00:00:00"),
            put("sellers", 600 + batch, 5 + batch, seller_id="s0", seller_zip_code_prefix=f"1000{batch % 2}", seller_city=city),
        ]

        def commit():
            ingest.write_batch(spark.createDataFrame(log, MESSAGE_SCHEMA), topics(), star.bronze, "s", batch)
            if batch == 2:
                ingest.compact(spark, star.bronze, SOURCE_TABLES)
            return ["ingest"]

        build.run(bronze, star.silver, star.gold, commit, incremental=True, buckets=2, keep_old=False)
        kept.refresh()
        kept.remove_old()
        star.compare()
        at = star.silver.snapshot()
        assert bag(kept.report()) == bag(rules.validate_layer(lambda t: at.read(t).drop(silver.AUDIT)))
        for table in ("orders", "orders_versions", "sellers", "sellers_versions", "geolocation_seen", "sellers_grain"):
            assert len(folders(star.silver, table)) == 1, table
        assert len(folders(star.gold, "dim_seller")) == 1
        months = star.gold.snapshot().folders("fact_order_items").values()
        assert {p.name for p in folders(star.gold, "fact_order_items")} == {Path(m).parent.name for m in months}
    assert not list(Path(star.bronze, "orders", "ingest_stream=s").glob("ingest_batch=*"))
    spark.sql(f"DROP DATABASE {bronze.database} CASCADE")


def test_kept_checks_are_counted_beside_each_other(star, monkeypatch):
    running, most, lock, real = [0], [0], threading.Lock(), KeptQuality._keyed

    def counted(self, *args):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            return real(self, *args)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(KeptQuality, "_keyed", counted)
    KeptQuality(star.silver, buckets=2).refresh()
    assert most[0] > 1
