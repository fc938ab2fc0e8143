"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.operators import cdc, keys, merge, quality
from smelter.plans import build, gold, rules, saved, silver
from smelter.plans.gold import MONTH
from smelter.scratch import scratch_path, use_scratch
from smelter.sources.csv import read_csv
from smelter.sources.tables import Layer
from smelter.sources.unique import KeyRegistry, UniqueTable
from smelter.specs import ORDER_ITEMS, ORDERS, SOURCE_TABLES, TableSpec
from smelter.streaming import ingest
from verification import derive
from verification.incremental import growing
from verification.warehouse import warehouse

Query = Callable[[SparkSession, str], DataFrame]

# Where the caller's session names no shared folder.
SCRATCH = "/tmp/checkpoints"

QUERIES: dict[str, Query] = {}

NOT_COMPARED = (silver.AUDIT, gold.AUDIT, MONTH, *gold.FACT_KEYS.values())


def comparable(df: DataFrame) -> DataFrame:
    """Plain types at the edge: money as double, times as text, no audit columns."""

    def plain(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.TimestampNTZType):
            # Through text, as date_format would pass through the session time zone.
            text = col.cast("string")
            whole = F.length(text) == 19
            col = F.rpad(F.when(whole, F.concat(text, F.lit("."))).otherwise(text), 23, "0")
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        return col.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields if f.name not in NOT_COMPARED])


def query(name: str):
    def add(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_scratch(spark, SCRATCH)
            return comparable(function(spark, sf_dir))

        QUERIES[name] = run
        return function

    return add


# --- change messages -------------------------------------------------------


def _event_envelopes(spark: SparkSession, sf_dir: str, **form: bool) -> DataFrame:
    events = derive.spread_out(derive.given(spark, sf_dir, "events"))
    return cdc.read_envelopes(derive.event_messages(events, **form), derive.EVENT_LOG)


def _flat(changes: DataFrame, *columns: str) -> DataFrame:
    return changes.select(
        *columns,
        "kafka_partition",
        "kafka_offset",
        "op",
        "ts_ms",
        F.coalesce("after.k", "before.k").alias("k"),
        F.col("after.v").alias("v"),
    )


@query("cdc_envelope_parse")
def _(spark, sf_dir):
    return _flat(cdc.valid_changes(_event_envelopes(spark, sf_dir)))


@query("cdc_envelope_bare")
def _(spark, sf_dir):
    envelopes = _event_envelopes(spark, sf_dir, wrapped=False, broken=True)
    rejected = cdc.rejected_messages(envelopes).select("kafka_offset", "reason")
    return _flat(cdc.valid_changes(envelopes)).unionByName(rejected, allowMissingColumns=True).select(
        "kafka_offset", "op", "k", "v", "reason"
    )


def _event_state(spark: SparkSession, sf_dir: str, deletes: str) -> DataFrame:
    changes = cdc.valid_changes(_event_envelopes(spark, sf_dir))
    return cdc.latest_by_key(changes, derive.EVENT_LOG.keys, deletes=deletes)


@query("cdc_latest_reference")
def _(spark, sf_dir):
    return _event_state(spark, sf_dir, "ignore")


@query("cdc_latest_delete_aware")
def _(spark, sf_dir):
    return _event_state(spark, sf_dir, "apply")


@query("cdc_latest_composite")
def _(spark, sf_dir):
    bronze = warehouse(spark, sf_dir).bronze("order_items")
    return cdc.latest_by_key(bronze, ORDER_ITEMS.keys)


@query("sample_changes")
def _(spark, sf_dir):
    changes = cdc.valid_changes(_event_envelopes(spark, sf_dir))
    return cdc.sample_changes(changes, 5)


# --- streaming -------------------------------------------------------------


def _stream_events(spark: SparkSession, sf_dir: str, runs: int) -> DataFrame:
    root, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    topics = {derive.EVENT_LOG.name: derive.EVENT_LOG}
    for _ in range(runs):
        messages = derive.event_messages(derive.event_stream(spark, sf_dir))
        ingest.stream_changes(messages, topics, root, checkpoint).awaitTermination()
    return _flat(ingest.read_bronze(spark, root, derive.EVENT_LOG))


@query("cdc_stream_append")
def _(spark, sf_dir):
    return _stream_events(spark, sf_dir, runs=1)


@query("cdc_stream_replay")
def _(spark, sf_dir):
    return _stream_events(spark, sf_dir, runs=2)


@query("cdc_topic_routing")
def _(spark, sf_dir):
    root, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    topics = {
        f"shop.{kind}": TableSpec(kind, derive.EVENT_LOG.columns, derive.EVENT_LOG.keys)
        for kind in derive.EVENT_TYPES
    }
    messages = derive.event_messages(
        derive.event_stream(spark, sf_dir), topic=F.concat(F.lit("shop."), "event_type")
    )
    ingest.stream_changes(messages, topics, root, checkpoint).awaitTermination()
    tables = [ingest.read_bronze(spark, root, spec) for spec in topics.values()]
    return _flat(reduce(DataFrame.unionByName, tables), "topic")


@query("cdc_unknown_topic")
def _(spark, sf_dir):
    """Topics that nobody declared are kept with their text."""
    root, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    declared = [kind for kind in derive.EVENT_TYPES if kind not in ("error", "view")]
    topics = {f"shop.{k}": TableSpec(k, derive.EVENT_LOG.columns, derive.EVENT_LOG.keys) for k in declared}
    messages = derive.event_messages(
        derive.event_stream(spark, sf_dir), topic=F.concat(F.lit("shop."), "event_type")
    )
    ingest.stream_changes(messages, topics, root, checkpoint).awaitTermination()
    kept = cdc.read_envelopes(ingest.read_unknown(spark, root), derive.EVENT_LOG)
    return _flat(kept, "topic").select("topic", "kafka_partition", "kafka_offset", "op", "k")


@query("cdc_stream_new_checkpoint")
def _(spark, sf_dir):
    """A checkpoint that is lost and begun again at the same path adds batches, and replaces none."""
    root, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    topics = {derive.EVENT_LOG.name: derive.EVENT_LOG}
    for place in (checkpoint, checkpoint + "/"):
        messages = derive.event_messages(derive.event_stream(spark, sf_dir))
        ingest.stream_changes(messages, topics, root, place).awaitTermination()
        set_aside(spark, checkpoint)
    stored = _flat(ingest.read_bronze(spark, root, derive.EVENT_LOG))
    return stored.groupBy(*stored.columns).agg(F.count("*").cast("int").alias("stored"))


def set_aside(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path
    system = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.rename(place(path), place(scratch_path(spark, "set-aside")))


@query("cdc_stream_compacted")
def _(spark, sf_dir):
    """Five batches, merged after the third and the fourth, read beside the fifth."""
    root, topics = scratch_path(spark, "bronze"), {derive.EVENT_LOG.name: derive.EVENT_LOG}
    messages = derive.event_messages(derive.given(spark, sf_dir, "events"))
    for number in range(5):
        batch = messages.filter(F.pmod(F.xxhash64("kafka_offset"), F.lit(5)) == number)
        ingest.write_batch(batch, topics, root, "events", number)
        if number in (2, 3):
            ingest.compact(spark, root, [derive.EVENT_LOG.name])
            ingest.vacuum(spark, root)
    return _flat(ingest.read_bronze(spark, root, derive.EVENT_LOG))


@query("cdc_one_topic_sink")
def _(spark, sf_dir):
    """One topic by the plain file sink."""
    root, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    messages = derive.event_messages(derive.event_stream(spark, sf_dir))
    ingest.stream_one_topic(messages, derive.EVENT_LOG, root, checkpoint).awaitTermination()
    return _flat(spark.read.parquet(ingest.table_path(root, derive.EVENT_LOG.name)))


@query("cdc_catch_up_topics")
def _(spark, sf_dir):
    """Scheduled catch-up: a stream per topic, run twice, each with a checkpoint of its own."""
    root, checkpoints = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoints")
    topics = {kind: TableSpec(kind, derive.EVENT_LOG.columns, derive.EVENT_LOG.keys) for kind in derive.EVENT_TYPES}

    def source(topic: str) -> DataFrame:
        events = derive.event_stream(spark, sf_dir).filter(F.col("event_type") == topic)
        return derive.event_messages(events, topic=F.lit(topic))

    for _ in range(2):
        ingest.catch_up_topics(source, topics, root, checkpoints)
    tables = [ingest.read_bronze(spark, root, spec) for spec in topics.values()]
    return _flat(reduce(DataFrame.unionByName, tables), "topic")


@query("cdc_rejected_shapes")
def _(spark, sf_dir):
    bronze = cdc.read_envelopes(derive.odd_messages(spark, sf_dir), derive.EVENT_LOG)
    return cdc.rejected_messages(bronze).select("kafka_offset", "raw", "reason")


# --- loads -----------------------------------------------------------------


@query("insert_if_absent")
def _(spark, sf_dir):
    lines = derive.given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_linestatus"
    )
    return merge.insert_if_absent(
        lines.filter(F.col("l_linestatus") == "O"),
        lines,
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey"],
    )


@query("insert_if_absent_stored")
def _(spark, sf_dir):
    """Finished lines, then all lines, into a stored table that is unique by key."""
    lines = derive.given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_linestatus"
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey"]
    stored = UniqueTable(stored_layer(spark), "lines", ["l_orderkey", "l_linenumber"], buckets=8)
    stored.insert(lines.filter("l_linestatus = 'F'"), order)
    stored.insert(lines, order)
    return stored.read()


@query("key_registry")
def _(spark, sf_dir):
    """Three refreshes: finished orders, open ones alone, and all, among them those that were gone in between."""
    orders = derive.given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    registry = KeyRegistry(stored_layer(spark), "orders", "o_orderkey", "order_sk", buckets=8)
    for status in ("F", "O"):
        registry.assign(orders.filter(F.col("o_orderstatus") == status))
    return registry.assign(orders)


def stored_layer(spark: SparkSession) -> Layer:
    tag = uuid.uuid4().hex[:8]
    return Layer(spark, f"stored_{tag}", scratch_path(spark, "stored"))


@query("csv_typed_load")
def _(spark, sf_dir):
    path = scratch_path(spark, "csv")
    rows = derive.source(spark, sf_dir, "orders").select(*ORDERS.columns)
    rows.write.options(header=True, ignoreLeadingWhiteSpace=False).csv(path)
    return read_csv(spark, path, ORDERS)[0]


# --- silver ----------------------------------------------------------------


def _silver(table: str) -> Query:
    return lambda spark, sf_dir: silver.from_changes(table, warehouse(spark, sf_dir).bronze(table))


SILVER_NAMES = {
    "customers": "silver_customers",
    "geolocation": "silver_geolocation",
    "sellers": "silver_sellers",
    "category_translation": "silver_category_translation",
    "products": "silver_products",
    "orders": "silver_orders",
    "order_items": "silver_order_items",
    "order_payments": "silver_payments",
    "order_reviews": "silver_reviews",
}
for _table, _name in SILVER_NAMES.items():
    query(_name)(_silver(_table))


# --- what grows batch by batch ---------------------------------------------


def _grown_silver(table: str) -> Query:
    return lambda spark, sf_dir: growing(spark, sf_dir).silver.read(table)


for _table, _name in SILVER_NAMES.items():
    query(_name.replace("silver_", "silver_incremental_"))(_grown_silver(_table))


@query("run_report")
def _(spark, sf_dir):
    """The report of ingest, silver and gold after the last batch."""
    return growing(spark, sf_dir).report.drop("reason")


DIMENSION_KEYS = {
    "dim_customer": "customer_sk",
    "dim_seller": "seller_sk",
    "dim_product": "product_sk",
    "dim_order_status": "order_status_sk",
    "dim_geography": "geography_sk",
}


def _by_business_key(read: Callable[[str], DataFrame], fact: str, keys: dict[str, tuple[str, str]]) -> DataFrame:
    """A fact with the names that its surrogate keys stand for: column -> (dimension, business key)."""
    rows = read(fact)
    for column, (table, name) in keys.items():
        key = DIMENSION_KEYS[table]
        names = read(table).select(F.col(key).alias(column), F.col(name).alias(f"{column.removesuffix('_sk')}_name"))
        rows = rows.join(names, column).drop(column)
    return rows


@query("gold_incremental_order_items")
def _(spark, sf_dir):
    return _by_business_key(
        growing(spark, sf_dir).gold.snapshot().read,
        "fact_order_items",
        {
            "customer_sk": ("dim_customer", "customer_unique_id"),
            "seller_sk": ("dim_seller", "seller_id"),
            "product_sk": ("dim_product", "product_id"),
            "order_status_sk": ("dim_order_status", "order_status"),
            "customer_geography_sk": ("dim_geography", "zip_code_prefix"),
            "seller_geography_sk": ("dim_geography", "zip_code_prefix"),
        },
    )


@query("gold_incremental_reviews")
def _(spark, sf_dir):
    return _by_business_key(
        growing(spark, sf_dir).gold.snapshot().read,
        "fact_reviews",
        {
            "customer_sk": ("dim_customer", "customer_unique_id"),
            "product_sk": ("dim_product", "product_id"),
            "customer_geography_sk": ("dim_geography", "zip_code_prefix"),
        },
    )


# --- gold ------------------------------------------------------------------


def _dimension(table: str) -> Query:
    return lambda spark, sf_dir: build.dimension(table, warehouse(spark, sf_dir).silver)


def _fact(table: str) -> Query:
    def from_stored(spark, sf_dir):
        w = warehouse(spark, sf_dir)
        return build.fact(table, w.silver, w.gold)

    return from_stored


for _table in build.DIMENSIONS:
    query(f"gold_{_table}")(_dimension(_table))
for _table in build.FACTS:
    query(f"gold_{_table}")(_fact(_table))


@query("key_dense")
def _(spark, sf_dir):
    orders = derive.given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return keys.assign_dense_key(orders, ["o_orderdate", "o_orderkey"], "order_sk")


@query("key_refresh")
def _(spark, sf_dir):
    """Orders get keys in two refreshes: those of the first keep theirs."""
    orders = derive.given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    first = keys.assign_stable_key(orders.filter("o_orderstatus = 'F'"), "o_orderkey", "order_sk", None)
    second = keys.assign_stable_key(orders, "o_orderkey", "order_sk", first)
    return second.select("o_orderkey", "order_sk")


# --- saved queries ---------------------------------------------------------


def _saved(name: str, filters: dict | None = None, limit: int | None = None, k: int = 5, wildcards=False):
    return lambda spark, sf_dir: _rounded(
        saved.run(warehouse(spark, sf_dir).gold, name, filters, limit, k, wildcards)
    )


def _rounded(df: DataFrame) -> DataFrame:
    if "avg_order_value" not in df.columns:
        return df
    return df.withColumn("avg_order_value", F.round("avg_order_value", 2))


query("q_customer_count")(_saved("cus_cnt"))
query("q_product_count")(_saved("prd_cnt"))
query("q_revenue_by_region")(_saved("revenue_by_region"))
query("q_top_categories")(_saved("top_products_by_category"))
query("q_review_analysis")(_saved("review_analysis"))


@query("q_customer_count_with_unknown")
def _(spark, sf_dir):
    return saved.customer_count_with_unknown(warehouse(spark, sf_dir).gold)


FILTERS = {
    "q_filter_eq": {"region": "SUL"},
    "q_filter_gte": {"full_date_gte": "1998-01-01"},
    "q_filter_lte": {"full_date_to": "1997-06-30"},
    "q_filter_gt": {"unit_price_gt": "50000.50"},
    "q_filter_lt": {"date_sk_lt": "19970101"},
    "q_filter_like": {"city_like": "Y 1"},
    "q_filter_in": {"state_in": "SP,BA"},
    "q_filter_timestamp": {"order_purchase_timestamp_gte": "1996-07-01 12:00:00"},
    "q_filter_and": {
        "full_date_from": "1996-01-01",
        "full_date_lte": "1999-12-31",
        "region_in": "SUDESTE,NORTE",
        "is_delivered": "true",
        "city": "",
    },
}
for _name, _filters in FILTERS.items():
    query(_name)(_saved("revenue_by_region", _filters, k=100))

query("q_filter_wildcard")(_saved("revenue_by_region", {"city_like": "C_TY%1"}, k=100, wildcards=True))
query("q_limit")(_saved("revenue_by_region", limit=3, k=100))


@query("q_schema")
def _(spark, sf_dir):
    described = saved.describe(warehouse(spark, sf_dir).gold, "review_analysis")
    return described.select("position", "name", "example")


@query("report_by_state")
def _(spark, sf_dir):
    return saved.customers_by_state(warehouse(spark, sf_dir).silver("customers"))


@query("report_by_city")
def _(spark, sf_dir):
    return saved.customers_by_city(warehouse(spark, sf_dir).silver("customers"))


@query("report_one_state")
def _(spark, sf_dir):
    return saved.customers_of_state(warehouse(spark, sf_dir).silver("customers"), "SP")


# --- quality ---------------------------------------------------------------

VERDICT = ["table_name", "check_name", "checked", "violations", "unknown", "violation_pct", "passed"]


def _column_reports(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    reports = [
        quality.column_checks(
            w.silver(t).drop(silver.AUDIT), t, rules.SILVER_KEYS[t], rules.RULES[t]
        )
        for t in SOURCE_TABLES
    ]
    found = reduce(DataFrame.unionByName, reports).filter(F.col("check_kind") == kind)
    return found.select(*VERDICT)


@query("dq_null_keys")
def _(spark, sf_dir):
    return _column_reports(spark, sf_dir, "null_key")


@query("dq_null_profile")
def _(spark, sf_dir):
    return _column_reports(spark, sf_dir, "null_profile")


@query("dq_rules")
def _(spark, sf_dir):
    return _column_reports(spark, sf_dir, "rule")


@query("dq_duplicates")
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    reports = [
        quality.duplicate_check(w.silver(t), t, rules.SILVER_KEYS[t]) for t in SOURCE_TABLES
    ]
    lines = derive.given(spark, sf_dir, "lineitem")
    reports.append(quality.duplicate_check(lines, "lineitem", ["l_orderkey", "l_linenumber"]))
    return reduce(DataFrame.unionByName, reports).select(*VERDICT)


@query("dq_orphans")
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    reports = [r for t in SOURCE_TABLES for r in rules.silver_orphans(t, w.silver)]
    return reduce(DataFrame.unionByName, reports).select(*VERDICT)


KEPT = {"dq_kept_null_profile": "null_profile", "dq_kept_rules": "rule", "dq_kept_duplicates": "duplicate", "dq_kept_orphans": "orphan"}


def _kept_quality(kind: str) -> Query:
    """Checks kept up by what each batch changed, after the last."""
    return lambda spark, sf_dir: growing(spark, sf_dir).quality.report().filter(F.col("check_kind") == kind).select(*VERDICT)


for _name, _kind in KEPT.items():
    query(_name)(_kept_quality(_kind))


@query("layer_summary")
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    for table in SOURCE_TABLES:
        w.silver(table)  # stored on first use
    return w.silver_layer.summary(SOURCE_TABLES)
