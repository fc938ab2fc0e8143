"""The given tables in the role of the e-commerce source tables.

``SOURCE_SQL`` runs unchanged on Spark and DuckDB. Events move back 26 years to
play reviews, into the years of the orders. ``_n`` numbers the source
rows; the change log of a table is built from it by the rules of ``messages``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.specs import SOURCE_TABLES, TableSpec

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_STATE = """CASE c_nationkey % 6 WHEN 0 THEN 'sp' WHEN 1 THEN 'RS' WHEN 2 THEN 'GO'
       WHEN 3 THEN 'BA' WHEN 4 THEN 'AM' ELSE 'XX' END"""

SOURCE_SQL: dict[str, str] = {
    "customers": f"""
SELECT c_custkey AS _n, CAST(c_custkey AS STRING) AS customer_id,
       CAST(CAST(floor(c_custkey / 2.0) AS BIGINT) AS STRING) AS customer_unique_id,
       lpad(CAST(c_nationkey AS STRING), 5, '0') AS customer_zip_code_prefix,
       concat('  city ', CAST(c_nationkey AS STRING), ' ') AS customer_city,
       {_STATE} AS customer_state
FROM customer""",
    "sellers": """
SELECT s_suppkey AS _n, CAST(s_suppkey AS STRING) AS seller_id,
       lpad(CAST(s_nationkey AS STRING), 5, '0') AS seller_zip_code_prefix,
       concat(' city ', CAST(s_nationkey AS STRING)) AS seller_city,
       CASE s_nationkey % 3 WHEN 0 THEN 'sp' WHEN 1 THEN 'RS' ELSE 'S1' END AS seller_state
FROM supplier""",
    "geolocation": f"""
SELECT c_custkey AS _n,
       CASE WHEN c_nationkey = 7 THEN '99907' ELSE lpad(CAST(c_nationkey AS STRING), 5, '0') END
         AS geolocation_zip_code_prefix,
       CAST((c_custkey * 37) % 200 - 100 AS DOUBLE) AS geolocation_lat,
       CAST((c_custkey * 53) % 400 - 200 AS DOUBLE) AS geolocation_lng,
       concat(' city ', CAST(c_custkey % 2 AS STRING)) AS geolocation_city,
       {_STATE} AS geolocation_state
FROM customer""",
    "category_translation": """
SELECT min(p_partkey) AS _n,
       CASE WHEN p_type = 'SMALL' THEN 'OTHER SMALL' ELSE p_type END AS product_category_name,
       lower(p_type) AS product_category_name_english
FROM part GROUP BY p_type""",
    "products": """
SELECT p_partkey AS _n, CAST(p_partkey AS STRING) AS product_id, p_type AS product_category_name,
       length(p_name) AS product_name_length, p_size * 10 AS product_description_length,
       p_partkey % 5 AS product_photos_qty,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size * 300 END AS product_weight_g,
       p_size AS product_length_cm, p_partkey % 40 + 1 AS product_height_cm,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 40 END AS product_width_cm
FROM part""",
    "orders": """
SELECT o_orderkey AS _n, CAST(o_orderkey AS STRING) AS order_id,
       CAST(o_custkey AS STRING) AS customer_id,
       CASE WHEN o_orderstatus = 'F' THEN ' delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
            WHEN o_orderkey % 3 = 0 THEN 'canceled' WHEN o_orderkey % 3 = 1 THEN 'processing'
            ELSE 'returned' END AS order_status,
       o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            ELSE o_orderdate + (o_orderkey % 4) * INTERVAL '1' DAY END AS order_approved_at,
       o_orderdate + 3 * INTERVAL '1' DAY AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + (o_orderkey % 40) * INTERVAL '1' DAY END
         AS order_delivered_customer_date,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL
            ELSE o_orderdate + 20 * INTERVAL '1' DAY END AS order_estimated_delivery_date
FROM orders""",
    "order_items": """
SELECT l_partkey * 100000 + l_suppkey AS _n, CAST(l_orderkey AS STRING) AS order_id,
       l_linenumber AS order_item_id,
       CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
       l_shipdate AS shipping_limit_date, l_extendedprice AS price,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS freight_value
FROM lineitem""",
    "order_payments": """
SELECT o_orderkey AS _n, CAST(o_orderkey AS STRING) AS order_id, 1 AS payment_sequential,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
            WHEN '3-MEDIUM' THEN 'voucher' WHEN '5-LOW' THEN 'debit_card'
            ELSE 'not_defined' END AS payment_type,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderkey % 13 END AS payment_installments,
       o_totalprice AS payment_value
FROM orders""",
    "order_reviews": """
SELECT event_id AS _n, CAST(event_id AS STRING) AS review_id, CAST(event_id AS STRING) AS order_id,
       CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_id % 6 END AS review_score,
       CASE event_type WHEN 'error' THEN '  ' WHEN 'view' THEN NULL ELSE event_type END
         AS review_comment_title,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END AS review_comment_message,
       ts - INTERVAL '9490' DAY AS review_creation_date,
       ts - INTERVAL '9490' DAY + (event_id % 100) * INTERVAL '37' MINUTE
         AS review_answer_timestamp
FROM events""",
}

# Log start, in epoch milliseconds.
EPOCH = 1_500_000_000_000


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source(spark: SparkSession, sf_dir: str, table: str, spread: bool = False) -> DataFrame:
    """Typed source rows with their number ``_n``; with ``spread``, dealt over all cores if the file is not."""
    views = {name: given(spark, sf_dir, name) for name in GIVEN if f"FROM {name}" in SOURCE_SQL[table]}
    text = SOURCE_SQL[table]
    for name in views:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}")
    rows = spark.sql(text, **views)
    return spread_out(rows, *views.values()) if spread else rows


def spread_out(df: DataFrame, *read: DataFrame) -> DataFrame:
    """Use all cores on a test file, which is a single row group.

    A large file is read in a part per core or more, and is not shuffled. ``read``: the tables as given that ``df`` is made from;
    none if it is one itself.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = min(table.rdd.getNumPartitions() for table in read or (df,))
    return df if parts >= cores else df.repartition(cores)


def epoch_millis(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> milliseconds, whatever the session time zone."""
    seconds = (ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
    return F.floor(seconds.cast("decimal(20,6)") * 1000).cast("bigint")


def as_text(df: DataFrame, column: str) -> Column:
    """A source value in the form the capture connector sends."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return epoch_millis(F.col(column)).cast("string")
    if isinstance(dtype, T.DoubleType):
        return F.col(column).cast("decimal(18,2)").cast("string")
    return F.col(column).cast("string")


def messages(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The change log of a derived table, as messages.

    Every source row is one change. Keyed tables other than order items also have,
    by row number: an older version that arrives later (n % 10 = 0), a version of
    equal time with an earlier offset (n % 10 = 1), and a delete that names only
    the key (n % 50 = 7). Their last column reads ``stale``. Order items have
    natural versions, ordered by shipping date and offset. Geolocation, without
    key, has replayed messages (n % 10 = 0). Odd rows come without ``payload``.
    """
    spec = SOURCE_TABLES[table]
    rows = source(spark, sf_dir, table, spread=True)
    names, last = list(spec.columns), list(spec.columns)[-1]
    image = F.struct(*[as_text(rows, c).alias(c) for c in names])
    stale = image.withField(last, F.lit("stale"))
    key_only = F.struct(
        *[
            (as_text(rows, c) if c in spec.keys else F.lit(None).cast("string")).alias(c)
            for c in names
        ]
    )
    none = F.lit(None).cast(spec.change_schema)
    n = F.col("_n")
    at = F.lit(EPOCH) + n * 1000

    def change(op, before, after, ts_ms, offset, when=F.lit(True)):
        body = F.struct(
            before.alias("before"),
            after.alias("after"),
            F.lit(op).alias("op"),
            ts_ms.alias("ts_ms"),
            offset.alias("offset"),
        )
        return F.when(when, body)

    if table == "order_items":
        shipped = epoch_millis(F.col("shipping_limit_date"))
        changes = [change("u", none, image, shipped, n)]
    elif table == "geolocation":
        changes = [
            change("r", none, image, at, n * 4),
            change("r", none, image, at, n * 4, n % 10 == 0),
            change("d", image, none, at + 1000, n * 4 + 1, n % 50 == 7),
        ]
    else:
        changes = [
            change("r", none, image, at, n * 4 + 1),
            change("r", none, stale, at - 500, n * 4 + 2, n % 10 == 0),
            change("u", stale, stale, at, n * 4, n % 10 == 1),
        ]
        if table != "category_translation":
            changes.append(change("d", key_only, none, at + 1000, n * 4 + 3, n % 50 == 7))
    log = rows.select("_n", F.explode(F.array_compact(F.array(*changes))).alias("c"))
    body = F.struct("c.before", "c.after", "c.op", "c.ts_ms")
    return log.select(
        F.lit(table).alias("topic"),
        F.pmod("_n", F.lit(4)).cast("int").alias("kafka_partition"),
        F.col("c.offset").cast("bigint").alias("kafka_offset"),
        F.when(F.pmod("_n", F.lit(2)) == 0, F.to_json(F.struct(body.alias("payload"))))
        .otherwise(F.to_json(body))
        .alias("value"),
    )


# The events table as a change log: key user_id, deletes from 'error'.
EVENT_LOG = TableSpec("event_log", {"k": "string", "v": "string"}, keys=("k",))
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def event_messages(
    events: DataFrame, wrapped: bool = True, broken: bool = False, topic: Column | None = None
) -> DataFrame:
    """Events as messages; works on a stream too.

    Two neighbours share one ``ts_ms``, so the offset decides between them. With
    ``broken``, every 7th text is cut short and every 11th message is empty.
    """
    is_delete = F.col("event_type") == "error"
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    key = F.col("user_id").cast("string")
    row = EVENT_LOG.change_schema
    body = F.struct(
        F.when(is_delete, F.struct(key.alias("k"), F.lit(None).cast("string").alias("v")))
        .otherwise(F.lit(None).cast(row))
        .alias("before"),
        F.when(~is_delete, F.struct(key.alias("k"), amount.alias("v"))).alias("after"),
        F.when(F.col("event_type") == "signup", "c")
        .when(is_delete, "d")
        .otherwise("u")
        .alias("op"),
        (F.lit(EPOCH) + F.floor(F.col("event_id") / 2) * 1000).alias("ts_ms"),
    )
    value = F.to_json(F.struct(body.alias("payload")) if wrapped else body)
    if broken:
        value = F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(
            F.when(F.col("event_id") % 7 == 0, F.substr(value, F.lit(1), F.length(value) - 9))
            .otherwise(value)
        )
    return events.select(
        (F.lit(EVENT_LOG.name) if topic is None else topic).alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        value.alias("value"),
    )


# Messages that cannot be applied, one shape for each remainder of event_id, and a sound one (5).
SHAPES_SQL = """concat('{"before":null,"after":',
  CASE event_id % 8 WHEN 1 THEN 'null' WHEN 2 THEN '"oops"' WHEN 6 THEN '{"k":null,"v":"1"}'
       ELSE concat('{"k":"', CAST(user_id AS STRING), '","v":"1"}') END,
  ',"op":"', CASE event_id % 8 WHEN 0 THEN 'x' WHEN 4 THEN 't' ELSE 'c' END,
  '","ts_ms":', CASE event_id % 8 WHEN 3 THEN '"soon"' ELSE CAST(event_id AS STRING) END, '}')"""


def odd_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"""
SELECT 'event_log' AS topic, CAST(user_id % 4 AS INT) AS kafka_partition, event_id AS kafka_offset,
       CASE WHEN event_id % 8 <> 7 THEN {SHAPES_SQL} END AS value FROM {{events}}"""
    return spark.sql(text.replace('{"', '{{"').replace('"}', '"}}').replace("'}'", "'}}'"), events=given(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as an unbounded stream."""
    schema = given(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
