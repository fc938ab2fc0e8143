"""Change messages as ``(topic, kafka_partition, kafka_offset, value)``.

Kafka needs Spark's Kafka connector on the class path. Any other batch or
stream of the same four columns works wherever these functions' results do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE_SCHEMA = "topic string, kafka_partition int, kafka_offset bigint, value string"


def from_kafka_records(records: DataFrame) -> DataFrame:
    """Rename the Kafka source's columns and read the payload as text."""
    return records.selectExpr(
        "topic",
        "partition AS kafka_partition",
        "offset AS kafka_offset",
        "CAST(value AS STRING) AS value",
    )


def kafka_batch(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """All messages of one topic from the earliest to the latest offset."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        **options,
    }
    return from_kafka_records(spark.read.format("kafka").options(**settings).load())


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str | None = None,
    pattern: str | None = None,
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Unbounded messages of one topic, or of every topic matching a pattern.

    ``max_offsets_per_trigger`` bounds a micro-batch; catching up takes as many as it needs.
    """
    if (topic is None) == (pattern is None):
        raise ValueError("give either a topic or a pattern")
    if not max_offsets_per_trigger or max_offsets_per_trigger < 1:
        raise ValueError("give max_offsets_per_trigger: without it the first batch is the whole history")
    chosen = {"subscribe": topic} if topic else {"subscribePattern": pattern}
    settings = {
        "kafka.bootstrap.servers": servers,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
        **chosen,
        **options,
    }
    return from_kafka_records(spark.readStream.format("kafka").options(**settings).load())


def file_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Messages landed as files, read as an unbounded stream."""
    return (
        spark.readStream.format(fmt)
        .schema(MESSAGE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
