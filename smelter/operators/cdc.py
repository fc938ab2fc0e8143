"""Change messages: parse the envelope, fold a log into its current rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.functions.columns import clean_text
from smelter.specs import TableSpec

# Arrival position within the log; breaks ties between equal ts_ms.
POSITION = ("kafka_partition", "kafka_offset")
LOG_ORDER = ("ts_ms", *POSITION)
DELETE = "d"
# Create, update, delete, snapshot read.
OPERATIONS = ("c", "u", DELETE, "r")


def envelope_schema(spec: TableSpec) -> T.StructType:
    """Accepts the envelope under ``payload`` and the bare envelope alike."""
    body = T.StructType(
        [
            T.StructField("before", spec.change_schema),
            T.StructField("after", spec.change_schema),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )
    return T.StructType([T.StructField("payload", body), *body.fields])


def _reason(fields: dict[str, Column], spec: TableSpec) -> Column:
    """Why a message cannot be applied; NULL for a sound change."""
    op, before, after = fields["op"], fields["before"], fields["after"]
    image = F.when(op == DELETE, before.isNotNull()).otherwise(after.isNotNull())
    parts = [
        F.coalesce(after.getField(k), before.getField(k)).isNotNull() for k in spec.keys
    ]
    return (
        F.when(F.col("value").isNull(), "empty message")
        .when(op.isNull(), "not a change envelope")
        .when(~op.isin(*OPERATIONS), "unknown operation")
        .when(fields["ts_ms"].isNull(), "no change time")
        .when(~image, "no row image")
        .when(~reduce(and_, parts, F.lit(True)), "no key")
    )


def read_envelopes(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """Messages -> bronze rows: ``(topic, before, after, op, ts_ms, position, raw, reason)``.

    A message that cannot be applied has NULL ``op``, keeps its text in ``raw`` and says why in ``reason``.
    The text is parsed by a generator, because Spark would copy a plain
    expression into every later filter and parse the message again for each.
    """
    parse = F.from_json("value", envelope_schema(spec))
    parsed = messages.select("topic", *POSITION, "value", F.explode(F.array(parse)).alias("_m"))
    fields = {
        name: F.coalesce(F.col(f"_m.payload.{name}"), F.col(f"_m.{name}"))
        for name in ("before", "after", "op", "ts_ms")
    }
    read = parsed.select(
        "topic", *[col.alias(name) for name, col in fields.items()], *POSITION, "value"
    )
    named = {name: F.col(name) for name in fields}
    judged = read.withColumn("reason", _reason(named, spec))
    sound = F.col("reason").isNull()
    return judged.select(
        "topic",
        "before",
        "after",
        F.when(sound, F.col("op")).alias("op"),
        "ts_ms",
        *POSITION,
        F.when(~sound, F.col("value")).alias("raw"),
        "reason",
    )


def valid_changes(bronze: DataFrame) -> DataFrame:
    """The rows that carry an operation."""
    return bronze.filter(F.col("op").isNotNull()).drop("raw", "reason")


def rejected_messages(bronze: DataFrame) -> DataFrame:
    """Everything ``valid_changes`` leaves out, with the text and the reason."""
    return bronze.filter(F.col("op").isNull()).select("topic", *POSITION, "raw", "reason")


def parse_changes(messages: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """``(valid changes, rejected messages)``; store the bronze rows where both are needed."""
    bronze = read_envelopes(messages, spec)
    return valid_changes(bronze), rejected_messages(bronze)


def check_deletes(deletes: str) -> None:
    if deletes not in ("apply", "ignore"):
        raise ValueError(f"deletes must be 'apply' or 'ignore', not {deletes!r}")


def image_effects(changes: DataFrame, deletes: str = "apply") -> DataFrame:
    """``(image, n)``: every addition of a row image as 1, every removal as -1; replays must be gone already."""
    check_deletes(deletes)
    added = F.when(F.col("op") != DELETE, F.struct(F.col("after").alias("image"), F.lit(1).alias("n")))
    removed = F.when(
        F.col("op").isin(DELETE, "u") & F.col("before").isNotNull(),
        F.struct(F.col("before").alias("image"), F.lit(-1).alias("n")),
    )
    effects = [added] if deletes == "ignore" else [added, removed]
    return changes.select(F.explode(F.array_compact(F.array(*effects))).alias("e")).select("e.*")


def current_images(changes: DataFrame, deletes: str = "apply") -> DataFrame:
    """Row images of a log without a key: each as often as it was added, less the times it was removed.

    A delete removes one row equal to its ``before``, an update one such row if it names one; a row
    removed more often than added is gone. Replayed messages, alike in position and time, count once.
    ``deletes="ignore"`` counts additions alone.
    """
    check_deletes(deletes)
    sound = changes.filter(F.col("op").isNotNull()).dropDuplicates(["topic", *POSITION, "ts_ms"])
    left = image_effects(sound, deletes).groupBy("image").agg(F.sum("n").alias("n")).filter("n > 0")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int")))
    return left.select("image", copies.alias("_copy")).select("image.*")


def latest_versions(
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    deletes: str = "apply",
) -> DataFrame:
    """The last change of every key, deletes too: ``(keys, op, after, order_by)``; see ``latest_by_key``."""
    check_deletes(deletes)
    kept = F.col("op") != DELETE if deletes == "ignore" else F.col("op").isNotNull()
    changes = changes.filter(kept)
    normalised = [
        clean_text(F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}"))).alias(k) for k in keys
    ]
    keyed = changes.select(*normalised, "op", "after", *order_by).dropna(subset=list(keys))
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_by])
    return keyed.withColumn("version", F.row_number().over(newest_first)).filter(F.col("version") == 1).drop("version")


def current_rows(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that last versions stand for; a delete stands for none."""
    image = versions.schema["after"].dataType.fieldNames()
    live = versions.filter(F.col("op") != DELETE)
    return live.select(*[F.col(c) if c in keys else F.col(f"after.{c}") for c in image])


def latest_by_key(
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    deletes: str = "apply",
) -> DataFrame:
    """Current rows of a change log: the last version of every key.

    ``deletes="apply"`` picks the last change first, so a deleted key is gone.
    ``deletes="ignore"`` drops delete events first, so such a key comes back
    as its last other version. Keys compare after trimming, and come from
    ``before`` where ``after`` is NULL. Rows with a NULL key part and rejected
    messages are dropped.

    Spark evaluates ``version = 1`` on both sides of the shuffle, so a key that
    holds most of the log sends one row per task.
    """
    return current_rows(latest_versions(changes, keys, order_by, deletes), keys)


def sample_changes(changes: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` changes of the log with their row images."""
    return changes.orderBy(*LOG_ORDER).limit(n).select("op", "ts_ms", "after.*")
