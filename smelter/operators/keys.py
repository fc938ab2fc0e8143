"""Surrogate keys and unknown members."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.scratch import written

UNKNOWN_KEY = -1


def assign_dense_key(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Add key 1..n in the order of ``order_by``, which must identify a row.

    Equals ``row_number() over (order by ...)`` without moving all rows to one
    task: range-partition, number each partition, write, then shift every
    partition by the rows before it. Range bounds are sampled, so partition and
    position are stored in one write and only read from there.
    """
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    # High bits: partition, in range order. Low 33 bits: position within it.
    stored = written(ranged.withColumn("_slot", F.monotonically_increasing_id()), f"keys-{name}")
    partition = F.shiftright("_slot", 33)
    position = F.col("_slot").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(partition.alias("_part")).agg(F.count("*").alias("_size"))
    # One row per partition of the write, so a single task adds them up and
    # every task can hold them.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return (
        stored.withColumn("_part", partition)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_before") + position + 1).cast("long").alias(name), *df.columns)
    )


def assign_stable_key(
    df: DataFrame, business_key: str, name: str, previous: DataFrame | None
) -> DataFrame:
    """Add a key that known members keep and new ones get after the largest so far.

    ``previous`` has the two key columns of the last refresh (None: there was none). ``business_key``
    identifies a row. Members that are gone leave gaps; on a first refresh the keys are dense.
    """
    if previous is None:
        return assign_dense_key(df, [business_key], name)
    known = written(
        previous.filter(F.col(name) != UNKNOWN_KEY).select(F.col(business_key), F.col(name)), f"known-{name}"
    )
    last = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    fresh = assign_dense_key(df.join(known, business_key, "left_anti"), [business_key], name)
    kept = df.join(known, business_key).select(name, *df.columns)
    return kept.unionByName(fresh.withColumn(name, F.col(name) + F.lit(last)))


def unique_key() -> Column:
    """A key that is unique and at least 1, but neither dense nor repeatable.

    For tables nothing refers to: it costs no shuffle, and is fixed once written.
    """
    return F.monotonically_increasing_id() + 1


def with_unknown_member(df: DataFrame, key: str, values: dict[str, Any]) -> DataFrame:
    """Add the row that stands for a missing lookup; columns not given are NULL."""
    row = [UNKNOWN_KEY if c == key else values.get(c) for c in df.columns]
    member = df.sparkSession.range(1).select(
        *[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(df.columns, row)]
    )
    return df.unionByName(member)


def known_members(dim: DataFrame, key: str) -> DataFrame:
    return dim.filter(F.col(key) != UNKNOWN_KEY)


def or_unknown(key: Column) -> Column:
    return F.coalesce(key.cast("long"), F.lit(UNKNOWN_KEY).cast("long"))
