"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.prefix import prefix_sums
from smelter.scratch import written


def draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) that depends on nothing but the key and the shard's number."""
    return (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + 0.5) * F.lit(2.0**-53)


def strength(key: Column, shard: int, weight: float) -> Column:
    """The highest bidder gets the key; a shard wins in proportion to its weight."""
    return F.lit(-float(weight)) / F.ln(draw(key, shard))


def place(key: Column, weights: Sequence[float]) -> Column:
    """struct(strength, -shard) of the winner among shards 0, 1, ...; ties go to the smaller number.

    A shard added at the end takes keys only into itself, since other shards' bids stay as they are.
    Shards of weight 0 or less get nothing.
    """
    bids = [
        F.struct(strength(key, i, w).alias("strength"), F.lit(-i).alias("negative"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    if not bids:
        raise ValueError("no shard has a weight")
    return F.array_max(F.array(*bids))


def shard(docs: DataFrame, weights: Sequence[float], key: str = "doc_id") -> DataFrame:
    """Assign each row a shard by its key, a slot in it, and its shard once one of weight 1 is added.

    Columns: the key, size (UTF-8 bytes of ``text``, NULL none, plus 16), text_crc32, shard, grown_shard, slot
    (0, 1, ... within the shard, in the order of key, checksum and size).
    Equal keys share a shard, a NULL key is a key; equal rows get different slots. Slots come from
    distributed prefix sums, so that no task sees a whole shard. No rows give no rows.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    bids = docs.select(
        F.col(key).alias(key),
        (F.length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        place(F.coalesce(F.col(key).cast("string"), F.lit("")), weights).alias("_winner"),
        strength(F.coalesce(F.col(key).cast("string"), F.lit("")), len(weights), 1.0).alias("_newcomer"),
    )
    placed = bids.select(
        key,
        "size",
        "text_crc32",
        (-F.col("_winner.negative")).alias("shard"),
        F.when(F.col("_newcomer") > F.col("_winner.strength"), F.lit(len(weights)))
        .otherwise(-F.col("_winner.negative"))
        .alias("grown_shard"),
    )
    stored = written(placed.withColumn("_one", F.lit(1)), "shards")
    return prefix_sums(stored, ["shard"], [key, "text_crc32", "size"], {"slot": "_one"}).drop("_one")
