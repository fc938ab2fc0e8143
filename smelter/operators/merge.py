"""Insert rows whose key is not there yet; merge rows into a bucketed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 500_000


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the least by ``order_by``; cut down on both sides of the shuffle."""
    in_order = Window.partitionBy(*keys).orderBy(*order_by)
    numbered = df.withColumn("_position", F.row_number().over(in_order))
    return numbered.filter(F.col("_position") == 1).drop("_position")


def absent_rows(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The incoming rows to append: first per key, and only keys ``target`` lacks.

    Both sides are reduced to one row per key before they meet. As with a
    unique constraint, a key with a NULL part conflicts with nothing.
    """
    has_key = F.expr(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    fresh = first_per_key(incoming.filter(has_key), keys, order_by)
    present = target.select(*keys).distinct()
    return fresh.join(present, list(keys), "left_anti").select(*incoming.columns).unionByName(
        incoming.filter(~has_key)
    )


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """``target`` plus the absent rows; where ``target`` is a table, append ``absent_rows``."""
    return target.unionByName(absent_rows(target, incoming, keys, order_by))


def enough_buckets(buckets: int, rows: int) -> int:
    """``buckets``, doubled until none has more than ``ROWS_PER_BUCKET`` of ``rows``, if they are even.

    By doubling, a state that grows is dealt out again once each time its rows have doubled.
    """
    while buckets * ROWS_PER_BUCKET < rows:
        buckets *= 2
    return buckets


def merged(
    state: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int, stored_in: int | None = None
) -> DataFrame:
    """``(keys, old, new)``: both sides of every key as structs, NULL where a side lacks it.

    ``state`` is bucketed by ``keys``, and only ``new``, one row per key, is dealt out; of a state ``stored_in`` another
    number of buckets all rows are dealt again. Keys are never NULL. Sides are sorted, which may spill; a hash table may not.
    """

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(name))

    return dealt_join(packed(state, "old"), packed(new, "new"), keys, buckets, stored_in)


def dealt_join(
    state: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int, stored_in: int | None = None
) -> DataFrame:
    """The full outer join of ``state``, as it is bucketed, with ``new``; its rows lie by bucket."""
    joined = state.join(new.repartition(stored_in or buckets, *keys).hint("merge"), list(keys), "full_outer")
    return joined if stored_in in (None, buckets) else joined.repartition(buckets, *keys)
