"""Sums over all earlier rows of a group, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.scratch import written


def prefix_sums(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], sums: dict[str, str]
) -> DataFrame:
    """Add, for each ``name: column`` of ``sums``, the sum of ``column`` over the rows before.

    "Before" is by ``order`` within equal ``group`` values (none: one group; NULL is a value of its
    own). Rows are range-partitioned, so a group of any size spans several partitions; each
    partition is summed on its own and shifted by the partitions before. Only one row per group
    and partition is windowed a second time. Rows that ``order`` cannot tell apart come in any
    order, which is stored once and then the same for every reader. An empty input gives no rows.
    """
    clash = {"_slot", "_part", "_shift", *(f"_{n}" for n in sums)} & set(df.columns)
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    keys = [F.col(c) if isinstance(c, str) else c for c in (*group, *order)]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = written(ranged.withColumn("_slot", F.monotonically_increasing_id()), "prefix")
    parted = stored.withColumn("_part", F.shiftright("_slot", 33))
    totals = parted.groupBy("_part", *group).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        F.col("_part").alias("_shift"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums],
    )
    inside = Window.partitionBy("_part", *group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    local = parted.select(
        *df.columns, "_part", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(n) for n, c in sums.items()]
    )
    same = F.col("_part") == F.col("_shift")
    for i, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return local.join(shifts, same, "left").select(
        *df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums]
    )
