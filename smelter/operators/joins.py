"""Equi joins that hold when one key carries a large share of the rows.

Nothing here forces a broadcast of data: Spark broadcasts a side when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
What a shuffle cannot survive is one key with billions of rows, so keys that
outgrow a task are counted first and spread over several.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from smelter.operators.keys import known_members, or_unknown
from smelter.scratch import written

ROWS_PER_TASK = 5_000_000
PLACES = 256  # by which keys are counted first, for each task's worth of rows


@dataclass(frozen=True)
class Heavy:
    """Keys with more rows than one task should take: a table of (_key, _splits)."""

    table: DataFrame | None = None

    def __bool__(self) -> bool:
        return self.table is not None

    def added_to(self, df: DataFrame, on: str) -> DataFrame:
        """``df`` with the number of tasks its key is spread over, in ``_splits``.

        Every heavy key has over ``rows_per_task`` rows, so there are fewer of them than
        rows / rows_per_task: the table is small enough to broadcast at any scale.
        """
        known = df.join(F.broadcast(self.table), F.col(on).eqNullSafe(F.col("_key")), "left")
        return known.select(*df.columns, F.coalesce("_splits", F.lit(1)).alias("_splits"))


NOT_HEAVY = Heavy()


def heavy_keys(
    df: DataFrame, columns: list[str], rows_per_task: int = ROWS_PER_TASK
) -> dict[str, Heavy]:
    """Find every heavy key of several columns, NULL among them, by exact counts.

    Rows are first counted by a hash of the key, in a few hundred places per task's worth of rows: a heavy key makes its place
    crowded, and only keys of crowded places are counted themselves. Counts are summed map-side; only crowded places and heavy
    keys are stored, and none reaches the driver. A table with no more rows than a task takes has no heavy key, so its keys are
    not counted. The counts only choose how rows are spread; results do not depend on them.
    """
    rows = df.count()
    if rows <= rows_per_task:
        return dict.fromkeys(columns, NOT_HEAVY)
    result = {}
    for column in columns:
        place = F.pmod(F.xxhash64(column), F.lit(PLACES * -(-rows // rows_per_task)))
        places = df.groupBy(place.alias("_place")).agg(F.count("*").alias("_n"))
        crowded = written(places.filter(F.col("_n") > rows_per_task).select("_place"), "crowded")
        result[column] = NOT_HEAVY
        if crowded.isEmpty():
            continue
        keys = df.select(F.col(column).alias("_key"), place.alias("_place")).join(F.broadcast(crowded), "_place", "left_semi")
        counts = keys.groupBy("_key").agg(F.count("*").alias("_n"))
        splits = F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_splits")
        table = written(counts.filter(F.col("_n") > rows_per_task).select("_key", splits), "heavy")
        if not table.isEmpty():
            result[column] = Heavy(table)
    return result


def _pick(df: DataFrame) -> Column:
    # Row content alone would keep equal rows together; the partition id parts them.
    spread = F.xxhash64(F.spark_partition_id(), *[c for c in df.columns if c != "_splits"])
    return F.when(F.col("_splits") > 1, F.pmod(spread, F.col("_splits"))).otherwise(0).cast("int")


def _every() -> Column:
    return F.explode(F.sequence(F.lit(0), F.col("_splits") - 1))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    heavy_left: Heavy = NOT_HEAVY,
    heavy_right: Heavy = NOT_HEAVY,
) -> DataFrame:
    """Join on one column, spreading the heavy keys of either side.

    Rows of a heavy key get one of its split numbers on the heavy side and all
    of them on the other, so every pair still meets exactly once. Only an inner
    join may spread the right side.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    if how == "left" and heavy_right:
        raise ValueError("a left join cannot spread its right side")
    salts = []
    for side, heavy in (("l", heavy_left), ("r", heavy_right)):
        if not heavy:
            continue
        name = f"_salt_{side}"
        left, right = heavy.added_to(left, on), heavy.added_to(right, on)
        if side == "l":
            left, right = left.withColumn(name, _pick(left)), right.withColumn(name, _every())
        else:
            left, right = left.withColumn(name, _every()), right.withColumn(name, _pick(right))
        left, right = left.drop("_splits"), right.drop("_splits")
        salts.append(name)
    return left.join(right, [on, *salts], how).drop(*salts)


def look_up(
    rows: DataFrame,
    dim: DataFrame,
    on: str,
    dim_key: str,
    key: str,
    alias: str | None = None,
    heavy: Heavy = NOT_HEAVY,
) -> DataFrame:
    """Add the surrogate key of ``rows[on]`` in ``dim``, or the unknown member.

    The unknown member itself never matches, whatever its business key says. ``dim`` has one row per key; where it
    is stored bucketed by ``dim_key``, it is read where it is and only ``rows`` are shuffled.
    """
    alias = alias or key
    lookup = known_members(dim, key).select(F.col(dim_key).alias(on), F.col(key).alias(alias))
    if heavy and isinstance(rows.schema[on].dataType, StringType):
        return _look_up_heavy(rows, lookup, on, alias, heavy)
    joined = spread_join(rows, lookup, on, "left", heavy_left=heavy)
    return joined.withColumn(alias, or_unknown(F.col(alias)))


def _look_up_heavy(rows: DataFrame, lookup: DataFrame, on: str, alias: str, heavy: Heavy) -> DataFrame:
    """The members of heavy keys come by broadcast, so the look-up table need not be copied per split.

    There is at most one member per heavy key: no more than there are heavy keys. Rows of such keys, NULL among them, pass
    the join under made-up places, spread over tasks; what they find there is not used.
    """
    members = lookup.join(F.broadcast(heavy.table), F.col(on) == F.col("_key"), "left_semi")
    members = F.broadcast(members.select(F.col(on).alias("_member"), F.col(alias).alias("_direct")))
    known = heavy.added_to(rows, on)
    place = F.when(F.col("_splits") > 1, F.concat(F.lit("\0"), _pick(known).cast("string"))).otherwise(F.col(on))
    known = known.withColumn("_place", place)
    known = known.join(members, (F.col("_splits") > 1) & (F.col(on) == F.col("_member")), "left")
    found = lookup.select(F.col(on).alias("_place"), F.col(alias).alias("_found"))
    value = F.when(F.col("_splits") > 1, F.col("_direct")).otherwise(F.col("_found"))
    return known.join(found, "_place", "left").select(*rows.columns, or_unknown(value).alias(alias))
