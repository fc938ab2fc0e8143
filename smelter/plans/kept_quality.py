"""Quality checks that are kept up: counts move by what enters and leaves silver, and nothing else is read.

Null and rule counts are sums over rows, so a run adds those of the rows that came and takes away those of the rows that went. For
duplicates the number of rows per key is kept, for orphans the rows that refer to a key and those that have it, in tables bucketed
by key; only keys that a run touches change their part of the total.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.operators import quality
from smelter.operators.merge import enough_buckets, merged
from smelter.plans import silver
from smelter.plans.rules import RULES, SILVER_KEYS
from smelter.sources.tables import Bucketed, Layer, Snapshot
from smelter.specs import SOURCE_TABLES
from smelter.steps import run_steps
from smelter.streaming.fold import BUCKETS, NEW, SIGN, feed_since, last_run

NOTE = "quality"
AT_ONCE = 3  # checks counted beside each other


class KeptQuality:
    """The checks of a silver layer that is refreshed by folds."""

    def __init__(self, layer: Layer, buckets: int = BUCKETS):
        self.layer, self.buckets = layer, buckets

    def refresh(self) -> int:
        """Take in what changed since the last refresh; returns how many tables had to be counted from the start.

        Tables that were not made by folds, or changed too often since, are. States and counts are one release.
        """
        at = self.layer.snapshot()
        note = at.notes.get(NOTE, {})
        runs = {t: last_run(at, spec) for t, spec in SOURCE_TABLES.items()}
        feeds, fresh = {}, set()
        for table, spec in SOURCE_TABLES.items():
            feeds[table] = feed_since(self.layer, spec, at, note.get("runs", {}).get(table))
            if feeds[table] is None:
                feeds[table] = at.read(table).drop(silver.AUDIT).withColumn(SIGN, F.lit(1))
                fresh.add(table)
        stored: dict[str, Bucketed] = {}
        counts, self.dealt = {}, dict(note.get("buckets", {}))
        sizes = {table: feed.count() for table, feed in feeds.items()}

        def rows_and_grain(table: str) -> Callable[[], None]:
            def step() -> None:
                feed, old = feeds[table], {} if table in fresh else note["counts"]
                counts[f"columns {table}"] = self._columns(table, feed, old.get(f"columns {table}"))
                grain = feed.groupBy(_text(*SILVER_KEYS[table])).agg(F.sum(SIGN).cast("long").alias("rows"))
                measures = {"checked": lambda c: c("rows"), "violations": lambda c: F.greatest(c("rows") - 1, F.lit(0))}
                counts[f"grain {table}"] = self._keyed(at, stored, f"{table}_grain", grain, measures, old.get(f"grain {table}"), sizes[table])

            return step

        def orphans(table: str, column: str, parent: str, parent_column: str) -> Callable[[], None]:
            def step() -> None:
                name = f"{table}_{column}"
                again = {table, parent} & fresh
                sides = [
                    feeds[t] if not again or t in fresh else at.read(t).drop(silver.AUDIT).withColumn(SIGN, F.lit(1))
                    for t in (table, parent)
                ]
                refers = sides[0].select(
                    _text(column), F.col(SIGN).alias("children"), F.lit(0).alias("parents"), F.col(column).isNull().alias("missing")
                )
                has = sides[1].select(
                    _text(parent_column), F.lit(0).alias("children"), F.col(SIGN).alias("parents"), F.col(parent_column).isNull().alias("missing")
                )
                sums = [F.sum(c).cast("long").alias(c) for c in ("children", "parents")]
                delta = refers.unionByName(has).groupBy("key").agg(*sums, F.first("missing").alias("missing"))
                measures = {
                    "checked": lambda c: c("children"),
                    "violations": lambda c: F.when((c("parents") > 0) | F.col("missing"), 0).otherwise(c("children")),
                    "unknown": lambda c: F.when(F.col("missing"), c("children")).otherwise(0),
                }
                before = None if again else note["counts"].get(f"orphans {name}")
                moving = sum(side.count() for side in sides) if again else sizes[table] + sizes[parent]
                counts[f"orphans {name}"] = self._keyed(at, stored, f"{name}_references", delta, measures, before, moving)

            return step

        steps = {table: rows_and_grain(table) for table in SOURCE_TABLES}
        for table, spec in SOURCE_TABLES.items():
            steps |= {f"{table}_{c}": orphans(table, c, *parent) for c, parent in spec.foreign_keys.items()}
        run_steps(steps, AT_ONCE)
        self.layer.publish(stored, {NOTE: {"runs": runs, "counts": counts, "buckets": self.dealt}}, based_on=at)
        return len(fresh)

    def remove_old(self) -> int:
        """Remove counts per key before the last refresh, which no later one reads; returns how many folders."""
        return self.layer.expire_all(self.layer.snapshot().notes[NOTE]["buckets"])

    def _columns(self, table: str, feed: DataFrame, before: dict | None) -> dict:
        rows = feed.drop(SIGN)
        moved = feed.selectExpr(*quality.column_counts(rows.schema, RULES[table], SIGN)).first().asDict()
        return {name: value + (before[name] if before else 0) for name, value in moved.items()}

    def _keyed(
        self, at: Snapshot, stored: dict, name: str, delta: DataFrame, measures: dict, before: dict | None, moving: int
    ) -> dict:
        """Merge counts per key into a state, and move the totals by what the merged keys measure more or less.

        ``moving``: the rows behind ``delta``, which with those of the state are dealt into buckets enough.
        """
        sums = [c for c in delta.columns if c not in ("key", "missing")]
        kept = [c for c in delta.columns if c == "missing"]
        if before is None or not at.exists(name):
            before = None
            none = F.lit(None).cast(delta.select(*sums, *kept).schema)
            buckets = enough_buckets(self.buckets, moving)
            both = delta.repartition(buckets, "key").select("key", F.struct(*sums, *kept).alias("new"), none.alias("old"))
        else:
            state, stored_in = at.read(name), self.dealt.get(name, self.buckets)
            buckets = enough_buckets(stored_in, moving + state.count())
            both = merged(state.select(*delta.columns), delta, ["key"], buckets, stored_in)
        self.dealt[name] = buckets

        def side(column: str, which: str) -> Column:
            return F.coalesce(F.col(f"{which}.{column}"), F.lit(0).cast("long"))

        rows = both.select(
            "key",
            *[(side(c, "old") + side(c, "new")).alias(c) for c in sums],
            *[F.coalesce(f"old.{c}", f"new.{c}").alias(c) for c in kept],
            *[side(c, "old").alias(f"_{c}") for c in sums],
            F.col("new").isNotNull().alias(NEW),
        )
        stored[name] = self.layer.stage_bucketed(name, rows, buckets, ["key"])
        moved = self.layer.load_bucketed(stored[name]).filter(NEW)
        change = [
            F.coalesce(F.sum(of(F.col) - of(lambda c: F.col(f"_{c}"))), F.lit(0)).cast("long").alias(m) for m, of in measures.items()
        ]
        totals = moved.agg(*change).first().asDict()
        return {m: value + (before[m] if before else 0) for m, value in totals.items()}

    def report(self) -> DataFrame:
        """What ``rules.validate_layer`` reports, as of the last refresh."""
        at, spark = self.layer.snapshot(), self.layer.spark
        counts, reports = at.notes[NOTE]["counts"], []

        def row(values: dict) -> DataFrame:
            schema = T.StructType([T.StructField(name, T.LongType()) for name in values])
            return spark.createDataFrame([tuple(values.values())], schema)

        for table, spec in SOURCE_TABLES.items():
            schema = at.read(table).drop(silver.AUDIT).schema
            keys = SILVER_KEYS[table]
            reports.append(quality.column_report(row(counts[f"columns {table}"]), table, schema, keys, RULES[table]))
            grain = {"unknown": 0} | counts[f"grain {table}"]
            reports.append(quality.total_report(table, "duplicate", ", ".join(keys), row(grain)))
            for column in spec.foreign_keys:
                reports.append(quality.total_report(table, "orphan", column, row(counts[f"orphans {table}_{column}"])))
        return reduce(DataFrame.unionByName, reports)


def _text(*columns: str) -> Column:
    """A key as text, NULL parts told apart."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)])).alias("key")
