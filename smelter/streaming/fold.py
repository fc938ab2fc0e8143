"""Silver from what is new: the state of every change log is kept, and a run folds in only the batches since the last.

The state of a log with keys is the last version of each key, deletes among them, so that a late older change is recognised. The state of a
log without keys is how often each row image was added less removed, the positions it has seen, and the exact sums behind the table's
means. States are bucketed by key: a run deals out the new batches by bucket and merges each bucket where it
is, without a shuffle of the state. State, silver table, changed keys and the batches taken in are one release of the silver layer,
so a run that dies has changed nothing and is simply run again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.operators.cdc import LOG_ORDER, POSITION, current_rows, image_effects, latest_versions, valid_changes
from smelter.operators.merge import dealt_join, enough_buckets, merged
from smelter.plans import silver
from smelter.scratch import written
from smelter.sources.tables import Bucketed, Layer, Snapshot
from smelter.specs import TableSpec
from smelter.streaming.ingest import committed, read_bronze

BUCKETS = 64
KEPT_CHANGES = 100  # runs whose changed keys are kept for readers that refresh from them
PLACE = ("zip_code_prefix", "city", "state")
STATES = ("versions", "seen", "counts", "places")  # parts of which a run reads the latest alone
NEW, OLD = "_new", "_old"  # what the last run changed, and what was there before
SIGN = "_sign"


def _identity(*columns: str) -> Column:
    """A text that tells values apart, NULLs too."""
    return F.to_json(F.struct(*columns))


class Fold:
    """The incremental fold of one source table.

    States have ``buckets``, or more where that would leave a bucket too many rows for a task; see ``enough_buckets``.
    """

    def __init__(self, layer: Layer, spec: TableSpec, buckets: int = BUCKETS, deletes: str = "apply"):
        self.layer, self.spec, self.buckets, self.deletes = layer, spec, buckets, deletes
        self.dealt, self.stored_in = buckets, None

    def name(self, part: str) -> str:
        return f"{self.spec.name}_{part}"

    def stage(self, part: str, rows: DataFrame, keys: Sequence[str]) -> Bucketed:
        return self.layer.stage_bucketed(self.name(part), rows, self.dealt, keys)

    def state(self, at: Snapshot, part: str) -> DataFrame | None:
        return at.read(self.name(part)).drop(NEW, OLD) if at.exists(self.name(part)) else None

    def run(self, bronze_root: str) -> bool:
        """Fold in the batches committed since the last run; whether there were any.

        The order of batches, replays and late changes do not matter: the table equals a fold of the whole log. Two runs at a time:
        the second fails with ``Conflict``.
        """
        at, seen = self.layer.snapshot(), committed(self.layer.spark, bronze_root)
        note = at.notes.get(self.spec.name)
        setting = {"buckets": self.buckets, "deletes": self.deletes}
        if note and {k: note[k] for k in setting} != setting:
            raise ValueError(f"the state of {self.spec.name} was made with other settings: {note}")
        applied = note["batches"] if note else {}
        if note and applied == seen.last():
            return False
        new = valid_changes(read_bronze(self.layer.spark, bronze_root, self.spec, seen, applied))
        rows = new.count()
        if note and not rows:  # of other tables only: nothing to rewrite
            self.layer.publish({}, {self.spec.name: note | {"batches": seen.last()}}, based_on=at)
            return False
        self.stored_in = note.get("dealt", self.buckets) if note else None
        state = self.state(at, "versions" if self.spec.keys else "seen")
        self.dealt = enough_buckets(self.stored_in or self.buckets, rows + (state.count() if state is not None else 0))
        fold = self.with_keys if self.spec.keys else self.without_keys
        stored, table, changed, feed = fold(at, new)
        stored[self.spec.name] = self.layer.stage(self.spec.name, table)
        number = note["run"] + 1 if note else 1
        paths = {"path": self.layer.stage(self.name("changed"), changed)}
        if state is not None:  # of a first run every row is new, and nobody has taken in a run before it
            paths["feed"] = self.layer.stage(self.name("feed"), feed)
        changes = [*(note["changes"] if note else []), {"run": number, **paths}][-KEPT_CHANGES:]
        now = {"run": number, "dealt": self.dealt, "batches": seen.last(), "changes": changes, "table": stored[self.spec.name]}
        self.layer.publish(stored, {self.spec.name: setting | now}, based_on=at)
        return True

    def with_keys(self, at: Snapshot, changes: DataFrame) -> tuple[dict[str, Bucketed], DataFrame, DataFrame, DataFrame]:
        """(states, table, changed keys, feed)."""
        keys, clean = self.spec.keys, silver.CLEAN[self.spec.name]
        new, state = latest_versions(changes, keys, deletes=self.deletes), self.state(at, "versions")
        if state is None:
            before = F.lit(None).cast(f"struct<op: string, after: {self.spec.change_schema.simpleString()}>")
            chosen = new.repartition(self.dealt, *keys).withColumns({NEW: F.lit(True), OLD: before})
        else:
            both = merged(state, new, keys, self.dealt, self.stored_in)
            order = [F.struct(*[F.col(f"{side}.{c}") for c in LOG_ORDER]) for side in ("new", "old")]
            newer = F.col("new").isNotNull() & (F.col("old").isNull() | (order[0] > order[1]))
            chosen = both.select(
                *keys,
                F.when(newer, F.col("new")).otherwise(F.col("old")).alias("v"),
                newer.alias(NEW),
                F.when(newer & F.col("old").isNotNull(), F.struct("old.op", "old.after")).alias(OLD),
            ).select(*keys, "v.*", NEW, OLD)
        stored = self.stage("versions", chosen, keys)
        versions = self.layer.load_bucketed(stored)
        # The marks of this run are read once below, and overwritten by the next run.
        moved = versions.filter(NEW)
        gone = moved.filter(F.col(OLD).isNotNull()).select(*keys, f"{OLD}.*")
        feed = _signed(clean(current_rows(gone, keys)), clean(current_rows(moved, keys)))
        return {self.name("versions"): stored}, clean(current_rows(versions, keys)), moved.select(*keys), feed

    def without_keys(self, at: Snapshot, changes: DataFrame) -> tuple[dict[str, Bucketed], DataFrame, DataFrame, DataFrame]:
        """The same of geolocation: images are counted, and the sums of their places moved by what each count moved."""
        positioned = changes.withColumn("position", _identity("topic", *POSITION, "ts_ms")).dropDuplicates(["position"])
        seen = self.state(at, "seen")
        if seen is not None:
            dealt = positioned.repartition(self.stored_in, "position")
            positioned = dealt.hint("merge").join(seen, "position", "left_anti")
        fresh = written(positioned.select("position", "before", "after", "op"), "fresh-changes")
        stored = {}

        def merge(part: str, new: DataFrame, key: str, old: DataFrame | None, total) -> DataFrame:
            if old is None:
                both = new.select(key, F.struct(*[c for c in new.columns if c != key]).alias("new")).repartition(self.dealt, key)
                both = both.withColumn("old", F.lit(None).cast(both.schema["new"].dataType))
            else:
                both = merged(old, new, [key], self.dealt, self.stored_in)
            stored[self.name(part)] = self.stage(part, both.select(key, *total), [key])
            return self.layer.load_bucketed(stored[self.name(part)])

        def either(column: str) -> Column:
            return F.coalesce(f"old.{column}", f"new.{column}").alias(column)

        def plus(column: str, kind: str = "long") -> Column:
            parts = [F.coalesce(F.col(f"{side}.{column}"), F.lit(0).cast(kind)) for side in ("old", "new")]
            return (parts[0] + parts[1]).cast(kind).alias(column)

        mark = F.col("new").isNotNull().alias(NEW)
        if seen is None:
            stored[self.name("seen")] = self.stage("seen", fresh.select("position").repartition(self.dealt, "position"), ["position"])
        else:
            every = dealt_join(seen, fresh.select("position"), ["position"], self.dealt, self.stored_in)
            stored[self.name("seen")] = self.stage("seen", every, ["position"])

        effects = image_effects(fresh, self.deletes).groupBy("image").agg(F.sum("n").cast("long").alias("n"))
        images = effects.select(_identity("image").alias("image_id"), "image", "n")
        before = F.coalesce(F.col("old.n"), F.lit(0).cast("long")).alias("n_before")
        counts = merge("counts", images, "image_id", self.state(at, "counts"), [either("image"), plus("n"), before, mark])
        moved = counts.filter(NEW).select("image.*", (F.greatest("n", F.lit(0)) - F.greatest("n_before", F.lit(0))).alias("times"))
        sums = silver.place_sums(moved.filter("times <> 0"), "times")
        sums = sums.select(_identity(*PLACE).alias("place_id"), *sums.columns)
        exact = [plus(c, silver.SUMS) for c in ("latitude", "longitude")]
        sides = [F.col(f"old.{c}").alias(c) for c in ("latitude", "longitude", "n")]
        totals = [*map(either, PLACE), *exact, plus("n"), mark, F.struct(*sides).alias(OLD)]
        places = merge("places", sums, "place_id", self.state(at, "places"), totals)
        moved = places.filter(NEW)
        gone = moved.select(*PLACE, f"{OLD}.*")
        feed = _signed(silver.places_from_sums(gone), silver.places_from_sums(moved))
        return stored, silver.places_from_sums(places), moved.select(*PLACE), feed


def _signed(gone: DataFrame, come: DataFrame) -> DataFrame:
    """Silver rows that a run took away (-1) and put in (1), in ``SIGN``."""
    both = gone.withColumn(SIGN, F.lit(-1)).unionByName(come.withColumn(SIGN, F.lit(1)))
    return both.drop(silver.AUDIT)


def last_run(at: Snapshot, spec: TableSpec) -> int | None:
    """The run that made a silver table; None if no fold did, or the table was rebuilt since."""
    note: Mapping | None = at.notes.get(spec.name)
    if note is None or at.entries[spec.name]["folders"] != [note["table"]]:
        return None
    return note["run"]


def _changes(at: Snapshot, spec: TableSpec, run: int | None) -> list[dict] | None:
    if run is None or last_run(at, spec) is None or run + 1 < at.notes[spec.name]["changes"][0]["run"]:
        return None
    return [c for c in at.notes[spec.name]["changes"] if c["run"] > run]


def changed_since(layer: Layer, spec: TableSpec, at: Snapshot, run: int | None) -> DataFrame | None:
    """Keys (places for geolocation) that changed in runs after ``run`` up to ``at``, as text; None if that is not known."""
    changes = _changes(at, spec, run)
    if changes is None:
        return None
    columns = spec.keys or PLACE
    if not changes:
        return layer.spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    return layer.spark.read.format(layer.fmt).load([c["path"] for c in changes]).select(*columns).distinct()


def feed_since(layer: Layer, spec: TableSpec, at: Snapshot, run: int | None) -> DataFrame | None:
    """Rows that left (``SIGN`` -1) and entered (1) a silver table in runs after ``run`` up to ``at``.

    None if that is not known, as of a table's first run, whose rows are the table.
    """
    changes = _changes(at, spec, run)
    if changes is None or not all("feed" in c for c in changes):
        return None
    if not changes:
        return at.read(spec.name).drop(silver.AUDIT).limit(0).withColumn(SIGN, F.lit(1))
    return layer.spark.read.format(layer.fmt).load([c["feed"] for c in changes])
