"""Stored tables whose rows are unique by key, and stored surrogate keys: only what comes in is shuffled.

The keys of a table are kept in an index, a table bucketed by key. Incoming rows are dealt out by bucket and meet the index
there; the index then takes in the new keys bucket by bucket. Rows are added as folders of their own, so what is stored is never rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.operators.keys import UNKNOWN_KEY, assign_dense_key
from smelter.operators.merge import first_per_key, merged
from smelter.scratch import written
from smelter.sources.tables import Bucketed, Layer, Parts, Snapshot

BUCKETS = 64
INSERT = "_insert"  # the partition column: number of the insert


class KeyIndex:
    """Keys, never NULL, with other columns that depend on them."""

    def __init__(self, layer: Layer, name: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.layer, self.name, self.keys, self.buckets = layer, name, list(keys), buckets

    def read(self, at: Snapshot) -> DataFrame | None:
        return at.read(self.name) if at.exists(self.name) else None

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, *self.keys)

    def absent(self, at: Snapshot, rows: DataFrame) -> DataFrame:
        """The rows whose keys the index lacks; the index is read where it is."""
        index = self.read(at)
        return rows if index is None else rows.join(index.select(*self.keys), self.keys, "left_anti")

    def stage_with(self, at: Snapshot, rows: DataFrame) -> Bucketed:
        """The index with the keys of ``rows``, not yet published; keys it has already stay as they are."""
        index = self.read(at)
        if index is None:
            return self.layer.stage_bucketed(self.name, self.dealt(rows), self.buckets, self.keys)
        both = merged(index.withColumn("_in", F.lit(1)), rows.withColumn("_in", F.lit(1)), self.keys, self.buckets)
        kept = both.select(*self.keys, F.coalesce("old", "new").alias("v")).select(*self.keys, "v.*").drop("_in")
        return self.layer.stage_bucketed(self.name, kept, self.buckets, self.keys)


class UniqueTable:
    """A stored table into which rows are inserted unless their key is there."""

    def __init__(self, layer: Layer, name: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.layer, self.name, self.keys = layer, name, list(keys)
        self.index = KeyIndex(layer, f"{name}_index", keys, buckets)

    def insert(self, incoming: DataFrame, order_by: Sequence[str]) -> int:
        """Insert the first row, by ``order_by``, of each key that is not there; returns how many rows.

        As with a unique constraint, a key with a NULL part conflicts with nothing. Rows and index are one release: an insert that
        dies has added nothing, and of two at a time the second fails with ``Conflict`` and may be repeated.
        """
        at = self.layer.snapshot()
        has_key = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in self.keys))
        fresh = self.index.absent(at, first_per_key(incoming.filter(has_key), self.keys, order_by))
        fresh = fresh.select(*incoming.columns).unionByName(incoming.filter(~has_key))
        folder = self.layer.stage(self.name, fresh)
        added = self.layer.load(folder)
        count = added.count()
        if not count and at.exists(self.name):
            return 0
        folders = at.folders(self.name)
        folders[str(len(folders))] = folder
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in incoming.schema.fields)
        parts = Parts(columns, f"{INSERT} int", [({INSERT: int(n)}, path) for n, path in folders.items()])
        keys = self.index.stage_with(at, added.filter(has_key).select(*self.keys, F.lit(len(folders) - 1).alias(INSERT)))
        self.layer.publish({self.name: parts, self.index.name: keys}, based_on=at)
        return count

    def read(self) -> DataFrame:
        return self.layer.snapshot().read(self.name).drop(INSERT)


class KeyRegistry:
    """Surrogate keys that members keep for good, also if they leave and come back."""

    def __init__(self, layer: Layer, name: str, business_key: str, key: str, buckets: int = BUCKETS):
        self.business_key, self.key, self.layer = business_key, key, layer
        self.index = KeyIndex(layer, f"{name}_registry", [business_key], buckets)

    def assign(self, members: DataFrame, before: DataFrame | None = None) -> DataFrame:
        """``members``, unique by business key, with their keys in front.

        New members are numbered after the largest key so far, in the order of their business keys, and registered before
        this returns. Only members are shuffled, and the result is partitioned by bucket. ``before``, a dimension, stands for the registry that does not exist yet. Members
        without a business key have no key and are left out.
        """
        at = self.layer.snapshot()
        known = self.index.read(at)
        if known is None and before is not None:
            start = before.filter(F.col(self.key) != UNKNOWN_KEY).select(self.business_key, self.key)
            self.layer.publish({self.index.name: self.index.stage_with(at, start)}, based_on=at)
            at = self.layer.snapshot()
            known = self.index.read(at)
        named = members.filter(F.col(self.business_key).isNotNull())
        last = 0 if known is None else known.agg(F.coalesce(F.max(self.key), F.lit(0))).first()[0]
        fresh = written(self.index.absent(at, named.select(self.business_key)), "fresh-members")
        if known is None or not fresh.isEmpty():
            numbered = assign_dense_key(fresh, [self.business_key], self.key)
            numbered = numbered.select(self.business_key, (F.col(self.key) + F.lit(last)).alias(self.key))
            self.layer.publish({self.index.name: self.index.stage_with(at, numbered)}, based_on=at)
            known = self.index.read(self.layer.snapshot())
        # The registry is sorted too: only the members of a bucket are.
        return self.index.dealt(named).hint("merge").join(known, self.business_key).select(self.key, *members.columns)
