"""Stored tables: read, replace, append, publish together, count.

Every refresh is a catalog table of its own, ``<table>__<id>``. The table's name is a view of the latest, which one catalog
call replaces, so it never is missing. A release, one document, names the latest refresh of all tables: readers of a ``Snapshot``
see tables of one release, whatever is published meanwhile.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.operators.keys import unique_key
from smelter.sources.versions import Conflict, Folder, Versions

_REFRESH = re.compile("(.*)__[0-9a-f]{32}")


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Parts:
    """A table put together from folders, one per partition: ``((values, folder), ...)``."""

    schema: str  # without the partition columns
    columns: str  # the partition columns, as DDL
    folders: Sequence[tuple[Mapping[str, object], str]] = field(default_factory=tuple)


@dataclass(frozen=True)
class Bucketed:
    """A refresh that is a bucketed catalog table already, not yet published."""

    name: str
    folder: str


class Snapshot:
    """The tables of one release, and its notes."""

    def __init__(self, spark: SparkSession, database: str, number: int, release: Mapping):
        self.spark, self.database, self.number = spark, database, number
        self.entries, self.notes = dict(release.get("tables", {})), dict(release.get("notes", {}))

    def exists(self, table: str) -> bool:
        return table in self.entries

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{self.entries[table]['name']}`")

    def stored(self, table: str) -> bool:
        """Whether the table of this release has not expired."""
        return self.exists(table) and self.spark.catalog.tableExists(f"{self.database}.{self.entries[table]['name']}")

    def folders(self, table: str) -> dict[str, str]:
        """Folder by partition, as published from ``Parts``; empty for other tables."""
        return dict(self.entries[table].get("parts", {})) if self.exists(table) else {}


@dataclass(frozen=True)
class Layer:
    """A catalog database whose external tables live under one folder."""

    spark: SparkSession
    database: str
    root: str
    fmt: str = "parquet"

    def qualified(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.qualified(table))

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def replace(
        self,
        table: str,
        df: DataFrame,
        partition_by: str | None = None,
        unique: str | None = None,
    ) -> DataFrame:
        """Full refresh, schema included.

        Rows go to a new folder, which is published after the write: a failed write
        changes nothing, and a query that has begun keeps the files it planned on. The
        old folder stays until ``expire``.
        """
        self.register(table, self.stage(table, df, partition_by, unique))
        return self.read(table)

    def stage(
        self,
        table: str,
        df: DataFrame,
        partition_by: str | None = None,
        unique: str | None = None,
        after: int = 0,
    ) -> str:
        """Write a refresh without publishing it; returns its folder, for ``register``.

        ``unique`` names a key column to number the rows with as they are written, from ``after`` + 1 on.
        """
        if partition_by:
            # Even tasks per partition value, large values split over several.
            df = df.hint("rebalance", partition_by)
        if unique:
            df = df.select((unique_key() + F.lit(after)).alias(unique), "*")
        writer = df.write.format(self.fmt)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        path = f"{self.root}/{table}/{uuid.uuid4().hex}"
        writer.save(path)
        return path

    def stage_bucketed(self, table: str, df: DataFrame, buckets: int, keys: Sequence[str]) -> Bucketed:
        """Write a refresh bucketed by ``keys`` without publishing it.

        Rows that come partitioned by bucket, as from a join with the last refresh, are written where they are. Buckets are not sorted:
        Spark does not rely on their order and sorts what it merges.
        """
        self._create_database()
        fresh = uuid.uuid4().hex
        path, name = f"{self.root}/{table}/{fresh}", f"{table}__{fresh}"
        writer = df.write.format(self.fmt).bucketBy(buckets, *keys).option("path", path)
        writer.saveAsTable(f"{self.database}.{name}")
        return Bucketed(name, path)

    def load_all(self, paths: Sequence[str]) -> DataFrame:
        """The rows of several folders of one table, partition columns left out."""
        return self.spark.read.format(self.fmt).load(list(paths))

    def load_bucketed(self, stored: Bucketed) -> DataFrame:
        return self.spark.table(self.qualified(stored.name))

    def _create_database(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION {_literal(self.root)}")

    def load(self, path: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(path)

    def releases(self) -> Versions:
        return Versions(self.spark, f"{self.root}/_releases")

    def snapshot(self, number: int | None = None) -> Snapshot:
        """All tables as of one release, the latest unless a number is given."""
        number, release = (number, self.releases().read(number)) if number else self.releases().latest()
        return Snapshot(self.spark, self.database, number, release)

    def refresh_of(self, table: str) -> str:
        """The catalog table behind the name."""
        return self.snapshot().entries[table]["name"]

    def location(self, table: str) -> str:
        """The folder the latest refresh is in."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.qualified(self.refresh_of(table))}")
        return rows.filter("col_name = 'Location'").first()["data_type"]

    def expire(self, table: str, keep: int = 1) -> int:
        """Remove what only releases before the last ``keep`` use; returns how many folders. Their readers must be done."""
        return self.expire_all([table], keep)

    def expire_all(self, tables: Iterable[str], keep: int = 1) -> int:
        """The same of several tables, with one look at the catalog."""
        releases = [r["tables"] for r in self.releases().last(keep)]
        stored = [r[0] for r in self.spark.sql(f"SHOW TABLES IN `{self.database}`").select("tableName").collect()]
        removed = 0
        for table in tables:
            kept = [r[table] for r in releases if table in r]
            names = {entry["name"] for entry in kept}
            used = {f.rstrip("/").split(f"/{table}/")[-1].split("/")[0] for entry in kept for f in entry["folders"]}
            for name in stored:
                of = _REFRESH.fullmatch(name)
                if of and of[1] == table and name not in names:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(name)}")
            folder = Folder(self.spark, f"{self.root}/{table}")
            old = [n for n in folder.names() if re.fullmatch("[0-9a-f]{32}", n) and n not in used]
            removed += sum(folder.remove(name) for name in old)
        return removed

    def append(self, table: str, df: DataFrame, path: str | None = None) -> DataFrame:
        """Add rows where the table's rows are, creating it on first use; a failed append is an error."""
        if not self.exists(table):
            path = path or f"{self.root}/{table}"
            df.write.format(self.fmt).mode("append").save(path)
            self.register(table, path)
            return self.read(table)
        name = f"{self.database}.{self.refresh_of(table)}"
        partitions = [c.name for c in self.spark.catalog.listColumns(name) if c.isPartition]
        df.write.format(self.fmt).mode("append").partitionBy(*partitions).save(self.location(table))
        if partitions:
            self.spark.catalog.recoverPartitions(name)
        self.spark.catalog.refreshTable(name)
        self.spark.catalog.refreshTable(f"{self.database}.{table}")
        return self.read(table)

    def _refresh(self, table: str, stored: str | Parts | Bucketed) -> dict:
        """Make the catalog table of one refresh; its entry in a release."""
        if isinstance(stored, Bucketed):
            return {"name": stored.name, "folders": [stored.folder]}
        name = f"{table}__{uuid.uuid4().hex}"
        try:
            if isinstance(stored, Parts):
                return {"name": name, **self._from_parts(table, name, stored)}
            self.spark.catalog.createTable(f"{self.database}.{name}", path=stored, source=self.fmt)
            if any(c.isPartition for c in self.spark.catalog.listColumns(f"{self.database}.{name}")):
                self.spark.catalog.recoverPartitions(f"{self.database}.{name}")
            return {"name": name, "folders": [stored]}
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(name)}")
            raise

    def _from_parts(self, table: str, name: str, parts: Parts) -> dict:
        place = _literal(f"{self.root}/{table}/_parts")  # of a partition without a folder; there is none
        keys = ", ".join(c.split()[0] for c in parts.columns.split(","))
        self.spark.sql(
            f"CREATE TABLE {self.qualified(name)} ({parts.schema}, {parts.columns}) USING {self.fmt} "
            f"PARTITIONED BY ({keys}) LOCATION {place}"
        )
        clauses, by_values = [], {}
        for values, folder in parts.folders:
            spec = ", ".join(f"{k} = {_literal(v) if isinstance(v, str) else v}" for k, v in values.items())
            clauses.append(f"PARTITION ({spec}) LOCATION {_literal(folder)}")
            by_values["/".join(str(v) for v in values.values())] = folder
        for at in range(0, len(clauses), 200):
            self.spark.sql(f"ALTER TABLE {self.qualified(name)} ADD IF NOT EXISTS {' '.join(clauses[at : at + 200])}")
        return {"folders": sorted(set(by_values.values())), "parts": by_values}

    def register(self, table: str, path: str) -> None:
        """Publish one table: its name shows the rows at ``path`` from now on."""
        self.publish({table: path})

    def publish(
        self,
        stored: Mapping[str, str | Parts | Bucketed],
        notes: Mapping[str, object] | None = None,
        based_on: Snapshot | None = None,
    ) -> int:
        """Publish several tables, and notes on them, in one release; returns its number.

        The release is one document, so a snapshot has all of it or nothing. The names in the catalog follow one by
        one, each in one call. If anything fails before the release, nothing has changed. ``based_on`` is the snapshot the
        rows were made from: if another writer has replaced one of these tables or notes since, this is a ``Conflict``.
        """
        self._create_database()
        made: dict[str, dict] = {}
        try:
            for table, where in stored.items():
                made[table] = self._refresh(table, where)
            number = self._release(made, dict(notes or {}), based_on)
        except Exception:
            for entry in made.values():
                self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(entry['name'])}")
            raise
        for table, entry in made.items():
            # To replace a view Spark drops it first; altering it is one call.
            change = "ALTER VIEW" if self.exists(table) else "CREATE OR REPLACE VIEW"
            self.spark.sql(f"{change} {self.qualified(table)} AS SELECT * FROM {self.qualified(entry['name'])}")
        return number

    def _release(self, made: Mapping[str, dict], notes: Mapping[str, object], based_on: Snapshot | None) -> int:
        """Add the entries to the latest release; tables of other writers stay."""
        for _ in range(100):
            number, release = self.releases().latest()
            tables, said = release.get("tables", {}), release.get("notes", {})
            if based_on is not None:
                moved = [t for t in made if tables.get(t) != based_on.entries.get(t)]
                moved += [n for n in notes if said.get(n) != based_on.notes.get(n)]
                if moved:
                    raise Conflict(f"{self.root}: {', '.join(moved)} changed since release {based_on.number}")
            try:
                return self.releases().follow(number, {"tables": tables | made, "notes": said | notes})
            except Conflict:  # of a writer of other tables: build on its release
                continue
        raise Conflict(f"{self.root}: too many writers")

    def register_all(self, paths: Mapping[str, str]) -> tuple[list[str], dict[str, str]]:
        """Register every table, going on after a failure: (registered, failed with reason)."""
        registered, failed = [], {}
        for table, path in paths.items():
            try:
                self.register(table, path)
                registered.append(table)
            except Exception as error:  # reported to the caller, per table
                failed[table] = str(error)
        return registered, failed

    def tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database) if not _REFRESH.fullmatch(t.name))

    def summary(self, tables: Iterable[str]) -> DataFrame:
        """Row counts of the named tables with a total; a table that is missing counts as an error."""
        return summary({t: self.read(t) if self.exists(t) else None for t in tables}, self.spark)


def summary(tables: Mapping[str, DataFrame | None], spark: SparkSession | None = None) -> DataFrame:
    """``(table_name, row_count, status)`` with a final total; a missing table counts as an error."""
    present = {name: df for name, df in tables.items() if df is not None}
    spark = spark or next(iter(present.values())).sparkSession
    rows = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit("OK").alias("status")
        )
        for name, df in present.items()
    ]
    rows += [
        spark.range(1).select(
            F.lit(name).alias("table_name"),
            F.lit(None).cast("long").alias("row_count"),
            F.lit("ERROR").alias("status"),
        )
        for name, df in tables.items()
        if df is None
    ]
    counted = reduce(DataFrame.unionByName, rows)
    # Kept as one pass: the total is a second grouping of the same rows.
    return (
        counted.rollup("table_name", "status")
        .agg(F.sum("row_count").alias("row_count"), F.grouping_id().alias("_level"))
        .filter(F.col("_level").isin(0, 3))
        .select(
            F.when(F.col("_level") == 3, "TOTAL").otherwise(F.col("table_name")).alias("table_name"),
            "row_count",
            F.when(F.col("_level") == 3, "OK").otherwise(F.col("status")).alias("status"),
        )
    )
