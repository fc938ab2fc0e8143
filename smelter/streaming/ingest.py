"""Change messages -> bronze tables, each message stored exactly once.

Every micro-batch writes to a folder named after its stream and batch number,
replacing whatever an earlier attempt of the same batch left there, and is committed by one file once all its
tables are written. The stream's name lives in its checkpoint: with the checkpoint, restarts and retries are safe on
plain parquet, and a new checkpoint, wherever it is, never touches the folders of an old
one. Readers see committed batches only, all tables of a batch or none.

``compact`` merges the small files of committed batches into large ones while streams and readers go on: what it has
merged is named by the next version of one document, and from then on read from there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from smelter.operators.cdc import read_envelopes
from smelter.sources.messages import MESSAGE_SCHEMA
from smelter.sources.tables import Layer, Parts
from smelter.sources.versions import Conflict, Folder, Versions
from smelter.specs import TableSpec
from smelter.steps import StepsFailed, run_steps

STREAM, BATCH = "ingest_stream", "ingest_batch"
UNKNOWN = "unknown_topics"
BATCHES, COMPACTIONS = "_batches", "_compactions"  # folders of commits beside the tables
FILE_BYTES = 256_000_000  # of compacted files
AT_ONCE = 4  # tables of a batch written beside each other
# Rows in a block of a held batch. Writing or reading blocks keeps the last hundred of them in the heap, beside what Spark
# counts as its memory (``spark.serializer.objectStreamReset``).
HELD_ROWS = 500
_BLOCK_ROWS = "spark.sql.inMemoryColumnarStorage.batchSize"


def table_path(root: str, table: str) -> str:
    return f"{root}/{table}"


def _batch_path(root: str, table: str, stream: str, batch: int) -> str:
    return f"{table_path(root, table)}/{STREAM}={stream}/{BATCH}={batch}"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream, kept in its checkpoint: made with it and lost with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/ingest-id")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        out = system.create(path, False)
        out.write(bytearray(uuid.uuid4().hex.encode()))
        out.close()
    return spark.read.text(path.toString()).first()[0]


def write_batch(
    messages: DataFrame, topics: Mapping[str, TableSpec], root: str, stream: str, batch: int
) -> None:
    """Split one batch by topic into its bronze tables, malformed messages included, and commit it.

    The batch is read from its source once and kept on the executors' disks while its tables are written beside each other; what a
    lost executor held is read again. Little of it is in their memory, which it may far exceed. Messages of topics that are not
    declared go to ``unknown_topics`` with their text. The first batch creates every table; later ones skip topics without
    messages. A failed write fails the batch, which Spark then repeats from the checkpoint.
    """
    spark = messages.sparkSession
    with _block_rows(spark, HELD_ROWS):
        held = messages.select("topic", "kafka_partition", "kafka_offset", "value").persist(StorageLevel.DISK_ONLY)
        try:
            declared = F.when(F.col("topic").isin(*topics), F.col("topic")) if topics else F.lit(None)
            found = held.select(declared.cast("string")).distinct().collect()  # one per declared topic at most; holds the batch
        except BaseException:
            held.unpersist()
            raise
    try:
        present = {row[0] for row in found}
        steps: dict[str, Callable[[], None]] = {}

        def put(table: str, rows: DataFrame) -> Callable[[], None]:
            return lambda: rows.write.mode("overwrite").parquet(_batch_path(root, table, stream, batch))

        for topic, spec in topics.items():
            if topic in present or batch == 0:
                steps[spec.name] = put(spec.name, read_envelopes(held.filter(F.col("topic") == topic), spec))
        if None in present or batch == 0:
            rest = F.coalesce(~F.col("topic").isin(*topics), F.lit(True)) if topics else F.lit(True)
            steps[UNKNOWN] = put(UNKNOWN, held.filter(rest))
        run_steps(steps, AT_ONCE)
        _commit(spark, root, stream, batch, sorted(steps))
    except StepsFailed as error:
        raise RuntimeError(f"batch {batch} of {stream}: {error}") from next(iter(error.failed.values()))
    finally:
        held.unpersist()


@contextmanager
def _block_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is held first within has blocks of so many rows; the session's own setting is back afterwards."""
    before = spark.conf.get(_BLOCK_ROWS)
    spark.conf.set(_BLOCK_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(_BLOCK_ROWS, before)


def _commit(spark: SparkSession, root: str, stream: str, batch: int, tables: list[str]) -> None:
    commits = Folder(spark, f"{root}/{BATCHES}/{stream}")
    try:
        commits.put(f"{batch:012d}", json.dumps(tables))
    except Conflict:  # a batch repeated after its commit has written the same rows again
        pass


@dataclass(frozen=True)
class Committed:
    """What a reader of bronze sees: merged folders, and the batches committed since."""

    version: int
    merged: dict[str, list[dict]]  # table -> {"path", "through": {stream: last batch}}
    through: dict[str, int]  # stream -> last batch that is merged
    batches: dict[str, dict[int, list[str]]]  # stream -> batch -> its tables

    def last(self) -> dict[str, int]:
        """The last committed batch of each stream."""
        return self.through | {stream: max(found) for stream, found in self.batches.items() if found}


def committed(spark: SparkSession, root: str) -> Committed:
    number, document = Versions(spark, f"{root}/{COMPACTIONS}").latest()
    through = document.get("through", {})
    batches = {}
    for stream in Folder(spark, f"{root}/{BATCHES}").names():
        folder = Folder(spark, f"{root}/{BATCHES}/{stream}")
        new = [n for n in folder.names() if n.isdigit() and int(n) > through.get(stream, -1)]
        batches[stream] = {int(n): json.loads(folder.text(n)) for n in new}
    return Committed(number, document.get("tables", {}), through, batches)


def compact(spark: SparkSession, root: str, tables: Iterable[str], file_bytes: int = FILE_BYTES, whole: bool = False) -> int:
    """Merge the committed batches that are not merged yet, of all ``tables`` together; returns how many batches.

    ``whole`` also merges the folders of earlier compactions. ``tables`` are all that streams write here, ``unknown_topics``
    included or not. Until the new version of the document is there readers see the old files, after it the new ones;
    a compaction that dies before it leaves files nobody reads. Two at a time: the second fails with ``Conflict``.
    """
    seen = committed(spark, root)
    count = sum(map(len, seen.batches.values()))
    names = sorted({*tables, UNKNOWN, *seen.merged})
    if not count and not (whole and any(len(m) > 1 for m in seen.merged.values())):
        return 0
    fresh = uuid.uuid4().hex
    merged = {}

    def merge(table: str) -> Callable[[], None]:
        def step() -> None:
            entries = seen.merged.get(table, [])
            paths = _batch_paths(root, table, seen, {})
            old = [e["path"] for e in entries] if whole and len(entries) > 1 else []
            kept = [] if old else entries
            if paths or old:
                rows = _stored(spark, root, table, paths, old)
                folder = f"{root}/_compacted/{table}/{fresh}"
                parts = max(1, -(-_bytes(spark, [*paths, *old]) // file_bytes))
                # Files read beside each other become one: no row is shuffled.
                rows.coalesce(parts).write.parquet(folder)
                kept = [*kept, {"path": folder, "through": seen.last()}]
            merged[table] = kept

        return step

    run_steps({table: merge(table) for table in names}, AT_ONCE)
    Versions(spark, f"{root}/{COMPACTIONS}").follow(seen.version, {"tables": merged, "through": seen.last()})
    return count


def vacuum(spark: SparkSession, root: str) -> int:
    """Remove merged batches and what compactions left unused; their readers must be done. Returns how many folders."""
    seen, removed = committed(spark, root), 0
    for table in {*seen.merged}:
        for stream, last in seen.through.items():
            folder = Folder(spark, f"{table_path(root, table)}/{STREAM}={stream}")
            old = [n for n in folder.names() if n.startswith(f"{BATCH}=") and int(n.split("=")[1]) <= last]
            removed += sum(folder.remove(n) for n in old)
        used = {e["path"].rsplit("/", 1)[1] for e in seen.merged[table]}
        folder = Folder(spark, f"{root}/_compacted/{table}")
        removed += sum(folder.remove(n) for n in folder.names() if n not in used)
    for stream, last in seen.through.items():
        folder = Folder(spark, f"{root}/{BATCHES}/{stream}")
        for name in folder.names():
            if name.isdigit() and int(name) <= last:
                folder.remove(name)
    return removed


def _bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    return sum(Folder(spark, p).system.getContentSummary(Folder(spark, p).place()).getLength() for p in paths)


def _batch_paths(root: str, table: str, seen: Committed, after: Mapping[str, int]) -> list[str]:
    return [
        _batch_path(root, table, stream, batch)
        for stream, found in seen.batches.items()
        for batch, tables in sorted(found.items())
        if table in tables and batch > after.get(stream, -1)
    ]


def _row_schema(table: str, spec: TableSpec | None) -> str:
    if table == UNKNOWN:
        return MESSAGE_SCHEMA
    row = spec.change_schema.simpleString()
    return (
        f"topic string, before {row}, after {row}, op string, ts_ms bigint, "
        "kafka_partition int, kafka_offset bigint, raw string, reason string"
    )


def _stored(
    spark: SparkSession, root: str, table: str, paths: list[str], merged: list[str], row: str | None = None
) -> DataFrame:
    """Rows of single batches and of merged folders, with their stream and batch."""
    frames = []
    for found, base in ((paths, table_path(root, table)), (merged, None)):
        if found:
            reader = spark.read.schema(f"{row}, {STREAM} string, {BATCH} bigint") if row else spark.read
            frames.append((reader.option("basePath", base) if base else reader).parquet(*found))
    if not frames:
        return spark.createDataFrame([], T.StructType.fromDDL(f"{row}, {STREAM} string, {BATCH} bigint"))
    return reduce(DataFrame.unionByName, [df.withColumn(STREAM, F.col(STREAM).cast("string")).withColumn(BATCH, F.col(BATCH).cast("long")) for df in frames])


def stream_changes(
    messages: DataFrame,
    topics: Mapping[str, TableSpec],
    root: str,
    checkpoint: str,
    catch_up: bool = True,
) -> StreamingQuery:
    """Start the ingest: until caught up and then stop, or on and on."""
    stream = stream_id(messages.sparkSession, checkpoint)
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: write_batch(batch, topics, root, stream, number)
    )
    return (writer.trigger(availableNow=True) if catch_up else writer).start()


def stream_one_topic(
    messages: DataFrame, spec: TableSpec, root: str, checkpoint: str, catch_up: bool = True
) -> StreamingQuery:
    """One topic by the plain file sink, which keeps its own log of committed files.

    Read the result at ``table_path`` while only this stream writes there.
    """
    writer = (
        read_envelopes(messages, spec)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", table_path(root, spec.name))
    )
    return (writer.trigger(availableNow=True) if catch_up else writer).start()


def catch_up_topics(
    source: Callable[[str], DataFrame],
    topics: Mapping[str, TableSpec],
    root: str,
    checkpoints: str,
) -> list[str]:
    """Scheduled catch-up: each topic reads what is new since its last run.

    Topics are independent; one that fails is reported after the others ran.
    """

    def step(topic: str, spec: TableSpec):
        return lambda: stream_changes(
            source(topic), {topic: spec}, root, f"{checkpoints}/{topic}"
        ).awaitTermination()

    return run_steps({topic: step(topic, spec) for topic, spec in topics.items()})


def await_all(queries: list[StreamingQuery], poll: float = 0.2) -> None:
    """Wait until every query has ended; a failure is raised as soon as it is seen."""
    pending = list(queries)
    while pending:
        # Raises the query's own failure, also of one that ended before this call.
        pending = [q for q in pending if not q.awaitTermination(timeout=poll)]


def register_bronze(
    layer: Layer, specs: Iterable[TableSpec]
) -> tuple[list[str], dict[str, str]]:
    """Publish the bronze tables under ``layer.root`` with their committed batches, going on after a failure.

    A batch is a partition, a merged folder another, named by its version. Tables without batches fail.
    """
    seen, registered, failed = committed(layer.spark, layer.root), [], {}
    for spec in specs:
        folders = [
            ({STREAM: stream, BATCH: batch}, _batch_path(layer.root, spec.name, stream, batch))
            for stream, found in seen.batches.items()
            for batch, tables in found.items()
            if spec.name in tables
        ]
        folders += [
            ({STREAM: "compacted", BATCH: i}, entry["path"]) for i, entry in enumerate(seen.merged.get(spec.name, []))
        ]
        try:
            if not folders:
                raise FileNotFoundError(f"no committed batch of {spec.name} under {layer.root}")
            row = T.StructType.fromDDL(_row_schema(spec.name, spec))
            schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in row.fields)
            layer.publish({spec.name: Parts(schema, f"{STREAM} string, {BATCH} bigint", folders)})
            registered.append(spec.name)
        except Exception as error:  # reported to the caller, per table
            failed[spec.name] = str(error)
    return registered, failed


def read_bronze(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    seen: Committed | None = None,
    after: Mapping[str, int] | None = None,
) -> DataFrame:
    """The committed rows of one bronze table, rejected messages among them.

    ``after`` (stream -> batch) leaves out all batches up to those; only folders with later ones are read.
    """
    return _read(spark, root, spec.name, _row_schema(spec.name, spec), seen or committed(spark, root), after or {})


def _read(spark: SparkSession, root: str, table: str, row: str, seen: Committed, after: Mapping[str, int]) -> DataFrame:
    newer = [
        e["path"]
        for e in seen.merged.get(table, [])
        if any(last > after.get(stream, -1) for stream, last in e["through"].items())
    ]
    rows = _stored(spark, root, table, _batch_paths(root, table, seen, after), newer, row)
    for stream, last in after.items():
        rows = rows.filter((F.col(STREAM) != stream) | (F.col(BATCH) > last))
    return rows


def read_unknown(spark: SparkSession, root: str) -> DataFrame:
    """Messages of topics that were not declared, with their text."""
    return _read(spark, root, UNKNOWN, _row_schema(UNKNOWN, None), committed(spark, root), {})
