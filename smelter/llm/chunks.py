"""Ask about keys of all documents, and answer, without a row per key.

Documents are stored in chunks of bounded size. Each chunk asks about its distinct keys (64-bit hashes of
whatever repeats: windows, n-grams, anchors), sorted and cut by key range into one packed block per
shard. A shard sees all blocks of its range, so it knows every key's total over the corpus, and answers
each block in the block's own order. The answers come home by a join on the chunk.

* Keys are aggregated in the chunk first: a key in a third of all documents is one entry per chunk.
* Hash ranges are even, so shards are, whatever the keys' frequencies.
* Chunks are stored in a table bucketed by chunk, so the join moves answers, never texts.
* Lost executors cost a retry: chunks are a written table, blocks a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.scratch import scratch_path

CHUNK_BYTES = 6_000_000  # text of a chunk; a longer document is a chunk of its own
CHUNK = pa.schema(
    [
        ("chunk", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("texts", pa.list_(pa.string())),
        ("flags", pa.list_(pa.bool_())),
    ]
)
LAST = np.iinfo(np.int64).max  # stands for a NULL id, which comes after all others


@dataclass
class Chunk:
    number: int
    ids: np.ndarray  # ascending
    texts: pa.Array
    flags: np.ndarray


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def stage(docs: DataFrame, flag: Column | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Store doc_id, text (NULL as empty) and a flag in chunks, bucketed by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, size, number = TaskContext.get().partitionId() << 22, [], 0, 0

        def chunk() -> pa.RecordBatch:
            ids = pa.concat_arrays([b["doc_id"].cast(pa.int64()) for b in held])
            texts = pc.fill_null(pa.concat_arrays([b["text"] for b in held]), "")
            flags = pc.fill_null(pa.concat_arrays([b["flag"] for b in held]), False)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, texts, flags)]
            return pa.RecordBatch.from_arrays([pa.array([first + number], pa.int64()), *lists], schema=CHUNK)

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths.astype(np.int64) + 16)  # so that empty texts fill a chunk, too
            at = 0
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + chunk_bytes - size, "right")))
                held.append(batch.slice(at, to - at))
                size, at = size + int(ends[to - 1] - before), to
                if size >= chunk_bytes or at < batch.num_rows:
                    yield chunk()
                    held, size, number = [], 0, number + 1
        if held:
            yield chunk()

    spark = docs.sparkSession
    name = f"chunks_{uuid.uuid4().hex[:16]}"
    named = docs.select("doc_id", "text", (F.lit(True) if flag is None else flag).alias("flag"))
    rows = named.mapInArrow(run, "chunk long, ids array<long>, texts array<string>, flags array<boolean>")
    writer = rows.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, name))
    writer.bucketBy(partitions(docs), "chunk").saveAsTable(name)
    return spark.table(name)


def each_chunk(
    batches: Iterator[pa.RecordBatch], work: Callable[..., Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """Call ``work(chunk, *other columns)`` for each stored chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, texts, flags = (pc.list_flatten(batch[c].slice(i, 1)) for c in CHUNK.names[1:])
            ids = pc.fill_null(ids, LAST).to_numpy(zero_copy_only=False)
            order = np.argsort(ids, kind="stable")
            rest = [batch[c][i].as_py() for c in batch.schema.names if c not in CHUNK.names]
            flags = flags.to_numpy(zero_copy_only=False).astype(bool)
            yield from work(Chunk(batch["chunk"][i].as_py(), ids[order], texts.take(pa.array(order)), flags[order]), *rest)
            pa.default_memory_pool().release_unused()


def rows_to_batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 64):
        columns = zip(*rows[at : at + 64])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == LAST)


# --- words and keys --------------------------------------------------------


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words per text, and all words: runs of anything but [\\x20\\x09-\\x0D]."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    empty = pc.equal(flat, "")
    if pc.any(empty).as_py():  # an empty text splits into one empty word
        gone = empty.to_numpy(zero_copy_only=False)
        counts -= np.bincount(np.repeat(np.arange(len(counts)), counts)[gone], minlength=len(counts))
        flat = flat.filter(pc.invert(empty))
    return counts, flat


def hash_words(flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(index of each word, hashes of the distinct words)."""
    coded = flat.dictionary_encode()
    words = coded.dictionary.to_numpy(zero_copy_only=False)
    hashes = pd.util.hash_array(words, categorize=False) if len(words) else np.zeros(0, np.uint64)
    return coded.indices.to_numpy(zero_copy_only=False), hashes


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers, one to one."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def ngrams(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, key) of every run of ``n`` words within one text; ``hashes`` has one entry per word."""
    total = len(hashes) - n + 1
    if total <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    key = np.zeros(total, np.uint64)
    for j in range(n - 1, -1, -1):
        key *= np.uint64(0xD6E8FEB86659FD93)
        key += hashes[j : j + total]
    ends = np.repeat(np.cumsum(counts), counts)[:total]
    start = np.flatnonzero(np.arange(total) + n <= ends)
    return start, mix(key[start])


# --- blocks ----------------------------------------------------------------


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as steps, in the fewest whole bytes a step needs."""
    steps = np.diff(keys, prepend=np.uint64(0))
    first, steps = steps[:1], steps[1:]
    width = max(1, -(-int(steps.max()).bit_length() // 8)) if len(steps) else 1
    body = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + first.astype("<u8").tobytes() + body.tobytes()


def unpack_sorted(block: bytes) -> np.ndarray:
    width = block[0]
    body = np.frombuffer(block, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(body) + 1, 8), np.uint8)
    steps[0] = np.frombuffer(block, np.uint8, 8, 1)
    steps[1:, :width] = body
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def pack_numbers(values: np.ndarray) -> bytes:
    """Integers from 0 in the fewest of 1, 2, 4 or 8 bytes each."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - (w == 8)))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack_numbers(block: bytes) -> np.ndarray:
    return np.frombuffer(block, f"<u{block[0]}", offset=1)


def shard_bounds(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range begins among sorted keys; shards + 1 numbers."""
    width = -(-(1 << 64) // shards)
    edges = np.array([i * width for i in range(1, shards) if i * width < 1 << 64], dtype=np.uint64)
    inner = np.searchsorted(keys, edges)
    return np.concatenate([[0], inner, np.full(shards - len(edges), len(keys))])


def merged(blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of sorted blocks, and for each entry of the blocks, one after another, which it is."""
    flat = np.concatenate(blocks)
    order = np.argsort(flat, kind="stable")
    new = np.append(True, flat[order][1:] != flat[order][:-1])
    which = np.empty(len(flat), np.int64)
    which[order] = np.cumsum(new) - 1
    return flat[order][new], which


def split_like(values: np.ndarray, blocks: list[np.ndarray]) -> list[np.ndarray]:
    return np.split(values, np.cumsum([len(b) for b in blocks])[:-1])


def with_answers(staged: DataFrame, answers: DataFrame, *columns: str, name: str = "answers") -> DataFrame:
    """The chunks, each with ``name``: an array of its shards' answers, shards in order (NULL: none).

    ``answers`` has chunk, shard and the named columns. Only it is shuffled.
    """
    home = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("shard", *columns))).alias(name))
    return staged.join(home.hint("shuffle_hash"), "chunk", "left")
