"""Substring dedup over a de Bruijn graph of words.

Every window of ``k`` words is an edge of the graph. Edges are joined over all documents by key: an edge in
more than one document is repeated, and it branches where its occurrences go on with, or come from, different
words. Runs of repeated edges of a document that meet without a branch are compacted to paths,
and the smallest document that has an edge is its source: what a later document repeats is removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm import chunks

REPEATED, EARLIER, FROM_MANY, TO_MANY = 1, 2, 4, 8
MANY = 255  # in place of a neighbour's mark: there are several

SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("removed", pa.list_(SPAN)),
        ("paths", pa.list_(SPAN)),
        ("kept", pa.string()),
    ]
)
RESULT_DDL = (
    "doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, "
    "paths array<struct<start:int,end:int>>, kept string"
)


@dataclass
class Edges:
    """The edges of one chunk, distinct and sorted by key."""

    counts: np.ndarray  # words of each document
    words: pa.Array
    start: np.ndarray  # of each occurrence, its first word
    doc: np.ndarray  # of each occurrence
    keys: np.ndarray
    which: np.ndarray  # of each occurrence, its key
    first_doc: np.ndarray  # of each key
    docs: np.ndarray  # of each key, 2 if in several documents
    before: np.ndarray  # of each key, a mark of the word before it: 0 none, MANY several
    after: np.ndarray


def _marks(mark: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One mark per group from its members' marks, 0 left out."""
    most = np.maximum.reduceat(mark, begin)
    least = np.minimum.reduceat(np.where(mark == 0, MANY, mark), begin)
    return np.where((most != 0) & (most != least), MANY, most).astype(np.uint8)


def edges(ids: np.ndarray, texts: pa.Array, k: int) -> Edges:
    counts, words = chunks.split_words(texts)
    index, hashes = chunks.hash_words(words)
    word = hashes[index] if len(index) else np.zeros(0, np.uint64)
    start, key = chunks.ngrams(word, counts, k)
    doc = np.repeat(np.arange(len(counts)), counts)[start]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    begin = np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1])) if len(key) else start
    which = np.empty(len(key), np.int64)
    which[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(key))))
    # A neighbour's mark: 8 bits of its hash, from 1 to 254. Two neighbours of one mark hide a
    # branch, which only makes a path longer.
    mark = (word % np.uint64(254) + np.uint64(1)).astype(np.uint8)
    owner = np.repeat(np.arange(len(counts)), counts)
    before, after = np.zeros(len(key), np.uint8), np.zeros(len(key), np.uint8)
    inner = start > 0
    inner[inner] = owner[start[inner] - 1] == doc[inner]
    before[inner] = mark[start[inner] - 1]
    inner = start + k < len(owner)
    inner[inner] = owner[start[inner] + k] == doc[inner]
    after[inner] = mark[start[inner] + k]
    if not len(key):
        none = np.zeros(0, np.int64)
        return Edges(counts, words, start, doc, key, which, none, none, none, none)
    ordered = ids[doc[order]]  # ascending within a key, as chunks are in order of ids
    last = np.append(begin[1:], len(key)) - 1
    return Edges(
        counts,
        words,
        start,
        doc,
        sorted_key[begin],
        which,
        ordered[begin],
        np.where(ordered[begin] != ordered[last], 2, 1),
        _marks(before[order], begin),
        _marks(after[order], begin),
    )


def ask(staged: DataFrame, k: int, shards: int) -> DataFrame:
    fields = [("chunk", pa.int64()), ("shard", pa.int32()), ("base", pa.int64())]
    schema = pa.schema(fields + [(c, pa.binary()) for c in ("keys", "docs", "first", "before", "after")])

    def of(chunk: chunks.Chunk) -> Iterator[pa.RecordBatch]:
        e = edges(chunk.ids, chunk.texts, k)
        bounds = chunks.shard_bounds(e.keys, shards)
        rows = []
        for shard in np.flatnonzero(np.diff(bounds)).tolist():
            part = slice(bounds[shard], bounds[shard + 1])
            base = int(e.first_doc[part].min())
            first = chunks.pack_numbers((e.first_doc[part] - base).astype(np.uint64))
            rows.append(
                (
                    chunk.number,
                    shard,
                    base,
                    chunks.pack_sorted(e.keys[part]),
                    np.packbits(e.docs[part] == 2).tobytes(),
                    first,
                    e.before[part].tobytes(),
                    e.after[part].tobytes(),
                )
            )
        yield from chunks.rows_to_batches(rows, schema)

    ddl = "chunk long, shard int, base long, keys binary, docs binary, first binary, before binary, after binary"
    return staged.mapInArrow(lambda b: chunks.each_chunk(b, of), ddl)


def answer(asked: DataFrame) -> DataFrame:
    """Flags for each edge: repeated, in an earlier document than the chunk's first, and where it branches."""

    def of(blocks: pd.DataFrame) -> pd.DataFrame:
        keys = [chunks.unpack_sorted(b) for b in blocks["keys"]]
        distinct, which = chunks.merged(keys)
        first = np.concatenate(
            [chunks.unpack_numbers(f).astype(np.int64) + b for f, b in zip(blocks["first"], blocks["base"])]
        )
        several = np.concatenate(
            [np.unpackbits(np.frombuffer(d, np.uint8), count=len(k)) for d, k in zip(blocks["docs"], keys)]
        )
        order = np.argsort(which, kind="stable")
        begin = np.searchsorted(which[order], np.arange(len(distinct)))
        least = np.minimum.reduceat(first[order], begin)
        repeated = (least != np.maximum.reduceat(first[order], begin)) | (np.maximum.reduceat(several[order], begin) > 0)
        flags = repeated * REPEATED
        for column, flag in (("before", FROM_MANY), ("after", TO_MANY)):
            marks = np.frombuffer(b"".join(blocks[column]), np.uint8)
            flags = flags + (_marks(marks[order], begin) == MANY) * flag
        each = (flags[which] + (first > least[which]) * EARLIER).astype(np.uint8)
        return pd.DataFrame(
            {
                "chunk": blocks["chunk"],
                "shard": blocks["shard"],
                "flags": [x.tobytes() for x in chunks.split_like(each, keys)],
            }
        )

    return asked.groupBy("shard").applyInPandas(of, "chunk long, shard int, flags binary")


def spans(flag: np.ndarray, owner: np.ndarray, glued: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[begin, end) of runs of set flags; a run ends with its owner, and where it is not glued to the next."""
    begins = flag & ~np.append(False, flag[:-1] & (owner[1:] == owner[:-1]) & glued[:-1])
    ends = flag & ~np.append(flag[1:] & (owner[1:] == owner[:-1]) & glued[:-1], False)
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _lists(begin: np.ndarray, end: np.ndarray, owner: np.ndarray, origin: np.ndarray, n: int) -> pa.Array:
    """Spans of words as a list per document, counted from its first word."""
    of = owner[begin] if len(begin) else begin
    offsets = np.append(0, np.cumsum(np.bincount(of, minlength=n)))
    pairs = pa.StructArray.from_arrays(
        [pa.array((begin - origin[of]).astype(np.int32)), pa.array((end - origin[of]).astype(np.int32))],
        fields=list(SPAN),
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def dedup(docs: DataFrame, k: int = 13) -> DataFrame:
    """Remove from each document the words covered by a window of ``k`` words that starts in an earlier one.

    Columns: doc_id, n_words, n_removed, removed (spans of words, [start, end)), paths (spans of
    repeated, unbranched windows, removed or not), kept (the words left, joined by one space).
    "Earlier" is a smaller doc_id; NULL comes last; rows of one id do not remove each other's words. Windows
    are judged on the input. NULL and empty texts have no words; texts shorter than
    ``k`` words have no window. Texts are read whole; other columns are ignored. No rows give no rows.

    Edges are compared by 64-bit hashes of their words: among n different windows, n^2 / 2^65 are
    expected to be taken for another.
    """
    staged = chunks.stage(docs)
    shards = 4 * chunks.partitions(docs)
    answers = answer(ask(staged, k, shards))

    def of(chunk: chunks.Chunk, replies: list | None) -> Iterator[pa.RecordBatch]:
        ids, e = chunk.ids, edges(chunk.ids, chunk.texts, k)
        flags = np.frombuffer(b"".join(r["flags"] for r in replies or []), np.uint8)
        n, words = len(ids), len(e.words)
        origin = np.cumsum(e.counts) - e.counts
        owner = np.repeat(np.arange(n), e.counts)
        flag = flags[e.which] if len(flags) else np.zeros(0, np.uint8)
        earlier = (flag & EARLIER > 0) | (ids[e.doc] > e.first_doc[e.which]) if len(flag) else flag.astype(bool)
        cover = np.zeros(words + 1, np.int64)
        np.add.at(cover, e.start[earlier], 1)
        np.add.at(cover, e.start[earlier] + k, -1)
        gone = np.cumsum(cover[:-1]) > 0
        removed = _lists(*spans(gone, owner, np.ones(words, bool)), owner, origin, n)
        # Windows in a row are neighbours in the graph; they are one path unless there is a branch between.
        glued = np.zeros(len(flag), bool)
        glued[:-1] = (flag[:-1] & TO_MANY == 0) & (flag[1:] & FROM_MANY == 0)
        begin, end = spans(flag & REPEATED > 0, e.doc, glued)
        path_begin = e.start[begin] if len(begin) else begin
        path_end = e.start[end - 1] + k if len(begin) else begin
        paths = _lists(path_begin, path_end, owner, origin, n)
        kept = e.words.filter(pa.array(~gone))
        left = np.bincount(owner[~gone], minlength=n)
        offsets = pa.array(np.append(0, np.cumsum(left)), pa.int32())
        text = pc.binary_join(pa.ListArray.from_arrays(offsets, kept), " ")
        result = pa.RecordBatch.from_arrays(
            [chunks.id_array(ids), pa.array(e.counts), pa.array(e.counts - left), removed, paths, text], schema=RESULT
        )
        for at in range(0, n, 2000):
            yield result.slice(at, 2000)

    home = chunks.with_answers(staged, answers, "flags")
    return home.mapInArrow(lambda b: chunks.each_chunk(b, of), RESULT_DDL)
