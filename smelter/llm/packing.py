"""Packing by Karmarkar-Karp multiway differencing.

A document is its token ids and an end token, cut into full windows and a remainder. Remainders of a group are
packed into windows of near-equal length: of all partial partitions the two with the greatest spread
are merged, longest windows of one onto shortest of the other, until one is left. If a window then holds more than
the capacity, the same is done with more windows. One remainder in ``Packing.fine`` is cut into ever
shorter pieces, the fine grain that evens out the rest.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from smelter.llm.batches import slices
from smelter.llm.bpe import byte_letters

# Fixed value: how this family of tokenizers cuts text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SLICE_BYTES = 2_000_000  # text handled at once


@dataclass(frozen=True)
class Packing:
    window: int = 1024
    end: int = 0  # id after each document
    group: int = 4096  # pieces packed together
    fine: int = 8  # one remainder in so many is cut finely


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers JSON file, in a faster library with equal results."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte = {letter: b for b, letter in enumerate(byte_letters())}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = {token: i for token, i in spec["model"]["vocab"].items() if token not in special}
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError(f"ids of {path} do not follow the order of its merges")
    ranks = {bytes(map(byte.__getitem__, token)): i for token, i in vocab.items()}
    return tiktoken.Encoding("from-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(path: str, text: str) -> np.ndarray:
    """Ids of one text; special tokens in it become their ids."""
    return np.array(encoder(path).encode(text, allowed_special="all"), dtype="<u4")


def cuts(ids: np.ndarray, packing: Packing) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    window, n = packing.window, len(ids)
    whole = [(at, window) for at in range(0, n - window + 1, window)]
    start, left = len(whole) * window, n % window
    if left and int(ids[start:].sum(dtype=np.uint64)) % packing.fine == 0:
        while left:
            length = -(-left // 4)
            whole.append((start, length))
            start, left = start + length, left - length
    elif left:
        whole.append((start, left))
    return whole


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item, by Karmarkar-Karp differencing into ``windows`` windows."""
    owner = np.arange(len(sizes))  # of each item: the item its window is named after

    def find(items: np.ndarray) -> np.ndarray:
        while (up := owner[items] != items).any():
            items = np.where(up, owner[items], items)
        return items

    # A partial partition: sums less the least of them, descending, and an item of each window that has one.
    order = np.argsort(-sizes, kind="stable")
    heap = [(-int(sizes[i]), n, sizes[i : i + 1].astype(np.int64), np.array([i])) for n, i in enumerate(order)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        _, _, a_sums, a_items = heapq.heappop(heap)
        _, _, b_sums, b_items = heapq.heappop(heap)
        both = max(0, len(a_sums) + len(b_sums) - windows)  # windows that hold items on either side
        free_a, free_b = len(a_sums) - both, len(b_sums) - both
        sums = np.concatenate([a_sums[:free_a], a_sums[free_a:] + b_sums[free_b:][::-1], b_sums[:free_b]])
        items = np.concatenate([a_items, b_items[:free_b]])
        owner[b_items[free_b:][::-1]] = a_items[free_a:]
        order = np.argsort(-sums, kind="stable")
        sums, items = sums[order], items[order]
        if len(sums) == windows:
            sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), number, sums, items))
        number += 1
    return np.unique(find(np.arange(len(sizes))), return_inverse=True)[1]


def pack_sizes(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each item, windows of near-equal sums and none above ``capacity``.

    Starts with the fewest windows that could do, and takes more, one in 256 or one, as long as a window is too full. Every item
    must be within the capacity.
    """
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, windows)
        if np.bincount(window, sizes).max() <= capacity:
            return window
        windows += max(1, windows // 256)


def pack(docs: DataFrame, path: str, packing: Packing = Packing()) -> DataFrame:
    """Cut and pack every document of ``docs`` (doc_id, text) into sequences of at most ``packing.window`` ids.

    ``path`` is a byte-level BPE file of the tokenizers library, on every worker. Columns, a row per piece: doc_id, start (ids
    of its document before it), ids (binary: little-endian unsigned 32-bit integers), length, doc_tokens (with the end
    token), sequence_id, offset (ids of its sequence before it). NULL and empty texts are an end token alone; texts of
    any length are read whole; repeated rows are packed each on its own; rows of NULL doc_id too; other columns
    are ignored; an empty table gives no rows. A document of over a window has full sequences of its own.

    Nothing is shuffled: a task packs the remainders of its rows, ``packing.group`` pieces at a time, so memory is bounded by a group
    and a document. A task that is run again gives the same sequences if its rows come in the same order, so ``docs``
    should be a stored table.
    """
    fields = [docs.schema["doc_id"]] + [
        T.StructField(name, kind)
        for name, kind in (
            ("start", T.LongType()),
            ("ids", T.BinaryType()),
            ("length", T.LongType()),
            ("doc_tokens", T.LongType()),
            ("sequence_id", T.LongType()),
            ("offset", T.LongType()),
        )
    ]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        id_type, held = None, []

        def rows(pieces: list[tuple], sequences: np.ndarray, offsets: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(pieces), 1024):
                doc_ids, starts, ids, lengths, totals = zip(*pieces[at : at + 1024])
                part = slice(at, at + 1024)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, id_type),
                        pa.array(starts, pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(lengths, pa.int64()),
                        pa.array(totals, pa.int64()),
                        pa.array(sequences[part], pa.int64()),
                        pa.array(offsets[part], pa.int64()),
                    ],
                    names=names,
                )

        def packed(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            sizes = np.array([p[3] for p in pieces])
            window = pack_sizes(sizes, packing.window)
            order = np.argsort(window, kind="stable")
            window, ends = window[order], np.cumsum(sizes[order])
            first = np.flatnonzero(np.append(True, window[1:] != window[:-1]))
            before = np.repeat((ends - sizes[order])[first], np.diff(np.append(first, len(window))))
            yield from rows([pieces[i] for i in order], sequence + window, ends - sizes[order] - before)
            sequence += int(window[-1]) + 1

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for part in slices(batch, "text", SLICE_BYTES):
                full = []
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                    ids = np.append(encode(path, text or ""), np.array([packing.end], "<u4"))
                    for start, length in cuts(ids, packing):
                        piece = (doc_id, start, ids[start : start + length].tobytes(), length, len(ids))
                        (full if length == packing.window else held).append(piece)
                yield from rows(full, sequence + np.arange(len(full)), np.zeros(len(full), np.int64))
                sequence += len(full)
                while len(held) >= 2 * packing.group:
                    yield from packed(held[: packing.group])
                    held = held[packing.group :]
        if held:
            yield from packed(held)

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(fields))
