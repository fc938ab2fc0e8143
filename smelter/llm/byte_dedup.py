"""Dedup of repeated byte strings by suffix sorting.

Sorting every suffix of a corpus would sort mostly text that repeats nowhere, so each window of ``width`` bytes
is first given an anchor, the 64-byte string in it whose hash is least: equal windows have equal anchors, at the same
place. A piece is a run of windows with one anchor. Chunks ask about their anchors and pieces by hash; a piece whose
anchor occurs once repeats nothing, one that occurs twice as a whole repeats in all its windows. Only pieces that
share an anchor with different pieces are sent, once each, to the anchor's shard, and there sorted by suffix.

An anchor at the edge of a passage that countless texts share has as many different pieces. No task could sort
those; their windows are dealt out by hash instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from smelter.llm import chunks, suffixes
from smelter.scratch import written

ANCHOR = 64  # bytes of an anchor
SEGMENT = 1 << 20  # windows of a text handled at once
PLACE = np.uint64((1 << 24) - 1)  # bits of a hash that give way to its place: of equal hashes the first counts

# What a shard says of a piece.
SINGLE, EVERYWHERE, SEND, SEND_EVERYWHERE, HASH, HASH_EVERYWHERE = 0, 1, 2, 3, 4, 5
MOST = 2000  # different pieces of one anchor that are sorted together

_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        _POWERS[base] = suffixes.powers(base, max(n, SEGMENT + 4096))
    return _POWERS[base][:n]


def pieces(text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, hash of the bytes, first window, window after the last) of each piece of some bytes."""
    anchor = min(ANCHOR, width)
    span, n = width - anchor + 1, len(text)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _powers(suffixes.MULTIPLIER, n), out=total[1:])
    back = _powers(suffixes.INVERSE, n)
    key = chunks.mix((total[anchor:] - total[:-anchor]) * back[: n - anchor + 1])
    placed = (key & ~PLACE) | np.arange(len(key), dtype=np.uint64)
    # Least of every ``span`` neighbours: each run of that length crosses one border of blocks.
    padded = np.append(placed, np.full(-len(placed) % span, ~np.uint64(0))).reshape(-1, span)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - width + 1
    least = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows]) & PLACE
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    after = np.append(first[1:], windows)
    whole = (total[after - 1 + width] - total[first]) * back[first] + (after - first).astype(np.uint64)
    # Anchors have the least hashes of all: mixed once more, they spread evenly over the shards.
    return chunks.mix(key[least[first].astype(np.int64)] + np.uint64(1)), chunks.mix(whole), first, after


@dataclass
class Pieces:
    """The pieces of a chunk; ``which`` numbers the distinct ones, in order of anchor and hash."""

    texts: list[np.ndarray]
    doc: np.ndarray
    first: np.ndarray
    after: np.ndarray
    which: np.ndarray
    anchors: np.ndarray
    hashes: np.ndarray
    times: np.ndarray
    one: np.ndarray  # an occurrence of each distinct piece


def chunk_pieces(texts: pa.Array, width: int) -> Pieces:
    buffers = texts.cast(pa.binary())
    offsets = np.frombuffer(buffers.buffers()[1], np.int32, len(buffers) + 1, 4 * buffers.offset)
    content = np.frombuffer(buffers.buffers()[2] or b"", np.uint8)
    bodies = [content[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    found: list[tuple] = []
    for i, text in enumerate(bodies):
        for at in range(0, len(text) - width + 1, SEGMENT):
            anchor, whole, first, after = pieces(text[at : at + SEGMENT + width - 1], width)
            found.append((anchor, whole, first + at, after + at, np.full(len(first), i)))
    if not found:
        none = np.zeros(0, np.int64)
        return Pieces(bodies, none, none, none, none, none.astype(np.uint64), none.astype(np.uint64), none, none)
    anchor, whole, first, after, doc = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((whole, anchor))
    new = np.append(True, (anchor[order][1:] != anchor[order][:-1]) | (whole[order][1:] != whole[order][:-1]))
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    one = order[new]
    return Pieces(bodies, doc, first, after, which, anchor[one], whole[one], np.bincount(which), one)


def ask(staged: DataFrame, width: int, shards: int) -> DataFrame:
    schema = pa.schema(
        [("chunk", pa.int64()), ("shard", pa.int32()), ("anchors", pa.binary()), ("hashes", pa.binary()), ("several", pa.binary())]
    )

    def of(chunk: chunks.Chunk) -> Iterator[pa.RecordBatch]:
        p = chunk_pieces(chunk.texts, width)
        bounds = chunks.shard_bounds(p.anchors, shards)
        rows = []
        for shard in np.flatnonzero(np.diff(bounds)).tolist():
            part = slice(bounds[shard], bounds[shard + 1])
            several = np.packbits(p.times[part] > 1).tobytes()
            rows.append((chunk.number, shard, chunks.pack_sorted(p.anchors[part]), p.hashes[part].tobytes(), several))
        yield from chunks.rows_to_batches(rows, schema)

    ddl = "chunk long, shard int, anchors binary, hashes binary, several binary"
    return staged.mapInArrow(lambda b: chunks.each_chunk(b, of), ddl)


def judge(asked: DataFrame, most: int) -> DataFrame:
    """What to do with each piece; of equal pieces in several chunks one is sent or hashed."""

    def of(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("chunk")
        keys = [chunks.unpack_sorted(b) for b in blocks["anchors"]]
        anchor = np.concatenate(keys)
        whole = np.concatenate([np.frombuffer(h, np.uint64) for h in blocks["hashes"]])
        several = np.concatenate(
            [np.unpackbits(np.frombuffer(s, np.uint8), count=len(k)) for s, k in zip(blocks["several"], keys)]
        )
        order = np.lexsort((np.arange(len(anchor)), whole, anchor))
        a, w = anchor[order], whole[order]
        new_anchor = np.append(True, a[1:] != a[:-1])
        new = new_anchor | np.append(True, w[1:] != w[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(a)))
        many = np.repeat((size > 1) | (np.add.reduceat(several[order].astype(np.int64), begin) > 0), size)
        group = np.cumsum(new_anchor) - 1
        different = np.bincount(group, weights=new)[group]  # pieces of the anchor
        mixed, crowd = different > 1, different > most
        state = np.where(
            many,
            np.where(mixed & new, np.where(crowd, HASH_EVERYWHERE, SEND_EVERYWHERE), EVERYWHERE),
            np.where(mixed, np.where(crowd, HASH, SEND), SINGLE),
        )
        states = np.empty(len(order), np.uint8)
        states[order] = state
        return pd.DataFrame(
            {
                "chunk": blocks["chunk"],
                "shard": blocks["shard"],
                "states": [x.tobytes() for x in chunks.split_like(states, keys)],
            }
        )

    return asked.groupBy("shard").applyInPandas(of, "chunk long, shard int, states binary")


def _states(replies: list | None) -> np.ndarray:
    return np.frombuffer(b"".join(r["states"] for r in replies or []), np.uint8)


def send(home: DataFrame, width: int, shards: int) -> DataFrame:
    """The bytes of the pieces to be sorted, by shard of their anchors."""
    schema = pa.schema(
        [("chunk", pa.int64()), ("shard", pa.int32()), ("sizes", pa.binary()), ("asked", pa.binary()), ("content", pa.binary())]
    )

    def of(chunk: chunks.Chunk, replies: list | None) -> Iterator[pa.RecordBatch]:
        p = chunk_pieces(chunk.texts, width)
        state = _states(replies)
        bounds = chunks.shard_bounds(p.anchors, shards)
        for shard in np.flatnonzero(np.diff(bounds)).tolist():
            mine = state[bounds[shard] : bounds[shard + 1]]
            sent = bounds[shard] + np.flatnonzero((mine == SEND) | (mine == SEND_EVERYWHERE))
            if not len(sent):
                continue
            one = p.one[sent]
            parts = [p.texts[d][a : b + width - 1] for d, a, b in zip(p.doc[one], p.first[one], p.after[one])]
            sizes = chunks.pack_numbers(np.array([len(x) for x in parts], np.uint64))
            asked = np.packbits(state[sent] == SEND).tobytes()
            yield from chunks.rows_to_batches(
                [(chunk.number, shard, sizes, asked, np.concatenate(parts).tobytes())], schema
            )

    ddl = "chunk long, shard int, sizes binary, asked binary, content binary"
    return home.mapInArrow(lambda b: chunks.each_chunk(b, of), ddl)


def sort_pieces(sent: DataFrame, width: int) -> DataFrame:
    """Sort the suffixes of a shard's pieces; flag the repeated windows of those that are to be known."""

    def of(blocks: pd.DataFrame) -> pd.DataFrame:
        sizes = [chunks.unpack_numbers(s).astype(np.int64) for s in blocks["sizes"]]
        found = suffixes.repeated_windows(b"".join(blocks["content"]), np.concatenate(sizes), width)
        windows, at = [], 0
        for size, asked in zip(sizes, blocks["asked"]):
            wanted = np.unpackbits(np.frombuffer(asked, np.uint8), count=len(size))
            mine = [f for f, w in zip(found[at : at + len(size)], wanted) if w]
            windows.append(np.packbits(np.concatenate(mine)).tobytes() if mine else b"")
            at += len(size)
        return pd.DataFrame({"chunk": blocks["chunk"], "shard": blocks["shard"], "windows": windows})

    return sent.groupBy("shard").applyInPandas(of, "chunk long, shard int, windows binary")


@dataclass
class Windows:
    """The windows of the hashed pieces of a chunk: distinct keys, sorted, and each window's key."""

    keys: np.ndarray
    which: np.ndarray
    times: np.ndarray
    pieces: np.ndarray
    lengths: np.ndarray  # windows of each of these pieces


def hashed_windows(p: Pieces, state: np.ndarray, width: int) -> Windows:
    hashed = np.flatnonzero(state >= HASH)
    one = p.one[hashed]
    if not len(one):
        none = np.zeros(0, np.int64)
        return Windows(none.astype(np.uint64), none, none, hashed, none)
    content = np.concatenate([p.texts[d][a : b + width - 1] for d, a, b in zip(p.doc[one], p.first[one], p.after[one])])
    lengths = p.after[one] - p.first[one]
    begin = np.cumsum(lengths + width - 1) - (lengths + width - 1)
    start = np.repeat(begin - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))
    total = np.zeros(len(content) + 1, np.uint64)
    np.cumsum((content + np.uint64(1)) * _powers(suffixes.MULTIPLIER, len(content)), out=total[1:])
    keys = chunks.mix((total[start + width] - total[start]) * _powers(suffixes.INVERSE, len(content))[start])
    distinct, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    return Windows(distinct, which, times, hashed, lengths)


def ask_windows(home: DataFrame, width: int, shards: int) -> DataFrame:
    schema = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("keys", pa.binary()), ("several", pa.binary())])

    def of(chunk: chunks.Chunk, replies: list | None) -> Iterator[pa.RecordBatch]:
        state = _states(replies)
        if not (state >= HASH).any():
            return
        w = hashed_windows(chunk_pieces(chunk.texts, width), state, width)
        bounds = chunks.shard_bounds(w.keys, shards)
        rows = []
        for shard in np.flatnonzero(np.diff(bounds)).tolist():
            part = slice(bounds[shard], bounds[shard + 1])
            several = np.packbits(w.times[part] > 1).tobytes()
            rows.append((chunk.number, shard, chunks.pack_sorted(w.keys[part]), several))
        yield from chunks.rows_to_batches(rows, schema)

    return home.mapInArrow(lambda b: chunks.each_chunk(b, of), "chunk long, shard int, keys binary, several binary")


def find_windows(asked: DataFrame) -> DataFrame:
    """Which of the windows asked about occur twice or more."""

    def of(blocks: pd.DataFrame) -> pd.DataFrame:
        keys = [chunks.unpack_sorted(b) for b in blocks["keys"]]
        _, which = chunks.merged(keys)
        several = np.concatenate(
            [np.unpackbits(np.frombuffer(s, np.uint8), count=len(k)) for s, k in zip(blocks["several"], keys)]
        )
        found = (np.bincount(which, weights=1 + several) > 1)[which]
        flags = [np.packbits(x).tobytes() for x in chunks.split_like(found, keys)]
        return pd.DataFrame({"chunk": blocks["chunk"], "shard": blocks["shard"], "found": flags})

    return asked.groupBy("shard").applyInPandas(of, "chunk long, shard int, found binary")


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(SPAN)),
        ("kept", pa.binary()),
    ]
)
RESULT_DDL = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def runs(flag: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[begin, end) of runs of set flags within one owner."""
    same = owner[1:] == owner[:-1]
    begin = flag & ~np.append(False, flag[:-1] & same)[: len(flag)]
    end = flag & ~np.append(flag[1:] & same, False)[: len(flag)]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def united(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals that overlap or touch, as one."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    first = np.append(True, begin[1:] > reach[:-1])
    return begin[first], reach[np.append(np.flatnonzero(first)[1:] - 1, len(reach) - 1)]


def _results(ids, texts: list[np.ndarray], size, origin, begin, end) -> Iterator[pa.RecordBatch]:
    """A row per text from the removed spans of all."""
    owner = np.searchsorted(origin, begin, "right") - 1
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    begin, end = begin - origin[owner], end - origin[owner]
    for at in range(0, len(texts), 500):
        rows = range(at, min(at + 500, len(texts)))
        spans, kept, removed = [], [], []
        for i in rows:
            part = slice(edges[i], edges[i + 1])
            cuts = list(zip(begin[part].tolist(), end[part].tolist()))
            starts = [0, *(e for _, e in cuts)]
            stops = [*(b for b, _ in cuts), int(size[i])]
            spans.append([{"start": b, "end": e} for b, e in cuts])
            kept.append(b"".join(texts[i][a:b].tobytes() for a, b in zip(starts, stops)))
            removed.append(int(size[i]) - len(kept[-1]))
        yield pa.RecordBatch.from_arrays(
            [
                chunks.id_array(ids[rows.start : rows.stop]),
                pa.array(size[rows.start : rows.stop]),
                pa.array(removed, pa.int64()),
                pa.array(spans, RESULT.field("spans").type),
                pa.array(kept, pa.binary()),
            ],
            schema=RESULT,
        )


def dedup(docs: DataFrame, width: int = 400, most: int = MOST) -> DataFrame:
    """Remove every byte covered by a ``width``-byte string that also starts anywhere else, in this text or another.

    Columns: doc_id, n_bytes, n_removed, spans (maximal removed runs of bytes, [start, end)), kept (the other
    bytes; a cut may part a character). Strings are judged on the input, overlaps count, and all copies go.
    NULL and empty texts, and those shorter than ``width``, lose nothing. Texts are read whole; a repeated row
    is another text. Other columns are ignored; no rows give no rows.

    Anchors and pieces are compared by 64-bit hashes, the windows of different pieces by suffix order, or
    by 64-bit hashes where an anchor has over ``most`` different pieces.
    """
    shards = 8 * chunks.partitions(docs)
    staged = chunks.stage(docs)
    judged = written(judge(ask(staged, width, shards), most), "pieces")
    known = chunks.with_answers(staged, judged, "states")
    sorted_ = sort_pieces(send(known, width, shards), width)
    found = find_windows(ask_windows(known, width, shards))

    def of(
        chunk: chunks.Chunk, states: list | None, replies: list | None, finds: list | None
    ) -> Iterator[pa.RecordBatch]:
        p = chunk_pieces(chunk.texts, width)
        state = _states(states)
        size = np.array([len(t) for t in p.texts], np.int64)
        origin = np.cumsum(size + 1) - (size + 1)  # a gap keeps the runs of two texts apart
        whole = (state == EVERYWHERE) | (state == SEND_EVERYWHERE) | (state == HASH_EVERYWHERE)
        hit = np.flatnonzero(whole[p.which]) if len(state) else p.which
        gone = [(origin[p.doc[hit]] + p.first[hit], origin[p.doc[hit]] + p.after[hit] + width - 1)]

        def cover(one: np.ndarray, flag: np.ndarray) -> None:
            """Runs of flagged windows of some pieces."""
            lengths = p.after[one] - p.first[one]
            owner = np.repeat(np.arange(len(one)), lengths)
            begin, end = runs(flag, owner)
            place = (origin[p.doc[one]] + p.first[one] - np.cumsum(lengths) + lengths)[owner[begin]]
            gone.append((place + begin, place + end + width - 1))

        asked = np.flatnonzero(state == SEND)
        shard = np.searchsorted(chunks.shard_bounds(p.anchors, shards), asked, "right") - 1
        for reply in replies or []:
            mine = p.one[asked[shard == reply["shard"]]]
            count = int((p.after[mine] - p.first[mine]).sum())
            cover(mine, np.unpackbits(np.frombuffer(reply["windows"], np.uint8), count=count) > 0)
        if finds:
            w = hashed_windows(p, state, width)
            parts = np.diff(chunks.shard_bounds(w.keys, shards))
            bits = [np.unpackbits(np.frombuffer(f["found"], np.uint8), count=parts[f["shard"]]) for f in finds]
            cover(p.one[w.pieces], np.concatenate(bits)[w.which] > 0)
        begin, end = united(*(np.concatenate(x) for x in zip(*gone)))
        yield from _results(chunk.ids, p.texts, size, origin, begin, end)

    home = chunks.with_answers(known, sorted_, "windows", name="sorted")
    home = chunks.with_answers(home, found, "found", name="finds")
    return home.mapInArrow(lambda b: chunks.each_chunk(b, of), RESULT_DDL)
