"""Induced suffix sorting with common prefixes, in external memory.

Suffixes that begin a rising stretch after a falling one (LMS suffixes, a third of all) are sorted first: the stretches
between them are named in order, and the shorter string of names is sorted. All others are induced: a scan over
the sorted suffixes puts, for each, the suffix one position longer at the next place of its first character.
Each entry is a tuple of position and common prefix with the entry before it; the common prefix of two induced entries is one
more than the least among the entries between those that induced them. Waiting entries stand in one queue
per character, which together are a priority queue by (character, time of arrival); queues beyond a
bound go to disk.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict

import numpy as np

HELD = 8_000_000  # queue entries in memory at most
MULTIPLIER = 0xD6E8FEB86659FD93
INVERSE = pow(MULTIPLIER, -1, 1 << 64)

Entries = tuple[np.ndarray, np.ndarray]  # positions, common prefix of each with the one before


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Queues:
    """First in, first out, for each character."""

    def __init__(self) -> None:
        self.parts: dict[int, list] = defaultdict(list)
        self.held, self.file = 0, None

    def put(self, char: int, positions: np.ndarray, common: np.ndarray) -> None:
        if self.held + len(positions) <= HELD:
            self.held += len(positions)
            self.parts[char].append((positions, common))
            return
        # An unnamed file of this task: it is gone with the task, however that ends.
        self.file = self.file or tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        self.file.write(positions.tobytes())
        self.file.write(common.tobytes())
        self.parts[char].append((at, len(positions)))

    def take(self, char: int) -> Entries:
        positions, common = [], []
        for a, b in self.parts.pop(char, ()):
            if isinstance(a, int):
                self.file.seek(a)
                both = np.frombuffer(self.file.read(8 * b), np.int32)
                a, b = both[:b], both[b:]
            else:
                self.held -= len(a)
            positions.append(a)
            common.append(b)
        if not positions:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        return np.concatenate(positions), np.concatenate(common)


def rising(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (type S); the last character counts as such."""
    up = np.append(text[:-1] < text[1:], True)
    same = np.flatnonzero(text[:-1] == text[1:])
    while (up[same] != up[same + 1]).any():  # as the next, which may be as the next but one
        up[same] = up[same + 1]
    return up


def refine(rank: np.ndarray, which: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order the members ``which`` of equal ranks by ``key``; return those still equal to another.

    A rank is the number of members below. ``which`` holds whole groups of equal rank.
    """
    order = np.lexsort((key, rank[which]))
    sorted_which, sorted_key = which[order], key[order]
    old = rank[sorted_which]
    group = np.append(True, old[1:] != old[:-1])
    run = group | np.append(True, sorted_key[1:] != sorted_key[:-1])
    place = np.arange(len(order))
    begin = np.maximum.accumulate(np.where(run, place, 0))
    rank[sorted_which] = old + begin - np.maximum.accumulate(np.where(group, place, 0))
    alone = run & np.append(run[1:], True)
    return sorted_which[~alone]


def sorted_lms(text: np.ndarray, up: np.ndarray, depth: int) -> Entries:
    """LMS suffixes in order, right to ``depth`` characters, with common prefixes up to ``depth``."""
    lms = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    m, n = len(lms), len(text)
    symbol = text << np.uint16(1) | up
    size = np.append(np.diff(lms) + 1, 1)  # each stretch with the first character of the next
    rank = np.zeros(m, np.int64)
    which, k = np.arange(m), 0
    while len(which):
        word = np.zeros(len(which), np.uint64)
        for j in range(6 * k, 6 * k + 6):  # six symbols of ten bits at a time
            at = lms[which] + j
            word = word << np.uint64(10) | np.where(j < size[which], symbol[np.minimum(at, n - 1)], 0).astype(np.uint64)
        which = refine(rank, which, word)
        which, k = which[size[which] > 6 * (k + 1)], k + 1
    # Names are in order now. Equal runs of names are told apart by what follows, twice as far each time;
    # a name stands for two characters at least.
    which, h = np.flatnonzero(np.bincount(rank, minlength=m)[rank] > 1), 1
    while len(which) and 2 * h < 2 * depth:
        after = which + h
        which = refine(rank, which, np.where(after < m, rank[np.minimum(after, m - 1)] + 1, 0))
        h *= 2
    order = lms[np.argsort(rank, kind="stable")].astype(np.int32)
    return order, common_prefixes(text, order, depth)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Of each position with the one before it, up to ``depth``, by bisection on hashes."""
    n = len(text)
    total = np.zeros(n + 1, np.uint64)
    total[1:] = powers(MULTIPLIER, n)
    total[1:] *= text + np.uint64(1)
    np.cumsum(total, out=total)
    back = powers(INVERSE, n)
    a, b = order[:-1], order[1:]
    common, step = np.zeros(len(a), np.int32), 1 << depth.bit_length()
    while step := step >> 1:
        to = common + step
        fits = (to <= depth) & (np.maximum(a, b) + to <= n)
        to = np.where(fits, to, 0)
        same = (total[a + to] - total[a]) * back[a] == (total[b + to] - total[b]) * back[b]
        common = np.where(fits & same, to, common)
    return np.append(np.int32(0), common)


def _between(common: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """One more than the least common prefix from each chosen entry to the next; the last has no meaning."""
    return np.minimum.reduceat(np.append(common, np.int32(0)), chosen + 1) + np.int32(1)


def _own(text: np.ndarray, char: int, entries: Entries) -> tuple[Entries, int]:
    """Add the entries that a bucket's entries induce in the bucket itself, and the longest run of ``char``.

    Those of round r begin with r times the character and then part, so neighbours of different rounds have the lesser run in common.
    """
    rounds, run = [entries], int(len(entries[0]) > 0)
    while True:
        positions, common = rounds[-1]
        chosen = np.flatnonzero((positions > 0) & (text[positions - 1] == char))
        if not len(chosen):
            break
        rounds.append((positions[chosen] - np.int32(1), np.append(np.int32(run), _between(common, chosen)[:-1])))
        run += 1
    return (np.concatenate([r[0] for r in rounds]), np.concatenate([r[1] for r in rounds])), run


def _induce(queues: Queues, text: np.ndarray, entries: Entries, wanted: np.ndarray) -> None:
    """Queue the suffixes one longer than the wanted entries, by their first character."""
    positions, common = entries
    chosen = np.flatnonzero(wanted)
    if not len(chosen):
        return
    chars = text[positions[chosen] - 1]
    by_char = np.argsort(chars, kind="stable")
    chosen, chars = chosen[by_char], chars[by_char]
    induced = np.append(np.int32(1), _between(common, chosen)[:-1])
    edges = np.append(np.flatnonzero(np.append(True, chars[1:] != chars[:-1])), len(chars))
    induced[edges[:-1]] = 1  # what a queue holds already follows from another character
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        queues.put(int(chars[a]), positions[chosen[a:b]] - np.int32(1), induced[a:b])


def repeated(text: np.ndarray, depth: int) -> np.ndarray:
    """Whether the first ``depth`` characters of each suffix also begin another suffix.

    ``text`` ends with a 0 that is nowhere else. Its characters are below 512.
    """
    up = rising(text)
    lms, lms_common = sorted_lms(text, up, depth)
    lms_edges = np.searchsorted(text[lms], np.arange(int(text.max()) + 2))
    falling, rising_, runs = Queues(), Queues(), {}
    done = Queues()
    top = int(text.max())
    # Upwards: falling suffixes (type L), induced by LMS suffixes and by each other.
    for char in range(top + 1):
        (positions, common), run = _own(text, char, falling.take(char))
        runs[char] = run
        done.put(char, positions, common)
        seeds = slice(lms_edges[char], lms_edges[char + 1])
        seed_common = lms_common[seeds].copy()
        if len(seed_common):
            first = int(lms[seeds][0])
            ahead = text[first : first + run + 1]
            seed_common[0] = min(run, int(np.argmax(np.append(ahead != char, True))))
        block = np.concatenate([positions, lms[seeds]]), np.concatenate([common, seed_common])
        before = block[0] - 1
        _induce(falling, text, block, (before >= 0) & ~up[before] & (text[before] > char))
    # Downwards: rising suffixes, largest first, induced by all.
    found = np.zeros(len(text), bool)
    for char in range(top, -1, -1):
        (positions, common), run = _own(text, char, rising_.take(char))
        falls, fall_common = done.take(char)
        turned = np.append(np.int32(min(run, runs[char])), fall_common[:0:-1])[: len(falls)]
        block = np.concatenate([positions, falls[::-1]]), np.concatenate([common, turned])
        block[1][:1] = 0  # the entry before begins with another character
        deep = np.flatnonzero(block[1] >= depth)
        found[block[0][deep]] = True
        found[block[0][deep - 1]] = True
        before = block[0] - 1
        _induce(rising_, text, block, (before >= 0) & up[before] & (text[before] < char))
    return found


def repeated_windows(content: bytes, lengths: np.ndarray, width: int) -> list[np.ndarray]:
    """For each of some byte strings, one after another in ``content``: which windows occur elsewhere in any of them."""
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.ones(int((lengths + 1).sum()) + 1, np.uint16)  # 1 ends a string
    inner = np.ones(len(text), bool)
    inner[starts + lengths] = False
    inner[-1] = False
    text[inner] = np.frombuffer(content, np.uint8).astype(np.uint16) + 2
    text[-1] = 0
    found = repeated(text, width)
    return [found[s : s + max(n - width + 1, 0)] for s, n in zip(starts.tolist(), lengths.tolist())]
