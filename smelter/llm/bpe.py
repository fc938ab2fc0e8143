"""BPE encoding and decoding by speculation: propose greedily, verify by pairs, merge only what fails.

A word's token sequence is its BPE encoding exactly when every adjacent pair of tokens is: encoding the
two tokens' text on its own gives those two tokens back. So greedy longest-match proposes tokens
for each distinct word, all adjacent pairs of a batch of words are tested at once, and words with a
pair that fails are merged rank by rank.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from smelter.llm.batches import slices

WORD_END = "</w>"
# Fixed values of this family of tokenizers: white space, and what is one word.
SPACE = r"\t-\r \x85\xa0  -     　"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")

CACHED_WORDS = 300_000  # distinct words a worker remembers; a full cache starts anew
SLICE_CHARS = 2_000_000  # text handled at once
NEVER = 1 << 40


def byte_letters() -> list[str]:
    """A visible letter for every byte: itself where it is printable Latin-1, else the next free one from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(hidden)) for b in range(256)]


class Tokenizer:
    """A BPE vocabulary with word ends, from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.strings = np.empty(size, dtype=object)
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.strings[i] = token
        # The longest token that begins with these (up to three) letters.
        self.reach: dict[str, int] = {}
        for token in self.vocab:
            n = len(bare := token.removesuffix(WORD_END))
            self.reach[bare[:3]] = max(n, self.reach.get(bare[:3], 0))
        self.letters = byte_letters()
        # A token's age is the rank of the merge that makes it; letters are never made.
        self.age = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        pairs, made = np.empty(len(merges), dtype=np.int64), np.empty(len(merges), dtype=np.int64)
        for rank, (a, b) in enumerate(merges):
            whole, first, second = self.vocab[a + b], self.vocab[a], self.vocab[b]
            self.age[whole], self.left[whole], self.right[whole] = rank, first, second
            pairs[rank], made[rank] = first * size + second, rank
        order = np.argsort(pairs)
        self.size, self.pairs, self.made = size, pairs[order], made[order]
        self.result = np.array([self.vocab[a + b] for a, b in merges], dtype=np.int64)
        self._index_pairs()
        self._forget()

    def _index_pairs(self) -> None:
        """An open-addressed table from pair to rank, probed for whole arrays at once."""
        self.mask = (1 << 18) - 1
        slots = np.full(self.mask + 1, -1, dtype=np.int64)
        waiting, self.probes = np.arange(len(self.pairs)), 0
        while len(waiting):
            at = self._slot(self.pairs[waiting], self.probes)
            free = slots[at] < 0
            slots[at[free]] = waiting[free]
            waiting, self.probes = waiting[slots[at] != waiting], self.probes + 1
        taken = slots >= 0
        self.slot_pair = np.where(taken, self.pairs[slots], -1)
        self.slot_rank = np.where(taken, self.made[slots], NEVER)

    def _slot(self, pair: np.ndarray, probe: int) -> np.ndarray:
        mixed = pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)
        return (mixed.astype(np.int64) + probe) & self.mask

    def rank(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, ``NEVER`` where there is none."""
        pair = first * self.size + second
        out = np.full(len(pair), NEVER, dtype=np.int64)
        open_ = np.arange(len(pair))
        for probe in range(self.probes):
            at = self._slot(pair[open_], probe)
            held = self.slot_pair[at]
            hit = held == pair[open_]
            out[open_[hit]] = self.slot_rank[at[hit]]
            open_ = open_[~hit & (held >= 0)]
            if not len(open_):
                break
        return out

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.uint32)

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over the word's letters."""
        vocab, reach, n, i, out = self.vocab, self.reach, len(word), 0, []
        while i < n:
            j = i + max(reach.get(word[i : i + 3], 0), reach.get(word[i : i + 2], 1))
            token = vocab.get(word[i:] + WORD_END) if j >= n else None
            if token is None:
                j = min(j, n - 1)
                while j > i and (token := vocab.get(word[i:j])) is None:
                    j -= 1
            else:
                j = n
            out.append(token)
            i = j
        return out

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Exact encoding of many words: (tokens one after the other, tokens per word).

        In each round every word merges its pair of lowest rank, wherever it occurs, left to right:
        a merge makes only pairs of higher rank, so this equals one merge at a time.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = [self.vocab[c] for c in self.letters]
        table = dict(zip(map(ord, self.letters), letters))
        ends = {ord(c): self.vocab[c + WORD_END] for c in self.letters}
        text = "".join(words)
        token = np.fromiter(map(table.__getitem__, map(ord, text)), np.int64, len(text))
        last = np.cumsum(sizes) - 1
        token[last] = np.fromiter((ends[ord(w[-1])] for w in words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        done_token, done_word = [], []
        while len(token):
            rank = np.full(len(token), NEVER, dtype=np.int64)
            joint = np.flatnonzero(word[:-1] == word[1:])
            rank[joint] = self.rank(token[joint], token[joint + 1])
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(word)))
            lowest = np.repeat(best, size)
            over = lowest == NEVER
            if over.any():
                done_token.append(token[over])
                done_word.append(word[over])
                token, word, rank, lowest = (x[~over] for x in (token, word, rank, lowest))
            hit = np.flatnonzero(rank == lowest)
            # Of hits side by side, as in "aaa", every second one counts.
            run = np.append(True, np.diff(hit) != 1)
            begin = np.repeat(hit[run], np.diff(np.append(np.flatnonzero(run), len(hit)))) if len(hit) else hit
            hit = hit[(hit - begin) % 2 == 0]
            token[hit] = self.result[rank[hit]]
            keep = np.ones(len(token), dtype=bool)
            keep[hit + 1] = False
            token, word = token[keep], word[keep]
        token, word = np.concatenate(done_token), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return token[order], np.bincount(word, minlength=len(words))

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens, encoded together, stays this pair.

        Undoes merges at the seam, youngest first. The pair breaks if, at some point, the tokens that
        meet there have a merge that comes before the one undone last: of equal ranks the left one
        comes first.
        """
        good = np.ones(len(first), dtype=bool)
        where = np.arange(len(first))
        a, b = first.astype(np.int64), second.astype(np.int64)
        # Merges of this age, and of the same age for those left of the seam, are too late.
        limit = np.full(len(a), 2 * len(self.ranks), dtype=np.int64)
        while len(where):
            key = a * self.size + b
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            breaks = (self.pairs[at] == key) & (2 * self.made[at] < limit)
            good[where[breaks]] = False
            done = breaks | ((self.age[a] < 0) & (self.age[b] < 0))
            where, a, b, limit = (x[~done] for x in (where, a, b, limit))
            undo_left = self.age[a] > self.age[b]
            # A merge at the seam lies right of one inside ``a`` and left of one inside ``b``.
            limit = np.where(undo_left, 2 * self.age[a], 2 * self.age[b] + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return good

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet."""
        spelled = ["".join(map(self.letters.__getitem__, w.encode())) for w in words]
        proposals = [self.propose(w) for w in spelled]
        counts = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(words)), counts)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        keys, which = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        fails = ~self.compatible(keys // self.size, keys % self.size)[which]
        failed = np.unique(owner[inner[fails]])
        if len(failed):
            merged, sizes = self.merge([spelled[i] for i in failed.tolist()])
            right = np.ones(len(words), dtype=bool)
            right[failed] = False
            flat, owner = flat[right[owner]], owner[right[owner]]
            order = np.argsort(np.append(owner, np.repeat(failed, sizes)), kind="stable")
            flat = np.append(flat, merged)[order]
            counts[failed] = sizes
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.starts = np.append(self.starts, len(self.tokens) + np.cumsum(counts) - counts)
        self.counts = np.append(self.counts, counts)
        self.tokens = np.append(self.tokens, flat.astype(np.uint32))

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma
        return WORDS.findall(text.lower())

    def split(self, text: str) -> list[str]:
        """Words and special tokens, which are cut out of the text before it is normalised."""
        if not any(s in text for s in self.special):
            return self.words(text)
        cut = regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text)
        return [w for i, part in enumerate(cut) for w in ([part] if i % 2 else self.words(part))]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text, 32-bit; None counts as empty."""
        split = [self.split(t) if t else [] for t in texts]
        new = {w for words in split for w in words} - self.known.keys()
        if len(self.known) + len(new) > CACHED_WORDS:
            self._forget()
            new = {w for words in split for w in words}
        for s in self.special:
            if s in new:
                new.discard(s)
                self.known[s] = len(self.known)
                self.starts = np.append(self.starts, len(self.tokens))
                self.counts = np.append(self.counts, 1)
                self.tokens = np.append(self.tokens, np.uint32(self.special[s]))
        if new:
            self.learn(list(new))
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        known = self.known
        which = np.fromiter((known[w] for words in split for w in words), np.int64, int(sizes.sum()))
        counts = self.counts[which]
        ends = np.cumsum(counts)
        ids = self.tokens[np.repeat(self.starts[which] - ends + counts, counts) + np.arange(counts.sum())]
        bounds = np.append(0, ends)[np.append(0, np.cumsum(sizes))]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' strings, one space between."""
        return " ".join(self.strings[ids].tolist())


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Encode every text of ``docs`` (doc_id, text) with the tokenizer file at ``path``.

    Columns: doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit integers). Special tokens in
    a text become their ids; none is added. NULL and empty texts have no ids; texts of any length are
    read whole; equal rows give equal rows; other columns are ignored. ``path`` must
    exist on every worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            for part in slices(batch, "text", SLICE_CHARS):
                ids = own.encode(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids"],
                )

    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``decoded``, the text of ``ids`` as ``encode`` returns them; NULL ids decode to empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            for part in slices(batch, "ids", 4 * SLICE_CHARS // 3):
                ids = [np.frombuffer(x or b"", dtype="<u4") for x in part["ids"].to_pylist()]
                yield part.append_column("decoded", pa.array([own.decode(x) for x in ids], pa.string()))

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(run, schema)
