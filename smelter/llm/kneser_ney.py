"""Interpolated modified Kneser-Ney over word pairs, learnt and looked up in hash ranges.

Counts of pairs are summed in Spark by hash range, and each range is stored as a sorted array of hashes beside
its counts; so are the words with what smoothing needs. Workers map these files into memory: the task of a range
maps its own pairs and answers the chunks that ask, and scoring tasks map the words.
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

from smelter.llm import arrays, chunks
from smelter.scratch import release, scratch_path, written

END, BEGIN = np.uint64(0xE4D0000000000001), np.uint64(0xBE61000000000003)  # stand for no word
TOTALS = ("tokens", "words", "pairs", "m1", "m2", "m3", "m4", "h1", "h2", "h3", "n1", "n2", "n3", "n4")


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the totals over all training documents."""

    root: str
    shards: int
    totals: dict[str, int]

    def store(self, kind: str, shard: int, keys: np.ndarray, values: np.ndarray) -> None:
        """Sorted hashes, and beside them rows of numbers in the fewest bytes."""
        narrow = np.min_scalar_type(int(values.max())) if values.size else np.uint8
        arrays.save(f"{self.root}/{kind}-{shard:06d}-keys.npy", keys)
        arrays.save(f"{self.root}/{kind}-{shard:06d}-values.npy", values.astype(narrow))

    def look_up(self, kind: str, shard: int, keys: np.ndarray, rows: int) -> np.ndarray:
        """The numbers stored for sorted ``keys``, a row for each; zeros where a key is missing."""
        known = arrays.load(f"{self.root}/{kind}-{shard:06d}-keys.npy")
        values = arrays.load(f"{self.root}/{kind}-{shard:06d}-values.npy")
        if known is None or not len(known):
            return np.zeros((rows, len(keys)), np.int64)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, values[:, at].astype(np.int64), 0)

    @property
    def discounts(self) -> np.ndarray:
        """By count 0, 1, 2, 3 or more, for pairs."""
        return discounts([self.totals[f"n{i}"] for i in (1, 2, 3, 4)])

    @property
    def word_discounts(self) -> np.ndarray:
        """The same for the number of different words before a word."""
        return discounts([self.totals[f"m{i}"] for i in (1, 2, 3, 4)])


def discounts(n: list[int]) -> np.ndarray:
    """From the numbers of things seen once to four times; kept inside (0, count) where these are few."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    raw = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0.75 * i for i in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, 0.1), i - 0.05) for i, d in enumerate(raw, 1))])


@dataclass
class Pairs:
    """The words and word pairs of a chunk; every text begins with BEGIN and ends with END."""

    lengths: np.ndarray  # tokens of each text: its words and END
    hashes: np.ndarray  # distinct words, sorted
    token: np.ndarray  # index of each token's word
    keys: np.ndarray  # distinct pairs, sorted
    which: np.ndarray  # of each token, its pair
    first: np.ndarray  # of each pair, the index of its first word
    second: np.ndarray
    count: np.ndarray  # of each pair, in training texts
    train: np.ndarray  # of each token


def pairs(texts: pa.Array, train: np.ndarray) -> Pairs:
    counts, flat = chunks.split_words(pc.ascii_lower(texts))
    index, hashes = chunks.hash_words(flat)
    hashes = np.concatenate([hashes, [END, BEGIN]]).astype(np.uint64)
    distinct, place = np.unique(hashes, return_inverse=True)
    lengths = counts + 1
    token = np.full(int(lengths.sum()), place[-2], dtype=np.int64)
    inner = np.ones(len(token), bool)
    inner[np.cumsum(lengths) - 1] = False
    token[inner] = place[index]
    before = np.append(place[-1], token[:-1])
    before[np.cumsum(lengths) - lengths] = place[-1]
    key = chunks.mix(distinct[before] * np.uint64(0xD6E8FEB86659FD93) + distinct[token])
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    begin = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    which = np.empty(len(key), np.int64)
    which[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(key))))
    trained = np.repeat(train, lengths)
    one = order[begin]
    return Pairs(
        lengths,
        distinct,
        token,
        ordered[begin],
        which,
        before[one],
        token[one],
        np.add.reduceat(trained[order].astype(np.int64), begin),
        trained,
    )


def ask(staged: DataFrame, shards: int) -> DataFrame:
    schema = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def of(chunk: chunks.Chunk) -> Iterator[pa.RecordBatch]:
        p = pairs(chunk.texts, chunk.flags)
        bounds = chunks.shard_bounds(p.keys, shards)
        rows = []
        for shard in np.flatnonzero(np.diff(bounds)).tolist():
            part = slice(bounds[shard], bounds[shard + 1])
            rows.append((chunk.number, shard, chunks.pack_sorted(p.keys[part]), chunks.pack_numbers(p.count[part])))
        yield from chunks.rows_to_batches(rows, schema)

    return staged.mapInArrow(lambda b: chunks.each_chunk(b, of), "chunk long, shard int, keys binary, counts binary")


def answer(asked: DataFrame, model: Model, learn: bool) -> DataFrame:
    """The training count of every pair asked for; if ``learn``, the counts asked with are summed and stored first.

    ``owner``: the one asker of a pair that counts it among the different pairs.
    """

    def of(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("chunk")
        keys = [chunks.unpack_sorted(b) for b in blocks["keys"]]
        distinct, which = chunks.merged(keys)
        shard = int(blocks["shard"].iloc[0])
        own = np.zeros(len(which), bool)
        if learn:
            counts = np.concatenate([chunks.unpack_numbers(c).astype(np.int64) for c in blocks["counts"]])
            total = np.bincount(which, weights=counts, minlength=len(distinct)).astype(np.int64)
            seen = total > 0
            model.store("pairs", shard, distinct[seen], total[seen][None])
            asked_with = np.flatnonzero(counts)
            own[asked_with[np.unique(which[asked_with], return_index=True)[1]]] = True
        else:
            total = model.look_up("pairs", shard, distinct, 1)[0]
        return pd.DataFrame(
            {
                "chunk": blocks["chunk"],
                "shard": blocks["shard"],
                "counts": [chunks.pack_numbers(c) for c in chunks.split_like(total[which], keys)],
                "owner": [np.packbits(o).tobytes() for o in chunks.split_like(own, keys)],
            }
        )

    return asked.groupBy("shard").applyInPandas(of, "chunk long, shard int, counts binary, owner binary")


def _answers(replies: list) -> tuple[np.ndarray, np.ndarray]:
    counts = [chunks.unpack_numbers(r["counts"]).astype(np.int64) for r in replies]
    owner = [np.unpackbits(np.frombuffer(r["owner"], np.uint8), count=len(c)) for r, c in zip(replies, counts)]
    return np.concatenate(counts), np.concatenate(owner) > 0


def word_sums(staged: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    """What each chunk adds to the words: their tokens, and the different pairs the chunk owns."""
    names = ["count", "n1", "n2", "n3", "ahead"]
    schema = pa.schema(
        [("chunk", pa.int64()), ("shard", pa.int32()), ("keys", pa.binary())]
        + [(n, pa.binary()) for n in names]
        + [("threes", pa.int64()), ("fours", pa.int64())]
    )

    def of(chunk: chunks.Chunk, replies: list) -> Iterator[pa.RecordBatch]:
        p = pairs(chunk.texts, chunk.flags)
        total, own = _answers(replies)
        n = len(p.hashes)

        def per_word(word: np.ndarray, chosen: np.ndarray) -> np.ndarray:
            return np.bincount(word[chosen], minlength=n)

        sums = np.stack(
            [
                per_word(p.token, p.train),
                per_word(p.first, own & (total == 1)),
                per_word(p.first, own & (total == 2)),
                per_word(p.first, own & (total >= 3)),
                per_word(p.second, own),
            ]
        )
        some = sums.any(axis=0)
        sums, keys = sums[:, some], p.hashes[some]
        bounds = chunks.shard_bounds(keys, shards)
        rest = (int((own & (total == 3)).sum()), int((own & (total == 4)).sum()))
        rows = []
        for shard in np.flatnonzero(np.diff(bounds)).tolist():
            part = slice(bounds[shard], bounds[shard + 1])
            packed = [chunks.pack_numbers(s[part]) for s in sums]
            rows.append((chunk.number, shard, chunks.pack_sorted(keys[part]), *packed, *rest))
            rest = (0, 0)
        yield from chunks.rows_to_batches(rows, schema)

    ddl = "chunk long, shard int, keys binary, " + ", ".join(f"{n} binary" for n in names) + ", threes long, fours long"
    return chunks.with_answers(staged, answers, "counts", "owner").mapInArrow(
        lambda b: chunks.each_chunk(b, of), ddl
    )


def store_words(sums: DataFrame, model: Model) -> DataFrame:
    """Store the words of each hash range; return a row of totals per range."""

    def of(blocks: pd.DataFrame) -> pd.DataFrame:
        keys = [chunks.unpack_sorted(b) for b in blocks["keys"]]
        distinct, which = chunks.merged(keys)
        stored = []
        for name in ("count", "n1", "n2", "n3", "ahead"):
            values = np.concatenate([chunks.unpack_numbers(v).astype(np.int64) for v in blocks[name]])
            stored.append(np.bincount(which, weights=values, minlength=len(distinct)).astype(np.int64))
        model.store("words", int(blocks["shard"].iloc[0]), distinct, np.stack(stored))
        count, n1, n2, _, ahead = stored
        totals = {
            "tokens": count.sum(),
            "words": (count > 0).sum(),
            "pairs": ahead.sum(),
            **{f"m{i}": (ahead == i).sum() for i in (1, 2, 3, 4)},
            "h1": (ahead == 1).sum(),
            "h2": (ahead == 2).sum(),
            "h3": (ahead >= 3).sum(),
            "n1": n1.sum(),
            "n2": n2.sum(),
            "n3": blocks["threes"].sum(),
            "n4": blocks["fours"].sum(),
        }
        return pd.DataFrame({t: [int(totals[t])] for t in TOTALS})

    return sums.groupBy("shard").applyInPandas(of, ", ".join(f"{t} long" for t in TOTALS))


def learn(staged: DataFrame) -> tuple[Model, DataFrame]:
    """Learn from the flagged documents of ``staged``.

    Returns the model and, as a by-product, the answers for ``staged`` that ``score`` can use. Only one row of
    totals reaches the driver.
    """
    spark = staged.sparkSession
    shards = 4 * chunks.partitions(staged)
    model = Model(scratch_path(spark, "language-model"), shards, {})
    answers = written(answer(ask(staged, shards), model, learn=True), "pair-counts")
    release(spark)
    totals = store_words(word_sums(staged, answers, shards), model).agg(
        *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TOTALS]
    )
    model = Model(model.root, shards, totals.first().asDict())
    del totals
    release(spark)
    return model, answers


def word_rows(model: Model, keys: np.ndarray) -> np.ndarray:
    """(count, n1, n2, n3, ahead) of sorted word hashes, from the mapped files."""
    bounds = chunks.shard_bounds(keys, model.shards)
    parts = [
        model.look_up("words", s, keys[bounds[s] : bounds[s + 1]], 5)
        for s in np.flatnonzero(np.diff(bounds)).tolist()
    ]
    return np.concatenate(parts, axis=1)


def probabilities(model: Model, p: Pairs, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability of each pair's second word after its first, training count of each word)."""
    t = model.totals
    count, n1, n2, n3, ahead = word_rows(model, p.hashes)
    # Words: by how many different words come before them, the rest spread evenly over all words and one unknown.
    even = 1 / (t["words"] + 1)
    if t["pairs"]:
        d = model.word_discounts
        rest = (d[1] * t["h1"] + d[2] * t["h2"] + d[3] * t["h3"]) / t["pairs"]
        alone = np.maximum(ahead - d[np.minimum(ahead, 3)], 0) / t["pairs"] + rest * even
    else:
        alone = np.full(len(count), even)
    # Nothing follows END, and as often as it comes, something follows BEGIN.
    context = np.where(p.hashes == BEGIN, count[p.hashes == END][0], count)
    d = model.discounts
    free = np.where(context > 0, (d[1] * n1 + d[2] * n2 + d[3] * n3) / np.maximum(context, 1), 1.0)
    after = np.maximum(total - d[np.minimum(total, 3)], 0) / np.maximum(context[p.first], 1)
    return after + free[p.first] * alone[p.second], count


SCORED = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(staged: DataFrame, model: Model, answers: DataFrame | None = None) -> DataFrame:
    """log10 probability of every document of ``staged``, and of a word-count baseline with one added to each count.

    Columns: doc_id, n_tokens (words and one end), n_known (tokens seen in training), train_tokens, base_score,
    score. A-Z is lower-cased. NULL and empty texts are their end alone. A text has no order beyond its words: white
    space does not count. Without training documents every word is as likely as any. Repeated rows score alike;
    no rows give no rows. Pairs are compared by 64-bit hashes.
    """
    answers = answers if answers is not None else answer(ask(staged, model.shards), model, learn=False)

    def of(chunk: chunks.Chunk, replies: list) -> Iterator[pa.RecordBatch]:
        p = pairs(chunk.texts, chunk.flags)
        likely, count = probabilities(model, p, _answers(replies)[0])
        t, begin = model.totals, np.cumsum(p.lengths) - p.lengths
        base = np.log10((count + 1) / (t["tokens"] + t["words"] + 1))
        result = pa.RecordBatch.from_arrays(
            [
                chunks.id_array(chunk.ids),
                pa.array(p.lengths),
                pa.array(np.add.reduceat((count > 0)[p.token].astype(np.int64), begin)),
                pa.array(np.full(len(begin), t["tokens"])),
                pa.array(np.add.reduceat(base[p.token], begin)),
                pa.array(np.add.reduceat(np.log10(likely)[p.which], begin)),
            ],
            names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )
        yield result

    return chunks.with_answers(staged, answers, "counts", "owner").mapInArrow(
        lambda b: chunks.each_chunk(b, of), SCORED
    )
