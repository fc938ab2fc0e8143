"""Near-duplicates by improved consistent weighted sampling of TF-IDF shingles.

Each text is the weighted set of its word shingles. Consistent weighted samples of two texts agree with the
probability of their weighted Jaccard similarity; bands of samples put similar texts into common buckets. In a
bucket, texts are compared with the bucket's centres first, and then with every member that is not connected yet;
pairs are verified by exact weighted Jaccard similarity, and classes are the connected texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from smelter.llm import chunks
from smelter.scratch import release, written

INDEX_BITS = 20  # of a text's number: its place in the chunk
BLOCK = 1 << 15  # shingles sampled at once, to stay in the processor's cache


@dataclass(frozen=True)
class Near:
    words: int = 5  # of a shingle; a shorter text is one shingle
    similarity: float = 0.8
    bands: int = 20
    rows: int = 5  # samples of a band: a pair of similarity 0.8 shares no band once in 2,900 times
    all_pairs: int = 12  # buckets up to this size compare all pairs at once, larger ones their centres with all first
    per_task: int = 250  # texts that one task compares with one other, or with as many
    held: int = 2_000_000  # total weight of the texts that a task holds


@dataclass
class Shingles:
    """Of a chunk: its distinct shingles, sorted, and each text's shingles with their counts, in order."""

    keys: np.ndarray
    doc: np.ndarray
    which: np.ndarray
    count: np.ndarray


def shingles(texts: pa.Array, words: int) -> Shingles:
    counts, flat = chunks.split_words(texts)
    index, hashes = chunks.hash_words(flat)
    word = hashes[index] if len(index) else np.zeros(0, np.uint64)
    start, key = chunks.ngrams(word, counts, words)
    doc = np.repeat(np.arange(len(counts)), counts)[start]
    origin = np.cumsum(counts) - counts
    for n in range(1, words):
        short = np.flatnonzero(counts == n)
        whole = np.full(len(short), n, np.uint64)
        for j in range(n):
            whole = chunks.mix(whole + word[origin[short] + j])
        doc, key = np.append(doc, short), np.append(key, whole)
    distinct, which = np.unique(key, return_inverse=True)
    both, count = np.unique(doc * max(len(distinct), 1) + which, return_counts=True)
    return Shingles(distinct, both // max(len(distinct), 1), both % max(len(distinct), 1), count)


def ask(staged: DataFrame, near: Near, shards: int) -> DataFrame:
    """Each chunk's shingles with the number of its texts that have them."""
    schema = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("keys", pa.binary()), ("texts", pa.binary())])

    def of(chunk: chunks.Chunk) -> Iterator[pa.RecordBatch]:
        s = shingles(chunk.texts, near.words)
        texts = np.bincount(s.which, minlength=len(s.keys))
        bounds = chunks.shard_bounds(s.keys, shards)
        rows = []
        for shard in np.flatnonzero(np.diff(bounds)).tolist():
            part = slice(bounds[shard], bounds[shard + 1])
            rows.append((chunk.number, shard, chunks.pack_sorted(s.keys[part]), chunks.pack_numbers(texts[part])))
        yield from chunks.rows_to_batches(rows, schema)

    return staged.mapInArrow(lambda b: chunks.each_chunk(b, of), "chunk long, shard int, keys binary, texts binary")


def rarity(documents: np.ndarray, total: int) -> np.ndarray:
    """Inverse document frequency in 0..255: 255 for a shingle of one document, 0 for one of all."""
    return np.rint(255 * (1 - np.log(documents) / np.log(max(total, 2)))).astype(np.uint8)


def answer(asked: DataFrame, total: int) -> DataFrame:
    def of(blocks: pd.DataFrame) -> pd.DataFrame:
        keys = [chunks.unpack_sorted(b) for b in blocks["keys"]]
        distinct, which = chunks.merged(keys)
        texts = np.concatenate([chunks.unpack_numbers(t).astype(np.int64) for t in blocks["texts"]])
        known = rarity(np.bincount(which, weights=texts, minlength=len(distinct)), total)
        return pd.DataFrame(
            {
                "chunk": blocks["chunk"],
                "shard": blocks["shard"],
                "rarity": [x.tobytes() for x in chunks.split_like(known[which], keys)],
            }
        )

    return asked.groupBy("shard").applyInPandas(of, "chunk long, shard int, rarity binary")


def weights(count: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """TF-IDF: the count, once to twice, by rarity. The bounded factor keeps copies of a much copied text similar."""
    return count * (1 + rare / 255.0)


def gamma_quantiles() -> np.ndarray:
    """65,536 equally likely values of a Gamma(2, 1) variable."""
    u = (np.arange(1 << 16) + 0.5) / (1 << 16)
    x = np.full(len(u), 1.0)
    for _ in range(60):
        x = np.maximum(x - ((1 - (1 + x) * np.exp(-x)) - u) / (x * np.exp(-x)), x / 10)
    return x.astype(np.float32)


GAMMA = gamma_quantiles()
LOG_GAMMA = np.log(GAMMA)


def samples(keys: np.ndarray, weight: np.ndarray, begin: np.ndarray, number: int) -> np.ndarray:
    """``number`` consistent weighted samples, 32 bits each, of the sets that begin at ``begin``; their keys are sorted.

    The random numbers of a shingle come from its hash: 16 bits each choose r and c, both Gamma(2, 1), and
    b, uniform. With t = floor(ln w / r + b) the shingle of least ln c - r (t - b + 1) is sampled, with t. Of equal ones
    the first is.
    """
    out = np.empty((len(begin), number), np.uint32)
    edges = np.append(begin, len(keys))
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + BLOCK, "right")) - 1)
        part = slice(edges[at], edges[to])
        key, log = keys[part], np.log(weight[part]).astype(np.float32)
        starts = begin[at:to] - begin[at]
        sizes = np.diff(np.append(starts, len(key)))
        x, high = np.empty_like(key), np.empty_like(key)
        for k in range(number):
            np.add(key, np.uint64((0xA0761D6478BD642F * (2 * k + 1)) % (1 << 64)), out=x)
            for shift, factor in ((31, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9), (32, 1)):  # as chunks.mix, in place
                np.right_shift(x, np.uint64(shift), out=high)
                np.bitwise_xor(x, high, out=x)
                if factor != 1:
                    np.multiply(x, np.uint64(factor), out=x)
            drawn = x.astype("<u8", copy=False).view("<u2").reshape(-1, 4)
            r, b = GAMMA.take(drawn[:, 0], mode="clip"), drawn[:, 2] * np.float32(2**-16)
            t = np.floor(log / r + b)
            level = LOG_GAMMA.take(drawn[:, 1], mode="clip") - r * (t - b + 1)
            least = np.flatnonzero(level == np.repeat(np.minimum.reduceat(level, starts), sizes))
            best = least[np.searchsorted(least, starts)]
            drawn_at = t[best].astype(np.int64).astype(np.uint64)
            out[at:to, k] = (x[best] >> np.uint64(32) ^ drawn_at * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
        at = to
    return out


def _rare(replies: list | None) -> np.ndarray:
    return np.frombuffer(b"".join(r["rarity"] for r in replies or []), np.uint8)


SIGNED = "doc_id long, no long, digest binary, weight double, bands array<long>"


def sign(home: DataFrame, near: Near) -> DataFrame:
    """Each text's number, MD5, total weight and bands; a text without words has no bands."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("no", pa.int64()),
            ("digest", pa.binary()),
            ("weight", pa.float64()),
            ("bands", pa.list_(pa.int64())),
        ]
    )

    def of(chunk: chunks.Chunk, replies: list | None) -> Iterator[pa.RecordBatch]:
        s, n = shingles(chunk.texts, near.words), len(chunk.ids)
        weight = weights(s.count, _rare(replies)[s.which]) if len(s.doc) else np.zeros(0)
        present, begin = np.unique(s.doc, return_index=True)
        drawn = samples(s.keys[s.which], weight, begin, near.bands * near.rows).astype(np.uint64)
        bands = np.zeros((len(present), near.bands), np.uint64)
        for j in range(near.rows):
            bands = chunks.mix(bands + drawn[:, j :: near.rows] + np.uint64(j + 1))
        size = np.zeros(n, np.int64)
        size[present] = near.bands
        body = pc.cast(chunk.texts, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                chunks.id_array(chunk.ids),
                pa.array((chunk.number << INDEX_BITS) + np.arange(n)),
                pa.array([hashlib.md5(t.as_py()).digest() for t in body], pa.binary()),
                pa.array(np.bincount(s.doc, weights=weight, minlength=n)),
                pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(bands.ravel().view(np.int64))
                ),
            ],
            schema=schema,
        )

    return home.mapInArrow(lambda b: chunks.each_chunk(b, of), SIGNED)


def buckets(texts: DataFrame) -> DataFrame:
    """(band, key, size, no, weight, fame): the members of every bucket of two texts or more."""
    rows = texts.select("no", "weight", F.posexplode("bands").alias("band", "key"))
    sizes = rows.groupBy("band", "key").agg(F.count("*").alias("size")).filter("size > 1")
    # A bucket with many members is split over tasks by Spark, as both sides are shuffled for the join.
    shared = written(rows.join(sizes, ["band", "key"]), "buckets")
    popular = shared.groupBy("no").agg(F.sum("size").alias("fame"))
    return written(shared.join(popular, "no"), "members")


def candidates(members: DataFrame, near: Near) -> DataFrame:
    """(a, b, shared): texts in common buckets that may be similar; ``a`` is the more central one.

    The centre of a bucket is the text whose buckets are the fullest: an original shares buckets with all its
    copies, a copy only with some. Large buckets propose each member with three members, which connects most;
    ``across`` compares those that are left.
    """
    centre = F.struct("fame", "no", "weight")
    three = members.filter(F.col("size") > near.all_pairs).groupBy("band", "key").agg(
        F.array(
            F.max(centre), F.max_by(centre, F.xxhash64("no")), F.max_by(centre, F.xxhash64("no", F.lit(1)))
        ).alias("centres")
    )
    own = F.struct("fame", "no", "weight")
    large = members.join(three, ["band", "key"]).select(
        "band", own.alias("one"), F.explode(F.array_distinct("centres")).alias("two")
    )
    few = members.filter(F.col("size") <= near.all_pairs).select("band", "key", own.alias("one"))
    small = few.join(few.withColumnRenamed("one", "two"), ["band", "key"]).filter("one.no < two.no")
    both = large.filter("one.no != two.no").unionByName(small.select("band", "one", "two"))
    lighter = F.least("one.weight", "two.weight") >= near.similarity * F.greatest("one.weight", "two.weight") * (1 - 1e-9)
    ordered = both.filter(lighter).select(
        "band", F.greatest("one", "two").getField("no").alias("a"), F.least("one", "two").getField("no").alias("b")
    )
    return ordered.groupBy("a", "b").agg(F.countDistinct("band").alias("shared"))


def vectors(home: DataFrame, wanted: DataFrame, near: Near) -> DataFrame:
    """The shingles of each text of ``wanted`` (no and other columns), beside its other columns."""
    columns = [f for f in wanted.schema if f.name != "no"]
    parts = [(n, pa.binary()) for n in ("keys", "counts", "rarity")]
    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in columns] + [("no", pa.int64())] + parts)
    needed = wanted.withColumn("chunk", F.shiftright("no", INDEX_BITS)).withColumn("shard", F.lit(0))

    def of(chunk: chunks.Chunk, replies: list | None, needs: list | None) -> Iterator[pa.RecordBatch]:
        if not needs:
            return
        s, rare = shingles(chunk.texts, near.words), _rare(replies)
        # 32 bits of a shingle tell it from the others of two texts.
        short = (s.keys >> np.uint64(32)).astype("<u4")
        edges = np.searchsorted(s.doc, np.arange(len(chunk.ids) + 1))
        rows = []
        for need in needs:
            i = need["no"] & ((1 << INDEX_BITS) - 1)
            part = slice(edges[i], edges[i + 1])
            which = s.which[part]
            packed = (short[which].tobytes(), chunks.pack_numbers(s.count[part]), rare[which].tobytes())
            rows.append((*(need[n] for n in names), need["no"], *packed))
            if len(rows) == 256:
                yield from chunks.rows_to_batches(rows, schema)
                rows = []
        yield from chunks.rows_to_batches(rows, schema)

    names = [f.name for f in columns]
    asked = chunks.with_answers(home, needed, "no", *names, name="needs")
    ddl = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in columns] + [VECTOR])
    return asked.mapInArrow(lambda b: chunks.each_chunk(b, of), ddl)


VECTOR = "no long, keys binary, counts binary, rarity binary"


def _vector(row: dict) -> tuple:
    """(sorted keys, weights, total) of a row of ``vectors``."""
    weight = weights(chunks.unpack_numbers(row["counts"]).astype(np.float64), np.frombuffer(row["rarity"], np.uint8))
    return np.frombuffer(row["keys"], "<u4"), weight, float(weight.sum())


def similarity(one: tuple, two: tuple) -> float:
    """Weighted Jaccard of two texts' (sorted keys, weights, total)."""
    if not len(one[0]) or not len(two[0]):
        return 0.0
    at = np.minimum(np.searchsorted(one[0], two[0]), len(one[0]) - 1)
    hit = one[0][at] == two[0]
    common = float(np.minimum(one[1][at[hit]], two[1][hit]).sum())
    return common / (one[2] + two[2] - common)


def verify(home: DataFrame, pairs: DataFrame, near: Near) -> DataFrame:
    """The pairs that are similar enough: (a, b)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    # Keyed by the more central text, and salted if that has many.
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / near.per_task).cast("int").alias("salts"))
    members = pairs.join(salts, "a").select(
        F.col("b").alias("no"), F.lit(True).alias("member"), "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt")
    )
    centres = salts.select(
        F.col("a").alias("no"), F.lit(False).alias("member"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, centre = None, None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                vector = _vector(row)
                if not row["member"]:
                    current, centre = row["a"], vector
                elif current == row["a"] and similarity(centre, vector) >= near.similarity - 1e-12:
                    found.append((row["a"], row["no"]))
            yield from chunks.rows_to_batches(found, schema)

    wanted = members.unionByName(centres)
    dealt = vectors(home, wanted, near).repartition("a", "salt").sortWithinPartitions("a", "salt", "member")
    return dealt.mapInArrow(run, "a long, b long")


def across(home: DataFrame, texts: DataFrame, members: DataFrame, labels: DataFrame, near: Near) -> DataFrame:
    """The similar pairs (a, b) of large buckets whose texts have different ``labels``.

    In each large bucket, the texts outside its most frequent label meet all others, in blocks: a task holds a block
    of the first and reads a block of the members. A pair is compared in the first band it shares only (if that
    bucket is a small one, it was), and not once its labels are connected within the task.
    """
    band, schema = ["band", "key"], pa.schema([("a", pa.int64()), ("b", pa.int64())])
    large = members.filter(F.col("size") > near.all_pairs).join(labels, "no", "left")
    large = large.select(*band, "no", "weight", F.coalesce("label", "no").alias("label"))
    each = large.groupBy(*band, "label").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    most = F.struct("n", "w", "label")
    open_ = each.groupBy(*band).agg(F.max(most).alias("main"), F.sum("n").alias("n"), F.sum("w").alias("w"))
    open_ = open_.filter(F.col("n") > F.col("main.n"))

    def blocks(n: Column, w: Column) -> Column:
        return F.greatest(F.ceil(n / near.per_task), F.ceil(w / near.held)).cast("int")

    open_ = open_.select(
        *band,
        F.col("main.label").alias("main"),
        blocks(F.col("n") - F.col("main.n"), F.col("w") - F.col("main.w")).alias("held_blocks"),
        F.ceil(F.col("n") / near.per_task).cast("int").alias("read_blocks"),
    )
    rows = large.join(open_, band).join(texts.select("no", "bands"), "no").select(
        *band,
        "no",
        "label",
        (F.col("label") == F.col("main")).alias("main"),
        F.slice("bands", F.lit(1), F.col("band")).alias("before"),  # what the text drew in earlier bands
        "held_blocks",
        "read_blocks",
    )
    rows = written(rows, "open")
    if rows.isEmpty():
        return rows.select(F.col("no").alias("a"), F.col("no").alias("b"))

    def dealt_to(own: str, others: str, own_name: str, other_name: str) -> list[Column]:
        return [
            F.pmod(F.xxhash64("no"), F.col(own)).cast("int").alias(own_name),
            F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other_name),
        ]

    columns = [*band, "i", "j", "reads", "no", "label", "main", "before"]
    held = rows.filter(~F.col("main")).withColumn("reads", F.lit(False))
    held = held.select("*", *dealt_to("held_blocks", "read_blocks", "i", "j")).select(*columns)
    read = rows.withColumn("reads", F.lit(True))
    read = read.select("*", *dealt_to("read_blocks", "held_blocks", "j", "i")).select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, group = None, None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if group != (row["band"], row["key"], row["i"], row["j"]):
                    group, block = (row["band"], row["key"], row["i"], row["j"]), Block()
                if row["reads"]:
                    found += [(a, row["no"]) for a in block.linked(row, near)]
                else:
                    block.hold(row)
            yield from chunks.rows_to_batches(found, schema)

    place = [*band, "i", "j"]
    dealt = vectors(home, held.unionByName(read), near).repartition(*place).sortWithinPartitions(*place, "reads")
    return dealt.mapInArrow(run, "a long, b long")


class Block:
    """Texts that are held, to be compared with those that are read."""

    def __init__(self) -> None:
        self.rows: list[dict] = []
        self.vectors: list[tuple] = []
        self.arrays: tuple | None = None
        self.joined: dict[int, int] = {}  # labels connected here, each with a smaller one

    def hold(self, row: dict) -> None:
        self.rows.append(row)
        self.vectors.append(_vector(row))

    def root(self, label: int) -> int:
        while label in self.joined:
            label = self.joined[label]
        return label

    def linked(self, row: dict, near: Near) -> list[int]:
        """The held texts that are similar to ``row``, one for each label."""
        if not self.rows:
            return []
        if self.arrays is None:
            self.arrays = (
                np.array([r["no"] for r in self.rows]),
                np.array([r["label"] for r in self.rows]),
                np.array([r["before"] for r in self.rows], np.int64).reshape(len(self.rows), -1),
                np.array([v[2] for v in self.vectors]),
            )
        no, label, before, total = self.arrays
        own, vector = self.root(row["label"]), _vector(row)
        maybe = (label != own) & ~(before == np.array(row["before"], np.int64)).any(axis=1)
        if not row["main"]:  # both are held somewhere, and read somewhere
            maybe &= no < row["no"]
        least, top = np.minimum(total, vector[2]), np.maximum(total, vector[2])
        maybe &= least >= near.similarity * top * (1 - 1e-9)
        found = []
        for i in np.flatnonzero(maybe).tolist():
            if label[i] != own and similarity(self.vectors[i], vector) >= near.similarity - 1e-12:
                found.append(int(no[i]))
                one, own = sorted((int(label[i]), own), reverse=True)
                self.joined[one] = own
                label[label == one] = own
        return found


def components(edges: DataFrame) -> DataFrame:
    """(no, label): the least number that each text is connected with. Texts without edges are left out."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = both.groupBy(F.col("a").alias("no")).agg(F.min("b").alias("label"))
    labels = written(labels.select("no", F.least("no", "label").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("no")).groupBy("a").agg(F.min("label").alias("seen"))
        least = labels.join(near, F.col("no") == F.col("a")).select(
            "no", F.col("label").alias("old"), F.least("label", "seen").alias("label")
        )
        # Every label is a text with a label of its own: take that one, to halve the way to the least.
        ahead = labels.select(F.col("no").alias("_no"), F.col("label").alias("_label"))
        moved = least.join(ahead, F.col("label") == F.col("_no")).select(
            "no", "old", F.least("label", "_label").alias("label")
        )
        moved = written(moved, "labels")
        if moved.filter("label != old").isEmpty():
            return moved.select("no", "label")
        labels = moved.select("no", "label")


def classes(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """The class of near-duplicates of every document.

    Columns: doc_id, class_id (least doc_id of the class), class_size, kept (true for one row of
    each class, that of class_id), digest (MD5 of the text). Two texts are linked if the weighted Jaccard similarity of their shingles
    (counts weighted by rarity over all documents, see ``weights``) is at least ``near.similarity``; linked texts
    are one class. Equal texts are, too; NULL is an empty text; texts without words are like equal texts only. Texts
    are read whole. A NULL doc_id comes after all others. Other columns are ignored; no rows give no rows.

    Equal texts are one text for all but the last step, so copies are never compared. Of two texts in a common
    bucket, all are compared that nothing else connects.
    """
    staged = chunks.stage(docs)
    total = staged.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    rare = written(answer(ask(staged, near, 4 * chunks.partitions(docs)), total), "rarity")
    release(docs.sparkSession)
    home = chunks.with_answers(staged, rare, "rarity")
    signed = written(sign(home, near), "signed")
    texts = written(
        signed.groupBy("digest").agg(F.min_by(F.struct("no", "weight", "bands"), "no").alias("t")).select("digest", "t.*"),
        "texts",
    )
    members = buckets(texts)
    pairs = written(candidates(members, near), "pairs")
    # First each text with the one it shares most buckets with: that settles nearly all.
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b")
    first = written(verify(home, best, near), "links")
    release(docs.sparkSession)
    joined = components(first)
    one = joined.select(F.col("no").alias("a"), F.col("label").alias("_a"))
    two = joined.select(F.col("no").alias("b"), F.col("label").alias("_b"))
    rest = (
        pairs.join(best, ["a", "b"], "left_anti")
        .join(one, "a", "left")
        .join(two, "b", "left")
        .filter(~F.coalesce(F.col("_a") == F.col("_b"), F.lit(False)))
        .select("a", "b")
    )
    second = written(verify(home, written(rest, "rest"), near), "links")
    release(docs.sparkSession)
    links = first.unionByName(second)
    labels = components(links)
    third = written(across(home, texts, members, labels, near), "links")
    if not third.isEmpty():
        labels = components(links.unionByName(third))
    labelled = texts.join(labels, "no", "left").select("digest", F.coalesce("label", "no").alias("label"))
    rows = written(signed.select("doc_id", "no", "digest").join(labelled, "digest"), "classes")
    first_row = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "no"))
    heads = rows.groupBy("label").agg(first_row.alias("head"), F.count("*").alias("class_size"))
    return rows.join(heads, "label").select(
        "doc_id",
        F.col("head.doc_id").alias("class_id"),
        "class_size",
        (F.col("no") == F.col("head.no")).alias("kept"),
        "digest",
    )


def one_of_each(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """The document of each class that stays, with all its columns (``_near_key`` is reserved).

    Rows alike in doc_id and text are one.
    """
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.lower(F.hex("digest")))
    kept = classes(docs, near).filter("kept").select(key.alias("_near_key"))
    own = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return (
        docs.withColumn("_near_key", own)
        .join(kept, "_near_key", "left_semi")
        .dropDuplicates(["_near_key"])
        .drop("_near_key")
    )
