"""Nearest neighbours by randomly rotated one-bit codes, reranked exactly.

A vector minus the mean of all vectors, normalised and rotated at random, is kept as the signs of its
components, one bit each, and two correction scalars: its length and the inner product of the code
with what it stands for. From these the inner product with a query is estimated without bias, with a
bound on the error that shrinks with the square root of the dimension. Vectors whose least possible distance is
below the k-th best greatest possible distance are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.scratch import written

CODES = "lane int, dim int, n int, ids binary, vectors binary, bits binary, lengths binary, fits binary"
FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Search:
    k: int = 10
    epsilon: float = 3.0  # width of the error bounds, in standard deviations about
    seed: int = 7  # of the rotation
    block: int = 2048  # vectors coded together
    query_block: int = 512


def usable(vector: Column) -> Column:
    """Vectors that take part: not NULL or empty, all components finite, one not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    square = np.random.default_rng((seed, dim)).standard_normal((dim, dim))
    q, r = np.linalg.qr(square)
    return (q * np.sign(np.diag(r))).astype(np.float32)


def centres(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector of each dimension: one short row per dimension reaches the driver."""
    parts = vectors.select(F.size("vector").alias("dim"), F.posexplode("vector"))
    means = parts.groupBy("dim", "pos").agg(F.avg(F.col("col").cast("double")).alias("mean"))
    lists = means.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("pos", "mean"))).alias("m"))
    # Any centre is right, so a mean beyond double precision is zero.
    return {r["dim"]: np.nan_to_num([x["mean"] for x in r["m"]], posinf=0, neginf=0) for r in lists.collect()}


def _matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of one dimension and at most ``size`` rows each."""
    for batch in batches:
        lengths = batch["vector"].value_lengths().to_numpy(zero_copy_only=False)
        ids = batch["vec_id"].to_numpy(zero_copy_only=False)
        for dim in np.unique(lengths):
            rows = np.flatnonzero(lengths == dim)
            flat = batch["vector"].take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
            vectors = flat.astype(np.float64).reshape(-1, dim)
            for at in range(0, len(rows), size):
                yield ids[rows[at : at + size]], vectors[at : at + size]


def directions(rest: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths in double precision, rotated unit vectors); not finite beyond double precision."""
    with np.errstate(over="ignore", invalid="ignore"):
        lengths = np.linalg.norm(rest, axis=1)
        unit = (rest / np.maximum(lengths, 1e-30)[:, None]).astype(np.float32)
        return lengths, unit @ rotation(rest.shape[1], seed)


def coded(vectors: DataFrame, means: dict[int, np.ndarray], lanes: int, search: Search) -> DataFrame:
    """Blocks of vectors with their codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _matrices(batches, search.block):
            dim = block.shape[1]
            lengths, turned = directions(block - means[dim], search.seed)
            fits = np.abs(turned).sum(axis=1) / np.sqrt(dim)
            row = {
                # Blocks spread over the lanes by what they hold.
                "lane": int(np.uint64(np.bitwise_xor.reduce(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % lanes),
                "dim": dim,
                "n": len(ids),
                "ids": ids.astype("<i8").tobytes(),
                "vectors": block.astype("<f8").tobytes(),
                "bits": np.packbits(turned > 0, axis=1).tobytes(),
                "lengths": lengths.astype("<f8").tobytes(),
                "fits": fits.astype("<f4").tobytes(),
            }
            yield pa.RecordBatch.from_pylist([row], schema=arrow_schema)

    arrow_schema = pa.schema(
        [("lane", pa.int32()), ("dim", pa.int32()), ("n", pa.int32())]
        + [(c, pa.binary()) for c in ("ids", "vectors", "bits", "lengths", "fits")]
    )
    return vectors.mapInArrow(run, CODES)


def query_blocks(queries: DataFrame, search: Search) -> DataFrame:
    arrow_schema = pa.schema([("dim", pa.int32()), ("q_ids", pa.binary()), ("q_vectors", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _matrices(batches, search.query_block):
            row = {"dim": block.shape[1], "q_ids": ids.astype("<i8").tobytes(), "q_vectors": block.astype("<f8").tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema=arrow_schema)

    return queries.mapInArrow(run, "dim int, q_ids binary, q_vectors binary")


def nearest(ids, vectors, bits, lengths, fits, q_ids, queries, centre, search: Search) -> pd.DataFrame:
    """The k nearest of one block for each query of one block."""
    dim = queries.shape[1]
    q_lengths, turned = directions(queries - centre, search.seed)
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    own = q_ids[:, None] == ids[None, :]
    with np.errstate(over="ignore", invalid="ignore"):
        cosine = (turned @ signs.T) / np.sqrt(dim) / np.maximum(fits, 1e-6)
        spread = np.sqrt(np.maximum(1 - fits**2, 0)) / np.maximum(fits, 1e-6)
        error = search.epsilon * spread / np.sqrt(max(dim - 1, 1)) + 1e-5
        base = lengths[None, :] ** 2 + q_lengths[:, None] ** 2
        scale = 2 * lengths[None, :] * q_lengths[:, None]
        most = base - scale * np.maximum(cosine - error, -1)
        most = np.where(own | ~np.isfinite(most), np.inf, most)
        least = base - scale * np.minimum(cosine + error, 1)
        k = min(search.k, len(ids))
        # The bound may be infinite where a block holds fewer than k other vectors.
        bound = np.partition(most, k - 1, axis=1)[:, k - 1 : k]
        # A bound that is not finite says nothing: such vectors are compared exactly.
        row, col = np.nonzero(((least <= bound + 1e-5 * (base + 1)) | ~np.isfinite(least)) & ~own)
    score = np.empty(len(row))
    for at in range(0, len(row), 200_000):
        part = slice(at, at + 200_000)
        with np.errstate(over="ignore"):
            gap = queries[row[part]] - vectors[col[part]]
            score[part] = np.sqrt(sum(gap[:, j] ** 2 for j in range(dim)))  # summed in order
        far = np.flatnonzero(np.isinf(score[part]) & np.isfinite(gap).all(axis=1))
        if len(far):  # the square is beyond double precision, the distance need not be
            top = np.abs(gap[far]).max(axis=1)
            score[at + far] = top * np.sqrt(((gap[far] / top[:, None]) ** 2).sum(axis=1))
    order = np.lexsort((ids[col], score, row))
    row, col, score = row[order], col[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    best = place < search.k
    return pd.DataFrame({"query_id": q_ids[row[best]], "vec_id": ids[col[best]], "score": score[best]})


def search_all(vectors: DataFrame, queries: DataFrame, search: Search = Search()) -> DataFrame:
    """The ``k`` nearest of ``vectors`` for each of ``queries``; both have vec_id and vector.

    Columns: query_id, rank (from 1), vec_id, score (Euclidean distance, double precision, of the
    vectors as given). Ties go to the smaller vec_id. Rows with a query's own vec_id are not its neighbours. Vectors
    that are NULL, empty, all zero or hold a NULL or non-finite component take no part, nor do rows without
    vec_id; vectors are compared with those of their own dimension. Repeated rows count as often as they
    come. A query without other vectors has no rows; empty tables give none.

    Every block of vectors meets every block of queries once: blocks of vectors are dealt over lanes, and blocks
    of queries are copied to each lane. Memory is bounded by a pair of blocks.
    """
    spark = vectors.sparkSession
    fit_for = vectors.filter(usable(F.col("vector")) & F.col("vec_id").isNotNull()).select("vec_id", "vector")
    means = centres(fit_for)
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    codes = written(coded(fit_for, means, lanes, search), "codes")
    asked = queries.filter(usable(F.col("vector")) & F.col("vec_id").isNotNull()).select("vec_id", "vector")
    blocks = query_blocks(asked, search).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    pairs = codes.join(blocks, ["lane", "dim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch[c][i].as_py() for c in batch.schema.names}
                dim, n = r["dim"], r["n"]
                found = nearest(
                    np.frombuffer(r["ids"], "<i8"),
                    np.frombuffer(r["vectors"], "<f8").reshape(n, dim),
                    np.frombuffer(r["bits"], np.uint8).reshape(n, -1),
                    np.frombuffer(r["lengths"], "<f8"),
                    np.frombuffer(r["fits"], "<f4"),
                    np.frombuffer(r["q_ids"], "<i8"),
                    np.frombuffer(r["q_vectors"], "<f8").reshape(-1, dim),
                    means[dim],
                    search,
                )
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    found = pairs.mapInArrow(run, FOUND)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= search.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
