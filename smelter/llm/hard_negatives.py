"""Hard negatives by lists that anchors of a cluster share.

Anchors are clustered by direction. For each cluster, candidates are sorted once by an upper bound of their inner product with any
member: length times the cosine of the angle to the cluster's centre less the cluster's radius. Every member
walks that list and stops where the bound certifies that nothing after can enter its result. One walk
finds the positives, a second one the negatives whose scores lie in the positives' ranges.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.scratch import written

FOUND = pa.schema(
    [(c, pa.int64()) for c in ("anchor_row", "anchor_id", "place", "positive_id", "positive_score", "vec_id", "score")]
)
EXACT = 2.0**53  # sums of whole numbers below this are exact in double precision
LEAST, MOST = -(2**63) + 1, 2**63 - 1


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 5  # per anchor and positive
    least: tuple[int, int] = (80, 100)  # a negative's score is at least this share of its positive's
    most: tuple[int, int] = (100, 100)  # and at most this one
    units: float = 256.0  # components become floor(units * x)
    clusters: int = 32  # of the anchors of one dimension, at most
    sample: int = 4096  # anchors the centres are fitted to; they shape the lists, not the results
    lane_rows: int = 65_536  # candidates, and
    slab_rows: int = 16_384  # anchors, compared in one task at a time
    seed: int = 7


def usable(vector: Column) -> Column:
    """Not NULL, and all components finite; zero and empty vectors are."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return lengths, vectors / np.maximum(lengths, 1e-300)[:, None]


def fit_centres(sample: np.ndarray, clusters: int, seed: int) -> np.ndarray:
    """Unit centres of directions, by a few rounds of spherical k-means."""
    unit = _unit(sample)[1]
    count = max(1, min(clusters, len(unit) // 8))
    centres = unit[np.random.default_rng(seed).choice(len(unit), count, replace=False)]
    for _ in range(8):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        lengths, moved = _unit(sums)
        centres = np.where(lengths[:, None] > 1e-9, moved, centres)
    return centres


def inner_products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond 64 bits an error."""
    top = np.abs(anchors).max(initial=0) * np.abs(candidates).max(initial=0) * anchors.shape[1]
    if top < EXACT:
        return (anchors @ candidates.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in side] for side in (anchors, candidates)]
    return np.array([[sum(map(int.__mul__, a, c)) for c in whole[1]] for a in whole[0]], dtype=np.int64)


def walk(
    anchors: np.ndarray,
    candidates: np.ndarray,
    allowed: np.ndarray,
    above: np.ndarray,
    below: np.ndarray,
    k: int,
    centre: np.ndarray,
    ids: np.ndarray,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors, ranges, candidates, scores): for each anchor and score range the ``k`` best allowed candidates.

    ``allowed`` is anchors by candidates, ``above`` and ``below`` are anchors by ranges (inclusive; a range with ``above`` over
    ``below`` is empty). Better is a greater score, then a smaller id.
    """
    a_lengths, a_units = _unit(anchors)
    lengths, units = _unit(candidates)
    angles = np.arccos(np.clip(a_units @ centre, -1, 1))
    to_centre = np.arccos(np.clip(units @ centre, -1, 1))
    bounds = lengths * np.cos(np.maximum(to_centre - angles.max() - 1e-6, 0))
    order = np.argsort(-bounds, kind="stable")
    # After each position: the most that an anchor of length one can still meet.
    rest = np.append(bounds[order][1:], -MOST)
    scores = np.zeros((len(anchors), len(order)), np.int64)
    met = np.zeros(scores.shape, bool)
    best = np.full((*above.shape, k), LEAST)
    active, at, step = np.flatnonzero((above <= below).any(axis=1)), 0, 256
    while len(active) and at < len(order):
        to = min(at + step, len(order))
        these = order[at:to]
        part = inner_products(anchors[active], candidates[these])
        scores[active, at:to] = part
        fit = allowed[np.ix_(active, these)]
        met[active, at:to] = fit
        for r in range(above.shape[1]):
            inside = fit & (part >= above[active, r : r + 1]) & (part <= below[active, r : r + 1])
            both = np.concatenate([best[active, r], np.where(inside, part, LEAST)], axis=1)
            best[active, r] = -np.partition(-both, k - 1, axis=1)[:, :k] if both.shape[1] > k else both
        ahead = a_lengths[active] * rest[to - 1]
        ahead += np.abs(ahead) * 1e-9 + 1e-6
        worst = best[active].min(axis=2)
        settled = (worst > ahead[:, None]) | (above[active] > ahead[:, None]) | (above[active] > below[active])
        active, at, step = active[~settled.all(axis=1)], to, min(step * 2, 4096)
    for r in range(above.shape[1]):
        least = np.maximum(best[:, r].min(axis=1), above[:, r])
        row, col = np.nonzero(met & (scores >= least[:, None]) & (scores <= below[:, r : r + 1]))
        found = scores[row, col]
        rank = np.lexsort((ids[order[col]], -found, row))
        row, col, found = row[rank], col[rank], found[rank]
        few = np.arange(len(row)) - np.searchsorted(row, row) < k
        yield row[few], np.full(few.sum(), r), order[col[few]], found[few]


def _matrix(vectors: pa.Array, units: float) -> np.ndarray:
    """Vectors of one dimension in whole numbers."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * units).reshape(len(vectors), len(flat) // max(1, len(vectors)))


def _centres(anchors: DataFrame, mining: Mining) -> dict[int, np.ndarray]:
    """Centres per dimension, fitted to at most ``mining.sample`` anchors, which reach the driver."""
    drawn = anchors.orderBy(F.xxhash64("row")).limit(mining.sample).select("vector").toArrow()["vector"]
    drawn = drawn.combine_chunks()
    dims = drawn.value_lengths().to_numpy(zero_copy_only=False)
    return {
        int(d): fit_centres(
            _matrix(drawn.take(pa.array(np.flatnonzero(dims == d))), mining.units), mining.clusters, mining.seed
        )
        for d in np.unique(dims)
        if d
    }


def _ranges(members: pa.Table, mining: Mining) -> tuple[np.ndarray, ...]:
    """(least score, greatest score, ids, scores) of the positives of each anchor; empty ranges where there are fewer."""
    ids, scores = members["positive_ids"].to_pylist(), members["positive_scores"].to_pylist()
    (low, whole), (high, other) = mining.least, mining.most

    def table(rows: list[list[int]], fill: int) -> np.ndarray:
        width = max(map(len, rows))
        return np.array([row + [fill] * (width - len(row)) for row in rows], dtype=np.int64)

    above = table([[-(-low * p // whole) for p in row] for row in scores], 1)
    below = table([[high * p // other for p in row] for row in scores], 0)
    return above, below, table(ids, 0), table(scores, 0)


def _search(
    slabs: DataFrame, lanes: DataFrame, centres: dict[int, np.ndarray], mining: Mining, positives: bool
) -> DataFrame:
    """What a slab's anchors find in a lane of their dimension: positives, or negatives for each positive."""

    def run(key: tuple, members: pa.Table, candidates: pa.Table) -> pa.Table:
        found = {name: [] for name in FOUND.names}
        if members.num_rows and candidates.num_rows:
            anchors, vectors = (_matrix(t["vector"].combine_chunks(), mining.units) for t in (members, candidates))
            dim = anchors.shape[1]
            own = centres.get(dim, np.zeros((1, dim)))
            rows, anchor_ids, labels = (members[c].to_numpy() for c in ("row", "vec_id", "label"))
            ids, c_labels = candidates["vec_id"].to_numpy(), candidates["label"].to_numpy()
            if not positives:
                above, below, positive_ids, positive_scores = _ranges(members, mining)
            cluster = (_unit(anchors)[1] @ own.T).argmax(axis=1)
            for c in np.unique(cluster):
                inside = np.flatnonzero(cluster == c)
                for at in range(0, len(inside), 128):
                    some = inside[at : at + 128]
                    same = labels[some][:, None] == c_labels[None, :]
                    if positives:
                        allowed, k = same & (anchor_ids[some][:, None] != ids[None, :]), mining.positives
                        low, high = np.full((len(some), 1), LEAST), np.full((len(some), 1), MOST)
                    else:
                        allowed, k, low, high = ~same, mining.negatives, above[some], below[some]
                    for row, place, col, score in walk(anchors[some], vectors, allowed, low, high, k, own[c], ids):
                        row = some[row]
                        found["anchor_row"].append(rows[row])
                        found["anchor_id"].append(anchor_ids[row])
                        found["place"].append(place)
                        found["positive_id"].append(place if positives else positive_ids[row, place])
                        found["positive_score"].append(place if positives else positive_scores[row, place])
                        found["vec_id"].append(ids[col])
                        found["score"].append(score)
        return pa.table({n: np.concatenate([np.zeros(0, np.int64), *v]) for n, v in found.items()}, schema=FOUND)

    pairs = slabs.groupBy("dim", "lane", "slab").cogroup(lanes.groupBy("dim", "lane", "slab"))
    return pairs.applyInArrow(run, ", ".join(f"{n} long" for n in FOUND.names))


def mine(vectors: DataFrame, is_anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """Hard negatives of each positive of each anchor; ``vectors`` has vec_id, label, vector.

    Components become floor(``units`` * x), x in double precision; a score is the inner product with the anchor, a whole number. An anchor's positives are
    the best other rows of its label. Its negatives for a positive are the best rows of other labels whose score is between the shares
    ``least`` and ``most`` of the positive's. Columns: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score. Higher scores come first, then smaller ids.

    Rows with NULL vec_id, label or vector, or with a NULL or non-finite component, take no part; zero vectors do. Vectors
    meet those of their own dimension. Rows with the anchor's own vec_id are not its positives; other repeated rows count as often as they come. A
    positive without negatives has no rows, and empty tables give none. Scores beyond 64 bits are an error. Other
    columns are ignored.

    Candidates are dealt over lanes, anchors over slabs, both of bounded size, and each slab meets each lane once in each walk. Memory is
    bounded by a slab and a lane; what leaves them is at most ``negatives`` rows per positive, and partial results are cut down before
    they are shuffled.
    """
    spark = vectors.sparkSession
    ready = vectors.withColumn("_anchor", F.coalesce(is_anchor, F.lit(False))).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    )
    rows = written(
        ready.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.col("vector").cast("array<double>").alias("vector"),
            F.size("vector").alias("dim"),
            "_anchor",
            F.monotonically_increasing_id().alias("row"),
        ),
        "vectors",
    )
    anchors = written(rows.filter("_anchor").drop("_anchor"), "anchors")
    count, asked = rows.count(), anchors.count()
    tasks = min(spark.sparkContext.defaultParallelism, -(-count // 4096))
    lanes, slabs = max(1, tasks, -(-count // mining.lane_rows)), max(1, -(-asked // mining.slab_rows))
    centres = _centres(anchors, mining)

    def every(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    dealt = rows.select(
        "vec_id", "label", "vector", "dim", F.pmod("row", F.lit(lanes)).cast("int").alias("lane"), every(slabs).alias("slab")
    )
    members = anchors.withColumn("slab", F.pmod(F.xxhash64("row"), F.lit(slabs)).cast("int"))

    def best(found: DataFrame, group: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    near = _search(members.withColumn("lane", every(lanes)), dealt, centres, mining, True)
    lists = written(
        best(near, ["anchor_row"], mining.positives).groupBy("anchor_row").agg(
            F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p")
        ),
        "positives",
    ).select(
        F.col("anchor_row").alias("row"), F.col("p.vec_id").alias("positive_ids"), F.col("p.score").alias("positive_scores")
    )
    ranged = members.join(lists, "row").withColumn("lane", every(lanes))
    hard = best(_search(ranged, dealt, centres, mining, False), ["anchor_row", "place"], mining.negatives)
    return hard.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
