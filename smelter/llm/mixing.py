"""Mix sources to target weights, measured in words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.prefix import prefix_sums
from smelter.llm.words import word_count
from smelter.scratch import written

ROW = "_mix_row"


@dataclass(frozen=True)
class Mix:
    """Source weights repeat in the order of source names (code points, NULL last)."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5  # words of the mix, as a share of all words
    epochs: int = 2  # times a source may be repeated at most


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """A row per source: source, source_size, target.

    Weighted shares of ``mix.share`` of all words; a target stops at ``mix.epochs`` times its source,
    and the excess goes to the others by weight until none is above. With the sources in
    order of cap / weight that is one prefix sum: the level (words per unit of weight) is the largest
    of (total - caps before) / (weights from here on). Only single rows of totals reach the driver.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = prefix_sums(
        per_source.withColumn("_one", F.lit(1)), [], [F.col("source").isNull(), F.col("source")], {"rank": "_one"}
    )
    cycle = F.array(*[F.lit(w) for w in mix.weights])
    weighed = written(
        ranked.select(
            "source",
            "source_size",
            F.get(cycle, F.pmod("rank", F.lit(len(mix.weights))).cast("int")).cast("long").alias("weight"),
            (F.col("source_size") * mix.epochs).alias("cap"),
        ),
        "sources",
    )
    words, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    if not words:
        return weighed.select("source", "source_size", F.lit(0.0).alias("target"))
    total = words * mix.share
    tightest = [F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source")]
    before = prefix_sums(weighed, [], tightest, {"caps": "cap", "weights": "weight"})
    level = before.agg(F.max((F.lit(total) - F.col("caps")) / (F.lit(weight) - F.col("weights")))).first()[0]
    return weighed.select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level)).alias("target"),
    )


def random_key(doc_id: Column) -> Column:
    """A key that shuffles documents the same way in every run."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """How often each document is taken.

    Columns: doc_id, ``_mix_row``, source, size, source_size, target, copies, taken (size * copies).
    Every document is taken once for each whole epoch in its source's target; what is left
    of the target is filled with documents in the order of their random keys, by distributed prefix
    sums. Documents stay whole: the one across the budget is taken if the budget lies
    in its second half, so a source misses its target by half a document at most.

    NULL text has size 0, NULL source is a source, equal or NULL ids are ordered by size. Rows that are
    alike in id and size may swap their numbers of copies, not change them. No rows give no rows.
    """
    sized = written(
        docs.select(
            "doc_id",
            F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id().alias(ROW),
            "source",
            word_count(F.col("text")).alias("size"),
        ),
        "sizes",
    )
    goal = targets(sized, mix).select(F.col("source").alias("_source"), "source_size", "target")
    placed = prefix_sums(
        sized.withColumn("_key", random_key(F.col("doc_id"))), ["source"], ["_key", "size", ROW], {"before": "size"}
    )
    joined = placed.join(goal, F.col("source").eqNullSafe(F.col("_source")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("_whole") * F.col("source_size")
    last = (2 * F.col("before") + F.col("size") <= 2 * F.col("_rest")).cast("long")
    counted = (
        joined.withColumn("_whole", whole)
        .withColumn("_rest", rest)
        .withColumn("copies", F.least(F.col("_whole") + last, F.lit(mix.epochs)).cast("long"))
    )
    return counted.select(
        "doc_id", ROW, "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: every document as often as planned, with all its columns."""
    stored = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "mix")
    copies = plan(stored, mix).filter("copies > 0").select(ROW, F.col("copies").alias("_copies"))
    return (
        stored.join(copies, ROW)
        .withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .drop(ROW, "_copies", "_epoch")
    )
