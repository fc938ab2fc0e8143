"""Exact dedup through a stored digest index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm.words import BLANK
from smelter.scratch import written

ROW = "_dedup_row"


def digest(text: Column) -> Column:
    """SHA-256 of the text without blanks ``[\\x20\\x09-\\x0D]``; NULL counts as empty."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")
    return F.unhex(F.sha2(bare.cast("binary"), 256))


class DigestIndex:
    """The digests seen so far, a table bucketed and sorted by digest.

    The files under ``path`` outlive the session; another session that opens the same path goes on
    with them. A new batch is grouped by digest first (map-side, so a text with a third of all rows
    sends one row per task), its groups are sort-merge anti-joined with the index, and what is new
    is appended to the buckets.

    Of equal texts of one batch the row with the most code points stays, then the smallest doc_id
    (NULL last), then the first stored of rows that are alike in both. A text that an earlier batch
    has stays with that batch's row. Empty texts are equal to each other; an empty batch adds
    nothing. Columns beside ``doc_id`` and ``text`` pass through, whatever they are called, except
    the reserved ``_dedup_row``.
    """

    def __init__(self, spark: SparkSession, table: str, path: str, buckets: int = 64):
        self.spark, self.table, self.path = spark, table, path
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} "
            "(digest BINARY, keep_id BIGINT, keep_row BIGINT, group_size BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        self.buckets = buckets

    def _append(self, rows: DataFrame) -> None:
        bucketed = rows.repartition(self.buckets, "digest").sortWithinPartitions("digest")
        (
            bucketed.write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )

    def add(self, docs: DataFrame, batch: str) -> DataFrame:
        """Add a batch and return a row per row of it.

        Columns: doc_id, ``_dedup_row``, digest, keep_id (of the row that stays), group_size (equal
        texts in the batch that brought the text), kept.
        """
        seen = docs.select(
            "doc_id",
            F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id().alias(ROW),
            digest(F.col("text")).alias("digest"),
            F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"),
        )
        stored = written(seen, "digests")
        best = F.max(F.struct("n_chars", (-F.col("doc_id")).alias("neg_id"), (-F.col(ROW)).alias("neg_row")))
        groups = stored.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
        known = self.spark.table(self.table).select("digest")
        fresh = groups.join(known.hint("merge"), "digest", "left_anti").select(
            "digest",
            (-F.col("best.neg_id")).alias("keep_id"),
            (-F.col("best.neg_row")).alias("keep_row"),
            "group_size",
            F.lit(batch).alias("batch"),
        )
        self._append(fresh)
        # Read by path, without its buckets: both sides are then shuffled, and Spark splits a
        # digest with many rows over several tasks.
        index = self.spark.read.schema(self.spark.table(self.table).schema).parquet(self.path)
        return stored.join(index, "digest").select(
            "doc_id",
            ROW,
            "digest",
            "keep_id",
            "group_size",
            ((F.col("batch") == batch) & (F.col("keep_row") == F.col(ROW))).alias("kept"),
        )

    def new_documents(self, docs: DataFrame, batch: str) -> DataFrame:
        """The rows of ``docs`` that stay, with all their columns."""
        stored = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "batch")
        kept = self.add(stored, batch).filter("kept").select(ROW)
        return stored.join(kept, ROW, "left_semi").drop(ROW)
