"""Layers that grow batch by batch: every message is in one of three batches, whatever its time, and the last comes twice."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.plans import build
from smelter.plans.kept_quality import KeptQuality
from smelter.scratch import drop_path, release, scratch_path
from smelter.sources.tables import Layer
from smelter.specs import SOURCE_TABLES, topics
from smelter.streaming import ingest
from verification.derive import messages

BUCKETS = 4


class Growing:
    """Silver folds each batch, gold and quality the first two and then the last; ``report`` is of the last run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        root, tag = scratch_path(spark, "growing"), uuid.uuid4().hex[:8]
        self.bronze, self.silver, self.gold = (
            Layer(spark, f"grown_{name}_{tag}", f"{root}/{name}") for name in ("bronze", "silver", "gold")
        )
        self.quality = KeptQuality(self.silver, BUCKETS)
        log = reduce(DataFrame.unionByName, [messages(spark, sf_dir, table) for table in SOURCE_TABLES])
        # 12 of 25 messages, 12 of 25, and the rest.
        part = F.floor(F.pmod(F.xxhash64("topic", "kafka_partition", "kafka_offset"), F.lit(25)) / 12)
        log, place = log.withColumn("_part", part.cast("int")), scratch_path(spark, "messages")
        log.write.parquet(place)
        log = spark.read.schema(log.schema).parquet(place)
        for number in range(3):
            batch = log.filter(F.col("_part") == number).drop("_part")

            def commit():
                ingest.write_batch(batch, topics(), self.bronze.root, "first", number)
                if number == 2:
                    ingest.compact(spark, self.bronze.root, SOURCE_TABLES)
                    ingest.write_batch(batch, topics(), self.bronze.root, "again", 0)
                    drop_path(spark, place)
                return ["ingest"]

            if number == 0:  # gold is first built from two batches
                commit()
                build.refresh_silver(self.bronze.root, self.silver, buckets=BUCKETS)
            else:
                self.report = build.run(
                    self.bronze, self.silver, self.gold, ingest=commit, incremental=True, buckets=BUCKETS, keep_old=False
                )
                self.quality.refresh()
                self.quality.remove_old()
            release(spark)


_GROWN: dict[tuple[str, str], Growing] = {}


def growing(spark: SparkSession, sf_dir: str) -> Growing:
    """The session's growing layers over ``sf_dir``."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _GROWN:
        _GROWN[key] = Growing(spark, key[1])
    return _GROWN[key]
