"""The layers built from one folder of test tables, each table on first use.

A table is written once per session to the shared scratch folder, as the
pipeline would, so a query is measured on stored inputs and not on rebuilding
the layers below it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from smelter.operators.cdc import read_envelopes
from smelter.plans import gold, silver
from smelter.plans.build import FACTS, dimension, fact
from smelter.scratch import scratch_path
from smelter.sources.tables import Layer
from smelter.specs import SOURCE_TABLES
from verification.derive import messages


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        root, tag = scratch_path(spark, "warehouse"), uuid.uuid4().hex[:8]
        self.bronze_layer, self.silver_layer, self.gold_layer = (
            Layer(spark, f"{name}_{tag}", f"{root}/{name}") for name in ("bronze", "silver", "gold")
        )

    def bronze(self, table: str) -> DataFrame:
        if not self.bronze_layer.exists(table):
            log = messages(self.spark, self.sf_dir, table)
            self.bronze_layer.replace(table, read_envelopes(log, SOURCE_TABLES[table]))
        return self.bronze_layer.read(table)

    def silver(self, table: str) -> DataFrame:
        if not self.silver_layer.exists(table):
            self.silver_layer.replace(table, silver.from_changes(table, self.bronze(table)))
        return self.silver_layer.read(table)

    def gold(self, table: str) -> DataFrame:
        if not self.gold_layer.exists(table):
            if table in FACTS:
                rows = fact(table, self.silver, self.gold)
                gold.store_fact(self.gold_layer, table, rows)
            else:
                self.gold_layer.replace(table, dimension(table, self.silver))
        return self.gold_layer.read(table)


_BUILT: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The session's warehouse over ``sf_dir``."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _BUILT:
        _BUILT[key] = Warehouse(spark, key[1])
    return _BUILT[key]
