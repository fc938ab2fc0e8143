"""The training-data pipeline over ``documents``: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smelter.llm import bpe, minhash, mixing, queries, toxicity
from smelter.llm.words import table
from smelter.scratch import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score one half or more go."""
    queries.prepare(spark)
    return toxicity.clean(docs, toxicity.learn(docs, queries.toxic_labels(spark, sf_dir)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space one stays."""
    queries.prepare(spark)
    return queries.new_index(spark).new_documents(docs, "first")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates one document stays."""
    queries.prepare(spark)
    return minhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document comes as often as the mix takes it."""
    queries.prepare(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Columns doc_id, n_tokens, ids, decoded."""
    queries.prepare(spark)
    return bpe.decode(bpe.encode(docs, queries.TOKENIZER), queries.TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("tokens", encode),
]

# Learning, sampling and hashing are beyond SQL: the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
