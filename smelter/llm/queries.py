"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm import (
    ann,
    bpe,
    byte_dedup,
    chunks,
    debruijn,
    divergence,
    exact_dedup,
    hard_negatives,
    kneser_ney,
    minhash,
    mixing,
    packing,
    sharding,
    toxicity,
)
from smelter.llm.words import remainder, table
from smelter.scratch import scratch_path, use_scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

SHARDS = 40
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started, and name a scratch folder."""
    paths = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths.get("PYTHONPATH", "").split(":"):
        paths["PYTHONPATH"] = ":".join(filter(None, [paths.get("PYTHONPATH"), root]))
    use_scratch(spark, "/tmp/checkpoints")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return register


@query("op1_suffix_dedup")
def _(spark, sf_dir):
    return byte_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op2_bpe")
def _(spark, sf_dir):
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER), TOKENIZER)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels to learn from: all but a fifth, by id."""
    return table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 5) != 0).select("doc_id", "toxic")


@query("op3_toxicity")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.learn(docs, toxic_labels(spark, sf_dir)))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )


@query(
    "op4_nearest_neighbours",
    r"""
    WITH kept AS (
        SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    compared AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               sqrt(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])))) AS score
        FROM kept q JOIN kept c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM compared)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
)
def _(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return ann.search_all(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


@query(
    "op5_substring_dedup",
    r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS content
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)),
    firsts AS (SELECT content, min(doc_id) AS first_id FROM windows GROUP BY content),
    later AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS gone
        FROM windows JOIN firsts USING (content) WHERE first_id < doc_id),
    removed AS (SELECT doc_id, list(gone) AS gone FROM later GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
           sha256(array_to_string(
               list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' ')) AS kept_sha256
    FROM words LEFT JOIN removed USING (doc_id)
    """,
)
def _(spark, sf_dir):
    return debruijn.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query(
    "op6_mixing",
    r"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               md5(coalesce(doc_id::VARCHAR, '')) AS key
        FROM documents),
    per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (
        SELECT source, source_size, source_size * 2 AS cap,
               [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::BIGINT AS weight
        FROM per_source),
    totals AS (SELECT sum(source_size)::DOUBLE * 1.5 AS total, sum(weight)::BIGINT AS weight FROM weighed),
    levels AS (
        SELECT (t.total - coalesce(sum(w.cap) OVER before, 0)::DOUBLE)
               / (t.weight - coalesce(sum(w.weight) OVER before, 0))::DOUBLE AS level
        FROM weighed w, totals t
        WINDOW before AS (ORDER BY w.cap::DOUBLE / w.weight, w.source IS NULL, w.source
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    goals AS (
        SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT max(level) FROM levels)) AS target
        FROM weighed),
    placed AS (
        SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, size
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM sized),
    counted AS (
        SELECT p.doc_id, p.size, p.before, g.source_size, g.target,
               CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size)::BIGINT ELSE 0 END AS whole
        FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, size, source_size, target,
           (size * least(2, whole + (2 * before + size <= 2 * (target - whole * source_size))::BIGINT))::BIGINT AS taken
    FROM counted
    """,
)
def _(spark, sf_dir):
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op7_exact_dedup",
    r"""
    WITH bare AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
        FROM documents),
    ranked AS (
        SELECT *, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place,
               count(*) OVER (PARTITION BY text_sha256) AS group_size
        FROM bare WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
    """,
)
def _(spark, sf_dir):
    index = new_index(spark)
    return index.add(table(spark, sf_dir, "documents"), "first").select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def new_index(spark: SparkSession) -> exact_dedup.DigestIndex:
    """An empty index in the shared folder."""
    path = scratch_path(spark, "digest-index")
    return exact_dedup.DigestIndex(spark, f"digest_index_{uuid.uuid4().hex[:12]}", path)


@query("op8_near_dedup")
def _(spark, sf_dir):
    return minhash.classes(table(spark, sf_dir, "documents")).drop("digest")


@query("op9_language_model")
def _(spark, sf_dir):
    fold = remainder(F.col("doc_id"), 7)
    staged = chunks.stage(table(spark, sf_dir, "documents"), fold != 2)
    model, counts = kneser_ney.learn(staged)
    return kneser_ney.score(staged, model, counts).withColumn("held_out", fold == 2)


@query("op10_sharding")
def _(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"), [1.0] * SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.col("grown_shard").cast("int").alias("grown_shard"),
    )


@query(
    "op11_hard_negatives",
    r"""
    WITH kept AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
               coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])), 0)::BIGINT AS score
        FROM kept a JOIN kept c ON len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored
        WHERE label = anchor_label AND vec_id <> anchor_id
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM positives JOIN scored USING (anchor_id)
    WHERE label <> anchor_label AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
    """,
)
def _(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


@query("op12_packing")
def _(spark, sf_dir):
    packed = packing.pack(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query(
    "op13_source_divergence",
    r"""
    WITH docs AS (
        SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
        FROM documents),
    per_doc AS (
        SELECT doc, lang, source,
               translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
        FROM docs),
    counts AS (
        SELECT lang, source, term, count(DISTINCT doc) AS docs, count(*) AS n FROM per_doc GROUP BY ALL),
    kept AS (SELECT lang, term, sum(n)::HUGEINT AS lang_n FROM counts GROUP BY ALL HAVING sum(docs) >= 10),
    langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
    grid AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.lang_n
        FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k ON g.lang = k.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM grid GROUP BY ALL),
    shares AS (
        SELECT lang, source, term, n,
               1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS p,
               1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS q
        FROM grid JOIN totals USING (lang, source) JOIN langs USING (lang)),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    others AS (
        SELECT a.lang, a.source, b.source AS item
        FROM (SELECT DISTINCT lang, source FROM docs) a
        JOIN (SELECT DISTINCT lang, source FROM docs) b ON a.lang = b.lang AND a.source <> b.source),
    parts AS (
        SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value
        FROM others LEFT JOIN pairs USING (lang, source, item)
        UNION ALL
        SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q)
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
    QUALIFY part = 'pair' OR rank <= 10
    """,
)
def _(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))
