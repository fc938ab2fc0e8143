"""How far the sources of a language differ in their words, by chunk factorization.

Text is cut at white space into chunks, far fewer of which are distinct than occur. Chunks, in small letters and without the
signs at their ends that are in no term, are counted per document and stored in blocks with a dictionary each. A chunk without
such signs inside is a term itself; of the others every one that is distinct over all blocks is cut into terms once,
and its terms are joined back to the dictionaries. Blocks then add up documents and occurrences per term.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.chunks import pack_numbers, partitions, split_words, unpack_numbers
from smelter.scratch import release, scratch_path, written

# What a term is, and the letters that are lower-cased.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TO_CUT = r"[\x00-\x60\x7B-\x7F]"  # in small chunks that are not terms as they are
NO_TERM = "".join(map(chr, [*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

GROUP = ["lang", "source"]
BLOCK = pa.schema(
    [("block", pa.int64())]
    + [(c, pa.list_(pa.string())) for c in ("to_cut", "plain", "langs", "sources")]
    + [(c, pa.binary()) for c in ("groups", "docs", "codes", "counts")]
)
COUNTED = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("n", pa.int64())]
)


@dataclass(frozen=True)
class Audit:
    least_docs: int = 10  # documents of its language that a kept term is in
    scale: int = 1_000_000_000  # of the smoothed shares
    top: int = 10  # terms reported per group
    block_bytes: int = 8_000_000  # text of a block; a longer document is a block of its own
    cell_terms: int = 50_000  # terms compared together


def _distinct(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _add_up(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys with the sum of each weight."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *[np.add.reduceat(w[order], first) if len(first) else w[:0] for w in weights]


def count_chunks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Store the chunks of each document with their counts, in blocks; bucketed by block.

    Codes count through the chunks to cut, the empty one of chunks without a term among them, then through the plain ones.
    """

    def block(number: int, texts: pa.Array, langs: pa.Array, sources: pa.Array) -> pa.RecordBatch:
        per_doc, flat = split_words(texts)
        code, whole = _distinct(flat)
        small, chunks = _distinct(pc.utf8_trim(pc.ascii_lower(whole), NO_TERM))
        code = small[code]
        odd = pc.or_(pc.match_substring_regex(chunks, TO_CUT), pc.equal(chunks, "")).to_numpy(zero_copy_only=False).astype(bool)
        code = np.where(odd, np.cumsum(odd) - 1, odd.sum() + np.cumsum(~odd) - 1)[code]
        doc = np.repeat(np.arange(len(texts)), per_doc)
        pairs, counts = _add_up(doc * max(1, len(chunks)) + code, np.ones(len(code), np.int64))
        lang, lang_names = _distinct(langs)
        source, source_names = _distinct(sources)
        groups, group = np.unique(lang * len(source_names) + source, return_inverse=True)
        packed = group, pairs // max(1, len(chunks)), pairs % max(1, len(chunks)), counts
        cut, plain = (chunks.filter(pa.array(x)) for x in (odd, ~odd))
        lists = cut, plain, lang_names.take(pa.array(groups // len(source_names))), source_names.take(pa.array(groups % len(source_names)))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64())]
            + [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            + [pa.array([pack_numbers(x)], pa.binary()) for x in packed],
            schema=BLOCK,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 22, [], 0

        def whole() -> pa.RecordBatch:
            return block(number, *[pa.concat_arrays([b[c] for b in held]) for c in ("text", "lang", "source")])

        for batch in batches:
            lengths = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = np.cumsum(lengths + 16), 0
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + block_bytes - size, "right")))
                held.append(batch.slice(at, to - at))
                size, at = size + int(ends[to - 1] - before), to
                if size >= block_bytes or at < batch.num_rows:
                    yield whole()
                    held, size, number = [], 0, number + 1
        if held:
            yield whole()

    spark, name = docs.sparkSession, f"chunk_counts_{uuid.uuid4().hex[:16]}"
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", *GROUP)])
    lists = "to_cut array<string>, plain array<string>, langs array<string>, sources array<string>"
    rows = read.mapInArrow(run, f"block long, {lists}, groups binary, docs binary, codes binary, counts binary")
    writer = rows.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, name))
    writer.bucketBy(partitions(docs), "block").saveAsTable(name)
    return spark.table(name)


def terms_of(chunk: Column) -> Column:
    """The terms of a chunk, one space between: only A to Z are lower-cased."""
    return F.translate(F.array_join(F.regexp_extract_all(chunk, F.lit(TERM), F.lit(0)), " "), UPPER, LOWER)


def term_counts(blocks: DataFrame) -> DataFrame:
    """(lang, source, term, docs, n), a row per block: documents with the term, and its occurrences."""
    entries = blocks.select("block", F.posexplode("to_cut").alias("pos", "chunk"))
    cut = entries.groupBy("chunk").agg(F.lit(1).alias("_one")).select("chunk", terms_of(F.col("chunk")).alias("terms"))
    back = entries.join(cut, "chunk").groupBy("block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "terms"))), lambda x: x["terms"]).alias("terms")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                plain = pc.list_flatten(row["plain"])
                per_cut, flat = split_words(pc.list_flatten(row["terms"]))
                per_chunk = np.append(per_cut, np.ones(len(plain), np.int64))
                code, names = _distinct(pa.concat_arrays([flat, plain]))
                group, doc, chunk, counts = (
                    unpack_numbers(row[c][0].as_py()).astype(np.int64) for c in ("groups", "docs", "codes", "counts")
                )
                if not len(names):
                    continue
                width = per_chunk[chunk]
                first = (np.cumsum(per_chunk) - per_chunk)[chunk]
                within = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                term = code[np.repeat(first, width) + within]
                pairs, n = _add_up(np.repeat(doc, width) * len(names) + term, np.repeat(counts, width))
                owner = group[pairs // len(names)]
                keys, docs, n = _add_up(owner * len(names) + pairs % len(names), np.ones(len(pairs), np.int64), n)
                langs, sources = pc.list_flatten(row["langs"]), pc.list_flatten(row["sources"])
                for at in range(0, len(keys), 20_000):
                    part = slice(at, at + 20_000)
                    g = pa.array(keys[part] // len(names))
                    columns = langs.take(g), sources.take(g), names.take(pa.array(keys[part] % len(names)))
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(docs[part]), pa.array(n[part])], schema=COUNTED)

    body = blocks.select("block", "plain", "langs", "sources", "groups", "docs", "codes", "counts")
    answered = body.join(back.hint("shuffle_hash"), "block", "left").drop("block")
    return answered.mapInArrow(run, "lang string, source string, term string, docs long, n long")


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, lang_n) of the terms in enough documents of their language: one shuffle, by language and term."""
    dealt = counts.repartition("lang", "term").groupBy(*GROUP, "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    term = Window.partitionBy("lang", "term")
    sums = dealt.withColumns({"_in": F.sum("docs").over(term), "lang_n": F.sum("n").over(term)})
    return sums.filter(F.col("_in") >= least_docs).select(*GROUP, "term", "n", "lang_n")


def _share(n: Column | str, total: str, terms: str, scale: int) -> Column:
    """1 + floor(scale * (n + 2) / (total + 2 * terms)), in whole numbers of 38 digits."""
    n = F.col(n) if isinstance(n, str) else n
    above = F.lit(scale).cast("decimal(12,0)") * (n + 2).cast("decimal(19,0)")
    below = (F.col(total) + 2 * F.col(terms)).cast("decimal(19,0)")
    return F.when(F.col(terms) > 0, F.call_function("div", above, below) + 1).cast("long")


def _gap(p: str, q: str) -> Column:
    p, q = F.col(p), F.col(q)
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(groups: DataFrame, kept: DataFrame, audit: Audit) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, itself excluded.

    Terms are dealt over cells; a cell has some terms of one language and all its sources, and adds up its own
    matrix of sources.
    """
    cells = max(1, -(-kept.count() // audit.cell_terms))
    dealt = kept.withColumn("cell", F.pmod(F.xxhash64("term"), F.lit(cells)))
    copied = groups.select(*GROUP, "zero", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell"))

    def run(key: tuple, terms: pa.Table, members: pa.Table) -> pa.Table:
        names = members["source"].to_pylist()
        zero = np.nan_to_num(members["zero"].to_numpy().astype(np.float64)).astype(np.int64)
        value = np.zeros((len(names), len(names)), np.int64)
        if terms.num_rows:
            place = {name: i for i, name in enumerate(names)}
            column = np.array([place[s] for s in terms["source"].to_pylist()])
            code, distinct = _distinct(terms["term"].combine_chunks())
            order = np.argsort(code, kind="stable")
            code, column, p = code[order], column[order], terms["p"].to_numpy()[order]
            step = max(1, 2_000_000 // len(names))
            for at in range(0, len(distinct), step):
                a, b = np.searchsorted(code, [at, at + step])
                share = np.repeat(zero[None, :], min(step, len(distinct) - at), axis=0)
                share[code[a:b] - at, column[a:b]] = p[a:b]
                share = np.ascontiguousarray(share.T)
                for g in range(1, len(names)):
                    gap = share[g] - share[:g]
                    value[g, :g] += (gap * gap // (share[g] + share[:g])).sum(axis=1)
            value += value.T
        g, h = np.nonzero(~np.eye(len(names), dtype=bool))
        return pa.table(
            {
                "lang": pa.array([members["lang"][0].as_py()] * len(g), pa.string()),
                "source": pa.array(names, pa.string()).take(pa.array(g)),
                "item": pa.array(names, pa.string()).take(pa.array(h)),
                "value": pa.array(value[g, h]),
            }
        )

    sums = dealt.groupBy("lang", "cell").cogroup(copied.groupBy("lang", "cell")).applyInArrow(
        run, "lang string, source string, item string, value long"
    )
    return sums.groupBy(*GROUP, "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """Divergence of the sources of each language: ``docs`` has text, lang, source, NULL meaning ''.

    Columns lang, source, part, item, value, rank (from 1 in each source and part, value descending, then item). Part
    ``pair``: every other source of the language and the divergence from it, over all kept terms. Part
    ``term``: the ``top`` terms that occur in the source more than in its language and their share of the divergence from
    it. Kept terms are those in at least ``least_docs`` rows of the language. Shares are whole numbers
    of 1/``scale``, smoothed by adding two; a term's divergence is floor((p-q)^2/(p+q)).

    Empty texts count as documents; texts of any length are read whole; repeated rows are documents of their
    own; a language without kept terms has pairs of value 0; an only source has no pair; an empty table gives no rows;
    other columns are ignored. Counts are exact up to 2^62.

    A chunk or term in every document is an entry per block. Blocks bound the memory of a task; so do cells, with all sources
    of a language, whose pairs are the result.
    """
    blocks = count_chunks(docs, audit.block_bytes)
    kept = written(kept_terms(term_counts(blocks), audit.least_docs), "kept-terms")
    release(docs.sparkSession)
    one = F.explode(F.arrays_zip("langs", "sources")).alias("g")
    groups = blocks.select(one).select(F.col("g.langs").alias("lang"), F.col("g.sources").alias("source")).distinct()
    sums = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    per_lang = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total")
    )
    sized = groups.join(sums, GROUP, "left").join(per_lang, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    sized = written(sized.withColumn("zero", _share(F.lit(0).cast("long"), "total", "terms", audit.scale)), "groups")
    shared = kept.join(sized, GROUP).withColumns(
        {
            "p": _share("n", "total", "terms", audit.scale),
            "q": _share("lang_n", "lang_total", "terms", audit.scale),
        }
    )
    pairs = _pair_sums(sized, shared.select(*GROUP, "term", "p"), audit)
    tops = shared.filter((F.col("n") > 0) & (F.col("p") > F.col("q"))).select(
        *GROUP, F.col("term").alias("item"), _gap("p", "q").alias("value")
    )
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")

    def ranked(part: str, rows: DataFrame) -> DataFrame:
        return rows.select(*GROUP, F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked("pair", pairs).unionByName(ranked("term", tops).filter(F.col("rank") <= audit.top))
