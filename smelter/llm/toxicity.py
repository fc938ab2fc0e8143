"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels say which documents are toxic, not where. The fewest word forms that explain the toxic documents
of a sample, and hardly occur in its clean ones, label its tokens; a two-state field is fitted to these. In every
document the forward-backward recursion then gives each token's probability to be toxic; the strongest and the sum of them
make the document's score, and tokens more likely toxic than not are its offending spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.batches import slices
from smelter.llm.chunks import split_words
from smelter.llm.words import WORD
from smelter.scratch import written

PREFIXES = (4, 5, 6)  # letters of a word's beginning that are features; the whole word is one too
EDGE = "\"'`.,;:!?()[]{}<>*#$%&-_~|/\\+=…“”‘’«»¿¡"  # not part of a word at its ends
SLICE_CHARS = 6_000_000
NEEDED = 3  # features that explain a toxic document
CHANCE = 7.0  # -log of the odds that a feature is toxic by chance so often
PIECE = 256  # words of a chain that one pass of the recursion takes; messages go on from piece to piece


@dataclass(frozen=True)
class Fit:
    """What bounds the fit; scoring is bounded by nothing."""

    documents: int = 2000  # labelled documents of each label that are sampled at most
    longest: int = 20_000  # characters of a sampled text at most
    sentences: int = 20_000  # chains the field is fitted to at most
    buckets: int = 1 << 20  # feature weights
    chain: int = 128  # words of a chain the field is fitted to at most: a sentence, or a part of one
    rounds: int = 80


@dataclass
class Field:
    """A fitted field; state 0 is clean, 1 toxic."""

    weights: np.ndarray  # of hashed features, for state 1
    bias: float
    step: np.ndarray  # 2 x 2, from state to state
    document: np.ndarray  # bias, weights of the strongest marginal's log odds and of the log of the sum


@dataclass
class Tokens:
    counts: np.ndarray  # of each text
    index: np.ndarray  # of each token, its distinct word
    features: np.ndarray  # of each distinct word: hashes, a row for each kind of feature
    begins: np.ndarray  # of each token, whether a chain begins: a sentence, whatever its length


def cut(begins: np.ndarray, longest: int) -> np.ndarray:
    """Chains of at most ``longest`` tokens."""
    first = np.flatnonzero(begins)
    place = np.arange(len(begins)) - np.repeat(first, np.diff(np.append(first, len(begins))))
    return begins | (place % longest == 0)


def tokens(texts: pa.Array) -> Tokens:
    counts, flat = split_words(pc.fill_null(texts, ""))
    coded = flat.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary
    bare = pc.utf8_lower(pc.utf8_trim(words, characters=EDGE))
    kinds = [bare, *(pc.utf8_slice_codeunits(bare, 0, n) for n in PREFIXES)]
    features = np.zeros((len(kinds), len(words)), np.uint64)
    for i, kind in enumerate(kinds):
        distinct = kind.dictionary_encode()
        hashes = pd.util.hash_array(distinct.dictionary.to_numpy(zero_copy_only=False), categorize=False)
        if len(hashes):
            # The kind is part of the feature: a whole word is not a beginning.
            features[i] = hashes[distinct.indices.to_numpy(zero_copy_only=False)] * np.uint64(8) + np.uint64(i)
    closing = pc.match_substring_regex(words, r"[.!?]$").to_numpy(zero_copy_only=False).astype(bool)
    begins = np.zeros(len(index), bool)
    begins[(np.cumsum(counts) - counts)[counts > 0]] = True
    if len(index):
        begins[1:] |= closing[index[:-1]]
    return Tokens(counts, index, features, begins)


def carried(
    odds: np.ndarray, move: np.ndarray, first: np.ndarray, length: np.ndarray, head: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What enters each piece from before and from behind, as ratios of state 1 to state 0.

    A piece acts on what enters it as a 2 x 2 matrix, the product of its tokens' ones. These are built for all pieces at once, one
    token at a time, and applied along the chains, one piece at a time. ``head``: whether a piece begins a chain.
    """
    ahead, behind = np.ones(len(first)), np.ones(len(first))
    tail = np.append(head[1:], True)
    cuts = np.flatnonzero(~(head & tail))
    if not len(cuts):
        return ahead, behind
    order = cuts[np.argsort(-length[cuts], kind="stable")]
    open_ = np.searchsorted(-length[order], -np.arange(int(length[order[0]])), "left")
    product = np.zeros((2, 2, len(order)))  # to, from
    product[0, 0] = product[1, 1] = 1
    for t, n in enumerate(open_):
        part = product[:, :, :n]
        clean = move[0, 0] * part[0] + move[1, 0] * part[1]
        toxic = move[0, 1] * part[0] + move[1, 1] * part[1]
        if t == 0:  # nothing comes before a chain's first token
            clean, toxic = (np.where(head[order[:n]], old, new) for old, new in zip(part, (clean, toxic)))
        new = np.stack([clean, toxic * odds[first[order[:n]] + t]])
        product[:, :, :n] = new / new.max(axis=(0, 1))
    whole = np.zeros((2, 2, len(first)))
    whole[:, :, order] = product
    rank = np.arange(len(first)) - np.maximum.accumulate(np.where(head, np.arange(len(first)), 0))
    by_rank = np.argsort(rank, kind="stable")
    steps = np.split(by_rank, np.cumsum(np.bincount(rank))[:-1])
    for at in steps[1:]:
        m, r = whole[:, :, at - 1], ahead[at - 1]
        ahead[at] = np.minimum((m[1, 0] + m[1, 1] * r) / (m[0, 0] + m[0, 1] * r), 1e12)
    for at in reversed(steps[1:]):
        m, r = whole[:, :, at], behind[at]
        behind[at - 1] = (m[0, 1] + m[1, 1] * r) / (m[0, 0] + m[1, 0] * r)
    return ahead, behind


def marginals(
    odds: np.ndarray, begins: np.ndarray, step: np.ndarray, piece: int = PIECE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward, backward, probability of state 1) of every token; ``odds`` are exp of its score.

    All chains move one token at a time, as ratios of state 1 to state 0, which need no scaling. Chains of more than ``piece``
    tokens move in pieces, which get the messages that enter them first: the result is that of the whole chain.
    """
    move = np.exp(step)
    starts = cut(begins, piece)
    first = np.flatnonzero(starts)
    length, head = np.diff(np.append(first, len(odds))), begins[first]
    before, behind = carried(odds, move, first, length, head)
    ahead, back = np.empty(len(odds)), np.ones(len(odds))
    back[first + length - 1] = behind
    order = np.argsort(-length, kind="stable")
    first, length, head, ratio = first[order], length[order], head[order], before[order]
    longest = int(length[0]) if len(length) else 0
    open_ = np.searchsorted(-length, -np.arange(longest), "left")  # pieces longer than t
    for t in range(longest):
        at = first[: open_[t]] + t
        r = ratio[: open_[t]]
        moved = (move[0, 1] + r * move[1, 1]) / (move[0, 0] + r * move[1, 0])
        r = np.minimum((moved if t else np.where(head, r, moved)) * odds[at], 1e12)
        ratio[: open_[t]] = r
        ahead[at] = r
    for t in range(longest - 2, -1, -1):
        at = first[: open_[t + 1]] + t
        q = odds[at + 1] * back[at + 1]
        back[at] = (move[1, 0] + move[1, 1] * q) / (move[0, 0] + move[0, 1] * q)
    whole = ahead * back
    return ahead, back, whole / (1 + whole)


def word_scores(field: Field, features: np.ndarray) -> np.ndarray:
    size = np.uint64(len(field.weights))
    return field.bias + sum(field.weights[(row % size).astype(np.int64)].astype(np.float64) for row in features)


def token_probabilities(field: Field, t: Tokens) -> np.ndarray:
    odds = np.exp(np.clip(word_scores(field, t.features), -30, 30))
    return marginals(odds[t.index], t.begins, field.step)[2]


def evidence(probability: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each text: 1, log odds of its strongest token, log of the sum of its tokens' probabilities."""
    out = np.stack([np.ones(len(counts)), np.full(len(counts), -12.0), np.full(len(counts), -12.0)], axis=1)
    some = counts > 0
    begin = (np.cumsum(counts) - counts)[some]
    if len(begin):
        p = np.clip(probability, 1e-6, 1 - 1e-6)
        most = np.maximum.reduceat(p, begin)
        out[some, 1] = np.clip(np.log(most / (1 - most)), -12, 12)
        # The share of chance grows with the text's length; only what stands out counts.
        out[some, 2] = np.log(np.add.reduceat(np.where(p > 0.2, p, 0), begin) + 6e-6)
    return out


def explaining(toxic: np.ndarray, doc: np.ndarray, index: np.ndarray, kinds: list[np.ndarray]) -> np.ndarray:
    """Features that explain the toxic documents, each ``NEEDED`` times if it can be.

    Greedily the one that explains most of those that need it, less three for each clean document with it.
    Only features that are too often toxic for chance are tried. ``doc`` and ``index``: document and distinct word of each
    token; ``kinds``: the features of the distinct words, a row for each kind, the most specific first.
    """
    names, clean, ranks, which, of = [], [], [], [], []
    for rank, row in enumerate(kinds):
        own, feature = np.unique(row, return_inverse=True)
        pairs = np.unique(doc * len(own) + feature[index])
        document, feature = pairs // len(own), pairs % len(own)
        counts = [np.bincount(feature, weights=w[document], minlength=len(own)) for w in (toxic, ~toxic)]
        useful = (counts[0] * -np.log(toxic.mean()) >= CHANCE) & (counts[0] > 10 * counts[1])
        keep = useful[feature] & toxic[document]
        number = np.cumsum(useful) - 1 + sum(map(len, names))
        names.append(own[useful])
        clean.append(counts[1][useful])
        ranks.append(np.full(int(useful.sum()), rank))
        which.append(number[feature[keep]])
        of.append(document[keep])
    names, clean, ranks, which, of = map(np.concatenate, (names, clean, ranks, which, of))
    need = np.full(len(toxic), NEEDED)
    least, chosen = max(2.0, 0.005 * toxic.sum()), []
    while len(which):
        gain = np.bincount(which, weights=need[of] > 0, minlength=len(names)) - 3.0 * clean
        best = int(np.lexsort((ranks, -gain))[0])
        if gain[best] < least:
            break
        chosen.append(names[best])
        need[of[which == best]] -= 1
        left = which != best
        which, of = which[left], of[left]
    return np.array(chosen, np.uint64)


def fit_field(t: Tokens, toxic: np.ndarray, fit: Fit) -> Field:
    doc = np.repeat(np.arange(len(t.counts)), t.counts)
    order = [0, *range(len(PREFIXES), 0, -1)]
    found = explaining(toxic, doc, t.index, [t.features[i] for i in order])
    label = np.isin(t.features, found).any(axis=0)[t.index] & toxic[doc]

    # Chains with a labelled token first, then others, up to the bound.
    cuts = cut(t.begins, fit.chain)
    chain = np.cumsum(cuts) - 1
    number = int(chain[-1]) + 1 if len(chain) else 0
    marked = np.bincount(chain, weights=label, minlength=number) > 0
    shuffled = np.random.default_rng(0).permutation(number)
    chosen = np.zeros(number, bool)
    chosen[shuffled[np.argsort(~marked[shuffled], kind="stable")][: fit.sentences]] = True
    use = chosen[chain] if number else np.zeros(0, bool)
    begins, label = cuts[use], label[use].astype(np.float64)
    slots = [(row[t.index[use]] % np.uint64(fit.buckets)).astype(np.int64) for row in t.features]

    field = Field(np.zeros(fit.buckets), -2.0, np.zeros((2, 2)), np.array([0.0, 1.0, 0.0]))
    inner = np.flatnonzero(~begins)  # tokens with one before them
    state = label.astype(np.int64)
    seen = np.bincount(state[inner - 1] * 2 + state[inner], minlength=4).reshape(2, 2)
    moment, square = [np.zeros(fit.buckets), 0.0, np.zeros((2, 2))], [np.zeros(fit.buckets), 0.0, np.zeros((2, 2))]
    scale = 1 / max(label.sum(), 1)
    for i in range(1, fit.rounds + 1) if len(begins) else ():
        odds = np.exp(np.clip(field.bias + sum(field.weights[s] for s in slots), -30, 30))
        ahead, back, p = marginals(odds, begins, field.step)
        lack = label - p
        to = odds[inner] * back[inner]
        joint = np.exp(field.step)[:, :, None] * np.stack(
            [np.stack([np.ones(len(inner)), to]), np.stack([ahead[inner - 1], ahead[inner - 1] * to])]
        )
        joint /= joint.sum(axis=(0, 1))
        slope = [
            sum(np.bincount(s, weights=lack, minlength=fit.buckets) for s in slots) * scale - 1e-4 * field.weights,
            lack.sum() * scale - 1e-4 * field.bias,
            (seen - joint.sum(axis=2)) * scale - 1e-3 * field.step,
        ]
        new = []
        for j, (value, g) in enumerate(zip((field.weights, field.bias, field.step), slope)):
            moment[j] = 0.9 * moment[j] + 0.1 * g
            square[j] = 0.99 * square[j] + 0.01 * g * g
            new.append(value + 0.3 * (moment[j] / (1 - 0.9**i)) / (np.sqrt(square[j] / (1 - 0.99**i)) + 1e-6))
        field.weights, field.bias, field.step = new[0], float(new[1]), new[2]
    field.weights = field.weights.astype(np.float32)
    return field


def fit_document(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression of the label on the evidence, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.diag([1e-4, 1e-2, 1e-2]) * len(x) / 100 + 1e-9 * np.eye(3)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (toxic - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fitted(texts: pa.Array, toxic: np.ndarray, fit: Fit) -> Field:
    """The field of a sample's texts and whether each is toxic."""
    if not toxic.any() or toxic.all():
        level = np.clip(toxic.mean() if len(toxic) else 0.0, 1e-6, 1 - 1e-6)
        return Field(np.zeros(8, np.float32), -30.0, np.zeros((2, 2)), np.array([np.log(level / (1 - level)), 0.0, 0.0]))
    t = tokens(texts)
    field = fit_field(t, toxic, fit)
    field.document = fit_document(evidence(token_probabilities(field, t), t.counts), toxic)
    return field


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Field:
    """Fit to a bounded sample of the labelled documents: ``fit.documents`` of each label, by hashes of ids.

    ``labels`` has doc_id and toxic; rows with a NULL in either take no part, a document with several
    labels is toxic if one says so. Sampled texts have ``fit.longest`` characters at most, so the sample is
    bounded. One task fits the field to it; only the field, of bounded size, reaches the driver. Without documents of both labels
    no token is toxic, and scores are the share of toxic documents.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    draw = F.xxhash64(F.col("doc_id"), F.lit(3))
    picked = [
        known.filter(F.col("toxic") == label).orderBy(draw, "doc_id").limit(2 * fit.documents) for label in (0, 1)
    ]
    # At most 4 * fit.documents rows of two numbers: small enough to broadcast at any scale.
    sample = docs.select("doc_id", "text").join(F.broadcast(written(picked[0].unionByName(picked[1]), "sampled")), "doc_id")
    usable = written(sample.filter(F.length("text") <= fit.longest).dropDuplicates(["text"]), "sample")
    parts = [usable.filter(F.col("toxic") == label).orderBy(draw, "text").limit(fit.documents) for label in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).select("text", F.col("toxic").cast("long").alias("toxic"), draw.alias("draw"))
    schema = pa.schema(
        [("weights", pa.binary()), ("bias", pa.float64()), ("step", pa.list_(pa.float64())), ("document", pa.list_(pa.float64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        field = fitted(rows["text"].combine_chunks(), rows["toxic"].to_numpy() == 1, fit)
        values = [field.weights.tobytes()], [field.bias], [field.step.ravel().tolist()], [field.document.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

    # The order of rows is fixed, as the chains that are drawn follow it.
    ordered = chosen.repartition(1).sortWithinPartitions("toxic", "draw", "text")
    if chosen.isEmpty():
        return fitted(pa.array([], pa.string()), np.zeros(0, bool), fit)
    row = ordered.mapInArrow(run, "weights binary, bias double, step array<double>, document array<double>").first()
    weights = np.frombuffer(bytes(row.weights), np.float32)
    return Field(weights, row.bias, np.array(row.step).reshape(2, 2), np.array(row.document))


RESULT = "doc_id long, score double, spans array<struct<start:int,end:int>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scored(batch: pa.RecordBatch, field: Field) -> Iterator[tuple[pa.RecordBatch, Tokens, np.ndarray, np.ndarray]]:
    """(part, tokens, their probabilities, score of each text) of bounded parts of a batch."""
    for part in slices(batch, "text", SLICE_CHARS):
        t = tokens(part["text"])
        p = token_probabilities(field, t)
        x = evidence(p, t.counts) @ field.document
        yield part, t, p, 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _spans(texts: pa.Array, t: Tokens, p: np.ndarray) -> list[list[dict]]:
    ends, hits = np.cumsum(t.counts), np.flatnonzero(p >= 0.5)
    spans: list[list[dict]] = [[] for _ in range(len(t.counts))]
    for i, these in pd.Series(hits).groupby(np.searchsorted(ends, hits, "right")):
        wanted = set((these - (ends[i] - t.counts[i])).tolist())
        found = enumerate(re.finditer(WORD, texts[i].as_py()))
        spans[i] = [{"start": m.start(), "end": m.end()} for j, m in found if j in wanted]
    return spans


def score(docs: DataFrame, field: Field) -> DataFrame:
    """Score the whole text of every document.

    Columns: doc_id, score (0 to 1), spans (offending words, [start, end) in code points). NULL and empty texts
    have no tokens and get the score of no evidence. Nothing but the text counts, so equal texts score
    alike; other columns are ignored; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # of bounded size
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("spans", SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t, p, scores in _scored(batch, shared.value):
                spans = pa.array(_spans(part["text"], t, p), SPANS)
                yield pa.RecordBatch.from_arrays([part["doc_id"].cast(pa.int64()), pa.array(scores), spans], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def clean(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of ``docs`` that score below one half, with all their columns.

    NULL and empty texts have the score of no evidence; repeated rows stay repeated; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _, scores in _scored(batch, shared.value):
                yield part.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(run, docs.schema)
