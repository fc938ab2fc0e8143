import pytest

import corpus_pipeline
from smelter.llm import queries
from smelter.llm.words import table
from tests.llm.test_debruijn import split
from verification.compare import difference


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(spark, sf_dir, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_every_operator_is_registered():
    numbers = sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_stages(spark, sf_dir):
    """Each stage against a plain version of it on what the stage before kept."""
    import numpy as np

    from smelter.llm import mixing, toxicity
    from tests.llm.test_minhash import expected as near_classes
    from tests.llm.test_mixing import expected as mix_plan
    from tokenizers import Tokenizer

    docs = table(spark, sf_dir, "documents")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], sf_dir).cache())
    assert all(df.columns == columns for df in kept[:-1])
    given, clean, single, apart, mix, coded = ([r.asDict() for r in df.collect()] for df in kept)

    scores = toxicity.score(docs, toxicity.learn(docs, queries.toxic_labels(spark, sf_dir))).collect()
    assert {r["doc_id"] for r in clean} == {r.doc_id for r in scores if r.score < 0.5}

    best = {}
    for r in clean:
        text = r["text"] or ""
        k = "".join(split(text))
        best[k] = min(best.get(k, (1, 0)), (-len(text), r["doc_id"]))
    assert {r["doc_id"] for r in single} == {i for _, i in best.values()}

    rows = [(r["doc_id"], r["text"]) for r in single]
    assert {r["doc_id"] for r in apart} == {c for _, c, _ in near_classes(rows)}

    plan = mix_plan([(r["doc_id"], r["text"], r["source"]) for r in apart], mixing.Mix())
    size = {r["doc_id"]: len(split(r["text"])) for r in apart}
    for i, _, _, _, taken in plan:
        assert sum(r["doc_id"] == i for r in mix) * size[i] == taken

    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    texts = {r["doc_id"]: r["text"] for r in mix}
    assert len(coded) == len(mix)
    for r in coded:
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)


def test_pipeline_without_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
