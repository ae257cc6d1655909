"""The pipeline's stages, each against a plain version on its own input."""

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from galley.llm import toxicity
from galley.llm.queries import tokenizer_path
from galley.session import materialize
from tests.llm import plain

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(materialize(stage(spark, found[-1], SF), name))
    return found


def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_columns(outputs):
    assert all(o.columns == outputs[0].columns for o in outputs[1:-1])


def test_toxic_documents_go(spark, outputs):
    before, after = texts(outputs[0]), texts(outputs[1])
    assert after.items() <= before.items() and len(after) > 0.8 * len(before)
    model = toxicity.fit(outputs[0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert len(before) - len(after) == sum(r.predicted for r in toxicity.score(outputs[0], model).collect())


def test_one_of_each_group_stays(outputs):
    before, after = texts(outputs[1]), texts(outputs[2])
    expected = plain.near_duplicates(before.items(), 5, 80)
    assert after == {i: t for i, t in before.items() if expected[i][1] == i}


def test_repeated_passages_go(outputs):
    assert texts(outputs[3]) == plain.without_repeated_words(texts(outputs[2]).items(), 50)
    assert all(r.n_chars == len(r.text) for r in outputs[3].collect())


def test_benchmark_passages_go(spark, outputs):
    before, after = texts(outputs[3]), texts(outputs[4])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = plain.benchmark_hits(before.items(), items)
    for i, (places, hit, _) in expected.items():
        assert after[i] == plain.cut(before[i], [(a, b) for a, b, _ in places], [p in hit for p in range(len(places))])


def test_ids(outputs):
    tool, before = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), texts(outputs[4])
    found = outputs[5].collect()
    assert len(found) == len(before)
    for r in found:
        ids = np.array(tool.encode(before[r.doc_id], add_special_tokens=False).ids, "<u4")
        assert bytes(r.ids) == ids.tobytes() and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tool.decode(ids.tolist(), skip_special_tokens=False).encode()).hexdigest()


def test_run(spark, outputs):
    found = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, outputs[-1].collect()))


@pytest.mark.parametrize("name", STAGES)
def test_stage_edges(spark, edges, no_documents, name):
    assert STAGES[name](spark, no_documents, SF).collect() == []
    found = STAGES[name](spark, edges, SF)
    assert found.count() > 0
    if name != "bpe":
        assert found.columns == edges.columns
