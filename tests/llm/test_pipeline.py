"""The pipeline's stages, each on its predecessor's rows written and read again, held against plain code."""

import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quillmine.llm import mixing, pii, toxicity

from .helpers import documents, empty_documents, odd_documents
from .test_learned import plain_spans
from .test_near_copies import survivors

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    out, docs = [documents(spark, sf)], documents(spark, sf)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns_stay(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])


def test_toxic_documents_go_and_others_stay(spark, sf, steps):
    scores = {r.doc_id: r.predicted for r in toxicity.scored(steps[0], spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert sorted(r.doc_id for r in steps[1].collect()) == sorted(d for d, p in scores.items() if not p)


def test_one_of_each_group_of_copies_stays(steps):
    before = steps[1].collect()
    expected = set(survivors([(r.doc_id, r.text) for r in before]))
    assert sorted(map(tuple, steps[2].collect())) == sorted(tuple(r) for r in before if r.doc_id in expected)


def test_personal_data_is_replaced(steps):
    before = {r.doc_id: r for r in steps[2].collect()}
    for r in steps[3].collect():
        text = before[r.doc_id].text
        spans = plain_spans(text)
        assert not plain_spans(r.text) and r.n_chars == len(r.text)
        assert spans or r.text == text or "[" in r.text
        assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
        if spans:
            assert all(text[a:b] not in r.text or text.count(text[a:b]) > 1 for _, a, b in spans)


def test_mixed_texts_are_words_of_their_documents(steps):
    before = {r.doc_id: WORD.findall(r.text) for r in steps[3].collect()}
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixture(steps[3]).collect()}
    seen = {}
    for r in steps[4].collect():
        words = WORD.findall(r.text)
        seen[r.doc_id] = seen.get(r.doc_id, 0) + len(words)
        at = 0
        for w in words:  # in order
            at = before[r.doc_id].index(w, at) + 1
    assert sum(seen.values()) == sum(taken.values()) or abs(sum(seen.values()) - sum(taken.values())) <= 0.01 * sum(taken.values())
    assert all(n <= 2 * len(before[d]) for d, n in seen.items())


def test_pieces_hold_the_mixed_texts(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted((r.doc_id, tuple(tokenizer.encode(r.text, add_special_tokens=False).ids) + (0,)) for r in steps[4].collect())
    pieces = steps[5].toPandas().sort_values(["sequence_id", "offset"])
    stream = np.concatenate([np.frombuffer(x, "<u4") for x in pieces["ids"]]).tolist()
    got, at = [], 0
    starts = pieces[pieces["start"] == 0]
    for doc_id, n in zip(starts["doc_id"], starts["doc_tokens"]):
        got.append((doc_id, tuple(stream[at : at + n])))
        at += n
    assert at == len(stream) and sorted(got) == rows


def test_run_is_the_stages_in_order(spark, sf, steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    assert corpus_pipeline.run(spark, sf).columns == steps[-1].columns


def test_odd_and_empty_tables_pass_through(spark, sf):
    for docs, some in ((odd_documents(spark), True), (empty_documents(spark), False)):
        for name, stage in corpus_pipeline.STAGES:
            columns, docs = docs.columns, stage(spark, docs, sf)
            assert name == "packing" or docs.columns == columns
        assert (docs.count() > 0) == some


def test_personal_data_model_is_reused(spark, sf):
    model = pii.Model(pii.boosting.Forest(0.0), {})
    assert pii.personal_data(documents(spark, sf), model).count() == documents(spark, sf).count()
