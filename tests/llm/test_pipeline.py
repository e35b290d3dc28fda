"""The pipeline against brute force, and its contract."""

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from stormledger.llm import bpe, decontam
from stormledger.llm.common import stage

from .test_minhash import brute_force as groups
from .test_suffixes import brute_force as passages


@pytest.fixture(scope="module")
def stages(spark, sf_dir, documents):
    """What every stage left of a part of the documents and some odd rows."""
    odd = spark.createDataFrame(
        [(-1, None), (-2, ""), (-3, "12 %"), (-4, "the and of " * 300), (None, "the and is")], "doc_id long, text string"
    )
    first = stage(documents.limit(150).unionByName(odd, allowMissingColumns=True))
    out = [("input", first)]
    for name, function in corpus_pipeline.STAGES:
        out.append((name, stage(function(spark, out[-1][1], sf_dir))))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    for _, df in stages[:-1]:
        assert df.schema.simpleString() == stages[0][1].schema.simpleString()


def test_language_stage_drops_only_what_has_no_letter(stages):
    before, after = texts(stages[0][1]), texts(stages[1][1])
    assert set(before) - set(after) == {-1, -2, -3}
    assert all(before[k] == t for k, t in after.items())


def test_near_dedup_stage_keeps_one_of_each_group(stages):
    before, after = texts(stages[1][1]), texts(stages[2][1])
    named = sorted((k, t) for k, t in before.items() if k is not None)
    wanted = {k for k, (_, component) in groups(named, 5, 80).items() if component == k}
    assert set(after) == wanted | {None}


def test_passage_stage_removes_what_repeats(stages):
    before, after = texts(stages[2][1]), texts(stages[3][1])
    keys = list(before)
    for k, (_, removed, _, sha) in zip(keys, passages([before[k] for k in keys])):
        if not removed:
            assert after[k] == before[k]
        elif len(after[k].encode()) == len(before[k].encode()) - removed:
            assert hashlib.sha256(after[k].encode()).hexdigest() == sha
    assert all(r.n_chars == len(r.text) for r in stages[3][1].collect())


def test_decontamination_stage(spark, sf_dir, stages):
    before, after = texts(stages[3][1]), texts(stages[4][1])
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = {r.doc_id for r in decontam.find_leaks(stages[3][1], items).collect()}
    assert set(after) == set(before) - leaks


def test_bpe_stage(stages):
    t = Tokenizer.from_file(bpe.vocabulary_path())
    before = texts(stages[4][1])
    got = {r.doc_id: r for r in stages[5][1].collect()}
    assert set(got) == set(before)
    for k, text in before.items():
        ids = t.encode(text, add_special_tokens=False).ids
        assert list(got[k].ids) == ids and got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_empty_input(spark, sf_dir, documents):
    docs = documents.limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, sf_dir))
    assert docs.count() == 0
