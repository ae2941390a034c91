"""The pipeline against its stages, each checked on its own input by a plain version."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from helpers import clashing, doc, frame, odd_documents
from patronlens.llm import mixing, quality, simhash
from patronlens.workspace import materialize
from test_secrets import TEXTS, spans_by_hand


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    """The documents that each stage gets."""
    held = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held.append(materialize(stage(spark, held[-1], sf_dir), name))
    return held


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality_stage_keeps_clean_documents(spark, sf_dir, inputs):
    verdicts = quality.quality_verdicts(inputs[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert set(by_id(inputs[1])) == {r["doc_id"] for r in verdicts.where("kept").collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    clean = {r["doc_id"] for r in labels.join(verdicts, "doc_id").where("not base_failed").collect()}
    assert len(clean - set(by_id(inputs[1]))) <= 0.01 * len(clean)


def test_near_duplicate_stage_keeps_one_of_each(inputs):
    classes = simhash.simhash_classes(inputs[1])
    assert set(by_id(inputs[2])) == {r[0] for r in classes.select("component_id").distinct().collect()}
    assert inputs[2].count() == len(by_id(inputs[2]))


def test_secret_stage_redacts_and_leaves_the_rest(spark, sf_dir, inputs):
    odd = frame(spark, [r for r in odd_documents() if r[0] != 8] + [doc(80, TEXTS[4]), doc(81, TEXTS[7])]).dropDuplicates(["doc_id"])
    for docs, result in ((inputs[2], inputs[3]), (odd, corpus_pipeline.redact_secrets(spark, odd, sf_dir))):
        redacted_rightly(by_id(docs), by_id(result))
    assert by_id(corpus_pipeline.redact_secrets(spark, odd, sf_dir))[81]["text"] == "[assign]'" * 300


def redacted_rightly(before, after):
    assert set(before) == set(after)
    for i, row in before.items():
        spans = spans_by_hand(row["text"])
        if not spans:
            assert after[i] == row
        else:
            assert spans_by_hand(after[i]["text"]) == [] and after[i]["n_chars"] == len(after[i]["text"])


def test_mix_stage_takes_what_the_mix_says(inputs):
    mixed = {r["doc_id"]: r["passes_taken"] for r in mixing.mix(inputs[3]).collect()}
    rows = inputs[4].groupBy("doc_id", "text").count().collect()
    assert {r["doc_id"]: r["count"] for r in rows} == {i: n for i, n in mixed.items() if n}


def test_the_run_encodes_what_the_stages_leave(spark, sf_dir, inputs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r["doc_id"], library.encode(r["text"], add_special_tokens=False).ids) for r in inputs[4].collect())
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in got) == want
    for r in got:
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()


def test_stages_on_odd_and_empty_tables(spark, sf_dir):
    for rows in (odd_documents() * 2, []):
        docs = clashing(frame(spark, rows))
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, docs, sf_dir), name)
            if name != "bpe_encoding":
                assert out.columns == docs.columns, name
                docs = out
    assert out.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
