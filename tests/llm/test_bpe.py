import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import clashing, doc, frame, odd_documents
from patronlens.llm import bpe
from patronlens.llm.queries import op2_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    return bpe.word_model(PATH)


def drawn(letters, n, size, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(size))) for _ in range(n)]


TEXTS = [
    "", " ", "Hello, WORLD's it's we'll 12½ <|endoftext|>x<|startoftext|><|endoftext|>", "İstanbul ΣΑΣ ς ́é \x85a\x1cb naïve",
    "a" * 5000, "</w> <|EndOfText|> <|endoftext", "日本語 \U0001f600\U0001f600 ﬁ ſ ŉ ǅ", "!!!!!!????.....$$$%%%", "''s'S'LL don'T", "\x01\x00Āā",
    "é éé", "²³¹¼ ªºµ €",
    *drawn("abcdefghijklmnopqrstuvwxyzé' .,0!-_</w>AB\n", 300, 300, 1), *drawn("aabn ", 200, 200, 2), *drawn("äßαж漢ا́ x", 100, 60, 3),
]


def test_ids_and_decoding_agree_with_the_library(model, library):
    mine = bpe.encode_texts(model, TEXTS)
    for text, ids, theirs in zip(TEXTS, mine, library.encode_batch(TEXTS, add_special_tokens=False)):
        assert ids.tolist() == theirs.ids, text
        assert model.decode(ids) == library.decode(theirs.ids, skip_special_tokens=False)


def test_results_do_not_depend_on_what_is_remembered(model, monkeypatch):
    before = [i.tolist() for i in bpe.encode_texts(model, TEXTS)]
    monkeypatch.setattr(bpe, "REMEMBERED", 0)
    assert [i.tolist() for t in TEXTS for i in bpe.encode_texts(model, [t])] == before


def test_a_border_stands_exactly_if_merging_the_pair_leaves_it(model):
    draw = np.random.default_rng(4)
    spelled = {i: s for s, i in ((s, i) for i, s in enumerate(_spellings(model)) if s)}
    tokens = np.array([i for i, s in spelled.items() if not s.endswith(bpe._END)])
    a, b = draw.choice(tokens, 3000), draw.choice(np.array([*spelled]), 3000)
    stands = model.border_stands(a, b)
    assert stands.any() and not stands.all()
    for x, y, stood in zip(a.tolist(), b.tolist(), stands.tolist()):
        assert (model.merge(_letters(model, spelled[x]) + _letters(model, spelled[y])) == [x, y]) == stood


def _spellings(model):
    spelled = [""] * len(model.names)
    for s, i in model.base.items():
        spelled[i] = s
    for i in np.argsort(model.rank, kind="stable").tolist():
        if model.rank[i] >= 0:
            spelled[i] = spelled[model.left[i]] + spelled[model.right[i]]
    return spelled


def _letters(model, spelling):
    ended = spelling.endswith(bpe._END)
    marks = [*spelling[:-2], spelling[-2:]] if ended else [*spelling]
    return [model.base[m] for m in marks]


def test_columns_on_odd_rows(spark, library):
    rows = odd_documents() + [doc(50, "Some <|endoftext|> words")]
    df = clashing(frame(spark, rows)).select("doc_id", "text", bpe.encoded_column(F.col("text"), PATH).alias("e"))
    for r in df.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        data = np.array(ids, "<u4").tobytes()
        said = library.decode(ids, skip_special_tokens=False).encode()
        assert tuple(r["e"]) == (len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(said).hexdigest())


def test_ids_round_trip_in_columns(spark, library):
    df = frame(spark, odd_documents()).select("text", bpe.ids_column(F.col("text"), PATH).alias("ids"))
    df = df.withColumn("back", bpe.decoded_column(F.col("ids"), PATH))
    for r in df.collect():
        assert r["back"] == library.decode(r["ids"], skip_special_tokens=False)


def test_query_agrees_with_the_library(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op2_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def test_empty_table(spark):
    assert frame(spark, []).select(bpe.encoded_column(F.col("text"), PATH)).collect() == []
