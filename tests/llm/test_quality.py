import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import clashing, doc, frame, odd_documents, words
from patronlens.llm import quality
from patronlens.llm.queries import op9_quality
from patronlens.llm.quality import FEATURES, LineField, fit_field, judge, keep_good, quality_verdicts

LABELS = "doc_id bigint, quality int, toxic int"


def base_by_hand(text):
    text = text or ""
    ws = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    runs = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    covered = {k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(i, i + 3)} if len(runs) < 3000 else set()
    failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def test_viterbi_finds_the_best_of_all_sequences():
    draw = np.random.default_rng(1)
    for n in range(1, 8):
        field = LineField(draw.standard_normal((len(FEATURES), 2)), draw.standard_normal((2, 2)))
        x = draw.standard_normal((n, len(FEATURES)))
        e = x @ field.emission

        def score(labels):
            return sum(e[i, y] for i, y in enumerate(labels)) + sum(field.transition[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert tuple(field.viterbi(x)) == best


def test_the_fit_follows_the_gradient_of_the_likelihood():
    good = [(f"Plain words here and there of text number {i}.\nAnother line of it.", 1) for i in range(20)]
    bad = [(f"MENU | {i} | HOME $$$ ###\n*** BUY!! NOW!!", 0) for i in range(20)]
    field = fit_field(good + bad)
    for text, label in good + bad:
        assert set(field.viterbi(quality._lines(text)[0])) == {label}
    again = fit_field(good + bad)
    assert (again.emission == field.emission).all()


def test_without_both_labels_every_line_is_content():
    field = fit_field([("a b c", 1)])
    assert field.viterbi(quality._lines("x\n$$$ |\ny")[0]).tolist() == [1, 1, 1]


TEXTS = [
    "a b c a b c", "a b c d " * 20, "x " * 60, " ".join(f"w{i}" for i in range(49)), " ".join(f"w{i}" for i in range(50)),
    "l1 a\nl1 a\n \n \nl1 a\nl1 a \n", "#*$%&|<> é\U0001f600\x1c x", " ".join(f"w{i % 40}" for i in range(119)), "",
]


def test_base_figures_by_hand():
    field = fit_field([])
    for text in [*TEXTS, None]:
        n, chars, symbols, dup, repeated, failed = base_by_hand(text)
        assert judge(text, field)[:6] == (n, chars, symbols, dup, repeated, failed), text


def test_verdicts_of_odd_rows(spark):
    rows = [r for r in odd_documents() if len(r[1] or "") < 10_000] + [doc(50 + i, t) for i, t in enumerate(TEXTS)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 0, None), (3, None, None)], LABELS)
    got = quality_verdicts(clashing(frame(spark, rows)).drop("kept"), labels)
    mine = sorted((str((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])) for r in got.collect()))
    assert mine == sorted(str((r[0], *base_by_hand(r[1]))) for r in rows)
    assert got.where("base_failed and kept").count() == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert quality_verdicts(frame(spark, []), none).collect() == []
    rows = [doc(1, " ".join(f"w{i}" for i in range(60))), doc(2, "short")]
    assert [r["doc_id"] for r in keep_good(frame(spark, rows), none).collect()] == [1]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    side = F.xxhash64("doc_id") % 2 == 0
    verdicts = quality_verdicts(docs, labels.where(side))
    held = verdicts.join(labels.where(~side), "doc_id").where("not base_failed")
    n, right, clean_lost = held.agg(
        F.count("*"), F.sum((F.col("kept") == (F.col("quality") == 1)).cast("int")), F.sum(((F.col("quality") == 1) & ~F.col("kept")).cast("int"))
    ).first()
    assert n > 100 and right >= 0.97 * n and clean_lost <= 0.01 * n


def test_query_gives_one_row_per_document(spark, sf_dir):
    got = op9_quality(spark, sf_dir)
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        if len(texts[r["doc_id"]]) < 8000:
            assert tuple(r)[1:7] == base_by_hand(texts[r["doc_id"]])


def test_repeat_words_need_three(spark):
    assert judge("a b a b", fit_field([]))[4] == 0
    assert judge("a b a b a", fit_field([]))[4] == 5
    with pytest.raises(AttributeError):
        judge(3, fit_field([]))
