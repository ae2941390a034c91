import itertools
import re

import numpy as np

from helpers import clashing, doc, frame, odd_documents, words
from patronlens.llm import filter_audit
from patronlens.llm.queries import op12_filter_audit

LABELS = "doc_id bigint, quality int, toxic int"


def fails(row, least):
    text = row[1] or ""
    ws = words(text)
    return {
        "A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search("[#$%&*|]", text)), "E": row[0] is not None and row[0] > least.get(text, row[0]),
    }


def by_hand(rows, labels):
    least, marks = {}, {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(least.get(r[1] or "", r[0]), r[0])
    for i, good, toxic in labels:
        if i is not None:
            old = marks.get(i, (0, 0))
            marks[i] = (max(old[0], int(good == 1)), max(old[1], int(toxic == 1)))
    parts = {}
    for r in rows:
        parts.setdefault(r[2] or "", []).append((fails(r, least), *(marks.get(r[0], (0, 0)) if r[0] is not None else (0, 0))))
    out = []
    for part, docs in parts.items():
        lines, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[f] += len(gone)
                failing = sum(d[0][f] for d in docs)
                only = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                lines.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), only, sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [(*line, shapley[line[1][line[2] - 1]]) for line in lines]
    return sorted(out)


def found(docs, labels):
    return sorted(tuple(r) for r in filter_audit.audit(filter_audit.failure_cells(docs, labels)).collect())


def test_gray_walk_gives_the_survivors_of_every_subset():
    cells = np.random.default_rng(1).integers(0, 50, (3, 32, 3))
    states = filter_audit.gray_states(cells)
    for subset in range(32):
        kept = [m for m in range(32) if m & subset == 0]
        assert (states[subset] == cells[:, kept].sum(axis=1)).all()


def test_odd_rows_labels_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(150))
    rows = odd_documents() + [
        doc(30, long), doc(31, long), doc(31, long), doc(30, long), doc(32, long.upper(), lang=None), doc(33, "a " * 120, lang=""), doc(34, long + " #", lang="de"),
        (None, long, "en", "s", 1), doc(-5, long, lang="fr"), doc(3, long),
    ]
    labels = [(30, 1, None), (30, 0, 1), (31, 0, 0), (None, 1, 1), (3, 1, 0), (-5, None, 1), (99, 1, 1), (34, 2, 1)]
    assert found(clashing(frame(spark, rows)).repartition(3), spark.createDataFrame(labels, LABELS)) == by_hand(rows, labels)


def test_a_large_group_of_copies(spark):
    rows = [doc(i, "the same text", lang="en" if i % 3 else "de") for i in range(2000)] + [(None, "the same text", "en", None, None)] * 500
    assert found(frame(spark, rows), spark.createDataFrame([(0, 1, 0)], LABELS)) == by_hand(rows, [(0, 1, 0)])


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert found(frame(spark, []), none) == []
    assert found(frame(spark, [doc(1, "one")]), none) == by_hand([doc(1, "one")], [])


def test_query_agrees_with_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert sorted(tuple(r) for r in op12_filter_audit(spark, sf_dir).collect()) == by_hand(rows, labels)
