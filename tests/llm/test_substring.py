import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import clashing, doc, frame, odd_documents, words
from patronlens.llm import substring
from patronlens.llm.queries import op6_substrings
from patronlens.llm.substring import WINDOW, Batch, remove_repeats


def by_hand(rows):
    first = {}
    split = [(r[0], words(r[1])) for r in rows]
    order = lambda i: -(1 << 63) if i is None else i
    for i, ws in split:
        for at in range(len(ws) - WINDOW + 1):
            key = tuple(ws[at:at + WINDOW])
            first[key] = min(first.get(key, (order(i), at)), (order(i), at))
    out = []
    for i, ws in split:
        gone = set()
        for at in range(len(ws) - WINDOW + 1):
            if first[tuple(ws[at:at + WINDOW])] < (order(i), at):
                gone.update(range(at, at + WINDOW))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=str)


def rows_with_passages(seed=1, n=60):
    draw = random.Random(seed)
    passages = [[f"p{k}w{draw.randrange(50)}" for _ in range(draw.randrange(15, 60))] for k in range(6)]
    rows = []
    for i in range(n):
        ws = []
        for _ in range(draw.randrange(6)):
            ws += draw.choice(passages) if draw.random() < 0.5 else [f"u{draw.randrange(10**6)}" for _ in range(draw.randrange(30))]
        rows.append(doc(i, draw.choice([" ", "\n", "\t "]).join(ws)))
    return rows


PERIODIC = [doc(200, "a " * 45), doc(201, "a b c " * 20), doc(202, "a b c " * 9 + "d"), doc(203, "x " * 20), doc(204, "x " * 19)]


@pytest.mark.parametrize("cells", [1 << 20, 1 << 11])
def test_removal_agrees_with_brute_force(spark, many_partitions, cells):
    rows = rows_with_passages() + PERIODIC
    df = frame(spark, rows).repartition(5)
    got = remove_repeats(df, cells=cells, batch_bytes=600)
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_hand(rows)


def test_odd_rows(spark):
    rows = odd_documents() + rows_with_passages(3, 10)
    df = clashing(frame(spark, rows)).drop("kept")
    got = sorted((tuple(r) for r in remove_repeats(df).collect()), key=str)
    assert got == by_hand(rows)


def test_query_agrees_with_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = [(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in by_hand(rows)]
    assert sorted((tuple(r) for r in op6_substrings(spark, sf_dir).collect()), key=str) == sorted(want, key=str)


def test_equal_windows_have_their_anchors_counted_twice():
    texts = [r[1] for r in rows_with_passages(9) + PERIODIC]
    batch = Batch(texts)
    anchors, counts = np.unique(batch.anchors(), return_counts=True)
    often = set(anchors[counts > 1].tolist())
    flat = [w for t in texts for w in words(t)]
    places = {}
    for at in np.flatnonzero(batch.windows).tolist():
        places.setdefault(tuple(flat[at:at + WINDOW]), []).append(at)
    assert any(len(p) > 1 for p in places.values())
    for same in places.values():
        if len(same) > 1:
            for at in same:
                assert all(batch.least[at + k].item() in often for k in range(batch.inner_runs))


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [])).collect() == []


def test_rows_of_one_id_keep_their_own_removals_when_their_texts_hash_alike(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    other = F.concat_ws(" ", *[F.concat(F.lit(f"q{k}_"), F.col("id").cast("string")) for k in range(30)])
    text = F.when(F.col("id") % 2 == 0, F.concat(F.lit(f"{passage} "), F.col("id").cast("string"))).otherwise(other)
    texts = spark.range(300_000).select("id", text.alias("text")).withColumn("h", F.hash("text"))
    pair = texts.groupBy("h").agg(F.collect_list("text").alias("t"), F.countDistinct(F.col("id") % 2).alias("kinds")).where("kinds = 2").first()
    rows = [doc(1, passage), *(doc(9, t) for t in pair["t"])]
    assert sorted((tuple(r) for r in remove_repeats(frame(spark, rows)).collect()), key=str) == by_hand(rows)


def test_only_windows_that_may_repeat_are_exchanged(spark):
    """Anchors are told apart by their numbers, not by cells that fill up as the corpus grows."""
    draw = random.Random(4)
    rows = [doc(i, " ".join(f"u{draw.randrange(10**9)}" for _ in range(400))) for i in range(100)]
    keyed = frame(spark, [*rows, doc(200, rows[3][1])]).selectExpr("doc_id as id", "doc_id as key", "text")
    batches = substring.batched(keyed.repartition(4), 9000)
    anchors = substring.repeated_anchors(batches, 7)
    told = substring.earlier_windows(batches, anchors, 7).collect()
    # Of 38,481 windows the 381 of the copied text: each is asked by one batch or two, in whole bytes of bits.
    assert substring.CELLS >= 1 << 40 and 381 // 8 <= sum(len(t["told"]) for r in told for t in r["told"]) <= 2 * (381 // 8 + 7)
