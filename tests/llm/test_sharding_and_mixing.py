import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import clashing, doc, frame, odd_documents, rows_of, words
from patronlens.llm import mixing, sharding
from patronlens.llm.queries import op7_shards, op8_mix
from patronlens.llm.sharding import CapacityTree, assign_shards, best_fit_decreasing
from patronlens.workspace import new_path


def test_the_tree_finds_the_tightest_bin():
    draw, tree, held = random.Random(1), CapacityTree(), []
    for turn in range(2000):
        if held and draw.random() < 0.4:
            tree.remove(*held.pop(draw.randrange(len(held))))
        else:
            held.append((draw.randrange(50), turn))
            tree.add(*held[-1])
        size = draw.randrange(60)
        assert tree.tightest(size) == min((h for h in held if h[0] >= size), default=None)
        assert tree.widest() == max(held, default=None)


def test_best_fit_decreasing_opens_few_bins():
    sizes = [7, 6, 5, 5, 4, 3]
    bins = best_fit_decreasing(sizes, [], new_bin=10)
    loads = defaultdict(int)
    for b, s in zip(bins, sizes):
        loads[b] += s
    assert sorted(loads.values()) == [10, 10, 10]
    assert best_fit_decreasing([], [5]) == []
    assert best_fit_decreasing([9, 2], [5, 5]) == [1, 0]


def check_shards(rows, got, shards, group_whole=True):
    assert len(got) == len(rows)
    by_text, slots, bytes_of = defaultdict(set), defaultdict(list), defaultdict(int)
    size = {}
    for i, text, *_ in rows:
        data = (text or "").encode()
        size.setdefault(i, set()).add((len(data) + 8, zlib.crc32(data)))
    for r in got:
        assert (r["size"], r["text_crc32"]) in size[r["doc_id"]]
        by_text[r["text_crc32"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        bytes_of[r["shard"]] += r["size"]
        assert 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if group_whole:
        assert all(len(s) == 1 for s in by_text.values())
    return [bytes_of[s] for s in range(shards)]


def test_shards_are_even_and_groups_stay_whole(spark, many_partitions):
    draw = random.Random(2)
    texts = ["t" * draw.randrange(1, 400) + str(i) for i in range(900)]
    rows = [doc(i, texts[draw.randrange(900)]) for i in range(3000)]
    loads = check_shards(rows, assign_shards(frame(spark, rows).repartition(6), 5).collect(), 5)
    assert max(loads) - min(loads) < 0.02 * max(loads)


def test_a_group_larger_than_a_shard_is_divided(spark, many_partitions):
    rows = [doc(i, "copy " * 50) for i in range(2000)] + [doc(5000 + i, f"text {i} " * 30) for i in range(2000)]
    loads = check_shards(rows, assign_shards(frame(spark, rows), 6).collect(), 6, group_whole=False)
    assert max(loads) - min(loads) < 0.05 * max(loads)


def test_groups_that_fit_in_a_shard_stay_whole(spark, many_partitions):
    rows = [doc(1000 * g + i, f"copy {g} " * 30) for g, n in enumerate((900, 700, 500, 300)) for i in range(n)]
    rows += [doc(9000 + i, f"text {i} " * 25) for i in range(4000)]
    loads = check_shards(rows, assign_shards(frame(spark, rows), 6).collect(), 6)
    assert max(loads) - min(loads) < 0.02 * max(loads)


def test_the_query_divides_no_group_that_fits(spark, sf_dir):
    got = op7_shards(spark, sf_dir).collect()
    copies = defaultdict(list)
    for r in got:
        copies[r["size"], r["text_crc32"]].append(r)
    capacity = -(-sum(r["size"] for r in got) // sharding.SHARDS)
    assert all(len({r["shard"] for r in rs}) == 1 for rs in copies.values() if sum(r["size"] for r in rs) <= capacity)


def test_shards_of_odd_rows(spark):
    rows = odd_documents()
    df = clashing(frame(spark, rows)).drop("size", "shard")
    check_shards(rows, assign_shards(df, 3).collect(), 3, group_whole=False)
    assert assign_shards(frame(spark, []), 3).collect() == []


def test_shard_query_and_files(spark, sf_dir):
    got = op7_shards(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check_shards([(r["doc_id"], r["text"]) for r in docs.collect()], got, 24, group_whole=False)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    path = new_path(spark, "shards")
    sharding.write_shards(docs, assign_shards(docs, 4), path)
    written = spark.read.parquet(path)
    assert written.count() == docs.count() and {r[0] for r in written.select("shard").distinct().collect()} == {0, 1, 2, 3}


def targets_by_hand(sizes):
    """Water filling by plain loops: sizes per source in code point order."""
    weights = dict(zip(sizes, [5, 2, 1] * len(sizes)))
    budget, full, target = 1.5 * sum(sizes.values()), set(), {}
    while True:
        left = budget - sum(2 * sizes[s] for s in full)
        whole = sum(weights[s] for s in sizes if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else left * weights[s] / whole for s in sizes}
        new = {s for s in sizes if s not in full and target[s] > 2 * sizes[s]}
        if not new:
            return target
        full |= new


@pytest.mark.parametrize("seed", range(3))
def test_the_mix_meets_its_targets(spark, many_partitions, seed):
    draw = random.Random(seed)
    rows = [doc(i, "w " * draw.randrange(1, 20), draw.choice(["b", "a", "a", "a", "é", None, "Z"])) for i in range(1500)]
    got = mixing.mix(frame(spark, rows).repartition(4)).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    ordered = {s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))}
    target, taken = targets_by_hand(ordered), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 40 for s in sizes)
    again = mixing.mix(frame(spark, rows).repartition(7))
    assert rows_of(again) == sorted((tuple(r) for r in got), key=str)


def test_mix_of_odd_rows(spark):
    rows = odd_documents()
    got = mixing.mix(clashing(frame(spark, rows)).drop("size", "taken")).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r[0]), len(words(r[1]))) for r in rows)
    taken = mixing.take(frame(spark, rows))
    assert taken.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert taken.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r["taken"] for r in got)


def test_mix_without_words_and_without_rows(spark):
    got = mixing.mix(frame(spark, [doc(1, ""), doc(2, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2
    assert mixing.mix(frame(spark, [])).collect() == []
    assert mixing.take(frame(spark, [])).collect() == []


def test_mix_runs_without_python(spark, sf_dir):
    plan = op8_mix(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
