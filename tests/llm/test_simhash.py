import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import clashing, doc, frame, odd_documents, words
from patronlens.llm import simhash
from patronlens.llm.queries import op4_simhash
from patronlens.llm.simhash import covering_masks, fingerprint_links, keep_representatives, simhash_classes


def print_by_hand(text):
    ws = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    runs = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_by_hand(prints, radius=2):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in itertools.combinations(parent, 2):
        if (a ^ b).bit_count() <= radius:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {p: root(p) for p in parent}


def test_every_pair_within_the_radius_meets_in_some_table():
    for radius in (2, 4):
        masks = covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1 and len(set(masks)) == len(masks)
        for bits in itertools.combinations(range(64), 2):
            assert any(m & (1 << bits[0] | 1 << bits[1]) == 0 for m in masks)
    draw = random.Random(1)
    for _ in range(3000):
        bits = sum(1 << b for b in draw.sample(range(64), 4))
        assert any(m & bits == 0 for m in covering_masks(4))


@pytest.mark.parametrize("paired", [64, 1])
def test_links_connect_what_is_near_and_nothing_else(spark, many_partitions, paired):
    draw = random.Random(paired)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        at = draw.getrandbits(64)
        for _ in range(draw.randrange(1, 12)):
            prints.add(at)
            at ^= sum(1 << b for b in draw.sample(range(64), draw.randrange(1, 5)))
    signed = [(simhash._signed(p),) for p in prints]
    links = fingerprint_links(spark.createDataFrame(signed, "fp bigint"), paired=paired).collect()
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 2 for r in links)
    found = {p: p for p in prints}

    def root(p):
        while found[p] != p:
            p = found[p]
        return p

    for r in links:
        x, y = sorted(root(v & (1 << 64) - 1) for v in (r["a"], r["b"]))
        found[y] = x
    assert {p: root(p) for p in prints} == classes_by_hand(prints)


def expected(rows):
    prints = [print_by_hand(r[1]) for r in rows]
    roots = classes_by_hand(set(prints))
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[roots[p]] = min(least.get(roots[p], r[0]), r[0])
    return sorted(((r[0], f"{p:016x}", least.get(roots[p])) for r, p in zip(rows, prints)), key=str)


def test_classes_of_odd_rows(spark):
    rows = odd_documents() + [doc(20, "THE Quick " * 9), doc(21, "the quick " * 9), doc(22, "two words"), doc(23, "one")]
    found = simhash_classes(clashing(frame(spark, rows)).drop("fp", "root"))
    got = sorted(((r["doc_id"], r["f"], r["component_id"]) for r in found.withColumn("f", simhash.hexadecimal(F.col("fp"))).collect()), key=str)
    assert got == expected(rows)


def test_query_agrees_with_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op4_simhash(spark, sf_dir).collect()), key=str) == expected(rows)


def test_long_chains_are_one_component(spark):
    from patronlens.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 1999)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(1, 301)} | {2000: 1999}


def test_one_row_of_each_component_stays(spark):
    rows = odd_documents()
    kept = keep_representatives(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = {c for _, _, c in expected(rows)}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len({print_by_hand(r[1]) for r in rows} and classes_by_hand({print_by_hand(r[1]) for r in rows}).values() and set(classes_by_hand({print_by_hand(r[1]) for r in rows}).values()))
    assert {i for i in ids} == want


def test_empty_table(spark):
    assert simhash_classes(frame(spark, [])).collect() == []
    assert keep_representatives(frame(spark, [])).collect() == []


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        fingerprint_links(spark.createDataFrame([(1,)], "fp bigint"), radius=3)
