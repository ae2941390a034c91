import hashlib
import zlib

import pytest

from helpers import clashing, doc, frame, odd_documents
from patronlens.llm import merkle
from patronlens.llm.queries import op13_merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row):
    i, text, lang, source, n = row
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def tree_by_hand(nodes, fanout):
    """The root, and for every node the (before, after) of each level."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at:at + fanout]
            for i in range(len(run)):
                for m in members[at + i]:
                    paths[m].append(("".join(run[:i]), "".join(run[i + 1:])))
            above.append(h(*run))
            held.append(sum(members[at:at + fanout], []))
        nodes, members = above, held
    return nodes[0], paths


def by_hand(rows, fanout=2):
    parts = {}
    for row in rows:
        parts.setdefault(row[2], []).append(row)
    langs = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for lang in langs:
        parts[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_by_hand(r)))
        trees[lang] = tree_by_hand([leaf_by_hand(r) for r in parts[lang]], fanout)
    root, over = tree_by_hand([trees[lang][0] for lang in langs], fanout) if langs else (None, [])
    out = []
    for lang, top in zip(langs, over):
        for row, path in zip(parts[lang], trees[lang][1]):
            whole = path + top
            now = leaf_by_hand(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                now = leaf_by_hand((*row[:4], row[4] + 1))
            tampered = now != leaf_by_hand(row)
            for before, after in whole:
                now = h(before, now, after)
            assert tampered == (now != root)
            out.append((row[0], leaf_by_hand(row), trees[lang][0], root, h(*[s for step in whole for s in step]), now, now == root))
    return sorted(out, key=str)


def found(df, fanout=2):
    proved = merkle.manifest(df, carry={"forged": merkle.tampered_leaf()}, fanout=fanout)
    checked = merkle.verify(proved).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in checked.collect()), key=str)


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_trees_of_many_sizes(spark, many_partitions, fanout):
    sizes = {"a": 1, "b": 2, "c": 3, "d": 16, "e": 17, "f": 33, "": 5, None: 4, "é": 260, "z": 31}
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i, f"text {i % 5}", lang, "s", i % 3 or None))
    assert found(frame(spark, rows).repartition(7), fanout) == by_hand(rows, fanout)


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_documents() + [(None, None, None, None, None)] * 40
    assert found(clashing(frame(spark, rows))) == by_hand(rows)


def test_one_part_and_one_row(spark):
    assert found(frame(spark, [doc(7, "alone")])) == by_hand([doc(7, "alone")])
    rows = [doc(i, "x" * i) for i in range(1, 70)]
    got = found(frame(spark, rows))
    assert got == by_hand(rows) and any(not r[-1] for r in got) and all(r[2] == r[3] for r in got)


def test_empty_table(spark):
    assert found(frame(spark, [])) == []


def test_query_agrees_with_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op13_merkle(spark, sf_dir).collect()), key=str) == by_hand(rows)
