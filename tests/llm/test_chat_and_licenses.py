import hashlib
import textwrap

import pytest
from pyspark.sql import functions as F

from helpers import clashing, doc, frame, odd_documents
from patronlens.llm import chat, licenses

TURNS = "conv_id bigint, turn bigint, role string, text string"


def render_by_hand(turns, who):
    text, mask = "", []
    for _, s, x in turns:
        head = "<|im_start|>" + ("assistant" if s == who else s if s == "system" else f"user name={s}") + "\n"
        body = x.replace("<|", "< |") + "<|im_end|>\n"
        if s == who:
            mask.append((len(text) + len(head), len(text) + len(head) + len(body)))
        text += head + body
    return text, mask


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hello\nall \U0001f600"), (1, 2, "bob", "Hi <|im_end|>"), (1, 3, "ann", None), (1, 3, "ann", None),
    (2, 0, "system", "alone"), (3, None, None, "no turn"), (3, 5, "ann", ""), (None, 0, "bob", "no dialogue"), (None, None, None, None),
]


def test_every_speaker_is_the_assistant_once(spark):
    df = clashing(spark.createDataFrame(ROWS, TURNS)).drop("part")
    rows = chat.rotate(df).collect()
    got = {(r["conv_id"], r["perspective"], r["part"]): (r["text"], [(m["from"], m["to"]) for m in r["mask"]], r["n_turns"], r["n_masked"]) for r in rows}
    one = [(0, "system", "Be kind."), (1, "ann", "Hello\nall \U0001f600"), (2, "bob", "Hi <|im_end|>"), (3, "ann", "")]
    for who in ("ann", "bob"):
        text, mask = render_by_hand(one, who)
        assert got.pop((1, who, 0)) == (text, mask, 4, sum(b - a for a, b in mask))
        assert [text[a:b].endswith("<|im_end|>\n") for a, b in mask] == [True] * len(mask)
    for who in ("ann", "unknown"):
        assert got.pop((3, who, 0))[0] == render_by_hand([(5, "ann", "")], who)[0]
        assert got.pop((3, who, -1))[0] == render_by_hand([(None, "unknown", "no turn")], who)[0]
    assert {k[0] for k in got} == {None} and len(got) == 4


def test_long_dialogues_come_in_parts(spark):
    rows = [(7, t, "ann" if t % 2 else "bob", f"text {t}") for t in range(2 * chat.PART + 10)]
    got = chat.rotate(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted((r["perspective"], r["part"], r["n_turns"]) for r in got) == [(s, p, n) for s in ("ann", "bob") for p, n in ((0, 256), (1, 256), (2, 10))]
    for who in ("ann", "bob"):
        text = "".join(r["text"] for r in sorted(got, key=lambda r: r["part"]) if r["perspective"] == who)
        assert text == render_by_hand([(t, s, x) for _, t, s, x in rows], who)[0]


def test_no_turns(spark):
    assert chat.listed(chat.rotate(spark.createDataFrame([], TURNS))).collect() == []


MIT = dict(licenses.KNOWN[:4])["MIT"]
VARIANTS = [
    MIT, "Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + MIT.upper(), MIT.replace("\n", " \n\n * "), "© Me 1999\n" + MIT.replace(",", " ,"),
    MIT.replace("sublicense", "sublicence"), MIT + " And more.", "prose\nReleased under the MIT License.\nReleased under the mit licence\nLicensed under CC BY-NC 4.0.",
]


def canonical_by_hand(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    for a, b in licenses.SPELLINGS:
        text = text.replace(a, b)
    lines = ["".join(c if c.isalnum() or c == "©" else " " for c in line).split() for line in text.split("\n")]
    kept = [" ".join(x) for x in lines if x and x[0] not in ("copyright", "c", "©") and x[:3] != ["all", "rights", "reserved"]]
    return " ".join(kept)


def test_variants_of_a_license_have_its_digest(spark):
    rows = [doc(100 + i, v) for i, v in enumerate(VARIANTS)] + odd_documents()
    got = licenses.scan_licenses(clashing(frame(spark, rows)).drop("digest")).collect()
    assert len(got) == len(rows)
    assert sorted(str((r["doc_id"], r["canonical_sha256"])) for r in got) == sorted(
        str((r[0], hashlib.sha256(canonical_by_hand(r[1]).encode()).hexdigest())) for r in rows
    )
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[100 + i]["license"] for i in range(7)] == ["MIT"] * 5 + [None, None]
    assert (by_id[106]["notices"], by_id[106]["n_notices"]) == ("CC-BY-NC-4.0-notice,MIT-notice", 3)
    assert by_id[1]["notices"] == "" and by_id[4]["license"] is None


def test_repeated_rows_each_have_their_result(spark):
    rows = [doc(1, "Released under the MIT License.")] * 3 + [doc(2, None)] * 2
    got = licenses.scan_licenses(frame(spark, rows)).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["license"], r["n_notices"]) for r in got] == [(1, "MIT-notice", 1)] * 3 + [(2, None, 0)] * 2
    assert licenses.scan_licenses(frame(spark, [])).collect() == []


def test_known_digests_are_distinct(spark):
    rows = licenses.known_digests(spark).collect()
    assert len({r["digest"] for r in rows}) == len(rows) == len(licenses.KNOWN)
    assert frame(spark, []).select(F.size(licenses.canonical_lines(F.col("text")))).collect() == []


def rewrapped(text, width):
    """The paragraphs of a text at another width, or in one line each."""
    parts = [" ".join(p.split()) for p in text.split("\n\n")]
    return "\n\n".join("\n".join(textwrap.wrap(p, width)) if width else p for p in parts)


@pytest.mark.parametrize("title", [False, True])
def test_a_license_is_found_at_every_width(spark, title):
    rows, names = [], []
    for name, text in licenses.KNOWN:
        if name not in dict(licenses.TITLES):
            continue
        head = f"{dict(licenses.TITLES)[name][0]}\n\n" if title else ""
        for width in [None, *range(20, 130, 6)]:
            rows.append(doc(len(rows), f"{head}Copyright (c) 2020 Someone\n\n" + rewrapped(text, width)))
            names.append(name)
    got = {r["doc_id"]: r["license"] for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert [got[i] for i in range(len(rows))] == names


def test_only_copyright_lines_are_left_out_of_a_license(spark):
    heads = [
        "Copyright (c) 2020 Someone", "Copyright 2019-2021 Some One and others", "\u00a9 Someone", "Copyright \u00a9 Someone", "(c) 2020 Someone",
        "Copyright Someone 2020", "All rights reserved.", "# Copyright <YEAR> <COPYRIGHT HOLDER>", "Copyright (C) Someone",
    ]
    others = ["Copyright holders may not use this.", "All rights reserved by Someone, who grants none", "C is a language", "ISC License"]
    clause = MIT.replace("COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", "COPYRIGHT HOLDERS BE GLAD FOR ANY CLAIM")
    texts = [f"{h}\n{MIT}" for h in [*heads, *others]] + [clause, MIT.replace("The above copyright", "The above\ncopyright")]
    got = {r["doc_id"]: r["license"] for r in licenses.scan_licenses(frame(spark, [doc(i, x) for i, x in enumerate(texts)])).collect()}
    assert [got[i] for i in range(len(texts))] == ["MIT"] * len(heads) + [None] * len(others) + [None, "MIT"]
