import hashlib
import re

import pytest
from pyspark.sql import functions as F

from helpers import DOCS, clashing, doc, frame, odd_documents, rows_of
from patronlens.llm import secrets
from patronlens.llm.queries import op1_secrets
from patronlens.workspace import new_path

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def spans_by_hand(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


TEXTS = [
    "secret=token: abcdefgh", "token==abcdefg token:'a' api-key=zzzzzzzz API_KEY = \"AbCdEf/+=\"", "password" * 3 + "=123456",
    "x" * 5 + "AKIA" + "B" * 15 + " AKIAAKIA" + "C" * 20, "é\U0001f600 secret : 0123456789abcdef0123456789abcdef é", "abcdef" * 4 + "g" + "abcdef" * 3,
    "ſecret=abcdefgh toKen=abcdefgh", "PASSWD='hunter22'" * 300, "token=\ntoken=12345 passwd=123456",
]


def by_hand(rows):
    out = []
    for i, text, *_ in rows:
        spans = spans_by_hand(text)
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(k == kind for k, *_ in spans) for kind in ("assign", "access", "hex")]
        out.append((i, *counts, hashlib.sha256(said.encode()).hexdigest(), said))
    return sorted(out, key=str)


def test_spans_agree_with_a_scan_by_hand(spark):
    rows = odd_documents() + [doc(100 + i, t) for i, t in enumerate(TEXTS)]
    df = clashing(frame(spark, rows).drop("spans"))
    assert rows_of(secrets.digests(secrets.scan_secrets(df))) == by_hand(rows)


def test_empty_table(spark):
    assert secrets.digests(secrets.scan_secrets(frame(spark, []))).collect() == []


def test_the_ledger_scans_only_what_is_new(spark):
    ledger = new_path(spark, "test-ledger")
    first = frame(spark, [doc(1, TEXTS[0]), doc(2, TEXTS[0]), doc(3, "clean")])
    assert {len(r["spans"]) for r in secrets.scan_secrets(first, ledger=ledger).collect()} == {0}
    stored = lambda: spark.read.parquet(ledger)
    assert stored().count() == 2 * 3
    secrets.scan_secrets(first, ledger=ledger).collect()
    assert stored().count() == 2 * 3
    second = frame(spark, [doc(1, TEXTS[4]), doc(3, "clean")])
    assert sum(len(r["spans"]) for r in secrets.scan_secrets(second, ledger=ledger).collect()) == 2
    assert stored().count() == 3 * 3
    newer = (*secrets.RULES[:2], secrets.Rule("hex", 2, "[0-9a-f]{8,}", 8))
    found = secrets.scan_secrets(first, ledger=ledger, rules=newer)
    assert stored().where("kind = 'hex' and version = 2").count() == 2
    assert stored().count() == 3 * 3 + 2
    assert found.select(F.sum(F.size("spans"))).first()[0] == 0


def test_several_path_columns(spark):
    df = spark.createDataFrame([("a", 1, TEXTS[4]), ("a", 2, TEXTS[4]), (None, None, TEXTS[4])], "path string, version int, body string")
    found = secrets.scan_secrets(df, ["path", "version"], "body").collect()
    assert sorted((str(r["path"]), len(r["spans"])) for r in found) == [("None", 2), ("a", 2), ("a", 2)]


def test_redaction_covers_overlaps(spark):
    text = TEXTS[4]
    found = secrets.scan_secrets(frame(spark, [doc(1, text)])).select(secrets.redacted(F.lit(text), F.col("spans"))).first()[0]
    assert found == "é\U0001f600 [assign] é"


def test_query_runs_without_python(spark, sf_dir):
    df = op1_secrets(spark, sf_dir)
    assert not any(word in df._jdf.queryExecution().toString() for word in ("Python", "Arrow", "Pandas"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.schema(DOCS).parquet(f"{sf_dir}/documents.parquet").collect()}
    assert rows_of(df) == by_hand([(i, t) for i, t in texts.items()])


def test_pattern_needs_a_known_group():
    with pytest.raises(TypeError):
        secrets.Rule("x")
