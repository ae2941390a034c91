"""Small tables with the cases every operator must take: nulls, empty and long texts, ties, repeats, odd columns."""

import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def doc(i, text, source="src0", lang="en"):
    return (i, text, lang, source, None if text is None else len(text))


def odd_documents():
    """Nulls in every column, empty and blank texts, a long one, equal rows, one id twice."""
    prose = "the quick brown fox jumps over the lazy dog near the old river bank while seven small birds sing"
    long = " ".join(f"w{i % 997}x{i // 997}" for i in range(30_000))
    return [
        doc(1, prose), doc(2, prose), doc(2, prose), doc(3, None), doc(4, ""), doc(5, " \t\n\x0b\x0c\r "),
        doc(6, long, None), (None, prose + " again", None, None, None), (7, "one\x1ctwo three", None, "src1", 5),
        doc(8, "token = abcdef1234 and AKIA" + "A" * 16 + " \U0001f600 " + "0123456789abcdef" * 2, "src2"), doc(8, "another text of the same id"),
        (None, None, None, None, None),
    ]


def clashing(df):
    """The same rows with more columns, named like those that operators make."""
    from pyspark.sql import functions as F

    names = ["blob_id", "spans", "fp", "root", "size", "shard", "unit", "place", "kept", "digest", "_row", "_key", "_text", "_n", "node", "taken", "part"]
    return df.withColumns({n: F.lit("x") for n in names})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
