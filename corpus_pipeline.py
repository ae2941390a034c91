"""From raw documents to encoded training text: quality, near duplicates, secrets, mix, tokens.

Every stage is (name, function of (spark, docs, sf_dir)). `run` writes each result to the shared
folder and reads it again as the next one's documents; so do other drivers of `STAGES`.
All stages but the last return the columns of their documents.

Defined cases: each stage states its own for nulls, empty texts and repeated rows; an empty table goes
through all stages and gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import bpe, mixing, quality, secrets, simhash
from patronlens.llm.queries import table, vocabulary
from patronlens.workspace import materialize


def keep_good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_representatives(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by its kind, and n_chars follows. Documents without a secret stay as they are."""
    # The document goes along as one struct, so that its columns cannot clash with others.
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text"))
    marked = marked.withColumn("row", F.xxhash64("doc"))
    found = secrets.scan_secrets(marked, ["row"]).where(F.size("spans") > 0)
    # Equal rows have one path: their findings are the same.
    found = found.groupBy("row", "blob_id").agg(F.first("spans").alias("spans"))
    joined = marked.withColumn("blob_id", secrets.blob_id(F.col("text"))).join(found, ["row", "blob_id"], "left")
    clean = secrets.redacted(F.col("text"), F.col("spans"))
    doc = F.col("doc").withField("text", clean)
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.length(clean).cast(docs.schema["n_chars"].dataType))
    return joined.select(F.when(F.col("spans").isNull(), F.col("doc")).otherwise(doc).alias("doc")).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids and their digests; decoding the ids gives the text of `decoded_sha256`."""
    path = vocabulary()
    return docs.select("doc_id", "source", bpe.encoded_column(F.col("text"), path, with_ids=True).alias("_e")).select("doc_id", "source", "_e.*")


STAGES = [
    ("quality_rules", keep_good_texts),
    ("simhash_near_dedup", keep_one_of_each),
    ("secret_scan", redact_secrets),
    ("source_mix", mix_sources),
    ("bpe_encoding", encode),
]

# The line field is fitted and the tokens need a merge loop: neither is expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
