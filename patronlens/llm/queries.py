"""One query per operator over its whole table, in the layout of the test inputs."""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import bpe, chat, filter_audit, graph_search, licenses, merkle, minhash, mixing, quality, secrets, sharding, simhash, substring


def vocabulary() -> str:
    """The place of the word vocabulary on this machine; executors read it from the same place."""
    return importlib.import_module("public_tokenizers").path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the inputs. Python workers get this package's folder, wherever the driver was started."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", bpe.encoded_column(F.col("text"), vocabulary()).alias("_e")).select("doc_id", "_e.*")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.listed(chat.rotate(table(spark, sf_dir, "conversations")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.simhash_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.search_table(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return assigned.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = minhash.minhash_classes(table(spark, sf_dir, "documents"))
    return classes.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = filter_audit.failure_cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(cells)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = merkle.manifest(table(spark, sf_dir, "documents"), carry={"forged": merkle.tampered_leaf()})
    return merkle.verify(proved).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secrets, op2_bpe, op3_chat, op4_simhash, op5_neighbours,
        op6_substrings, op7_shards, op8_mix, op9_quality, op10_licenses,
        op11_minhash, op12_filter_audit, op13_merkle,
    )
}
