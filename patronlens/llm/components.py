"""Connected components of a link table by alternating large and small stars.

Every round is written to the shared folder; the driver sees one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.workspace import materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """`links` has bigint columns a and b; returns (node, root) for every linked node but the roots."""
    now = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
        check = now.agg(F.count("*").alias("n"), F.sum(mixed).alias("sum")).first()
        if check == seen or check["n"] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = check
        large = _large_star(now).where("a <> b").distinct()
        now = materialize(_small_star(large).where("a <> b").distinct(), "links")
