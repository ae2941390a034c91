"""Splits and resamples that depend on the rows' keys and the seed alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.operators.ranking import follows, global_rank, order_statistics


def _ticket(id_cols: Sequence[str], seed: int):
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols], F.lit(str(seed))))


def stratified_split(
    df: DataFrame, label: str, id_cols: Sequence[str], test: float = 0.25, seed: int = 42
) -> DataFrame:
    """Adds `is_test`: in every class the first floor(test * size) rows in hash order.

    The last test row of each class is looked up; marking the rows is a comparison. `df` is
    read twice and should be a written table.
    """
    hashed = df.withColumn("_ticket", _ticket(id_cols, seed))
    order = [("_ticket", True)] + [(c, True) for c in id_cols]

    def last_test_row(n: int) -> list[int]:
        return [int(n * test)] if int(n * test) else []

    ends = order_statistics(hashed, order, last_test_row, by=label)
    in_test = F.lit(False)
    for value, rows in ends.items():
        for row in rows:
            in_test = in_test | ((F.col(label) == F.lit(value)) & ~follows(order, row))
    return hashed.withColumn("is_test", in_test.cast("int")).drop("_ticket")


def upsample_minority(
    df: DataFrame, label: str, id_cols: Sequence[str], minority: int = 1, seed: int = 42
) -> DataFrame:
    """All rows of the other class, and as many drawn with replacement from `minority`.

    Minority rows are numbered in key order; draw i takes row number hash(i, seed) modulo
    their count. The numbers are spread evenly, so the join on them has no hot key. Adds
    `draw`, null for rows that were not drawn.
    """
    few, many = df.where(F.col(label) == minority), df.where(F.col(label) != minority)
    sizes = df.agg(
        F.count_if(F.col(label) == minority).alias("few"), F.count_if(F.col(label) != minority).alias("many")
    ).first()
    numbered = global_rank(few, [(c, True) for c in id_cols], "_number")
    if not sizes["few"]:
        return many.withColumn("draw", F.lit(None).cast("bigint"))
    # 15 hex digits stay below 2^63.
    digits = F.substring(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(str(seed)))), 1, 15)
    draws = df.sparkSession.range(sizes["many"]).select(
        F.col("id").alias("draw"),
        (F.conv(digits, 16, 10).cast("bigint") % sizes["few"] + 1).alias("_number"),
    )
    sample = numbered.join(draws, "_number").drop("_number")
    return many.withColumn("draw", F.lit(None).cast("bigint")).unionByName(sample)
