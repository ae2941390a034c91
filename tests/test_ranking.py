import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronlens.operators.ranking import global_rank, quantile_score, quantile_scores, running_totals


def frame(spark, values):
    rows = [(f"C{i:05d}", v) for i, v in enumerate(values)]
    random.Random(len(rows)).shuffle(rows)
    return spark.createDataFrame(rows, "customer_id string, value double")


def binned(values, k, ascending):
    """Equal-count bins over unique ranks, ties in order of appearance."""
    ranks = pd.Series(values).rank(method="first", ascending=ascending)
    return pd.qcut(ranks, k, labels=range(1, k + 1)).astype(int).tolist()


@pytest.mark.parametrize("n", [2, 4, 6, 7, 8, 9, 10, 23, 101])
@pytest.mark.parametrize("ascending", [True, False])
def test_scores_equal_quantile_bins(spark, many_partitions, n, ascending):
    values = [float(random.Random(n * 7 + i).randint(0, max(1, n // 3))) for i in range(n)]
    scored = quantile_score(frame(spark, values), "value", 5, "score", ascending)
    got = [r["score"] for r in scored.orderBy("customer_id").collect()]
    assert got == binned(values, 5, ascending)


def test_single_row_and_nulls(spark):
    one = quantile_score(frame(spark, [3.0]), "value", 5, "score").first()
    assert one["score"] == 1
    mixed = quantile_score(frame(spark, [5.0, None, 1.0]), "value", 4, "score")
    assert {r["customer_id"]: r["score"] for r in mixed.collect()} == {
        "C00000": 4, "C00001": None, "C00002": 1,
    }
    empty = quantile_score(frame(spark, [3.0]).limit(0), "value", 5, "score")
    assert empty.count() == 0


def test_several_values_at_once_with_a_hot_value(spark, many_partitions):
    n = 3000
    df = spark.range(n).select(
        F.format_string("C%06d", "id").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17).alias("few"),
        (F.col("id") * 7919 % 100003).cast("decimal(18,2)").alias("many"),
    )
    scored = quantile_scores(df, {"a": ("few", False), "b": ("many", True)}, 5)
    got = scored.orderBy("customer_id").toPandas()
    assert got["a"].tolist() == binned(got["few"].tolist(), 5, False)
    assert got["b"].tolist() == binned(got["many"].astype(float).tolist(), 5, True)
    sizes = got["a"].value_counts()
    assert sizes.max() - sizes.min() <= 1


def test_global_rank_and_running_totals(spark, many_partitions):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("key"), (F.col("id") % 7).alias("x"))
    ranked = global_rank(df, [("key", False)]).collect()
    assert {r["key"]: r["rank"] for r in ranked} == {k: 500 - k for k in range(500)}
    rows = running_totals(df, [("key", True)], {"upto": "x"}).orderBy("key").collect()
    total = 0
    for row in rows:
        total += row["x"]
        assert row["upto"] == total
    assert {r["upto_total"] for r in rows} == {total}
